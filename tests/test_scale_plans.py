"""Chains over ranges, the as-of index, hot windows, bounded model state."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import joins as J
from tidewater.operators import timewindows as TW
from tidewater.plans import sequence as S
from tidewater.session import scratch_path
from tidewater.sinks.versions import committed, newest_before
from tidewater.streaming.runner import replay_as_files


@pytest.mark.parametrize("partitions", [1, 3, 25])
@pytest.mark.parametrize("width", [1, 40, 100_000])
def test_chains_follow_a_key_through_its_ranges(spark, partitions, width):
    rng = random.Random(6)
    rows = []
    for key, size in [("hot", 900), ("a", 40), ("b", 1), ("c", 3)]:
        x = 0
        for n in range(size):
            x += rng.choice([0, 1, 2, 7, 60])
            rows.append((key, x, n + 1))
    want = set()
    for key in ("hot", "a", "b", "c"):
        target = None
        for k, x, n in rows:
            if k == key and (target is None or x >= target):
                want.add((k, n))
                target = x + width
    df = spark.createDataFrame(rows, "k string, x long, n long").repartition(7)
    got = S.chain_reached(df, ["k"], "x", "n", width, partitions).collect()
    assert len(got) == len(want) and {(r.k, r.n) for r in got} == want
    assert S.chain_reached(df.limit(0), ["k"], "x", "n", width, partitions).count() == 0


def test_models_far_apart_cost_nothing(spark):
    """Three models 200 days apart: no interval is cut into pieces."""
    models = spark.createDataFrame([(0, "a"), (200, "b"), (400, "c")], "day long, m string") \
        .select(F.timestamp_seconds(F.col("day") * 86400 + 5).alias("mts"), "m")
    data = spark.createDataFrame([(1, 0), (2, 6), (3, 200 * 86400 + 5), (4, 10 ** 9), (5, None)], "i long, s long") \
        .withColumn("ts", F.timestamp_seconds("s"))
    for broadcast in (None, True, False):
        got = J.asof_backward(data, "ts", models, "mts", broadcast=broadcast).select("i", "m").collect()
        assert sorted(map(tuple, got)) == [(1, None), (2, "a"), (3, "b"), (4, "c"), (5, None)]
    assert J.asof_backward(data, "ts", models.limit(0), "mts").filter("m is not null").count() == 0


def test_heavy_keys_are_found_within_their_bound(spark):
    rng = random.Random(7)
    rows = [("hot", 1)] * 400 + [(None, 2)] * 150 + [(f"k{rng.randrange(5000)}", rng.randrange(3)) for _ in range(650)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, w int").repartition(5)
    got = {(r.k, r.w) for r in TW.heavy_keys(df, ["k", "w"], 0.1, counters=20).collect()}
    share = {x: n / len(rows) for x, n in Counter(rows).items()}
    assert {x for x, s in share.items() if s > 0.1} <= got and len(got) <= 20
    assert TW.heavy_keys(df.limit(0), ["k", "w"], 0.1).count() == 0


def test_hot_window_is_dealt_over_tasks(spark):
    rng = random.Random(8)
    left = [(i, "hot" if i % 3 else f"k{rng.randrange(200)}", 1 if i % 3 else rng.randrange(100)) for i in range(3000)]
    right = [(i, "hot" if i % 10 == 0 else f"k{rng.randrange(200)}", 1 if i % 10 == 0 else rng.randrange(100)) for i in range(200)]
    a = spark.createDataFrame(left, "i long, k string, s long").withColumn("lt", F.timestamp_seconds("s")).drop("s")
    b = spark.createDataFrame(right, "j long, k string, s long").withColumn("rt", F.timestamp_seconds("s")).drop("s")
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = TW.window_join(a, b, "k", "lt", "rt", "2 seconds")
        rows = out.select("k", "i", "j", F.spark_partition_id().alias("p")).collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    want = sorted((x[1], x[0], y[0]) for x in left for y in right if x[1] == y[1] and x[2] // 2 == y[2] // 2)
    assert sorted((r.k, r.i, r.j) for r in rows) == want
    size = Counter(r.p for r in rows)
    assert len(size) == 8 and max(size.values()) < 2 * np.median(list(size.values()))


def test_model_state_is_bounded(spark):
    """1,000 windows: the state keeps the last few, the answers are the batch's."""
    e = spark.range(4000).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 15).alias("ts"),
                                 (F.col("id") % 17).cast("double").alias("value"))
    models = TW.tumble(e, [], "ts", "60 seconds", [F.round(F.avg("value"), 6).alias("prediction")]) \
        .select(F.col("window_end").alias("model_ts"), "prediction")
    want = J.asof_backward(e, "ts", models, "model_ts").select("event_id", "model_ts", "prediction")
    src = replay_as_files(spark, e, "event_id", 4, scratch_path(spark, "models-replay"), files=1)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out, state = scratch_path(spark, "pred"), scratch_path(spark, "models")
    J.latest_model_predict_stream(stream, "event_id", "ts", "value", 60, out, state, scratch_path(spark, "ckpt")).awaitTermination()
    got = spark.read.parquet(out).select("event_id", "model_ts", "prediction")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.read.parquet(newest_before(spark, state, 10 ** 6)).count() <= 4
    assert len(committed(spark, state)) <= 3


def test_running_wordcount_writes_documents_not_tokens(spark):
    """Its last plan splits the text of written document ranges."""
    import __spark_entry__ as E
    plan = E.queries()["running_wordcount"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(split(lower" in plan


def test_running_wordcount_shuffles_and_joins_no_token(spark, tmp_path):
    """Words are counted on over ranges; null and repeated ids count by (id, pos)."""
    import re
    from collections import Counter
    from tidewater.plans.keyedqueries import running_wordcount
    rows = [(i, f"A b{i % 3} a, \u0130a;{'the ' * (i % 5)}") for i in range(300)] + [(None, "a the A"), (7, "b1 a"), (400, None), (401, " ;")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    df = running_wordcount(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and len(re.findall("Exchange ", plan)) == 1 and plan.index("Generate") < plan.index("Exchange ")
    tokens = [(i, p, w) for i, t in rows for p, w in enumerate(re.split(r"\W+", (t or "").lower(), flags=re.ASCII)) if w]
    seen, want = Counter(), []
    for i, p, w in sorted(tokens, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        seen[w] += 1
        want.append((str(i), p, w, seen[w]))
    assert sorted((str(r.doc_id), r.pos, r.word, r.cnt) for r in df.collect()) == sorted(want)


def test_running_count_with_a_written_carry(spark):
    rows = [(k, i, i // 7) for k in ("a", "b", None) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, i int, b int").repartition(5)
    got = S.running_agg(df, ["k"], ["i"], F.col("b"), [("n", F.lit(1), "count"), ("m", "i", "max")], write_carry=True)
    assert sorted((str(r.k), r.i, r.n, r.m) for r in got.collect()) == sorted((str(k), i, i + 1, i) for k, i, _ in rows)


def test_first_at_or_after_brings_columns_along(spark):
    points = spark.createDataFrame([("a", 5, 1, "x"), ("a", 5, 2, "y"), ("a", 9, 3, None), ("b", 1, 1, "z")],
                                   "k string, t long, n long, v string")
    asks = spark.createDataFrame([("a", i, i) for i in (0, 5, 6, 9, 10)] + [("b", 1, 1), ("c", 1, 1)], "k string, x long, id int")
    got = S.first_at_or_after(points, asks, ["k"], "t", "n", "x", carry=["v"]).collect()
    assert sorted((r.k, r.id, r.first_n, r.v) for r in got if r.first_n) == [
        ("a", 0, 1, "x"), ("a", 5, 1, "x"), ("a", 6, 3, None), ("a", 9, 3, None), ("b", 1, 1, "z")]
    assert {(r.k, r.id) for r in got if r.first_n is None} == {("a", 10), ("c", 1)}


def test_token_variants_run_no_interpreted_lambda_or_trailing_regex(spark, tmp_path):
    from tidewater.plans.catalog import tokenize_variants
    rows = [(1, "A b,,; ;"), (2, " \t,x;;\u00a0 \x0b"), (3, ""), (4, None), (5, ",;, \n  \nB  "), (6, "\u03a3x\u03a3 q")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    df = tokenize_variants(spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "lambdafunction" not in plan

    def plain(line, pattern):
        import re
        tokens = re.split(pattern, line, flags=re.ASCII)
        while tokens and tokens[-1] == "" and line:
            tokens.pop()
        return tokens

    expect = {}
    for _, text in rows:
        for line in [] if text is None else text.split("\n"):
            for name, pattern in (("word", r"\W+"), ("space", " "), ("ws", r"\s"), ("comma", ","), ("semicolon", ";")):
                for t in plain(line.lower() if name == "word" else line, pattern):
                    if name != "word" or t:
                        expect[name, t] = expect.get((name, t), 0) + 1
    assert {(r.variant, r.token): r.cnt for r in df.collect()} == expect
