"""User-given accumulators, table aggregates and reductions: plain versions,
hot keys, stream = batch."""

import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidewater.operators.accumulators import Accumulator, accumulate, register_accumulator, running_reduce
from tidewater.plans.keyedqueries import HeavyBins, MeanAndSpread, affine_step
from tidewater.session import scratch_path
from tidewater.streaming.runner import replay_as_files, run_available_now

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not import the tests


@pytest.fixture(scope="module")
def rows():
    """(seq, key, m, c): a hot key, a null key, keys with one row."""
    rng = random.Random(1)
    keys = ["hot"] * 500 + [None] * 40 + ["a", "b"] * 60 + [f"k{i}" for i in range(80)]
    rng.shuffle(keys)
    return [(i, k, rng.randrange(1, 50), rng.randrange(1000)) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "seq long, key string, m long, c long")


def plain_reduce(rows):
    last, out = {}, []
    for seq, k, m, c in sorted(rows):
        x = {"m": np.int64(m), "c": np.int64(c)}
        last[k] = affine_step(last[k], x) if k in last else x
        out.append((seq, k, int(last[k]["m"]), int(last[k]["c"])))
    return out


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_running_reduce_over_range_borders(table, rows, partitions):
    got = running_reduce(table.repartition(5), ["key"], ["seq"], affine_step, ["m", "c"], partitions)
    assert got.columns == table.columns
    assert sorted(map(tuple, got.collect())) == plain_reduce(rows)


def test_running_reduce_in_small_batches(spark, table, rows):
    """Runs that go on from one Arrow batch to the next."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = running_reduce(table, ["key"], ["seq"], affine_step, ["m", "c"], 3).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sorted(map(tuple, got)) == plain_reduce(rows)


def test_running_reduce_with_nulls_and_strings(spark):
    """First non-null value and the text of all so far."""
    def step(a, b):
        return {"v": np.where(a["v"] == None, b["v"], a["v"]), "t": a["t"] + b["t"]}  # noqa: E711
    rows = [(1, "x", None, "a"), (2, "x", 5, "b"), (3, "x", 6, "c"), (4, "y", None, "d"), (5, "y", None, "e")]
    df = spark.createDataFrame(rows, "seq long, key string, v long, t string")
    got = sorted(map(tuple, running_reduce(df, ["key"], ["seq"], step, ["v", "t"], 2).collect()))
    assert got == [(1, "x", None, "a"), (2, "x", 5, "ab"), (3, "x", 5, "abc"), (4, "y", None, "d"), (5, "y", None, "de")]
    assert running_reduce(df.limit(0), ["key"], ["seq"], step, ["v", "t"]).count() == 0


def test_running_reduce_stream_equals_batch(spark, table, rows):
    src = replay_as_files(spark, table, "seq", 4, scratch_path(spark, "reduce-replay"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 4).parquet(src)
    out = run_available_now(running_reduce(stream, ["key"], ["seq"], affine_step, ["m", "c"]), scratch_path(spark, "reduce-out"))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == plain_reduce(rows)


def test_running_reduce_plan(table):
    """The second pass reads what the first wrote: no exchange is left."""
    plan = running_reduce(table, ["key"], ["seq"], affine_step, ["m", "c"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


# ------------------------------------------------------------ accumulators
class Tally(Accumulator):
    """Rows, and the most rows that one partial state was made of."""

    def zero(self):
        return 0, 0

    def add(self, state, rows):
        return state[0] + rows.num_rows, state[0] + rows.num_rows

    def merge(self, state, other):
        return state[0] + other[0], max(state[1], other[1])

    def finish(self, state):
        return [state]


@pytest.mark.parametrize("fan,held", [(0, 10_000), (4, 10_000), (16, 1)])
def test_accumulate_merges_partial_states(table, rows, fan, held):
    count = Counter(k for _, k, _, _ in rows)
    got = accumulate(table.repartition(10), ["key"], Tally(), "n long, most long", fan, held).collect()
    assert {r.key: r.n for r in got} == count and len(got) == len(count)
    # no state was made of the whole hot group
    assert max(r.most for r in got) < count["hot"] / 4


def test_accumulate_without_salt_or_rows(spark, table):
    plan = accumulate(table, ["key"], Tally(), "n long, most long", 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert accumulate(table.limit(0), ["key"], Tally(), "n long, most long").count() == 0


def test_accumulate_several_keys(spark):
    rows = [("a", None, 1.0), ("a", None, 2.0), ("a", float("nan"), 3.0), ("a", float("nan"), 5.0), (None, 1.0, None)]
    df = spark.createDataFrame(rows, "a string, b double, v double").repartition(3)
    got = accumulate(df, ["a", "b"], MeanAndSpread("v"), "n long, mean double, spread double").collect()
    assert sorted((str(r.a), str(r.b), r.n, r["mean"], r.spread) for r in got) == [
        ("None", "1.0", 0, None, None), ("a", "None", 2, 1.5, 1.0), ("a", "nan", 2, 4.0, 2.0)]


def test_table_aggregate_on_a_stream_retracts(spark, table, rows):
    bins = table.select("seq", "key", (F.col("c") / 100).cast("long").alias("bin"))
    batch = accumulate(bins, ["key"], HeavyBins("bin", 12), "bin long, cnt long")
    src = replay_as_files(spark, bins, "seq", 5, scratch_path(spark, "bins-replay"))
    stream = spark.readStream.schema(bins.schema).option("maxFilesPerTrigger", 4).parquet(src)
    out = run_available_now(accumulate(stream, ["key"], HeavyBins("bin", 12), "bin long, cnt long"),
                            scratch_path(spark, "bins-out"))
    changes = spark.read.parquet(out).collect()
    net = defaultdict(int)
    for r in changes:
        net[r.key, r.bin, r.cnt] += 1 if r.is_add else -1
    assert any(not r.is_add for r in changes) and set(net.values()) <= {0, 1}
    assert sorted((k for k, n in net.items() if n), key=str) == sorted(map(tuple, batch.collect()), key=str)


def test_accumulator_from_sql_text(spark, table, rows):
    register_accumulator(spark, "tally", Tally(), "key", "string", "n long, most long")
    table.repartition(6).createOrReplaceTempView("tally_input")
    got = spark.sql("""SELECT * FROM tally_merge(TABLE(SELECT * FROM tally_partial(TABLE(tally_input))) PARTITION BY key)""").collect()
    assert {r.key: r.n for r in got} == Counter(k for _, k, _, _ in rows)
    assert max(r.most for r in got) < 250
