"""Streaming forms: the same operator over a replayed file stream equals the
static result; restarting from a checkpoint resumes with the same state."""

import pytest
from pyspark.sql import Window, functions as F

from tidewater.operators import changelog as CL
from tidewater.operators import folds as FO
from tidewater.operators import keyed as K
from tidewater.operators import timewindows as TW
from tidewater.session import scratch_path
from tidewater.sources.tables import table
from tidewater.streaming.runner import replay_as_files, run_available_now

SF = "/root/testdata/sf0.001"
ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def readings(spark):
    e = table(spark, SF, "events")
    return e.select("event_id", F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
                    F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("temperature"))


def as_stream(spark, df, n=3, flush=None):
    """Replay ``df`` as ``n`` files in event_id order (+ an optional flush
    row far in the future, as the last file)."""
    path = scratch_path(spark, "replay")
    replay_as_files(spark, df, "event_id", n, path, files=2 if n < 5 else 1)
    if flush is not None:
        flush.coalesce(1).write.mode("overwrite").parquet(f"{path}/c{n:05d}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2 if n < 5 else 1).parquet(f"{path}/c*")


def collect_stream(spark, sdf):
    out = run_available_now(sdf, scratch_path(spark, "sink"))
    return spark.read.parquet(out)


def keyset(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_jump_alert_stream_equals_batch(spark, readings):
    batch = K.jump_alert(readings, "id", ORDER, None, "temperature", 10.0, initial=0.0)
    stream = K.jump_alert(as_stream(spark, readings), "id", ORDER, None, "temperature", 10.0, initial=0.0)
    got = collect_stream(spark, stream)
    cols = ["event_id", "id", "last_value", "temperature"]
    assert keyset(got, cols) == keyset(batch, cols)
    assert got.count() > 0


def test_changelog_stream_equals_batch_and_restarts(spark, readings):
    batch = CL.changelog_count(readings, "id", ORDER, None, carry=["event_id"])
    path = scratch_path(spark, "replay")
    replay_as_files(spark, readings, "event_id", 3, path, files=2)
    ckpt, sink = scratch_path(spark, "ckpt"), scratch_path(spark, "sink")

    def run(glob):
        src = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 2).parquet(glob)
        run_available_now(CL.changelog_count(src, "id", ORDER, None, carry=["event_id"]), sink, checkpoint=ckpt)

    # first run sees only the first file; the restart picks up the rest
    # from the checkpoint with the counts it had reached
    run(f"{path}/c00000")
    first = spark.read.parquet(sink).count()
    run(f"{path}/c*")
    got = spark.read.parquet(sink)
    cols = ["event_id", "id", "is_add", "cnt", "step"]
    assert 0 < first < got.count()
    assert keyset(got, cols) == keyset(batch, cols)


def test_rising_alert_stream_equals_batch(spark, readings):
    batch = FO.rising_alert(readings, "id", "ts", "event_id", "temperature", None, seconds=6 * 3600)
    last = readings.agg(F.max("ts"), F.max("event_id")).first()
    flush = spark.createDataFrame([(last[1] + 1, "__flush__", None, 0.0)], readings.schema) \
        .withColumn("ts", F.lit(last[0]) + F.expr("INTERVAL 30 DAYS"))
    src = as_stream(spark, readings, 3, flush)
    got = collect_stream(spark, FO.rising_alert(src, "id", "ts", "event_id", "temperature", None,
                                                seconds=6 * 3600)).filter("id != '__flush__'")
    cols = ["id", "alert_ts", "last_value"]
    assert keyset(got, cols) == keyset(batch, cols)
    assert got.count() > 0


def test_session_stream_equals_batch(spark, readings):
    batch = TW.session_windows(readings, ["id"], "ts", "event_id", 600, [F.count(F.lit(1)).alias("cnt")])
    last = readings.agg(F.max("ts"), F.max("event_id")).first()
    flush = spark.createDataFrame([(last[1] + 1, "__flush__", None, 0.0)], readings.schema) \
        .withColumn("ts", F.lit(last[0]) + F.expr("INTERVAL 30 DAYS"))
    src = as_stream(spark, readings, 3, flush).withWatermark("ts", "0 seconds")
    got = collect_stream(spark, TW.session_windows(src, ["id"], "ts", "event_id", 600,
                                                   [F.count(F.lit(1)).alias("cnt")])).filter("id != '__flush__'")
    cols = ["id", "session_start", "session_end", "cnt"]
    assert keyset(got, cols) == keyset(batch, cols)


def test_state_kinds(spark, sensors):
    from tidewater.streaming.stateful import state_kinds_stream
    df = sensors.select(F.col("seq").alias("event_id"), "id", "ts", "temperature")
    got = collect_stream(spark, state_kinds_stream(as_stream(spark, df, 2), "id", "temperature", ORDER))
    s1 = sorted((r.previous or -1.0, r.list_size, r.had_marker, r.running_max)
                for r in got.filter("id = 'sensor_1'").collect())
    assert s1 == [(-1.0, 1, False, 35.6), (35.6, 1, True, 39.6), (39.6, 1, True, 39.6)]


def _late_rows(spark):
    # seq, id, event time (s), temperature: the fourth row moves the
    # watermark far ahead, the fifth is then too late for its window
    return (spark.createDataFrame([(1, "s", 0, 5.0), (2, "s", 20, 6.0), (3, "s", 3, 4.0), (4, "s", 90, 7.0),
                                   (5, "s", 2, 1.0)], "event_id long, id string, t long, temperature double")
            .withColumn("ts", F.timestamp_seconds("t")).drop("t"))


def test_late_side_output_stream(spark):
    from tidewater.operators.late import split_late_stream
    df = _late_rows(spark)
    src = as_stream(spark, df, 5)
    on_time, late, state = (scratch_path(spark, n) for n in ("ontime", "late", "lstate"))
    q = split_late_stream(src, "ts", 15, 3, 60, on_time, late, state, scratch_path(spark, "ckpt"),
                          arrival_order=["event_id"])
    q.awaitTermination()
    assert [r.event_id for r in spark.read.parquet(late).collect()] == [5]
    assert spark.read.parquet(on_time).count() == 4


def test_allowed_lateness_updates_stream(spark):
    """Late-but-allowed rows update their window; too-late rows go to the
    side output and never re-open a window.  (Spark's own update mode can
    re-create an evicted window for a row behind the watermark, so the
    too-late rows are split off first.)"""
    from tidewater.operators.late import split_late_stream
    df = _late_rows(spark)
    on_time, late, state = (scratch_path(spark, n) for n in ("ontime", "late", "lstate"))
    split_late_stream(as_stream(spark, df, 5), "ts", 15, 3, 60, on_time, late, state,
                      scratch_path(spark, "ckpt"), arrival_order=["event_id"]).awaitTermination()
    agg = TW.tumble(spark.read.parquet(on_time), ["id"], "ts", "15 seconds", [F.min("temperature").alias("m")])
    assert sorted((int(r.window_start.timestamp()), r.m) for r in agg.collect()) == [(0, 4.0), (15, 6.0), (90, 7.0)]


def test_window_join_stream(spark):
    g = (spark.createDataFrame([(1, "tom", 0, 3), (2, "tom", 1999, 4), (3, "bob", 2000, 5)],
                               "event_id long, name string, ms long, grade int")
         .withColumn("gts", F.timestamp_millis("ms")).drop("ms"))
    s = (spark.createDataFrame([(1, "tom", 500, 100), (2, "bob", 1999, 200), (3, "bob", 3999, 300)],
                               "event_id long, name string, ms long, salary int")
         .withColumn("sts", F.timestamp_millis("ms")).drop("ms"))
    gs = as_stream(spark, g, 2).withWatermark("gts", "1 second").drop("event_id")
    ss = as_stream(spark, s, 2).withWatermark("sts", "1 second").drop("event_id")
    got = collect_stream(spark, TW.window_join(gs, ss, "name", "gts", "sts", "2 seconds")
                         .select("name", "grade", "salary"))
    assert keyset(got, ["name", "grade", "salary"]) == [("bob", 5, 300), ("tom", 3, 100), ("tom", 4, 100)]


def test_rows_frame_stream_equals_batch(spark, readings):
    batch = K.rows_frame(readings, ["id"], ORDER, None, 2,
                         {"cnt": lambda w: F.count("id").over(w),
                          "avg_value": lambda w: F.round(F.avg("temperature").over(w), 6)})
    got = collect_stream(spark, K.rows_frame(as_stream(spark, readings), ["id"], ORDER, None, 2, {},
                                             stream_value="temperature")).withColumn("avg_value", F.round("avg_value", 6))
    cols = ["event_id", "id", "cnt", "avg_value"]
    assert keyset(got, cols) == keyset(batch, cols)


def test_count_window_stream_equals_batch(spark):
    from tidewater.operators import countwindows as CW
    e = table(spark, SF, "events").select("event_type", "event_id", "value")
    batch = CW.sliding_count_window_sum(e, ["event_type"], ["event_id"], None, "value", size=25, slide=15) \
        .withColumn("total", F.round("total", 6))
    got = collect_stream(spark, CW.sliding_count_window_sum(as_stream(spark, e), ["event_type"], ["event_id"],
                                                            None, "value", size=25, slide=15))
    cols = ["event_type", "n", "total"]
    assert keyset(got.withColumn("total", F.round("total", 6)), cols) == keyset(batch, cols)
    assert got.count() > 0


def test_tiny_values_sum_alike_on_stream_and_batch(spark):
    from tidewater.operators import countwindows as CW
    df = spark.range(0, 40).select(F.col("id").alias("event_id"), F.lit("k").alias("k"), F.lit(1e-8).alias("v"))
    batch = CW.sliding_count_window_sum(df, ["k"], ["event_id"], None, "v", size=10, slide=5)
    got = collect_stream(spark, CW.sliding_count_window_sum(as_stream(spark, df), ["k"], ["event_id"], None, "v", size=10, slide=5))
    scaled = lambda d: keyset(d.withColumn("s", F.round(F.col("total") * 1e8, 6)), ["n", "s"])
    assert scaled(got) == scaled(batch) == [(5, 5.0)] + [(n, 10.0) for n in range(10, 45, 5)]


def test_tumbling_count_window_stream_equals_batch(spark, readings):
    from tidewater.operators import countwindows as CW
    batch = CW.tumbling_count_window(readings, ["id"], ORDER, None, 4,
                                     [F.min("temperature").alias("m"), F.max_by("ts", "event_id").alias("last_ts")])
    got = collect_stream(spark, CW.tumbling_count_window(
        as_stream(spark, readings), ["id"], ORDER, None, 4, [], {"m": ("temperature", "min"), "last_ts": ("ts", "last")}))
    cols = ["id", "window_no", "m", "last_ts"]
    assert keyset(got, cols) == keyset(batch, cols) and got.count() > 0


def test_top1_additions_stream_equals_batch(spark, readings):
    d = readings.select("event_id", "id", "ts", "temperature")
    batch = CL.top1_additions(d, "id", ORDER, None, "temperature")
    got = collect_stream(spark, CL.top1_additions(as_stream(spark, d), "id", ORDER, None, "temperature"))
    assert keyset(got, ["event_id", "id", "is_add"]) == keyset(batch, ["event_id", "id", "is_add"])


def test_top_speed_stream_equals_batch(spark, readings):
    total = F.sum(F.round(F.col("temperature") * 100).cast("long") - 4000).over(Window.partitionBy("id").orderBy(*ORDER))
    d = readings.withColumn("d", F.when(F.col("event_id") % 11 != 0, total))
    args = ("id", "ts", "event_id", "temperature", "d")
    batch = FO.top_speed_delta(d, *args, threshold_cents=2000, evict_seconds=36000)
    got = collect_stream(spark, FO.top_speed_delta(as_stream(spark, d), *args, threshold_cents=2000, evict_seconds=36000))
    cols = ["id", "event_id", "speed", "distance", "time"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, batch.select(cols).collect())) and got.count() > 0


def test_sliding_sum_stream_equals_batch(spark, readings):
    """Windows of 2500 ms every 500 ms, on a scale of milliseconds."""
    d = readings.withColumn("ts", F.timestamp_millis(F.floor(F.unix_micros("ts") / 60_000_000).cast("long")))
    last = d.agg(F.max("ts"), F.max("event_id")).first()
    flush = spark.createDataFrame([(last[1] + 1, "__flush__", None, 0.0)], d.schema).withColumn(
        "ts", F.lit(last[0]) + F.expr("INTERVAL 1 HOUR")).select(d.columns)
    args = (["id"], "ts", "temperature", "2500 milliseconds", "500 milliseconds")
    batch = TW.sliding_sum(d, *args)
    src = as_stream(spark, d, 3, flush).withWatermark("ts", "0 seconds")
    got = collect_stream(spark, TW.sliding_sum(src, *args)).filter("id != '__flush__'")
    rnd = lambda x: keyset(x.withColumn("total", F.round("total", 6)), ["id", "window_start", "window_end", "total"])
    assert rnd(got) == rnd(batch) and got.count() > 0


def test_processing_time_window_on_arrival(spark):
    df = TW.on_arrival(spark.range(0, 10).withColumn("word", F.lit("a")))
    r = TW.tumble(df, ["word"], "arrival", "1 day", [F.count(F.lit(1)).alias("cnt")]).collect()
    assert sum(x.cnt for x in r) == 10


def test_running_reduce_branch_equals_batch(spark, readings):
    d = readings.withColumn("sec", F.unix_seconds("ts"))
    batch = K.running_reduce_latest_step(d, "id", ORDER, None, "sec")
    got = collect_stream(spark, K.running_reduce_latest_step(as_stream(spark, d), "id", ORDER, None, "sec"))
    assert keyset(got, ["event_id", "sec"]) == keyset(batch, ["event_id", "sec"])


def test_replay_keeps_rows_without_order(spark):
    df = spark.createDataFrame([(None, "x"), (2 ** 60, "y"), (2 ** 60 + 1, "z"), (5, "w")], "event_id long, v string")
    path = scratch_path(spark, "replay")
    got = spark.read.parquet(replay_as_files(spark, df, "event_id", 3, path))
    assert sorted(r.v for r in got.collect()) == ["w", "x", "y", "z"]
    import glob
    assert all(len(glob.glob(f"{path.removeprefix('file:')}/c0000{i}/part-*")) >= 1 for i in range(3))


def test_lookup_timeout_is_per_request(spark):
    """A slow lookup fails although others finish in the meantime."""
    from tidewater.operators.joins import async_lookup

    def slow_one(k):
        import time
        time.sleep(3.0 if k == 0 else 0.02)
        return "ok"

    df = spark.range(0, 400).select(F.col("id").alias("rid"), F.col("id").alias("k")).coalesce(1)
    with pytest.raises(Exception, match="longer than"):
        async_lookup(df, "k", "rid", slow_one, capacity=4, timeout_s=1.0, ordered=False).collect()
    got = async_lookup(df.filter("k > 0"), "k", "rid", slow_one, capacity=4, ordered=True, position_col="p").collect()
    assert [(r.rid, r.p) for r in sorted(got, key=lambda r: r.p)] == [(i + 1, i) for i in range(399)]


def test_running_reduce_stream(spark, sensors):
    from tidewater.streaming.stateful import running_reduce_stream
    df = sensors.select(F.col("seq").alias("event_id"), "id", "time_stamp", "temperature", "ts")

    def keep_latest_step(acc, row):
        return dict(row, time_stamp=acc["time_stamp"] + 10)

    got = collect_stream(spark, running_reduce_stream(as_stream(spark, df, 2), "id", ORDER, keep_latest_step))
    assert keyset(got.filter("id = 'sensor_1'"), ["time_stamp", "temperature"]) == [
        (1612523073, 35.6), (1612523083, 39.6), (1612523093, 36.6)]


def test_latest_model_stream_equals_batch(spark):
    from tidewater.operators.joins import latest_model_predict_stream
    from tidewater.plans.morequeries import latest_model_predict
    e = table(spark, SF, "events").select("event_id", "ts", "value")
    out = scratch_path(spark, "pred")
    latest_model_predict_stream(as_stream(spark, e, 4), "event_id", "ts", "value", 3600, out,
                                scratch_path(spark, "models"), scratch_path(spark, "ckpt")).awaitTermination()
    got = spark.read.parquet(out)
    cols = ["event_id", "model_ts", "prediction"]
    assert keyset(got, cols) == keyset(latest_model_predict(spark, SF), cols)


def test_fibonacci_loop_on_stream(spark):
    from tidewater.operators import iterate as IT
    df = spark.createDataFrame([(1, 10, 7), (2, 1, 1), (3, 49, 49)], "event_id long, a int, b int")
    got = collect_stream(spark, as_stream(spark, df, 2).select(
        "event_id", IT.fibonacci_steps(F.col("a"), F.col("b"), 100).alias("n")))
    assert keyset(got, ["event_id", "n"]) == [(1, 5), (2, 10), (3, 2)]


def test_async_lookup_results_and_failure(spark):
    from tidewater.operators.joins import async_lookup

    def slow_label(k):
        import time
        time.sleep(0.002 * (k % 3))
        return "key" + str(int(k) % 10)

    def failing_lookup(k):
        if k == 77:
            raise RuntimeError("lookup failed")
        return "ok"

    df = spark.range(0, 200).select(F.col("id").alias("rid"), (F.col("id") * 7).alias("k")).repartition(2)
    for ordered in (True, False):
        got = async_lookup(df, "k", "rid", slow_label, capacity=5, ordered=ordered).collect()
        assert sorted((r.rid, r.result) for r in got) == [(i, "key" + str((i * 7) % 10)) for i in range(200)]
    # a failed lookup fails the task (and the job after retries)
    with pytest.raises(Exception):
        async_lookup(df, "k", "rid", failing_lookup, capacity=5).collect()


def test_state_kinds_take_plain_rows(spark):
    """No data frame per key; nulls come last in the order and stay in the
    maximum."""
    from tidewater.streaming.stateful import state_kinds_stream
    rows = [(1, "a", 5, 2.0), (2, "a", None, 9.0), (3, "a", 4, 3.0), (4, "b", 1, None), (5, "b", 2, 1.0), (6, None, 1, 7.0)]
    df = spark.createDataFrame(rows, "event_id long, id string, ts long, temperature double")
    stream = state_kinds_stream(as_stream(spark, df, 1), "id", "temperature", ORDER)
    assert "InPandas" not in stream._jdf.queryExecution().analyzed().toString()
    got = sorted((tuple(r) for r in collect_stream(spark, stream).collect()), key=repr)
    assert got == sorted([("a", None, 1, False, 3.0), ("a", 3.0, 1, True, 3.0), ("a", 2.0, 1, True, 9.0),
                          ("b", None, 1, False, None), ("b", None, 1, True, None), (None, None, 1, False, 7.0)], key=repr)


def test_ordered_lookups_call_once_per_row(spark, tmp_path, monkeypatch):
    """The query counts its partitions' rows from what the lookups returned,
    not from a second round of lookups."""
    import os
    from tidewater.operators import joins as J
    from tidewater.plans.morequeries import async_enrich_ordered
    calls = str(tmp_path / "calls")

    def counted(k):
        f = os.open(calls, os.O_CREAT | os.O_APPEND | os.O_WRONLY)
        os.write(f, b".")
        os.close(f)
        return "key" + str(int(k) % 10)

    monkeypatch.setattr(J, "key_mod_label", counted)
    e = spark.range(300).select((F.col("id") * 3).alias("event_id"), (F.col("id") % 17).alias("user_id"))
    e.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    got = sorted(async_enrich_ordered(spark, str(tmp_path)).collect())
    assert [tuple(r) for r in got] == [(i * 3, f"key{i % 17 % 10}", i) for i in range(300)]
    assert os.path.getsize(calls) == 300


def test_idle_input_does_not_hold_back_windows(spark, readings):
    """WM4: a union of a busy and an idle input.  Under the default policy
    the idle input's watermark holds every window open; with
    ``tolerate_idle_inputs`` the busy input's watermark closes them."""
    from tidewater.streaming.runner import tolerate_idle_inputs

    def run():
        busy = as_stream(spark, readings, 4).withWatermark("ts", "0 seconds")
        idle = as_stream(spark, readings.filter("event_id <= 3"), 1).withWatermark("ts", "0 seconds")
        counts = (busy.unionByName(idle).groupBy(F.window("ts", "1 hour"))
                  .agg(F.count(F.lit(1)).alias("n")))
        return collect_stream(spark, counts).count()

    key = "spark.sql.streaming.multipleWatermarkPolicy"
    old = spark.conf.get(key, "min")
    try:
        spark.conf.set(key, "min")
        held = run()
        tolerate_idle_inputs(spark)
        assert spark.conf.get(key) == "max"
        released = run()
    finally:
        spark.conf.set(key, old)
    assert held <= 1 < released
