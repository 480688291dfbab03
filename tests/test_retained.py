"""State that a stopped query has left: read back, and given to another."""

from pyspark.sql import functions as F

from tidewater.operators import folds as FO
from tidewater.operators import keyed as K
from tidewater.session import scratch_path
from tidewater.sources.tables import table
from tidewater.streaming import retained as R
from tidewater.streaming import stateful as ST
from tidewater.streaming.runner import replay_as_files, run_available_now

SF = "/root/testdata/sf0.001"
ORDER = ["ts", "event_id"]


def readings(spark):
    return table(spark, SF, "events").select(
        "event_id", F.concat(F.lit("sensor_"), (F.col("user_id") % 5).cast("string")).alias("id"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("temperature"))


def run(spark, df, operator, checkpoint, cuts=2):
    src = replay_as_files(spark, df, "event_id", cuts, scratch_path(spark, "kept-replay"), files=1)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    return spark.read.parquet(run_available_now(operator(stream), scratch_path(spark, "kept-out"), checkpoint=checkpoint))


def halves(df):
    lo, hi = df.agg(F.min("event_id"), F.max("event_id")).first()
    return df.filter(F.col("event_id") <= (lo + hi) // 2), df.filter(F.col("event_id") > (lo + hi) // 2)


def rows_of(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_variables_and_earlier_batches(spark):
    df, ckpt = readings(spark), scratch_path(spark, "kept-ckpt")
    run(spark, df, lambda s: ST.state_kinds_stream(s, "id", "temperature", ORDER), ckpt)
    held = {(r.state, r.kind) for r in R.state_variables(spark, ckpt).collect()}
    assert held == {("value", "ValueState"), ("list", "ListState"), ("map", "MapState"), ("reduce", "ValueState")}
    assert rows_of(R.read_state(spark, ckpt, "reduce"), "key.id", "value.v") == rows_of(
        df.groupBy("id").agg(F.max("temperature").alias("m")), "id", "m")
    assert rows_of(R.read_state(spark, ckpt, "reduce", batch=0), "key.id", "value.v") == rows_of(
        halves(df)[0].groupBy("id").agg(F.max("temperature").alias("m")), "id", "m")
    assert {tuple(r) for r in R.read_state(spark, ckpt, "map").select("user_map_key.k", "user_map_value.v").collect()} == {("marker", 0.0)}
    assert R.read_state(spark, ckpt, "list").count() == 5


def test_seeded_jump_alert_goes_on(spark):
    df, (a, b) = readings(spark), halves(readings(spark))
    one, two = scratch_path(spark, "jump-one"), scratch_path(spark, "jump-two")
    alert = lambda seed=None: lambda s: ST.jump_alert_stream(s, "id", ORDER, "temperature", 30.0, seed=seed)
    got = run(spark, a, alert(), one).unionByName(run(spark, b, alert(R.jump_alert_seed(spark, one)), two))
    cols = ["event_id", "id", "temperature", "last_value"]
    assert rows_of(got, *cols) == rows_of(K.jump_alert(df, "id", ORDER, None, "temperature", 30.0), *cols)


def test_timers_are_read_and_handed_on(spark):
    df, (a, b) = readings(spark), halves(readings(spark))
    one, two = scratch_path(spark, "rise-one"), scratch_path(spark, "rise-two")
    seconds = 4 * 3600
    rise = lambda seed=None: lambda s: ST.rising_alert_stream(s, "id", "ts", "event_id", "temperature", seconds, seed=seed)
    before = run(spark, a, rise(), one)
    # what is pending, row by row
    last, deadline = {}, {}
    rows = sorted((r.ts.timestamp(), r.event_id, r.id, r.temperature) for r in a.collect())
    for t, _, i, v in rows:
        if deadline.get(i) is not None and deadline[i] <= t:
            deadline[i] = None
        if v > last.get(i, 0.0) and deadline.get(i) is None:
            deadline[i] = t + seconds
        elif v < last.get(i, 0.0):
            deadline[i] = None
        last[i] = v
    end = rows[-1][0]
    pending = {(i, -(-round(t * 1e6) // 1000)) for i, t in deadline.items() if t is not None and t > end}
    assert {tuple(r) for r in R.read_timers(spark, one).select("key.id", "expiration_timestamp_ms").collect()} == pending
    assert pending and rows_of(R.rising_alert_seed(spark, one), "id", "last") == sorted(last.items(), key=str)
    after = run(spark, b, rise(R.rising_alert_seed(spark, one)), two)
    whole = run(spark, df, rise(), scratch_path(spark, "rise-whole"), cuts=4)
    cols = ["id", "alert_ts", "last_value"]
    assert rows_of(before.unionByName(after), *cols) == rows_of(whole, *cols)
