"""Registered queries: sources and sinks (written then read back), iteration,
k-means, latest-model join, concurrent lookups and sequential folds."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tidewater.functions import text as T
from tidewater.operators import folds as FO
from tidewater.operators import iterate as IT
from tidewater.operators import joins as J
from tidewater.operators import timewindows as TW
from tidewater.plans import sequence as S
from tidewater.plans.catalog import _t, query, sensor_readings
from tidewater.session import scratch_path
from tidewater.sinks import writers as W
from tidewater.sources import readers as RD


def _readings_seconds(spark, sf):
    s = sensor_readings(spark, sf)
    return s.withColumn("time_stamp", F.unix_seconds(F.col("ts").cast("timestamp")))


# ------------------------------------------------------------------ sources
@query
def src_text_lines(spark, sf):
    path = scratch_path(spark, "doc-text")
    _t(spark, sf, "documents").select("text").write.mode("overwrite").text(path)
    return RD.read_lines(spark, path).withColumnRenamed("value", "line")


@query
def src_delimited(spark, sf):
    path = scratch_path(spark, "lineitem-psv")
    W.write_delimited(_t(spark, sf, "lineitem"), path, sep="|")
    li = RD.read_delimited(spark, path, "id bigint, extdprice double, discount double, shipdate string",
                           sep="|", positions=[0, 5, 6, 10])
    return li.withColumn("shipdate", F.to_date(F.substring("shipdate", 1, 10)))


@query
def src_csv_table(spark, sf):
    path = scratch_path(spark, "customer-csv")
    W.write_delimited(_t(spark, sf, "customer"), path, sep=",", header=True)
    RD.register_csv(spark, "customer_csv", path,
                    "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                    header=True)
    return spark.sql("SELECT c_custkey, c_name, c_acctbal FROM customer_csv WHERE c_mktsegment = 'BUILDING'")


@query
def parse_readings(spark, sf):
    s = _readings_seconds(spark, sf)
    lines = s.select(F.concat_ws(", ", "id", F.col("time_stamp").cast("string"),
                                 F.col("temperature").cast("string")).alias("value"))
    return RD.parse_readings(lines)


@query
def parse_tuple(spark, sf):
    e = _t(spark, sf, "events")
    lines = e.select(F.concat(F.lit("("), F.concat_ws(",", F.col("user_id").cast("string"),
                                                      F.col("event_id").cast("string"),
                                                      F.col("value").cast("string")), F.lit(")")).alias("value"))
    return RD.parse_tuple(lines, "value", "a bigint, b bigint, v double")


@query
def kafka_style_csv_filter(spark, sf):
    e = _t(spark, sf, "events")
    topic = e.select(W.csv_value(["event_id", "user_id", "event_type", "value"]).alias("value"))
    decoded = RD.decode_csv(topic, "event_id bigint, user_id bigint, event_type string, amount double")
    clicks = decoded.filter(F.col("event_type") == "click")
    return clicks.withColumn("value", W.csv_value(["event_id", "user_id", "event_type", "amount"]))


@query
def kafka_value_encode(spark, sf):
    s = _readings_seconds(spark, sf)
    return s.select("event_id", W.record_string("SensorReading", ["id", "time_stamp", "temperature"]).alias("value"))


@query
def json_documents(spark, sf):
    s = _readings_seconds(spark, sf)
    return s.select("event_id", W.document_json({"sensor_id": "id", "temperature": "temperature",
                                                 "ts": "time_stamp"}).alias("doc"))


@query
def catalog_roundtrip(spark, sf):
    """Database -> table in the session catalog: create a database and an
    external parquet table in it, list its tables, insert a query result,
    read it through the catalog.  Database and table are dropped again; the
    result is the catalog's scan, planned before, of the external files."""
    import uuid
    db = f"tidewater_{uuid.uuid4().hex[:8]}"
    place = scratch_path(spark, "customer-copy")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    try:
        spark.sql(f"CREATE TABLE {db}.customer_copy (id BIGINT, name STRING, balance DOUBLE) USING parquet LOCATION '{place}'")
        c = _t(spark, sf, "customer")
        spark.sql(f"INSERT INTO {db}.customer_copy SELECT c_custkey, c_name, c_acctbal FROM {{c}}", c=c)
        shown = spark.sql(f"SHOW TABLES IN {db}").filter("NOT isTemporary").collect()
        assert [r.tableName for r in shown] == ["customer_copy"]
        result = spark.table(f"{db}.customer_copy")
        result.schema
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")
    return result


@query
def src_row_groups(spark, sf):
    """A user-defined stream source over the table's row groups."""
    from tidewater.sources.row_groups import read_row_groups, run_until_read
    _t(spark, sf, "events")
    stream = read_row_groups(spark, f"{sf}/events.parquet", "event_id long, user_id long, event_type string, value double")
    return spark.read.parquet(run_until_read(stream, scratch_path(spark, "row-groups"), scratch_path(spark, "row-groups-ckpt")))


@query
def sink_delimited_roundtrip(spark, sf):
    from tidewater.plans.catalog import wordcount_batch
    path = scratch_path(spark, "wordcount-ssv")
    W.write_delimited(wordcount_batch(spark, sf), path, sep=" ")
    return RD.read_delimited(spark, path, "word string, cnt bigint", sep=" ")


@query
def sink_stream_files(spark, sf):
    from tidewater.streaming.runner import replay_width, run_available_now, spread_as_files
    e = _t(spark, sf, "events").select("event_id", "user_id", "value")
    src = spread_as_files(e, 3, scratch_path(spark, "events-replay"))
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", replay_width(spark)).parquet(src)
    out = run_available_now(stream, scratch_path(spark, "events-sink"), fmt="parquet")
    return spark.read.parquet(out)


@query
def sink_manifest_stream(spark, sf):
    """A stream into files that count once their micro-batch is committed."""
    from tidewater.sinks.manifest import read_manifest_table, write_manifest_table
    from tidewater.streaming.runner import replay_width, spread_as_files
    e = _t(spark, sf, "events").select("event_id", "user_id", "value")
    src = spread_as_files(e, 3, scratch_path(spark, "events-replay"))
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", replay_width(spark)).parquet(src)
    place = scratch_path(spark, "events-manifest")
    q = write_manifest_table(stream, place, scratch_path(spark, "events-manifest-ckpt"), availableNow=True)
    q.awaitTermination()
    return read_manifest_table(spark, place, e.schema)


@query
def stream_wordcount(spark, sf):
    from tidewater.streaming.runner import replay_width, run_keyed_updates, spread_as_files
    docs = _t(spark, sf, "documents").select("text")
    # the documents as text files; a line reader stream over them feeds the
    # word count, three micro-batches of several files
    src = spread_as_files(docs, 3, scratch_path(spark, "docs-text"), fmt="text")
    lines = RD.read_lines(spark, src, streaming=True, max_files_per_trigger=replay_width(spark)).filter(F.col("value") != "")
    # split on single spaces, empty tokens included, no lower-casing
    counts = (lines.select(F.explode(T.split_drop_trailing("value", T.SPACE)).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))
    return run_keyed_updates(spark, counts, ["word"], scratch_path(spark, "wordcount-state"))


@query
def state_kinds(spark, sf):
    """Value / list / map / reducing state per sensor, run as a stream over
    the readings replayed in arrival order."""
    from tidewater.streaming.runner import replay_as_files, replay_width, run_available_now
    from tidewater.streaming.stateful import state_kinds_stream
    s = sensor_readings(spark, sf)
    src = replay_as_files(spark, s, "event_id", 3, scratch_path(spark, "readings-replay"))
    stream = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", replay_width(spark)).parquet(src)
    kinds = state_kinds_stream(stream, "id", "temperature", ["ts", "event_id"])
    return spark.read.parquet(run_available_now(kinds, scratch_path(spark, "state-kinds"), fmt="parquet"))


def _state_kinds_run(spark, readings, checkpoint, seed=None):
    """The rows that the state-kinds stream gives for some of the readings."""
    from tidewater.streaming.runner import replay_as_files, replay_width, run_available_now
    from tidewater.streaming.stateful import state_kinds_stream
    src = replay_as_files(spark, readings, "event_id", 2, scratch_path(spark, "readings-replay"))
    stream = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", replay_width(spark)).parquet(src)
    kinds = state_kinds_stream(stream, "id", "temperature", ["ts", "event_id"], seed)
    return spark.read.parquet(run_available_now(kinds, scratch_path(spark, "state-kinds"), checkpoint=checkpoint))


@query
def state_retained(spark, sf):
    """What the stopped state-kinds query keeps for each sensor, read from
    its checkpoint."""
    from tidewater.streaming.retained import state_kinds_seed
    checkpoint = scratch_path(spark, "state-kinds-ckpt")
    _state_kinds_run(spark, sensor_readings(spark, sf), checkpoint)
    return state_kinds_seed(spark, checkpoint)


@query
def state_seeded(spark, sf):
    """The state kinds of all readings: one query takes the first half, another
    starts from the state that it left and takes the rest."""
    from tidewater.streaming.retained import state_kinds_seed
    s = sensor_readings(spark, sf)
    lo, hi = s.agg(F.min("event_id"), F.max("event_id")).first()
    first = F.col("event_id") <= ((lo or 0) + (hi or 0)) // 2
    one, two = scratch_path(spark, "state-one"), scratch_path(spark, "state-two")
    before = _state_kinds_run(spark, s.filter(first), one)
    return before.unionByName(_state_kinds_run(spark, s.filter(~first), two, state_kinds_seed(spark, one)))


@query
def map_partition_setup(spark, sf):
    """A pattern compiled once per partition, applied to whole batches."""
    import re

    import pandas as pd

    from tidewater.operators.rich import map_with_setup

    def extract(pattern, pdf):
        k = pdf["props"].str.extract(pattern, expand=False)
        return pd.DataFrame({"event_id": pdf["event_id"], "k": pd.to_numeric(k).astype("Int64")})

    e = _t(spark, sf, "events").select("event_id", "props")
    return map_with_setup(e, lambda: re.compile(r'"k"\s*:\s*(-?\d+)'), extract, "event_id bigint, k bigint")


# ------------------------------------------------------- async lookups
@query
def async_enrich_ordered(spark, sf):
    """Results in input order: the place at which each row comes out of its
    partition is its place in it."""
    e = _t(spark, sf, "events").select("event_id", "user_id").repartitionByRange("event_id") \
        .sortWithinPartitions("event_id")
    r = J.async_lookup(e, "user_id", "event_id", J.key_mod_label, capacity=20, timeout_s=10.0, ordered=True,
                       position_col="position")
    # written, so that every row is looked up once
    r = S.written(r.withColumn("part", F.spark_partition_id()), "lookups")
    first = r.groupBy("part").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                                         F.lit(0)))
    return r.join(F.broadcast(first.select("part", "before")), "part") \
        .select("event_id", "result", (F.col("before") + F.col("position")).alias("position"))


@query
def async_enrich_unordered(spark, sf):
    e = _t(spark, sf, "events").select("event_id", "user_id")
    return J.async_lookup(e, "user_id", "event_id", J.key_mod_label, capacity=10, timeout_s=10.0, ordered=False)


# ------------------------------------------------------------- iteration
@query
def iterate_fibonacci(spark, sf):
    e = _t(spark, sf, "events")
    pairs = e.select("event_id", F.ceil("value").cast("long").alias("a"), (F.col("user_id") + 1).alias("b"))
    return pairs.select("event_id", "a", "b", IT.fibonacci_steps(F.col("a"), F.col("b"), 100).alias("n"))


@query
def iterate_stream(spark, sf):
    """The feedback loop on a stream: pairs that are not done go round again
    with the next micro-batch."""
    from tidewater.streaming.runner import replay_width, spread_as_files
    pairs = _t(spark, sf, "events").select("event_id", F.ceil("value").cast("long").alias("a"), (F.col("user_id") + 1).alias("b"))
    pairs = pairs.select("*", F.col("a").alias("x"), F.col("b").alias("y"), F.lit(0).alias("n"))
    src = spread_as_files(pairs, 3, scratch_path(spark, "pairs-replay"))
    stream = spark.readStream.schema(pairs.schema).option("maxFilesPerTrigger", replay_width(spark)).parquet(src)

    def step(d):
        known = F.col("x").isNotNull() & F.col("y").isNotNull()
        return d.select("event_id", "a", "b", F.col("y").alias("x"), (F.col("x") + F.col("y")).alias("y"),
                        F.when(known, F.col("n") + 1).alias("n"))

    return IT.iterate_until(stream, step, (F.col("x") < 100) & (F.col("y") < 100)).select("event_id", "a", "b", "n")


def _embeddings(spark, sf):
    return _t(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")


def _round_vec(c):
    return F.transform(c, lambda x: F.round(x, 6))


@query
def kmeans_assign(spark, sf):
    pts = _embeddings(spark, sf)
    seeds = IT.initial_centroids_by_label(pts, "v", "label")
    return IT.kmeans_assign(pts, "v", seeds).select("vec_id", "cluster_id")


@query
def kmeans_step(spark, sf):
    pts = _embeddings(spark, sf)
    seeds = IT.initial_centroids_by_label(pts, "v", "label")
    means = IT.cluster_means(IT.kmeans_assign(pts, "v", seeds), "v")
    return means.select("cluster_id", "n", _round_vec(F.col("centroid")).alias("centroid"))


KMEANS_ROUNDS = 10


@query
def kmeans_centroids(spark, sf, rounds: int = KMEANS_ROUNDS):
    pts = _embeddings(spark, sf)
    seeds = IT.initial_centroids_by_label(pts, "v", "label")
    cents = IT.kmeans(pts, "v", seeds, iterations=rounds)
    out = spark.createDataFrame([(int(c), v) for c, v in cents], "cluster_id int, centroid array<double>")
    return out.select("cluster_id", _round_vec(F.col("centroid")).alias("centroid"))


# ------------------------------------------------------ latest-model join
@query
def latest_model_predict(spark, sf):
    e = _t(spark, sf, "events").select("event_id", "ts", "value")
    models = (TW.tumble(e, [], "ts", "1 hour", [F.round(F.avg("value"), 6).alias("prediction")])
              .select(F.col("window_end").alias("model_ts"), "prediction"))
    return J.asof_backward(e, "ts", models, "model_ts").select("event_id", "model_ts", "prediction")


# ---------------------------------------------------------------- folds
@query
def rising_alert(spark, sf):
    s = sensor_readings(spark, sf)
    return FO.rising_alert(s, "id", "ts", "event_id", "temperature", seconds=6 * 3600)


@query
def top_speed_delta(spark, sf):
    e = _t(spark, sf, "events").select(F.col("user_id").alias("car_id"), "ts", "event_id",
                                       F.col("value").alias("speed"),
                                       F.round(F.col("value") * 100).cast("long").alias("cents"))
    # one bucketing for the running distance and the operator
    e, bucket = S.balanced_bucket(e, ["car_id"], ["ts", "event_id"])
    d = S.running_agg(e, ["car_id"], ["ts", "event_id"], bucket, [("distance_cents", "cents", "sum")])
    return FO.top_speed_delta(d, "car_id", "ts", "event_id", "speed", "distance_cents",
                              threshold_cents=5000, evict_seconds=10 * 3600, bucket=bucket)
