"""Sinks: keyed upserts (JDBC MERGE, parquet versions), table inserts,
declared stream tables."""

import uuid

import pytest
from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.sinks import upsert as U
from tidewater.sinks import writers as W
from tidewater.sinks.versions import commit, committed, newest_before


def test_jdbc_upsert_latest_value(spark, sensors):
    # in-process Derby database: no server, no port
    url = f"jdbc:derby:memory:tw{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    U._jdbc_execute(spark, url, ["CREATE TABLE SENSOR_TEMP (ID VARCHAR(32) PRIMARY KEY, TEMP DOUBLE)"], props)
    first = sensors.filter("seq <= 4")
    second = sensors.filter("seq > 4").unionByName(
        spark.createDataFrame([(8, "sensor_1", 1612523080, 40.5)], "seq long, id string, time_stamp long, temperature double")
        .withColumn("ts", F.timestamp_seconds("time_stamp")))
    for batch in (first, second):
        U.upsert_jdbc(spark, batch.select(F.col("id").alias("ID"), F.col("temperature").alias("TEMP"), "ts", "seq"),
                      url, "SENSOR_TEMP", ["ID"], ["ts", "seq"], ["TEMP"], props)
    got = dict((r.ID, r.TEMP) for r in spark.read.jdbc(url, "SENSOR_TEMP", properties=props).collect())
    assert got == {"sensor_1": 40.5, "sensor_10": 36.6, "sensor_2": 36.1, "sensor_3": 37.6, "sensor_4": 38.3}


def test_parquet_upsert_versions(spark, sensors):
    """Deltas, a replayed and a skipped version, compaction."""
    path = scratch_path(spark, "upsert")
    read = lambda **kw: dict((r.id, r.temperature) for r in U.read_upserted(spark, path, ["id"], ["ts", "seq"], **kw).collect())
    assert U.read_upserted(spark, path, ["id"], ["ts", "seq"]) is None
    U.upsert_parquet(spark, sensors.filter("seq <= 3"), path, 0, ["id"], ["ts", "seq"])
    U.upsert_parquet(spark, sensors.filter("seq = 4"), path, 1, ["id"], ["ts", "seq"])
    U.upsert_parquet(spark, sensors.filter("seq = 4"), path, 1, ["id"], ["ts", "seq"])        # replayed
    out = U.upsert_parquet(spark, sensors.filter("seq > 4"), path, 3, ["id"], ["ts", "seq"])  # 2 was skipped
    assert spark.read.parquet(out).count() == 3                                               # only what changed
    want = {"sensor_1": 36.6, "sensor_10": 36.6, "sensor_2": 36.1, "sensor_3": 37.6, "sensor_4": 38.3}
    assert read() == want and read(upto=1) == {k: want[k] for k in ("sensor_1", "sensor_10")}
    for v in range(4, U.COMPACT_EVERY + 2):
        row = [(100 + v, "sensor_9", 1, float(v))]
        U.upsert_parquet(spark, spark.createDataFrame(row, "seq long, id string, time_stamp long, temperature double")
                         .withColumn("ts", F.timestamp_seconds("time_stamp")), path, v, ["id"], ["ts", "seq"])
    assert committed(spark, f"{path}/base") == [U.COMPACT_EVERY - 1]
    assert read() == want | {"sensor_9": float(U.COMPACT_EVERY + 1)}


def test_damaged_version_is_an_error_not_an_empty_table(spark, sensors):
    import glob
    path = scratch_path(spark, "damaged")
    out = U.upsert_parquet(spark, sensors, path, 0, ["id"], ["ts", "seq"])
    for f in glob.glob(f"{out.removeprefix('file:')}/part-*"):
        open(f, "wb").write(b"not parquet")
    for f in glob.glob(f"{out.removeprefix('file:')}/.part-*.crc"):
        open(f, "wb").write(b"")
    with pytest.raises(Exception):
        U.read_upserted(spark, path, ["id"], ["ts", "seq"]).collect()
    # a version that was never finished is passed over
    half = scratch_path(spark, "half")
    commit(sensors.select("id"), half, 0)
    sensors.select("id").write.parquet(f"{half}/v=00000001")
    import os
    os.remove(f"{half.removeprefix('file:')}/v=00000001/_SUCCESS")
    assert committed(spark, half) == [0] and newest_before(spark, half, 5).endswith("v=00000000")


def test_jdbc_append_is_safe_to_replay(spark):
    url = f"jdbc:derby:memory:tw{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    U._jdbc_execute(spark, url, ["CREATE TABLE SUMS (NAME VARCHAR(32), TOTAL DOUBLE)"], props)
    one = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "name string, total double")
    two = spark.createDataFrame([("c", 3.0)], "name string, total double")
    for batch, number in ((one, 0), (one, 0), (two, 1), (one, 0)):
        W.append_batch_once(batch, number, url, "SUMS", props)
    assert sorted((r.NAME, r.TOTAL) for r in spark.read.jdbc(url, "SUMS", properties=props).collect()) == [
        ("a", 1.0), ("b", 2.0), ("c", 3.0)]


def test_one_header_over_many_files(spark):
    path = scratch_path(spark, "headed")
    W.write_delimited_once(spark.range(0, 20).repartition(4).select("id", (F.col("id") * 2).alias("two")), path, ";")
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines.count("id;two") == 1 and len(lines) == 21


def test_topic_reader_and_writer(spark, tmp_path):
    """The message source and sink with a file format in place of a broker."""
    from tidewater.sources.readers import read_topic_lines
    src, out = scratch_path(spark, "topic"), scratch_path(spark, "topic-out")
    spark.createDataFrame([("a",), ("b",)], "value string").coalesce(1).write.text(src)
    lines = read_topic_lines(spark, "unused:0", "readings", fmt="text", options={"path": src})
    W.write_topic(lines, "unused:0", "copy", scratch_path(spark, "ckpt"), fmt="text", options={"path": out},
                  trigger={"availableNow": True}).awaitTermination()
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["a", "b"]


def test_insert_into_declared_csv_table(spark, sensors):
    name = f"sensor_counts_{uuid.uuid4().hex[:8]}"
    loc = scratch_path(spark, name)
    spark.sql(f"CREATE TABLE {name} (id STRING, cnt BIGINT) USING csv LOCATION '{loc}'")
    W.insert_into(sensors.groupBy("id").agg(F.count("id").alias("cnt")), name)
    assert dict((r.id, r.cnt) for r in spark.table(name).collect())["sensor_1"] == 3


def test_noop_and_encoders(spark, sensors):
    W.write_noop(sensors)
    r = sensors.filter("seq = 1").select(
        W.record_string("SensorReading", ["id", "time_stamp", "temperature"]).alias("v"),
        W.document_json({"sensor_id": "id", "temperature": "temperature", "ts": "time_stamp"}).alias("d"),
        W.csv_value(["id", "time_stamp", "temperature"]).alias("c")).first()
    assert r.v == "SensorReading(sensor_1,1612523073,35.6)"
    assert r.d == '{"sensor_id":"sensor_1","temperature":"35.6","ts":"1612523073"}'
    assert r.c == "sensor_1,1612523073,35.6"


def test_declared_stream_table_tumble(spark):
    """Declared table over JSON payloads with a computed event-time column
    and a watermark, windowed sum in SQL, appended to a file sink."""
    from tidewater.sources.table_source import table_source
    from tidewater.streaming.runner import run_available_now
    payloads = [
        '{"album_id": "a", "bidding_price": 1.5, "request_time": "2024-01-01 00:00:01"}',
        '{"album_id": "a", "bidding_price": 2.0, "request_time": "2024-01-01 00:00:04"}',
        '{"album_id": null, "bidding_price": 9.0, "request_time": "2024-01-01 00:00:02"}',
        '{"album_id": "b", "bidding_price": 3.0, "request_time": "2024-01-01 00:00:06"}',
        '{"album_id": "a", "bidding_price": 0.5, "request_time": "2024-01-01 00:01:00"}',
    ]
    src = scratch_path(spark, "payloads")
    spark.createDataFrame([(p,) for p in payloads], "value string").coalesce(1).write.text(src)
    raw = spark.readStream.format("text").load(src)
    view = f"impressions_{uuid.uuid4().hex[:6]}"
    table_source(raw, view, "album_id string, bidding_price double, request_time string",
                 computed={"ts": "to_timestamp(request_time)"}, watermark=("ts", "5 seconds"))
    agg = spark.sql(f"""SELECT album_id, sum(bidding_price) AS price, window.start AS start_time,
                               window.end AS end_time
                        FROM {view} WHERE album_id IS NOT NULL
                        GROUP BY album_id, window(ts, '5 seconds')""")
    out = spark.read.parquet(run_available_now(agg, scratch_path(spark, "sink")))
    got = sorted((r.album_id, r.price) for r in out.collect())
    # the last window (a @ 00:01:00) stays open: the watermark has not passed it
    assert got == [("a", 3.5), ("b", 3.0)]


def test_stream_tumble_to_jdbc(spark):
    from tidewater.sources.table_source import table_source
    payloads = [
        '{"album_id": "a", "bidding_price": 1.5, "request_time": "2024-01-01 00:00:01"}',
        '{"album_id": "a", "bidding_price": 2.0, "request_time": "2024-01-01 00:00:04"}',
        '{"album_id": "b", "bidding_price": 3.0, "request_time": "2024-01-01 00:00:06"}',
        '{"album_id": "a", "bidding_price": 0.5, "request_time": "2024-01-01 00:01:00"}',
    ]
    src = scratch_path(spark, "payloads")
    spark.createDataFrame([(p,) for p in payloads], "value string").coalesce(1).write.text(src)
    view = f"imp_{uuid.uuid4().hex[:6]}"
    table_source(spark.readStream.format("text").load(src), view,
                 "album_id string, bidding_price double, request_time string",
                 computed={"ts": "to_timestamp(request_time)", "pt": "current_timestamp()"},
                 watermark=("ts", "5 seconds"))
    agg = spark.sql(f"""SELECT album_id, sum(bidding_price) AS price, window.start AS start_time,
                               window.end AS end_time
                        FROM {view} WHERE album_id IS NOT NULL GROUP BY album_id, window(ts, '5 seconds')""")
    url = f"jdbc:derby:memory:tw{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    U._jdbc_execute(spark, url, ["CREATE TABLE ALBUM_PRICE (ALBUM_ID VARCHAR(64), PRICE DOUBLE, "
                                 "START_TIME TIMESTAMP, END_TIME TIMESTAMP)"], props)
    W.stream_to_jdbc(agg, url, "ALBUM_PRICE", scratch_path(spark, "ckpt"), props).awaitTermination()
    got = sorted((r.ALBUM_ID, r.PRICE) for r in spark.read.jdbc(url, "ALBUM_PRICE", properties=props).collect())
    assert got == [("a", 3.5), ("b", 3.0)]


def test_print_schema_of_declared_table(spark, capsys):
    """SQL6: a declared table's schema (payload fields plus computed
    columns) prints as a tree."""
    from tidewater.sources.table_source import table_source
    raw = spark.createDataFrame([('{"id": "sensor_1", "ts": "2021-02-05 11:04:33", "temperature": 35.6}',)],
                                "value string")
    t = table_source(raw, "declared_readings", "id string, ts string, temperature double",
                     computed={"rowtime": "to_timestamp(ts)"})
    t.printSchema()
    printed = capsys.readouterr().out
    for line in ("|-- id: string", "|-- temperature: double", "|-- rowtime: timestamp"):
        assert line in printed
    assert printed.strip() == t.schema.treeString().strip()


def test_same_rows_is_a_set_comparison(spark, sensors):
    from tidewater.sources.readers import same_rows
    ids = sensors.select("id")
    assert same_rows(ids, [("sensor_1",), ("sensor_10",), ("sensor_2",), ("sensor_3",), ("sensor_4",)])
    assert not same_rows(ids, [("sensor_1",), ("sensor_2",)])
    assert same_rows(ids, ids.union(ids))
