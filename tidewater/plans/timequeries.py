"""Registered queries: event-time windows, count windows, late data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import countwindows as CW
from tidewater.operators import late as L
from tidewater.operators import timewindows as TW
from tidewater.plans.catalog import _t, query, sensor_readings


@query
def tumble_min_reduce(spark, sf):
    s = sensor_readings(spark, sf)
    return TW.tumble(s, ["id"], "ts", "1 hour",
                     [F.min("temperature").alias("min_temp"), F.max_by("ts", "event_id").alias("last_ts")])


@query
def tumble_wordcount(spark, sf):
    e = _t(spark, sf, "events").select(F.col("event_type").alias("word"), "ts")
    return TW.tumble(e, ["word"], "ts", "1 hour", [F.count(F.lit(1)).alias("cnt")])


@query
def sliding_sum(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "ts", "value")
    r = TW.sliding_sum(e, ["user_id"], "ts", "value", "50 minutes", "10 minutes")
    return r.withColumn("total", F.round("total", 6))


@query
def sliding_sum_millis(spark, sf):
    """A window that is no whole number of seconds, on a scale of
    milliseconds: one second of the stream for each minute of ``events``."""
    e = _t(spark, sf, "events").select("user_id", "ts", "value")
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000).cast("long")
    e = e.withColumn("ts", F.timestamp_millis(ms).cast("timestamp_ntz"))
    r = TW.sliding_sum(e, ["user_id"], "ts", "value", "2500 milliseconds", "500 milliseconds")
    return r.withColumn("total", F.round("total", 6))


@query
def session_sum(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return TW.session_windows(e, ["user_id"], "ts", "event_id", 600,
                              [F.count(F.lit(1)).alias("cnt"), F.round(F.sum("value"), 6).alias("total")])


@query
def window_all_model(spark, sf):
    e = _t(spark, sf, "events").select("ts", "value")
    return TW.tumble(e, [], "ts", "1 hour",
                     [F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("model")])


@query
def table_tumble_count_avg(spark, sf):
    s = sensor_readings(spark, sf)
    return (TW.tumble(s, ["id"], "ts", "1 hour",
                      [F.count("id").alias("cnt"), F.round(F.avg("temperature"), 6).alias("avg_temp")])
            .drop("window_start"))


@query
def minby_tumble(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    r = TW.tumble(e, ["user_id"], "ts", "1 hour",
                  [F.min_by(F.struct("event_id", "value"), F.struct("value", "event_id")).alias("r")])
    return r.select("user_id", "window_start", "r.event_id", "r.value")


@query
def ddl_tumble_sum(spark, sf):
    """A table declared over JSON payloads of ``events`` with a computed
    event-time column and a watermark, summed per hour in SQL."""
    from tidewater.sources.table_source import table_source
    e = _t(spark, sf, "events")
    payload = e.select(F.to_json(F.struct(
        "event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))).alias("value"))
    t = table_source(payload, "event_payloads", "event_id bigint, event_type string, value double, at string",
                     computed={"ts": "to_timestamp(at)"}, watermark=("ts", "5 seconds"))
    return spark.sql("""
        SELECT CAST(window.start AS TIMESTAMP_NTZ) AS hour_start, CAST(window.end AS TIMESTAMP_NTZ) AS hour_end,
               event_type, round(sum(value), 6) AS total
        FROM {t}
        WHERE event_type IS NOT NULL
        GROUP BY window(ts, '1 hour'), event_type""", t=t)


@query
def window_join(spark, sf):
    e = _t(spark, sf, "events")
    grades = e.filter(F.col("event_type") == "click").select(F.col("user_id").alias("name"),
                                                             F.col("value").alias("grade"), F.col("ts").alias("gts"))
    salaries = e.filter(F.col("event_type") == "view").select(F.col("user_id").alias("name"),
                                                              F.col("value").alias("salary"), F.col("ts").alias("sts"))
    return TW.window_join(grades, salaries, "name", "gts", "sts", "1 hour") \
        .select("name", "window_start", "grade", "salary")


@query
def count_window_sliding(spark, sf):
    e = _t(spark, sf, "events").select("event_type", "event_id", "value")
    return (CW.sliding_count_window_sum(e, ["event_type"], ["event_id"], None, "value", size=250, slide=150)
            .withColumn("total", F.round("total", 6)))


@query
def count_window_tumbling(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return CW.tumbling_count_window(e, ["user_id"], ["ts", "event_id"], None, 10,
                                    [F.min("value").alias("min_temp"), F.max_by("ts", "event_id").alias("last_ts")])


def _delayed_arrivals(spark, sf):
    """Arrival time = event time, plus two hours for every seventh event id:
    an out-of-order stream derived from ``events``."""
    e = _t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    delay = F.when(F.col("event_id") % 7 == 0, F.expr("INTERVAL 2 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
    return e.withColumn("arrival", F.col("ts") + delay)


LATE_ARGS = dict(size_seconds=900, delay_seconds=180, lateness_seconds=3600)


@query
def late_side_output(spark, sf):
    d = _delayed_arrivals(spark, sf)
    _, late = L.split_late(d, "ts", ["arrival", "event_id"], None, **LATE_ARGS)
    return late.select("event_id", "user_id", "ts", "value")


@query
def late_updates(spark, sf):
    d = _delayed_arrivals(spark, sf)
    on_time, _ = L.split_late(d, "ts", ["arrival", "event_id"], None, **LATE_ARGS)
    return (TW.tumble(on_time, ["user_id"], "ts", "15 minutes",
                      [F.min("value").alias("min_temp"), F.count(F.lit(1)).alias("cnt")])
            .drop("window_end"))


def _marked_arrivals(spark, sf):
    """Events in the order of their number, every seventh with an event time
    five hours back; every 20th carries its time as watermark."""
    e = _t(spark, sf, "events").select(
        "event_id", "user_id", "value",
        F.when(F.col("event_id") % 7 == 3, F.col("ts") - F.expr("INTERVAL 5 HOURS")).otherwise(F.col("ts")).alias("ts"))
    return e, F.when(F.col("event_id") % 20 == 0, F.col("ts"))


@query
def punctuated_windows(spark, sf):
    e, marker = _marked_arrivals(spark, sf)
    closed, _ = L.punctuated_windows(e, ["user_id"], "ts", "event_id", marker, 3600,
                                     [F.min("value").alias("low"), F.count("*").alias("cnt")])
    return closed


@query
def punctuated_late_rows(spark, sf):
    e, marker = _marked_arrivals(spark, sf)
    _, late = L.punctuated_windows(e, ["user_id"], "ts", "event_id", marker, 3600, [F.count("*").alias("cnt")])
    return late
