"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the given tables.  Oracle SQL for each lives in :mod:`oracle`.

Mapping of the reference's inputs onto the test tables: ``events`` is the
sensor / click / car stream (``id = 'sensor_' || user_id``, temperature =
``value``, event time = ``ts``, arrival order = ``event_id``); text inputs
are ``documents.text``; vectors are ``embeddings``; TPC-H tables as named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.functions import text as T
from tidewater.operators import aggregates as A
from tidewater.operators import relational as R
from tidewater.session import prepare
from tidewater.sources.tables import spread, table

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    prepare(spark)
    return table(spark, sf, name)


def sensor_readings(spark, sf) -> DataFrame:
    """events as sensor readings: (event_id, id, ts, temperature)."""
    e = _t(spark, sf, "events")
    return e.select("event_id", F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
                    "ts", F.col("value").alias("temperature"))


# --------------------------------------------------------------- relational
@query
def tpch_q3(spark, sf):
    return R.tpch_q3(_t(spark, sf, "lineitem"), _t(spark, sf, "customer"), _t(spark, sf, "orders"))


@query
def select_filter(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("event_id", "user_id", "value").filter(F.col("event_type") == "click") \
        .toDF("event_id", "user_id", "amount")


@query
def column_range(spark, sf):
    c = _t(spark, sf, "customer")
    return R.rename_all(R.select_range(c, 1, 4), "id", "name", "nation", "balance")


@query
def prefix_filter(spark, sf):
    return R.prefix_filter(sensor_readings(spark, sf), "id", "sensor_1").select("event_id", "id", "temperature")


@query
def count_by_key(spark, sf):
    return _t(spark, sf, "events").groupBy("user_id").agg(F.count("event_id").alias("cnt"))


@query
def global_count_avg_year(spark, sf):
    o = _t(spark, sf, "orders")
    y = F.year("o_orderdate")
    # integer average stays integer (sum div count), as in the reference engine
    return o.agg(F.count(F.lit(1)).alias("n_orders"),
                 (F.sum(y).cast("long") / F.count(y)).cast("long").cast("int").alias("avg_year"))


def _orders_ab(spark, sf):
    e = _t(spark, sf, "events")
    cols = [F.col("user_id").alias("user"), F.col("event_type").alias("product"), F.col("value").alias("amount")]
    return (e.filter(F.col("event_type") == "click").select(*cols),
            e.filter(F.col("event_type") == "view").select(*cols))


@query
def union_all_filtered(spark, sf):
    a, b = _orders_ab(spark, sf)
    return spark.sql("SELECT * FROM {a} WHERE amount > 30 UNION ALL SELECT * FROM {b} WHERE amount < 5",
                     a=a, b=b)


@query
def union_all_then_filter(spark, sf):
    a, b = _orders_ab(spark, sf)
    return R.union_all(a, b).select("user", "product", "amount").filter(F.col("amount") > 30)


@query
def split_high_low(spark, sf):
    s = sensor_readings(spark, sf).select("event_id", "id", "temperature")
    return R.tag_by_threshold(s, "temperature", 37.0)


@query
def split_then_union(spark, sf):
    s = sensor_readings(spark, sf).select("event_id", "id", "temperature")
    return R.split_union(s, "temperature", 37.0, lambda r: r, lambda r: r)


@query
def connect_comap(spark, sf):
    s = sensor_readings(spark, sf).select("event_id", "id", "temperature")
    return R.split_union(
        s, "temperature", 37.0,
        lambda r: F.struct(r["event_id"], r["id"], r["temperature"], F.lit("warning").alias("status")),
        lambda r: F.struct(r["event_id"], r["id"], F.lit(None).cast("double").alias("temperature"),
                           F.lit("healthy").alias("status")))


# --------------------------------------------------------------- word counts
def doc_words(spark, sf, pattern=T.WORD_SEPARATOR, lower=True) -> DataFrame:
    """Non-empty tokens of every document.  Empty tokens are removed as rows
    after the explode (plain codegen), which also makes the JVM trailing-
    empty rule irrelevant."""
    d = spread(_t(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    text = F.lower("text") if lower else F.col("text")
    return d.select(F.explode(F.split(text, pattern)).alias("word")).filter(F.col("word") != "")


@query
def wordcount_batch(spark, sf):
    w = doc_words(spark, sf).filter(F.col("word") != "")
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@query
def wordcount_sql(spark, sf):
    w = doc_words(spark, sf).filter(F.col("word") != "").select("word", F.lit(1).cast("long").alias("frequency"))
    return spark.sql("SELECT word, SUM(frequency) AS frequency FROM {w} GROUP BY word", w=w)


@query
def having_filter(spark, sf):
    w = doc_words(spark, sf).filter(F.col("word") != "")
    return (w.groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))
            .filter(F.col("frequency") == 2))


def doc_lines(spark, sf) -> DataFrame:
    """Documents as text lines (a line reader splits on \\n, \\r\\n and \\r)."""
    d = spread(_t(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return d.select("doc_id", F.posexplode(F.split(F.col("text"), "\r\n|\r|\n")).alias("line_no", "line"))


@query
def tokenize_variants(spark, sf):
    lines = doc_lines(spark, sf).select("line")
    variants = [("word", T.WORD_SEPARATOR, True, True),
                ("space", T.SPACE, False, False),
                ("ws", T.WHITESPACE_CHAR, False, False),
                ("comma", T.COMMA, False, False),
                ("semicolon", T.SEMICOLON, False, False)]
    # one scan: each line is exploded into its (variant, tokens) pairs; empty
    # tokens are dropped below, so those variants need no trailing rule
    split = lambda pat, lower, drop_empty: (F.split(F.lower("line") if lower else F.col("line"), pat) if drop_empty
                                            else T.words("line", pat, lower))
    pairs = F.array(*[F.struct(F.lit(name).alias("variant"), split(pat, lower, drop_empty).alias("tokens"),
                               F.lit(drop_empty).alias("drop_empty")) for name, pat, lower, drop_empty in variants])
    tok = (lines.select(F.explode(pairs).alias("p"))
           .select("p.variant", "p.drop_empty", F.explode("p.tokens").alias("token"))
           .filter(~F.col("drop_empty") | (F.col("token") != "")))
    return tok.groupBy("variant", "token").agg(F.count(F.lit(1)).alias("cnt"))


@query
def json_english_wordcount(spark, sf):
    from tidewater.sources.readers import parse_json
    d = spread(_t(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id")
    tweets = d.select(F.to_json(F.struct(F.col("text"), F.struct(F.col("lang")).alias("user"))).alias("value"))
    parsed = parse_json(tweets, "value", "text string, user struct<lang: string>")
    english = parsed.filter((F.col("user.lang") == "en") & F.col("text").isNotNull())
    tok = english.select(F.explode(F.split(F.col("text"), "[ \t\n\r\f]+")).alias("t"))
    tok = tok.select(F.lower(F.regexp_replace("t", r"\s", "")).alias("word")).filter(F.col("word") != "")
    return tok.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@query
def wordcount_semicolon(spark, sf):
    from tidewater.sinks.writers import write_delimited_once
    from tidewater.sources.readers import read_lines
    from tidewater.session import scratch_path
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = scratch_path(spark, "people-csv")
    write_delimited_once(c.repartition("c_custkey"), path, sep=";")   # more than one split
    lines = read_lines(spark, path)
    tok = lines.select(F.explode(T.split_drop_trailing("value", T.SEMICOLON)).alias("word"))
    return tok.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


# ------------------------------------------------------- latest value per key
def _nullable_events(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("user_id", "ts", "event_id", "event_type",
                    F.when(F.col("event_type") == "click", F.col("value")).alias("click_value"))


@query
def last_non_null(spark, sf):
    return A.last_non_null(_nullable_events(spark, sf), ["user_id"], ["ts", "event_id"],
                           ["event_type", "click_value"])


@query
def last_row_value(spark, sf):
    return A.last_row(_nullable_events(spark, sf), ["user_id"], ["ts", "event_id"],
                      ["event_type", "click_value"])


@query
def dedup_keep_last(spark, sf):
    e = _t(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return spark.sql("""
        SELECT event_id, ts, user_id, event_type, value
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM {e})
        WHERE rn = 1""", e=e)


@query
def upsert_latest_by_key(spark, sf):
    from tidewater.sinks.upsert import latest_per_key
    s = sensor_readings(spark, sf)
    return latest_per_key(s, ["id"], ["ts", "event_id"]).select("id", "temperature")


@query
def top2_per_key(spark, sf):
    s = sensor_readings(spark, sf)
    return A.top_n_filled(s, ["id"], "temperature", n=2, floor=0.0)


@query
def udaf_avg(spark, sf):
    s = sensor_readings(spark, sf)
    return s.groupBy("id").agg(F.round(A.avg_temp("temperature"), 6).alias("avg_temp"))


# --------------------------------------------------------- scalar functions
@query
def java_hash(spark, sf):
    s = sensor_readings(spark, sf)
    wide = F.concat(F.col("id"), F.lit("\U0001F600"))        # a character of two code units
    return s.select("event_id", "id", T.scaled_hash("id", 2).alias("hash_code"), T.scaled_hash(wide, 2).alias("wide_hash"))


@query
def normalize_address(spark, sf):
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    return cn.select("c_custkey", T.normalize_address("c_name", "n_name", "c_mktsegment").alias("address"))


@query
def lateral_split(spark, sf):
    s = sensor_readings(spark, sf).select("event_id", "id")
    return s.select("event_id", "id", F.explode(T.split_drop_trailing("id", "_")).alias("word")) \
        .withColumn("length", F.length("word"))


@query
def getting_started(spark, sf):
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    raw = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_name", "c_acctbal", "n_name", "c_mktsegment", (F.col("c_acctbal") > 0).alias("has_credit"),
        "c_custkey")
    named = R.rename_all(R.select_range(raw, 1, 5), "name", "balance", "city", "segment", "has_credit")
    young = (named.filter(F.col("segment").isNotNull())
             .filter(F.col("has_credit") == F.lit(True))
             .filter(F.col("balance") >= 5000.0))
    return young.select(F.upper("name").alias("name"), "balance",
                        T.normalize_address("name", "segment", "city").alias("address"))
