"""Registered queries: per-key sequential operators, OVER windows, changelogs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.operators import changelog as CL
from tidewater.operators import keyed as K
from tidewater.operators.accumulators import Accumulator, accumulate, register_accumulator
from tidewater.plans import sequence as S
from tidewater.plans.catalog import _t, query, sensor_readings

WORD_BLOCK_BYTES = 32 << 20        # text of a range in running_wordcount
ORDER = ["ts", "event_id"]


@query
def jump_alert(spark, sf):
    s = sensor_readings(spark, sf)
    return K.jump_alert(s, "id", ORDER, None, "temperature", 10.0) \
        .select("event_id", "id", "last_value", "temperature")


@query
def jump_alert_default_zero(spark, sf):
    s = sensor_readings(spark, sf)
    return K.jump_alert(s, "id", ORDER, None, "temperature", 10.0, initial=0.0) \
        .select("event_id", "id", "last_value", "temperature")


@query
def running_reduce(spark, sf):
    s = sensor_readings(spark, sf).withColumn("time_stamp", F.unix_seconds(F.col("ts").cast("timestamp")))
    return K.running_reduce_latest_step(s, "id", ORDER, None, "time_stamp", 10) \
        .select("event_id", "id", "time_stamp", "temperature")


PRIME = 1_000_003


def affine_step(a, b):
    """First a, then b, of the maps y -> m * y + c modulo PRIME."""
    return {"m": a["m"] * b["m"] % PRIME, "c": (b["m"] * a["c"] + b["c"]) % PRIME}


@query
def running_reduce_any(spark, sf):
    """A linear recurrence per reading, y = 3 * y + cents: a running reduce
    with a function that does not commute."""
    from tidewater.operators.accumulators import running_reduce as reduce_any
    s = sensor_readings(spark, sf).select("event_id", "id", "ts", F.lit(3).cast("long").alias("m"),
                                          F.round(F.col("temperature") * 100).cast("long").alias("c"))
    r = reduce_any(s, ["id"], ORDER, affine_step, ["m", "c"])
    return r.select("event_id", "id", (F.col("c") % PRIME).alias("state"))


class MeanAndSpread(Accumulator):
    """Number, mean and spread of a column, in exact hundredths."""

    def __init__(self, col: str):
        self.col = col

    def zero(self):
        return 0, 0, None, None

    def add(self, state, rows):
        v = rows.column(self.col).drop_null().to_numpy(zero_copy_only=False)
        if not len(v):
            return state
        cents = np.rint(v * 100).astype(np.int64)
        return self.merge(state, (len(v), int(cents.sum()), int(cents.min()), int(cents.max())))

    def merge(self, state, other):
        if not state[0] or not other[0]:
            return state if state[0] else other
        return state[0] + other[0], state[1] + other[1], min(state[2], other[2]), max(state[3], other[3])

    def finish(self, state):
        n, total, low, high = state
        return [(n, round(total / n / 100, 6) if n else None, (high - low) / 100 if n else None)]


@query
def udaf_accumulate(spark, sf):
    e = _t(spark, sf, "events").select("event_type", "value")
    return accumulate(e, ["event_type"], MeanAndSpread("value"), "n long, mean double, spread double")


@query
def sql_udaf_merge(spark, sf):
    """The same accumulator from SQL text, merged from partial states."""
    register_accumulator(spark, "mean_spread", MeanAndSpread("temperature"), "id", "string", "n long, mean double, spread double")
    return spark.sql("""SELECT id, n, mean, spread FROM mean_spread_merge(TABLE(
                          SELECT * FROM mean_spread_partial(TABLE(SELECT id, temperature FROM {s}))) PARTITION BY id)""",
                     s=sensor_readings(spark, sf))


class HeavyBins(Accumulator):
    """Table aggregate: the bins of a column that hold at least ``share``
    percent of the key's rows, with their number."""

    def __init__(self, col: str, share: int):
        self.col, self.share = col, share

    def zero(self):
        return {}

    def add(self, state, rows):
        bins, n = np.unique(rows.column(self.col).to_numpy(zero_copy_only=False), return_counts=True)
        return self.merge(dict(state), dict(zip(bins.tolist(), n.tolist())))

    def merge(self, state, other):
        for b, n in other.items():
            state[b] = state.get(b, 0) + n
        return state

    def finish(self, state):
        total = sum(state.values())
        return [(b, n) for b, n in sorted(state.items()) if 100 * n >= self.share * total]


@query
def table_agg_heavy_bins(spark, sf):
    e = _t(spark, sf, "events").filter("value is not null") \
        .select("event_type", F.floor(F.col("value") / 10).cast("long").alias("bin"))
    return accumulate(e, ["event_type"], HeavyBins("bin", 5), "bin long, cnt long")


@query
def running_wordcount(spark, sf):
    # the documents are cut into ranges, not their tokens: no token is written or shuffled
    docs = _t(spark, sf, "documents").select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // WORD_BLOCK_BYTES + 1)
    d, block = S.balanced_bucket(docs, ["doc_id"], [], blocks)
    return K.running_word_count(d, "doc_id", "text", T.WORD_SEPARATOR, block, blocks)


@query
def changelog_count(spark, sf):
    s = sensor_readings(spark, sf)
    return CL.changelog_count(s, "id", ORDER, None, carry=["event_id"])


@query
def changelog_adds_top1(spark, sf):
    s = sensor_readings(spark, sf).select("event_id", "id", "ts", "temperature")
    return CL.top1_additions(s, "id", ORDER, None, "temperature").select("event_id", "id", "temperature",
                                                                             "is_add")


@query
def over_rows_2_preceding(spark, sf):
    s = sensor_readings(spark, sf)
    r = K.rows_frame(s, ["id"], ORDER, None, 2,
                     {"cnt": lambda w: F.count("id").over(w),
                      "avg_temp": lambda w: F.round(F.avg("temperature").over(w), 6)})
    return r.select("event_id", "id", "cnt", "avg_temp")


@query
def over_rows_named_window(spark, sf):
    s = sensor_readings(spark, sf)
    ctx = S.with_preceding(s, ["id"], ORDER, None, 2)
    r = spark.sql("""
        SELECT event_id, id, ts, _ghost,
               count(id) OVER w AS cnt,
               round(avg(temperature) OVER w, 6) AS avg_temp
        FROM {ctx}
        WINDOW w AS (PARTITION BY id, _bkt ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
                  ctx=ctx)
    return r.filter(~F.col("_ghost")).select("event_id", "id", "ts", "cnt", "avg_temp")


# ------------------------------------------------------ SQL function surface
@query
def sql_hash_code(spark, sf):
    from tidewater.functions.sql_functions import register_sql_functions
    register_sql_functions(spark)
    return spark.sql("SELECT event_id, id, hash_code(id, 2) AS hash_code, hash_code(id || '\U0001F600', 2) AS wide_hash FROM {s}",
                     s=sensor_readings(spark, sf))


@query
def sql_lateral_split(spark, sf):
    from tidewater.functions.sql_functions import register_sql_functions
    register_sql_functions(spark)
    s = sensor_readings(spark, sf).select("event_id", "id")
    return spark.sql("SELECT s.event_id, s.id, t.word, t.length FROM {s} s, LATERAL split_words(s.id, '_') t", s=s)


@query
def sql_normalize_address(spark, sf):
    from tidewater.functions.sql_functions import register_sql_functions
    register_sql_functions(spark)
    c, n = _t(spark, sf, "customer"), _t(spark, sf, "nation")
    return spark.sql("""SELECT c_custkey, normalize_address(c_name, n_name, c_mktsegment) AS address
                        FROM {c} JOIN {n} ON c_nationkey = n_nationkey""", c=c, n=n)
