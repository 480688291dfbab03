"""Count windows per key (windows measured in rows, not time).

* sliding ``(size, slide)``: every ``slide``-th row of a key emits the sum of
  its last ``size`` rows (fewer at the start); rows after the last multiple
  of ``slide`` emit nothing.
* tumbling ``size``: each complete block of ``size`` rows emits once.

Plans: the row number of each row within its key is a bucketed running
count (:mod:`tidewater.plans.sequence`), so a hot key is split across
buckets.  Sliding sums add up panes of ``gcd(size, slide)`` rows: one partial
aggregate per pane, then each pane goes to the size/slide windows it lies in.
No frame of ``size`` rows is materialised and no difference of large prefix
sums is taken, so tiny values keep their digits.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.plans import sequence as S


def sliding_count_window_sum(df: DataFrame, keys: list[str], order: list[str], bucket: Column | None,
                             value: str, size: int, slide: int, out: str = "total") -> DataFrame:
    if df.isStreaming:
        from tidewater.streaming.stateful import count_window_stream
        (key,) = keys
        return count_window_stream(df, key, order, value, size, slide).withColumnRenamed("total", out)
    d = df.select(*keys, *order, F.col(value).cast("double").alias("__v"))
    ranked = S.running_agg(d, keys, order, bucket, [("__n", F.lit(1), "count")])
    g = gcd(size, slide)
    panes = (ranked.groupBy(*keys, F.floor((F.col("__n") - 1) / g).cast("long").alias("__p"))
             .agg(F.sum("__v").alias("__s"), F.count(F.lit(1)).alias("__c")))
    # window f ends with row f * slide; pane p is rows p*g+1 .. (p+1)*g
    first = F.ceil((F.col("__p") + 1) * g / F.lit(slide)).cast("long")
    last = F.floor((F.col("__p") * g + size) / F.lit(slide)).cast("long")
    wide = (panes.withColumn("__a", first).withColumn("__b", last).filter("__a <= __b")
            .select(*keys, F.explode(F.sequence("__a", "__b")).alias("__f"), "__s", "__c"))
    sums = wide.groupBy(*keys, "__f").agg(F.sum("__s").alias(out), F.sum("__c").alias("__c"))
    n = F.col("__f") * slide
    # a window that the key's rows do not reach has fewer rows than it should
    return (sums.filter(F.col("__c") == F.least(n, F.lit(size))).select(*keys, n.alias("n"), out))


def tumbling_count_window(df: DataFrame, keys: list[str], order: list[str], bucket: Column | None,
                          size: int, aggs: list[Column],
                          stream_aggs: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Each complete block of ``size`` rows of a key, with ``aggs`` over it.
    A streaming input needs them as ``{name: (column, kind)}`` instead (see
    ``streaming.stateful.tumbling_count_window_stream``)."""
    if df.isStreaming:
        from tidewater.streaming.stateful import tumbling_count_window_stream
        (key,) = keys
        return tumbling_count_window_stream(df, key, order, size, stream_aggs or {})
    ranked = S.running_agg(df, keys, order, bucket, [("__n", F.lit(1), "count")])
    grp = ranked.withColumn("__blk", F.floor((F.col("__n") - 1) / F.lit(size)).cast("long"))
    return (grp.groupBy(*keys, "__blk").agg(F.count(F.lit(1)).alias("__cnt"), *aggs)
            .filter(F.col("__cnt") == size)
            .withColumn("window_no", F.col("__blk") + 1)
            .drop("__blk", "__cnt"))
