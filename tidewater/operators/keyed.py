"""Per-key sequential operators in batch form (the streaming forms live in
:mod:`tidewater.streaming.stateful`).

Each uses the two-level scans of :mod:`tidewater.plans.sequence`, so no key
is ever processed by a single task as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.plans import sequence as S


def with_previous(df: DataFrame, keys: list[str], order: list[str], bucket: Column | None,
                  col: str, out: str = "prev", default=None) -> DataFrame:
    """Add the previous row's ``col`` per key (``lag``), exact at bucket edges."""
    ctx = S.with_preceding(df, keys, order, bucket, 1)
    w = Window.partitionBy(*keys, S.BKT).orderBy(*order)
    prev = F.lag(F.col(col)).over(w)
    if default is not None:
        prev = F.coalesce(prev, F.lit(default))
    return S.drop_ghosts(ctx.withColumn(out, prev))


def jump_alert(df: DataFrame, key: str, order: list[str], bucket: Column | None, value: str,
               threshold: float, initial: float | None = None) -> DataFrame:
    """Emit ``(key, last, current)`` when ``|current - last| > threshold``.
    Without ``initial`` the first row of a key only sets ``last``; with it,
    the first row is compared with ``initial`` (value-state default).
    A streaming input runs the stateful processor form."""
    if df.isStreaming:
        from tidewater.streaming.stateful import jump_alert_stream
        return jump_alert_stream(df, key, order, value, threshold, initial)
    p = with_previous(df, [key], order, bucket, value, "last_value", initial)
    return p.filter(F.abs(F.col(value) - F.col("last_value")) > F.lit(threshold))


def rows_frame(df: DataFrame, keys: list[str], order: list[str], bucket: Column | None, preceding: int,
               aggs: dict[str, callable], stream_value: str | None = None) -> DataFrame:
    """Aggregates over ``ROWS BETWEEN preceding PRECEDING AND CURRENT ROW``
    per key; ``aggs`` maps output name -> function of a WindowSpec.  A
    streaming input gives ``cnt``, ``total`` and ``avg_value`` of the column
    ``stream_value`` next to the input's columns."""
    if df.isStreaming:
        from tidewater.streaming.stateful import rows_frame_stream
        (key,) = keys
        return rows_frame_stream(df, key, order, stream_value, preceding, [c for c in df.columns if c != key])
    ctx = S.with_preceding(df, keys, order, bucket, preceding)
    w = Window.partitionBy(*keys, S.BKT).orderBy(*order).rowsBetween(-preceding, 0)
    for name, fn in aggs.items():
        ctx = ctx.withColumn(name, fn(w))
    return S.drop_ghosts(ctx)


def running_count(df: DataFrame, keys: list[str], order: list[str], bucket: Column | None, out: str = "n",
                  write_carry: bool = False) -> DataFrame:
    return S.running_agg(df, keys, order, bucket, [(out, F.lit(1), "count")], write_carry=write_carry)


def running_word_count(docs: DataFrame, id_col: str, text: str, separator: str, bucket: Column, blocks: int,
                       out: str = "cnt") -> DataFrame:
    """(id, pos, word, out): every token of the lower-cased texts and how often
    its word came up to it, by (id, pos).  ``bucket`` numbers ranges of ids from
    0 to ``blocks - 1``.  What a word's earlier ranges hold is one written row
    per word and range; it goes to the range's task as the first row of the
    word there, and the texts are split there, so no token is shuffled or
    joined."""
    split = F.posexplode(F.split(F.lower(text), separator)).alias("pos", "word")
    d = docs.select(F.col(id_col), F.col(text).cast("string").alias(text), bucket.cast("int").alias(S.BKT))
    per_block = d.select(S.BKT, split).filter(F.col("word") != "").groupBy("word", S.BKT).agg(F.count("*").alias("n"))
    before = Window.partitionBy("word").orderBy(S.BKT).rowsBetween(Window.unboundedPreceding, -1)
    carry = S.written(per_block.select("word", S.BKT, F.sum("n").over(before).alias("__before")).filter("__before > 0"), "carry")

    # a word of the carry is a text of one token
    rows = d.withColumn("__before", F.lit(None).cast("long")).unionByName(
        carry.select(F.lit(None).cast(d.schema[id_col].dataType).alias(id_col), F.col("word").alias(text), S.BKT, "__before"))
    tokens = rows.repartitionById(blocks, F.col(S.BKT)).select(S.BKT, "__before", id_col, split).filter(F.col("word") != "")
    carried = F.col("__before").isNotNull()
    so_far = (Window.partitionBy("word", S.BKT).orderBy(carried.desc(), id_col, "pos")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = tokens.withColumn(out, F.sum(F.coalesce("__before", F.lit(1).cast("long"))).over(so_far))
    return counted.filter(~carried).select(id_col, "pos", "word", out)


def running_reduce_latest_step(df: DataFrame, key: str, order: list[str], bucket: Column | None, ts_seconds: str,
                               step: int = 10) -> DataFrame:
    """Running reduce of the sample: keep the latest value, advance the
    timestamp by ``step`` per row => ``first_ts + step * (n - 1)``."""
    if df.isStreaming:
        from tidewater.streaming.stateful import running_reduce_stream
        return running_reduce_stream(df, key, order, lambda acc, row: dict(row, **{ts_seconds: acc[ts_seconds] + step}))
    r = S.running_agg(df, [key], order, bucket, [("__n", F.lit(1), "count"), ("__first", ts_seconds, "first")])
    return (r.withColumn(ts_seconds, F.col("__first") + F.lit(step) * (F.col("__n") - 1))
            .drop("__n", "__first"))
