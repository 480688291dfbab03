"""Grouped aggregates: latest value per key, top-N table aggregate, average.

All of these are partial/final hash aggregates or group-limited windows, so a
hot key is reduced map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _ord(order) -> Column:
    cols = [F.col(o) if isinstance(o, str) else o for o in ([order] if isinstance(order, (str, Column)) else order)]
    return F.struct(*cols)


def last_non_null(df: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """``LAST_VALUE`` per key that skips NULLs: per column, the value of the
    latest row (by ``order``) where that column is not null."""
    o = "struct(" + ", ".join(f"`{c}`" for c in order) + ")"
    aggs = [F.expr(f"max_by(`{c}`, {o}) FILTER (WHERE `{c}` IS NOT NULL)").alias(c) for c in cols]
    return df.groupBy(*keys).agg(*aggs)


def last_row(df: DataFrame, keys: list[str], order, cols: list[str]) -> DataFrame:
    """Values of the latest row per key, NULLs included."""
    o = _ord(order)
    rec = F.max_by(F.struct(*[F.col(c) for c in cols]), o).alias("__r")
    return df.groupBy(*keys).agg(rec).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in cols])


def top_n_filled(df: DataFrame, keys: list[str], value: str, n: int = 2, floor: float = 0.0,
                 value_name: str = "temp", rank_name: str = "rank") -> DataFrame:
    """Table aggregate "top N values with rank": always N rows per key; slots
    start at ``floor`` so values <= floor never enter and empty slots read
    ``floor``; equal values may fill several slots.

    ``row_number() <= n`` is planned as a partial group limit before the
    shuffle, so each map task sends at most N rows per key.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc())
    top = (df.select(*keys, value)
           .withColumn("__rk", F.row_number().over(w))
           .filter(F.col("__rk") <= n))
    # at most n entries per key (bounded); the aggregate reuses the window's
    # partitioning, so the whole operator has one exchange
    slots = top.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__rk", value))).alias("__m"))
    out = slots.select(*keys, "__m", F.explode(F.sequence(F.lit(1), F.lit(n))).alias(rank_name))
    v = F.greatest(F.coalesce(F.element_at("__m", F.col(rank_name)), F.lit(floor)), F.lit(floor))
    return out.select(*keys, v.cast("double").alias(value_name), F.col(rank_name).cast("int"))


def avg_temp(col) -> Column:
    """Aggregate function with a (sum, count) accumulator; Spark's partial /
    final aggregation is the accumulate / merge step."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c) / F.count(c)
