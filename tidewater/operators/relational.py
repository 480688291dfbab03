"""Projections, filters, set operations and the TPC-H Q3 variant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def select_range(df: DataFrame, lo: int, hi: int) -> DataFrame:
    """Columns ``lo..hi`` by position, 1-based and inclusive."""
    return df.select(*df.columns[lo - 1:hi])


def rename_all(df: DataFrame, *names: str) -> DataFrame:
    return df.toDF(*names)


def prefix_filter(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Plain prefix match: ``sensor_1`` also keeps ``sensor_10``."""
    return df.filter(F.col(col).startswith(prefix))


def tag_by_threshold(df: DataFrame, col: str, threshold: float, tag: str = "side") -> DataFrame:
    """Split into ``high`` (strictly above) and ``low`` outputs as a tag column;
    consumers filter on the tag (one scan serves every output)."""
    return df.withColumn(tag, F.when(F.col(col) > F.lit(threshold), "high").otherwise("low"))


def split_by_threshold(df: DataFrame, col: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The two outputs as DataFrames of their own, for consumers that differ;
    each of them scans the input.  To bring them together again use
    :func:`split_union`."""
    tagged = tag_by_threshold(df, col, threshold, "__side")
    return (tagged.filter(F.col("__side") == "high").drop("__side"),
            tagged.filter(F.col("__side") == "low").drop("__side"))


def split_union(df: DataFrame, col: str, threshold: float, high, low) -> DataFrame:
    """Split at the threshold, one function per side, one output, in one
    scan: ``high`` and ``low`` map the row (a struct column) to structs of the
    same fields."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    tagged = tag_by_threshold(df, col, threshold, "__side")
    out = F.when(F.col("__side") == "high", high(row)).otherwise(low(row))
    return tagged.select(out.alias("__row")).select("__row.*")


def connect_comap(left: DataFrame, right: DataFrame, left_fn, right_fn) -> DataFrame:
    """Two differently shaped inputs, one function each, one output:
    missing columns on either side are null."""
    return left_fn(left).unionByName(right_fn(right), allowMissingColumns=True)


def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def tpch_q3(lineitem: DataFrame, customer: DataFrame, orders: DataFrame,
            segment: str = "AUTOMOBILE", date: str = "1995-03-12",
            ship_priority: Column | None = None) -> DataFrame:
    """Shipping-priority query: unshipped revenue per order for one market
    segment, ordered by revenue desc then order date.

    Date predicates are written against the raw timestamp columns
    (``to_date(x) < d``  <=>  ``x < d 00:00``; ``to_date(x) > d``  <=>
    ``x >= d+1 00:00``) so they stay pushable into the Parquet scan.
    """
    day = F.lit(date).cast("date")
    day_ts = day.cast("timestamp_ntz")
    next_ts = F.date_add(day, 1).cast("timestamp_ntz")
    c = customer.filter(F.col("c_mktsegment") == segment).select(F.col("c_custkey"))
    o = (orders.filter(F.col("o_orderdate") < day_ts)
         .select("o_orderkey", "o_custkey", "o_orderdate"))
    l = (lineitem.filter(F.col("l_shipdate") >= next_ts)
         .select("l_orderkey", (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("rev")))
    prio = ship_priority if ship_priority is not None else F.lit(0)
    items = (o.join(c, o.o_custkey == c.c_custkey, "inner")
             .select("o_orderkey", "o_orderdate")
             .join(l, F.col("o_orderkey") == F.col("l_orderkey"), "inner"))
    # o_orderdate depends on the order key alone: grouping by the key keeps
    # the join's hash partitioning (no second shuffle when the join is a
    # sort-merge join at scale)
    return (items.groupBy("l_orderkey")
            .agg(F.round(F.sum("rev"), 2).alias("revenue"), F.any_value("o_orderdate").alias("o_orderdate"))
            .select("l_orderkey", "revenue", F.to_date("o_orderdate").alias("o_orderdate"),
                    prio.cast("int").alias("o_shippriority"))
            .orderBy(F.col("revenue").desc(), F.col("o_orderdate").asc()))
