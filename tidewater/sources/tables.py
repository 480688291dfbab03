"""Parquet test/production tables.

Reads are lazy: Catalyst prunes columns and pushes filters into the scan, so
callers select what they need after ``table()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-distribute an under-split input on ``key`` (a unique id) before
    CPU-heavy per-row work such as tokenizing text.  Only when the scan gives
    fewer splits than the session has cores -- a table stored as one large
    row group, or unsplittable files; a large table already has enough
    splits and is returned as it is (no extra shuffle).  Checking the split
    count plans the scan; it runs no job."""
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key)
