"""Versioned state tables: one folder per version below a path.

A version is committed when its writer has finished (Spark's ``_SUCCESS``
file).  Readers take the newest committed version before their own, so a
skipped number or a half-written version is passed over, and nothing but the
absence of any committed version means "empty": errors in reading a committed
version are raised.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions, ascending."""
    fs, p = _files(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for status in fs.listStatus(p):
        m = re.fullmatch(r"v=(\d+)", status.getPath().getName())
        if m and fs.exists(status.getPath().suffix("/_SUCCESS")):
            out.append(int(m[1]))
    return sorted(out)


def version_path(path: str, version: int) -> str:
    return f"{path}/v={version:08d}"


def newest_before(spark: SparkSession, path: str, version: int) -> str | None:
    """Folder of the newest committed version below ``version``."""
    older = [v for v in committed(spark, path) if v < version]
    return version_path(path, older[-1]) if older else None


# Versions that a state table keeps: only the last batch can be replayed, and
# it reads the version before its own.
KEPT = 3


def commit(df: DataFrame, path: str, version: int, keep: int | None = None) -> str:
    """Write a version (again, if its batch is replayed); of tables whose
    newest version holds everything, ``keep`` versions stay."""
    out = version_path(path, version)
    df.write.mode("overwrite").parquet(out)
    if keep:
        fs, p = _files(df.sparkSession, path)
        for old in [v for v in committed(df.sparkSession, path) if v <= version][:-keep]:
            fs.delete(p.suffix(f"/v={old:08d}"), True)
    return out
