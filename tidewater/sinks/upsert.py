"""Keyed upsert: a table that holds the latest value per key.

The reference updates a row by key and inserts when nothing was updated, one
statement per record.  Here each micro-batch (or a static DataFrame) is first
reduced to its latest row per key -- a partial/final aggregate, so a hot key
costs one row per map task -- and then merged as a set:

* ``upsert_parquet``: the changed rows of a batch become a version folder of
  their own (merge on read, in proportion to the change); every
  ``COMPACT_EVERY`` versions the state so far is written as one;
* ``upsert_jdbc``: executors bulk-write the reduced batch to a staging table,
  then one ``MERGE`` statement runs in the database.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, functions as F

from tidewater.sinks.versions import commit, committed, version_path


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Latest row per key by ``order`` (later order wins)."""
    cols = [c for c in df.columns if c not in keys]
    rec = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(*keys).agg(rec.alias("__r")).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in cols])


COMPACT_EVERY = 16


def upsert_parquet(spark, batch: DataFrame, path: str, version: int, keys: list[str],
                   order: list[str]) -> str:
    """Add the latest rows of ``batch`` as version ``version`` below ``path``;
    :func:`read_upserted` resolves the newest row per key.  Writing is in
    proportion to the batch.  Every ``COMPACT_EVERY`` versions the state is
    also written as one table below ``path/base``, so that a reader meets at
    most that many deltas.  A replayed version rewrites its own folders."""
    out = commit(latest_per_key(batch, keys, order), f"{path}/delta", version)
    if (version + 1) % COMPACT_EVERY == 0:
        commit(read_upserted(spark, path, keys, order, version), f"{path}/base", version)
    return out


def read_upserted(spark, path: str, keys: list[str], order: list[str], upto: int | None = None) -> DataFrame | None:
    """The newest row per key over the newest base and the deltas after it
    (up to a version); None if nothing was ever committed.  Of two versions
    the later one wins, whatever their order columns say."""
    end = upto if upto is not None else 2 ** 62
    bases = [v for v in committed(spark, f"{path}/base") if v < end]
    deltas = [v for v in committed(spark, f"{path}/delta") if (not bases or v > bases[-1]) and v <= end]
    parts = [(f"{path}/base", bases[-1])] if bases else []
    parts += [(f"{path}/delta", v) for v in deltas]
    if not parts:
        return None
    log = None
    for folder, v in parts:
        one = spark.read.parquet(version_path(folder, v)).withColumn("__version", F.lit(v))
        log = one if log is None else log.unionByName(one)
    return latest_per_key(log, keys, ["__version"]).drop("__version")


def upsert_jdbc(spark, batch: DataFrame, url: str, table: str, keys: list[str], order: list[str],
                value_cols: list[str], properties: dict | None = None,
                string_type: str = "VARCHAR(1024)") -> None:
    """Latest value per key into a JDBC table through a staging table and a
    single ``MERGE`` (one round trip per batch instead of per row).  String
    columns of the staging table get ``string_type`` so they compare with
    the target's keys."""
    props = dict(properties or {})
    latest = latest_per_key(batch, keys, order).select(*keys, *value_cols)
    staging = f"{table}_STAGE"
    str_cols = [c for c, t in latest.dtypes if t == "string"]
    w = latest.write.mode("overwrite")
    if str_cols:
        w = w.option("createTableColumnTypes", ", ".join(f"{c} {string_type}" for c in str_cols))
    w.jdbc(url, staging, properties=props)
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sets = ", ".join(f"{c} = s.{c}" for c in value_cols)
    cols = ", ".join(keys + value_cols)
    vals = ", ".join(f"s.{c}" for c in keys + value_cols)
    stmt = (f"MERGE INTO {table} t USING {staging} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})")
    _jdbc_execute(spark, url, [stmt], props)


@contextmanager
def jdbc_connection(spark, url: str, props: dict):
    """A connection of the driver JVM's JDBC DriverManager."""
    jvm = spark.sparkContext._jvm
    jp = jvm.java.util.Properties()
    for k, v in props.items():
        jp.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, jp)
    try:
        yield conn
    finally:
        conn.close()


def _jdbc_execute(spark, url: str, statements: list[str], props: dict) -> None:
    """Run DDL/DML statements."""
    with jdbc_connection(spark, url, props) as conn:
        st = conn.createStatement()
        for s in statements:
            st.execute(s)
        st.close()
