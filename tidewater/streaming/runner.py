"""Running Structured Streaming queries to completion over file streams.

* ``replay_as_files``: split a static DataFrame into ``n`` chunks by ranges of
  an order column, written one after another by several tasks each, so a file
  stream sees them as successive micro-batches in order (files out of event
  order make Spark drop rows behind the watermark).
* ``spread_as_files``: the same in one pass, in no order.
* ``run_available_now``: append-mode query into a file sink with a
  checkpoint; returns the sink folder.
* ``run_keyed_updates``: update-mode query whose micro-batches are written
  in ``foreachBatch`` as ``batch_id`` folders of a keyed table (merge on
  read: latest row per key wins); a replayed batch rewrites its folder.

Checkpoints and sink folders go below the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.session import scratch_path


def tolerate_idle_inputs(spark: SparkSession) -> None:
    """Multi-input stream queries (joins, unions) follow the fastest input's
    watermark instead of the slowest, so an idle source does not hold the
    others back.  Set before the query starts."""
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")


def replay_width(spark: SparkSession) -> int:
    """Files of a chunk, one for each core of the cluster."""
    return spark.sparkContext.defaultParallelism


def replay_as_files(spark: SparkSession, df: DataFrame, order_col: str, n: int, path: str, fmt: str = "parquet",
                    columns: list[str] | None = None, files: int | None = None) -> str:
    """Write ``df`` as ``n`` consecutive chunks of ranges of the integer
    column ``order_col`` (rows without one come first), ``files`` files each
    (default: one per core), written by as many tasks; only ``columns``, if given -- e.g. the one
    string column of a text file.  A file stream over the returned pattern
    with ``maxFilesPerTrigger=files`` takes a chunk per micro-batch.  Rows of
    a chunk are in no order, as in any micro-batch."""
    files = files or replay_width(spark)
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    lo, hi = (0, 0) if lo is None else (int(lo), int(hi))
    for i in range(n):
        a, b = lo + (hi - lo + 1) * i // n, lo + (hi - lo + 1) * (i + 1) // n
        mine = (F.col(order_col) >= F.lit(a)) & (F.col(order_col) < F.lit(b))
        if i == 0:
            mine = mine | F.col(order_col).isNull()
        (df.filter(mine).select(*(columns or df.columns)).repartition(files)
         .write.mode("overwrite").format(fmt).save(f"{path}/c{i:05d}"))
    return f"{path}/c*"


def spread_as_files(df: DataFrame, n: int, path: str, fmt: str = "parquet", files: int | None = None) -> str:
    """Write ``df`` as ``n * files`` files in one pass, for streams whose
    result does not depend on the order of the rows."""
    df.repartition(n * (files or replay_width(df.sparkSession))).write.mode("overwrite").format(fmt).save(path)
    return path


def run_available_now(stream: DataFrame, out_path: str, fmt: str = "parquet", mode: str = "append",
                      checkpoint: str | None = None, timeout_s: float | None = None) -> str:
    spark = stream.sparkSession
    ckpt = checkpoint or scratch_path(spark, "ckpt")
    q = (stream.writeStream.format(fmt).outputMode(mode)
         .option("checkpointLocation", ckpt)
         .option("path", out_path)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination(timeout_s)
    if q.exception():
        raise q.exception()
    return out_path


def run_keyed_updates(spark: SparkSession, stream: DataFrame, keys: list[str], table_path: str,
                      checkpoint: str | None = None, timeout_s: float | None = None) -> DataFrame:
    """Run an updating aggregate (update mode) to completion and return the
    current table: the newest row per key.

    Merge-on-read: each micro-batch writes only its changed rows into its
    own ``batch_id=N`` folder (overwritten when a batch is replayed, so the
    sink is idempotent); :func:`read_keyed_table` resolves the latest row
    per key with a partial/final ``max_by`` aggregate.  Writing is
    proportional to the changes; every ``COMPACT`` batches the table is
    rewritten as one version, and the folders that only the version before
    needed are removed, so there are never more than 2 * ``COMPACT``."""
    ckpt = checkpoint or scratch_path(spark, "ckpt")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")
        if batch_id % COMPACT == COMPACT - 1:
            compact_keyed_table(spark, table_path, keys, batch_id)

    q = (stream.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.exception():
        raise q.exception()
    return read_keyed_table(spark, table_path, keys, stream.schema)


COMPACT = 16


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def compact_keyed_table(spark: SparkSession, table_path: str, keys: list[str], batch_id: int) -> None:
    """Write the table up to a batch as one version.  Folders since the
    version before stay, as a replay of this batch reads them again."""
    from tidewater.sinks.versions import KEPT, commit, committed
    old = [v for v in committed(spark, f"{table_path}/_compacted") if v < batch_id]
    commit(read_keyed_table(spark, table_path, keys, before=batch_id), f"{table_path}/_compacted", batch_id, KEPT)
    if old:
        fs, p = _folder(spark, table_path)
        for status in fs.listStatus(p):
            name = status.getPath().getName()
            if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= old[-1]:
                fs.delete(status.getPath(), True)


def read_keyed_table(spark: SparkSession, table_path: str, keys: list[str], schema=None, before: int | None = None) -> DataFrame:
    """Latest row per key of a keyed table: its newest compacted version (the
    newest below ``before``) and the ``batch_id=`` folders after it."""
    from tidewater.sinks.upsert import latest_per_key
    from tidewater.sinks.versions import committed, version_path
    fs, folder = _folder(spark, table_path)
    if not fs.exists(folder):            # nothing written yet; other errors are raised
        if schema is None:
            raise FileNotFoundError(table_path)
        return spark.createDataFrame([], schema)
    rows = spark.read.parquet(table_path)
    if base := [v for v in committed(spark, f"{table_path}/_compacted") if before is None or v < before]:
        whole = spark.read.parquet(version_path(f"{table_path}/_compacted", base[-1])).withColumn("batch_id", F.lit(base[-1]))
        rows = rows.filter(F.col("batch_id") > base[-1]).unionByName(whole)
    return latest_per_key(rows, keys, ["batch_id"]).drop("batch_id")
