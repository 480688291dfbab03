"""Session construction and shared-folder helpers.

Everything that has to be written between jobs (lineage cuts, round-trip
tables, stream checkpoints) goes below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (unit tests,
a laptop) do we pick a temporary folder ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the library relies on.  Session time zone is
# pinned to UTC so that event-time arithmetic on TIMESTAMP columns does not
# depend on the machine the driver runs on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Arrow batches to Python workers: bounded by bytes, as texts may be long
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tidewater", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench.  On a cluster the launcher decides
    master and shuffle width; only the library-wide settings are applied."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators depend on to a session made
    elsewhere (the driver's).  Only SQL runtime settings are touched."""
    for name in ("spark.sql.session.timeZone", "spark.sql.streaming.stateStore.providerClass",
                 "spark.sql.execution.arrow.maxBytesPerBatch"):
        if spark.conf.get(name, None) != BASE_CONF[name]:
            spark.conf.set(name, BASE_CONF[name])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if the
    session has none and runs in this one process (tests)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # static conf on some deployments; context dir is set
            pass
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
