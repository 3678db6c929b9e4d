"""Session helpers for tests, the bench and command-line runs.

Library code never creates a session or sets the master; it uses the
session that owns its input frames.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings the operators rely on (UTC wall clock for naive event times,
# AQE for runtime coalescing and skew splitting).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split in a join even if the step above then has to shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


# Defaults for large clusters, applied by the command line only where the
# submitted configuration leaves them unset. Scan splits and post-shuffle
# partitions of ~256 MB keep tasks inside executor memory; AQE coalesces
# small stages to the advisory size instead of spreading them thin
# (parallelismFirst off). The one wide shuffle of the batch chain, the
# full-row ledger de-duplication, has its own width (``--dedupe-partitions``):
# a session-wide width for it would cost the driver map tasks x partitions
# of bookkeeping in every other shuffle.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "shelfwise") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder that ``spark.checkpoint.dir`` names.

    Only a local master may leave it unset (tests): then a scratch folder is
    created and registered. On a cluster a folder of the driver's machine
    would be out of the executors' reach, so an unset folder is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "local") or "local"
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # Spark Connect: no SparkContext; the conf is enough
        pass
    return path


_RUN: ContextVar[str | None] = ContextVar("shelfwise_run", default=None)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for stream checkpoints and lineage-cutting tables."""
    return ensure_checkpoint_dir(spark).rstrip("/")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this process wrote, through Spark's file systems."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


@contextmanager
def run_folder(spark: SparkSession):
    """Tables that :func:`materialize` writes inside this block go to one
    folder, which is deleted when the block ends."""
    path = f"{checkpoint_root(spark)}/tables/run-{uuid.uuid4().hex[:12]}"
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        delete_folder(spark, path)


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read
    it back: the lineage is cut at a columnar table that any executor can
    re-read after a failure (cheaper to write than an RDD checkpoint)."""
    spark = df.sparkSession
    root = _RUN.get() or f"{checkpoint_root(spark)}/tables"
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
