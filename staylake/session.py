"""Session helpers: building a session and finding the shared work folder.

Everything that has to be written between steps (CSV snapshots, staged
Parquet, star tables, streaming checkpoints) goes below the folder the
cluster names in ``spark.checkpoint.dir``.  That folder is shared by all
executors, so a lost executor never takes written data with it.  Only when
the setting is absent (unit tests, a laptop) do we pick a folder ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a production job wants on: adaptive execution re-plans joins
# with measured sizes, coalesces small shuffle partitions and splits
# skewed ones; the session zone is pinned so timestamp text is stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # min/max/count answered from Parquet footers (e.g. max surrogate id).
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files of unreachable DataFrames are removed by the cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str = "local[*]", app: str = "staylake",
              shuffle_partitions: int | None = 8,
              conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects."""
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_dir(spark)
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and checkpoints.

    Read from ``spark.checkpoint.dir``, else from the checkpoint folder the
    context already has.  A folder of our own is set only on a local master:
    on a cluster it would be a different disk on every machine.
    """
    context = spark.sparkContext
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or context.getCheckpointDir())
    if not configured:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="staylake-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the work folder for one run of one job."""
    return f"{work_dir(spark)}/staylake/{name}-{uuid.uuid4().hex[:12]}"
