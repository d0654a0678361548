"""SparkSession helpers.

On a cluster the session comes from the platform; ``configure`` sets the SQL
settings the models rely on (ANSI, UTC as the session time zone, AQE with
coalescing and skew join) whatever the cluster set for them, and one tuning
value only where the session still has Spark's default. With UTC, an unpinned
"today" is the UTC date. The
checkpoint folder is read from ``spark.checkpoint.dir``; a local one is created
only when nothing is configured (tests on one machine).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the models depend on. ANSI stays on: bad casts and division by zero
# must fail loudly, every division in the models is guarded.
_REQUIRED = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Tuning applied only where the session still has Spark's default value.
# AQE turns a sort-merge join into a shuffled hash join when every partition
# of the build side was measured below this size (no sort; the size check at
# runtime keeps the hash maps small), else the sort-merge join stays.
_TUNING_IF_DEFAULT = {
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": ("0b", "64MB"),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the models need to an existing session."""
    for key, value in _REQUIRED.items():
        spark.conf.set(key, value)
    for key, (default, value) in _TUNING_IF_DEFAULT.items():
        if spark.conf.get(key, default) in (default, "0"):
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, the benchmark) gets a folder of its own
    when none is configured; on a cluster an unset folder stays unset, since
    a machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            return None
        configured = tempfile.mkdtemp(prefix="bankmart-ckpt-")
    # spark.checkpoint.dir itself cannot change at run time; the context's
    # checkpoint folder can
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "bankmart", warehouse: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, no servers)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BANKMART_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    for key, value in _REQUIRED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
