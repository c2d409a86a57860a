"""Session settings the plans rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Dates are cut in UTC everywhere. Skewed joins are split by AQE even when the
# split costs one more exchange: a hot key must never land in a single task. A join
# on several keys may use sides that are bucketed by one of them.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session made elsewhere.

    The number of exchange partitions is the session's: the caller knows the
    bytes of a run, and adaptive execution merges what is small.
    """
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(
    cores: int | str = 8, app: str = "palimpsest", extra: dict[str, str] | None = None,
) -> SparkSession:
    """Single-JVM session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for name, value in {**SQL_SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session.

    Executors of a cluster must all see what a job writes, so the folder comes
    from ``spark.checkpoint.dir``. Only a local-mode session, where driver and
    executors are one process, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="palimpsest-")
    return f"{shared.rstrip('/')}/palimpsest/{purpose}-{uuid.uuid4().hex}"
