"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Results depend on UTC day boundaries; the rest lets AQE size and re-plan shuffles.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python sees batches of bounded size, however long the texts are.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def ready(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, settings: Mapping[str, str] | None = None
) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("obslake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(map=dict(settings or {}))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return ready(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, read from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own; on a
    cluster a machine-local folder would not be visible to every executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="obslake-"))
        configured = context.getCheckpointDir()
    return configured.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses, under this application's name."""
    application = f"obslake-{spark.sparkContext.applicationId}"
    return f"{shared_dir(spark)}/{application}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back.

    Cuts the lineage, spares a second evaluation and makes the size known, so that
    Spark broadcasts a small dimension by its own size check and shuffles a large one.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give every core work when costly per-row Python follows a scan of few splits.

    For plain scans. Large ones come in more splits than there are cores and pass
    through unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
