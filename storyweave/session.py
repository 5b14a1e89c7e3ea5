"""Session settings and the two ways of cutting lineage: checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Sorts are skipped where the shuffled partitions turn out small enough to hash.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages are long: hand them to Python a few at a time.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Folders of a table are listed many a task: one a task costs more to hand out than to list.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "storyweave", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> None:
    """The settings a running session can still take."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; only local masters may do without."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if context.applicationId not in _own_folders:
            _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="storyweave-")
        folder = _own_folders[context.applicationId]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for the small state carried between rounds of a loop."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write once as Parquet in the shared folder, in a folder for each value of ``by``, and read back, for tables that several steps scan."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=list(by) or None)
    return spark.read.schema(df.schema).parquet(path)
