"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys: AQE cuts a shuffle partition far above the median into
    # several tasks and repeats the matching rows of the other side.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Top-n per key cuts each map task's rows to n also for large n.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    # Windows and dedupe state outgrow the heap long before the cluster's disks.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "feedlens", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of the same application for streaming jobs.

    The number of state partitions is fixed for the life of a checkpoint, so it must not
    follow whatever the batch session has set: it is the cluster's parallelism unless
    given.
    """
    session = spark.newSession()
    for key, value in SESSION_DEFAULTS.items():
        session.conf.set(key, value)
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def use_utc(spark: SparkSession) -> SparkSession:
    """Days, windows and last-N-days limits are all UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    A session without the setting uses a folder below its warehouse. On a cluster that must not be the driver's own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith("file:") and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see; the warehouse is on the driver's machine")
    return f"{warehouse}/_runs"


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one run's tables, deleted when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read again.

    The written files cut the lineage (a lost executor costs a re-read, not the job) and give
    the planner real sizes, so it broadcasts a side only when the measured size allows.
    """
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def enable_checkpoints(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` and ALS at the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")
