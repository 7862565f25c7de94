"""Writers. Per-batch output overwrites its own ``batch_id`` partition, so a batch that
is run again after a failure replaces its rows instead of repeating them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.operators.events import dedupe_events, encode_events, to_audit_rows
from feedlens.operators.scores import replay_score_deltas

RAW_COLUMNS = (
    "event_id", "user_id", "session_id", "event_type", "article_id", "category_id",
    "event_timestamp", "device", "metadata", "raw_json", "topic", "partition", "offset",
    "kafka_timestamp",
)
AUDIT_CHUNK = 2000
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def append_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, *partition_by: str) -> None:
    """Overwrite only the partitions present in ``df``; nothing happens when it is empty."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path)
    )


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    replace_partitions(df.withColumn("batch_id", F.lit(batch_id).cast("long")), path, "batch_id")


def write_raw_events(events: DataFrame, path: str, batch_id: int) -> None:
    """Raw events by (event day, batch): readers of the last days skip the other folders,
    and a repeated batch still overwrites exactly its own rows. The rebalance gathers a
    day's rows into few files and cuts a day that holds most of the batch into several."""
    dated = raw_columns(events).withColumns({
        "event_date": F.to_date("event_timestamp"), "batch_id": F.lit(batch_id).cast("long"),
    })
    replace_partitions(dated.hint("rebalance", "event_date"), path, "event_date", "batch_id")


def write_dead_letters(letters: DataFrame, path: str, batch_id: int) -> None:
    """Dead letters by (day the log received them, batch)."""
    dated = letters.withColumns({
        "received_date": F.to_date("kafka_timestamp"), "batch_id": F.lit(batch_id).cast("long"),
    })
    replace_partitions(dated, path, "received_date", "batch_id")


def write_rollup(counts: DataFrame, path: str, batch_id: int) -> None:
    """Event counts of a batch by (event day, batch)."""
    replace_partitions(counts.withColumn("batch_id", F.lit(batch_id).cast("long")), path, "event_date", "batch_id")


def existing_table(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """The table, or no rows of its layout as long as nothing has been written."""
    try:
        return spark.read.schema(layout).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], layout)


def raw_columns(events: DataFrame) -> DataFrame:
    return events.select(*RAW_COLUMNS)


def write_recommendations(df: DataFrame, path: str) -> None:
    """Replace the model versions present in ``df``; an empty result changes nothing."""
    replace_partitions(df, path, "model_version")


def stored_versions(spark: SparkSession, path: str) -> DataFrame:
    """The stored recommendations; none before the first result."""
    return existing_table(spark, path, S.RECOMMENDATIONS)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, times to the microsecond."""
    df.write.mode("overwrite").option("timestampFormat", JSON_TIME).json(path)


def read_jsonl(spark: SparkSession, path: str, layout: str) -> DataFrame:
    return spark.read.schema(layout).option("timestampFormat", JSON_TIME).json(path)


def publish_events(events: DataFrame, servers: str, topic: str) -> None:
    """One JSON record per event to the log, keyed by event id."""
    (
        encode_events(events).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    )


def staging_name(table: str) -> str:
    return f"{table}_staging"


def swap_statements(table: str, columns: Sequence[str]) -> list[str]:
    """One transaction that replaces a table's rows by its staging table's: readers see the old or the new rows."""
    names = ", ".join(columns)
    return [f"DELETE FROM {table}", f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging_name(table)}"]


def insert_absent_statements(table: str, columns: Sequence[str], key: str) -> list[str]:
    """One transaction that inserts the staged rows whose key is new; a repeated run inserts nothing."""
    names, staging = ", ".join(columns), staging_name(table)
    return [
        f"INSERT INTO {table} ({names}) SELECT {', '.join('s.' + name for name in columns)} FROM {staging} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE t.{key} = s.{key})"
    ]


def stage_jdbc(df: DataFrame, table: str, options: Mapping[str, str], partitions: int) -> None:
    """Fill the staging table anew over ``partitions`` connections; a retried task's rows are replaced with it."""
    (
        df.repartition(partitions).write.format("jdbc").mode("overwrite").options(**options)
        .option("dbtable", staging_name(table)).option("truncate", "true").option("batchsize", AUDIT_CHUNK).save()
    )


def run_transaction(spark: SparkSession, options: Mapping[str, str], statements: Sequence[str]) -> None:
    """The statements in one transaction, on the driver's connection; no row passes through it."""
    connection = spark._jvm.java.sql.DriverManager.getConnection(options["url"], options["user"], options["password"])
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            connection.createStatement().execute(statement)
        connection.commit()
    finally:
        connection.close()


def write_audit_jdbc(events: DataFrame, options: Mapping[str, str], partitions: int = 8) -> None:
    """Audit rows that are not stored yet, each event id once; device and metadata as JSON text."""
    rows = to_audit_rows(dedupe_events(events)).withColumns(
        {"device": F.to_json("device"), "metadata_json": F.to_json("metadata_json")}
    )
    stage_jdbc(rows, "pending_events", options, partitions)
    run_transaction(events.sparkSession, options, insert_absent_statements("pending_events", rows.columns, "event_id"))


def publish_table_jdbc(df: DataFrame, table: str, options: Mapping[str, str], partitions: int = 8) -> None:
    """Replace the rows of a database table at once, keeping its definition."""
    stage_jdbc(df, table, options, partitions)
    run_transaction(df.sparkSession, options, swap_statements(table, df.columns))


def write_documents(events: DataFrame, options: Mapping[str, str]) -> None:
    """Raw events to the document collection, through its connector."""
    raw_columns(events).write.format("mongodb").mode("append").options(**options).save()


def write_both(events: DataFrame, publish, audit) -> None:
    """The same events to the log and to the audit table; the input is computed once."""
    kept = events.persist()
    try:
        publish(kept)
        audit(kept)
    finally:
        kept.unpersist()


class ScoreStore:
    """User-category scores on shared storage: a delta ledger and versioned snapshots.

    A micro-batch only writes its ledger partition, work in proportion to the batch.
    ``compact`` folds open batches into a new snapshot directory and commits it by
    appending one row to the version log; a reader sees the old version or the new one,
    and a compaction lost half-way leaves an uncommitted directory nobody reads.
    """

    def __init__(self, spark: SparkSession, base: str, mode: str = "signed") -> None:
        self.spark = spark
        self.ledger_path = f"{base}/user_category_score_deltas"
        self.versions_path = f"{base}/user_category_scores_versions"
        self.snapshots_path = f"{base}/user_category_scores"
        self.mode = mode

    def ledger(self) -> DataFrame:
        return existing_table(self.spark, self.ledger_path, f"{S.SCORE_DELTAS}, processed_at TIMESTAMP, batch_id BIGINT")

    def append(self, deltas: DataFrame, batch_id: int) -> None:
        write_batch(deltas.withColumn("processed_at", F.current_timestamp()), self.ledger_path, batch_id)

    def _version(self) -> tuple[int, int]:
        """(snapshot version, highest batch folded in); (0, -1) before the first one."""
        last = existing_table(self.spark, self.versions_path, "version BIGINT, batch_id BIGINT").agg(
            F.max(F.struct("version", "batch_id")).alias("last")
        ).first()["last"]
        return (last["version"], last["batch_id"]) if last else (0, -1)

    def _snapshot(self, version: int) -> DataFrame:
        if version == 0:
            return self.spark.createDataFrame([], S.USER_CATEGORY_SCORES)
        return self.spark.read.schema(S.USER_CATEGORY_SCORES).parquet(f"{self.snapshots_path}/version={version}")

    def _folded(self, version: int, batch_id: int) -> DataFrame:
        open_batches = self.ledger().where(F.col("batch_id") > batch_id)
        return replay_score_deltas(self._snapshot(version), open_batches, mode=self.mode)

    def current(self) -> DataFrame:
        """Scores as of now: the last snapshot with the open batches replayed."""
        return self._folded(*self._version())

    def compact(self) -> int:
        """Fold the open batches into a new snapshot; returns its version.

        Afterwards the batches folded before and the snapshots before the last one are deleted:
        a reader of the version just replaced still finds all it needs.
        """
        version, folded = self._version()
        open_batches = self.ledger().where(F.col("batch_id") > folded)
        newest = open_batches.agg(F.max("batch_id")).first()[0]
        if newest is None:
            return version
        # Batches that arrive meanwhile stay open.
        span = open_batches.where(F.col("batch_id") <= newest)
        merged = replay_score_deltas(self._snapshot(version), span, mode=self.mode)
        merged.write.mode("overwrite").parquet(f"{self.snapshots_path}/version={version + 1}")
        self.spark.createDataFrame([(version + 1, newest)], "version BIGINT, batch_id BIGINT").coalesce(
            1
        ).write.mode("append").parquet(self.versions_path)
        self._delete_partitions(self.ledger_path, "batch_id=", folded)
        self._delete_partitions(self.snapshots_path, "version=", version - 1)
        return version + 1

    def _delete_partitions(self, table: str, prefix: str, last: int) -> None:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(table)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for status in fs.listStatus(root) if fs.exists(root) else []:
            name = status.getPath().getName()
            if name.startswith(prefix) and int(name.removeprefix(prefix)) <= last:
                fs.delete(status.getPath(), True)
