"""Thin readers: the same table or stream from files, JDBC, a document store or a log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens import schemas as S

# Table name -> layout; ids are called ``id`` in the database tables.
TABLES = {
    "users": S.USERS,
    "categories": S.CATEGORIES,
    "articles": S.ARTICLES,
    "user_category_subscriptions": S.SUBSCRIPTIONS,
    "article_likes": S.ARTICLE_LIKES,
    "saved_articles": S.SAVED_ARTICLES,
    "pending_events": S.PENDING_EVENTS,
    "user_category_scores": S.USER_CATEGORY_SCORES,
    "daily_event_stats": S.DAILY_EVENT_STATS,
    "recommendations": S.RECOMMENDATIONS,
    "raw_user_events": S.RAW_EVENTS,
}
OWN_ID = {"users": "user_id", "categories": "category_id", "articles": "article_id"}


def read_files(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(TABLES[name]).format(fmt).load(f"{base}/{name}")


def read_jdbc(spark: SparkSession, name: str, options: Mapping[str, str],
              bounds: tuple[int, int, int] | None = None, column: str = "id") -> DataFrame:
    """A database table. ``bounds`` (lowest id, highest id, partitions) splits the scan by
    id ranges; without them one task reads the whole table."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", name)
    if bounds is not None:
        low, high, partitions = bounds
        reader = reader.options(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions)
        )
    table = reader.load()
    return table.withColumnRenamed("id", OWN_ID[name]) if name in OWN_ID else table


def bounds_query(name: str, column: str = "id") -> str:
    return f"SELECT min({column}) AS low, max({column}) AS high FROM {name}"


def read_jdbc_split(spark: SparkSession, name: str, options: Mapping[str, str], partitions: int, column: str = "id") -> DataFrame:
    """A database table in even ranges of the ids it has: the source is asked for its bounds first."""
    ends = spark.read.format("jdbc").options(**options).option("query", bounds_query(name, column)).load().first()
    bounds = None if ends["low"] is None else (int(ends["low"]), int(ends["high"]), partitions)
    return read_jdbc(spark, name, options, bounds, column)


def read_documents(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The raw event collection through the document-store connector."""
    return spark.read.schema(S.RAW_EVENTS).format("mongodb").options(**options).load()


def read_event_stream(spark: SparkSession, kind: str, **options: str) -> DataFrame:
    """Streaming log records: topic, partition, offset, timestamp, value.

    ``kafka`` takes ``servers`` and ``topic`` (``startingOffsets`` defaults to latest).
    ``text`` reads files of one JSON event per line and ``parquet`` files of log records,
    both with ``path``; other options go to the reader.
    """
    if kind == "kafka":
        stream = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", options.pop("servers"))
            .option("subscribe", options.pop("topic"))
            .options(**{"startingOffsets": "latest", "failOnDataLoss": "false", **options})
            .load()
        )
        return stream.select("topic", "partition", "offset", "timestamp", F.col("value").cast("string"))
    path = options.pop("path")
    if kind == "parquet":
        return spark.readStream.schema(S.LOG_RECORD).options(**options).parquet(path)
    if kind == "text":
        lines = spark.readStream.options(**options).text(path)
        return lines.select(
            F.col("_metadata.file_path").alias("topic"), F.lit(0).alias("partition"),
            F.lit(None).cast("long").alias("offset"),
            F.col("_metadata.file_modification_time").alias("timestamp"), "value",
        )
    raise ValueError(f"unknown stream kind {kind!r}")


def raw_events_view(raw: DataFrame) -> DataFrame:
    """The five typed columns the recommendation job needs of a raw or audit table."""
    return raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("long").alias("user_id"),
        F.col("article_id").cast("long").alias("article_id"),
        F.col("category_id").cast("long").alias("category_id"),
        F.col("event_type").cast("string").alias("event_type"),
    )
