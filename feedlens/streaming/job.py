"""The event stream job: decode, validate, fan out per micro-batch, run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedlens.operators import aggregates as A
from feedlens.operators.events import decode_events, dedupe_events, split_events, validate_events
from feedlens.sources.compaction import compact_days
from feedlens.sources.sinks import (
    ScoreStore, existing_table, write_batch, write_dead_letters, write_raw_events, write_rollup,
)

DEFAULT_TRIGGER = "10 seconds"
LATE_AFTER_DAYS = 2


@dataclass(frozen=True)
class StreamPaths:
    base: str

    @property
    def raw_events(self) -> str:
        return f"{self.base}/raw_user_events"

    @property
    def dead_letters(self) -> str:
        return f"{self.base}/dead_letter_events"

    @property
    def rollup(self) -> str:
        return f"{self.base}/aggregates/events_rollup"

    @property
    def progress(self) -> str:
        return f"{self.base}/batch_progress"

    @property
    def scores(self) -> str:
        return f"{self.base}/scores"


def validated_stream(records: DataFrame, require_session: bool = True) -> DataFrame:
    """Log records to validated events; ``require_session=False`` lets API actions without a session pass."""
    return validate_events(decode_events(records), require_session)


def first_copies(valid: DataFrame, paths: StreamPaths, batch_id: int) -> DataFrame:
    """Events of the batch that no other batch has stored, each once.

    Only the stored ids of the batch's own days are read, so copies are found as long as they share
    their event day, however late they come.
    """
    own = dedupe_events(valid)
    span = own.agg(F.min(F.to_date("event_timestamp")).alias("low"), F.max(F.to_date("event_timestamp")).alias("high")).first()
    if span["low"] is None:
        return own
    stored = existing_table(valid.sparkSession, paths.raw_events, "event_id STRING, event_date DATE, batch_id BIGINT").where(
        F.col("event_date").between(span["low"], span["high"]) & (F.col("batch_id") != batch_id)
    )
    return own.join(stored.select("event_id"), "event_id", "left_anti")


PROGRESS = "events_count BIGINT, late_count BIGINT, newest_event TIMESTAMP, batch_id BIGINT"
#: Batches back that are searched for the newest event time before a batch.
LOOK_BACK = 100


def late_progress(valid: DataFrame, paths: StreamPaths, batch_id: int, delay_days: int = LATE_AFTER_DAYS) -> DataFrame:
    """One row: the batch's events, those older than the newest event before it less the delay, and the newest so far.

    A batch without valid events carries the newest time on, so the batches looked back to hold it.
    """
    earlier = existing_table(valid.sparkSession, paths.progress, PROGRESS).where(
        (F.col("batch_id") < batch_id) & (F.col("batch_id") >= batch_id - LOOK_BACK)
    )
    newest = earlier.select(F.max("newest_event").alias("newest")).scalar()
    late = F.col("event_timestamp") < newest - F.make_dt_interval(F.lit(delay_days))
    return valid.agg(
        F.count("*").alias("events_count"), F.count_if(F.coalesce(late, F.lit(False))).alias("late_count"),
        F.coalesce(F.max(F.greatest("event_timestamp", newest)), newest).alias("newest_event"),
    )


def process_batch(paths: StreamPaths, store: ScoreStore, compact_every: int = 0, dedupe: bool = False,
                  ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing every output of one micro-batch.

    Every event is a raw row or a dead letter, late ones too; with ``dedupe`` further copies of an
    event id are left out. All outputs are ``batch_id`` partitions that a repeated batch
    overwrites. Daily totals are sums over the rollup of all batches (``daily_totals``), so
    days that span batches and late events count right. The upsert of scores is the ledger write: a failure
    anywhere fails the batch, the batch is run again, and nothing is counted twice.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        once = None
        try:
            if kept.isEmpty():
                return
            valid, invalid = split_events(kept)
            if dedupe:
                valid = once = first_copies(valid, paths, batch_id).persist()
            write_dead_letters(invalid.drop("is_valid"), paths.dead_letters, batch_id)
            write_raw_events(valid, paths.raw_events, batch_id)
            write_rollup(A.rollup(valid), paths.rollup, batch_id)
            write_batch(late_progress(valid, paths, batch_id), paths.progress, batch_id)
            store.append(A.category_score_deltas(valid), batch_id)
        finally:
            kept.unpersist()
            if once is not None:
                once.unpersist()
        if compact_every and (batch_id + 1) % compact_every == 0:
            store.compact()

    return run


def daily_totals(spark: SparkSession, paths: StreamPaths) -> dict[str, DataFrame]:
    """Event-time totals as of now: by type, by category and per user, from the rollup of all batches."""
    layout = "event_type STRING, category_id BIGINT, user_id BIGINT, session_id STRING, n BIGINT, event_date DATE, batch_id BIGINT"
    events = existing_table(spark, paths.rollup, layout).drop("batch_id")
    return {"by_type": A.daily_by_type(events), "by_category": A.daily_by_category(events), "user_activity": A.user_activity_daily(events)}


def late_totals(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    """One row: all events and the late ones among them, over all batches."""
    return existing_table(spark, paths.progress, PROGRESS).agg(
        F.coalesce(F.sum("events_count"), F.lit(0)).alias("events_count"), F.coalesce(F.sum("late_count"), F.lit(0)).alias("late_count")
    )


def compact_closed_days(spark: SparkSession, paths: StreamPaths, before: date) -> dict[str, int]:
    """One partition per day for the days before ``before``, which no batch writes any more; returns the days rewritten."""
    return {
        path: compact_days(spark, path, column, before)
        for path, column in ((paths.raw_events, "event_date"), (paths.rollup, "event_date"), (paths.dead_letters, "received_date"))
    }


def run_stream(stream: DataFrame, sink: Callable[[DataFrame, int], None] | str, checkpoint: str,
               available_now: bool = False, processing_time: str = DEFAULT_TRIGGER) -> StreamingQuery:
    """Start the stream into a batch function, or into a Parquet table path (append)."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=processing_time)
    if callable(sink):
        return writer.foreachBatch(sink).start()
    return writer.outputMode("append").format("parquet").option("path", sink).start()


def run_event_job(spark: SparkSession, records: DataFrame, base: str, checkpoint: str,
                  available_now: bool = False, processing_time: str = DEFAULT_TRIGGER,
                  dedupe: bool = False, compact_every: int = 0, require_session: bool = True) -> StreamingQuery:
    sink = process_batch(StreamPaths(base), ScoreStore(spark, f"{base}/scores"), compact_every, dedupe)
    return run_stream(validated_stream(records, require_session), sink, checkpoint, available_now, processing_time)
