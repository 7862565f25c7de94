"""Event-time stateful aggregates.

Distinct users need no growing set: a first aggregate keeps one row per (window, key,
user), spread over all state partitions, and a second one counts these rows. A hot
event type is therefore split by user before it is summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WATERMARK = "2 days"
WINDOW = "1 day"


def with_watermark(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return events.withWatermark("event_timestamp", delay)


def dedupe_stream(events: DataFrame, delay: str = WATERMARK, salts: int = 8) -> DataFrame:
    """One event per id within the watermark; ids are forgotten after it.

    A stateful dedupe has no map-side step: all copies of an id meet in one task. Copies
    differ in their log position, so a first dedupe by (id, salt of the position) spreads
    a much repeated id over ``salts`` tasks, and the second one sees one copy per salt.
    ``salts=1``, or events without a log position, leave the first pass out.
    """
    marked = with_watermark(events, delay)
    if salts > 1 and {"partition", "offset"} <= set(events.columns):
        salt = F.pmod(F.xxhash64("partition", "offset"), F.lit(salts))
        marked = marked.withColumn("_salt", salt).dropDuplicatesWithinWatermark(["event_id", "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(["event_id"])


def _windowed(events: DataFrame, key: str, member: str, distinct_name: str) -> DataFrame:
    """Append mode: a day is emitted once, when the watermark has passed its end. NULL
    members count as events, not as distinct members."""
    per_member = events.groupBy(F.window("event_timestamp", WINDOW), key, member).agg(
        F.count("*").alias("n")
    )
    stamped = per_member.select(F.window_time("window").alias("at"), key, member, "n")
    return stamped.groupBy(F.window("at", WINDOW), key).agg(
        F.sum("n").alias("events_count"), F.count(member).alias(distinct_name)
    ).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        key, "events_count", distinct_name,
    )


def daily_by_type_stream(events: DataFrame) -> DataFrame:
    """``events`` must carry a watermark."""
    return _windowed(events, "event_type", "user_id", "unique_users_count")


def daily_by_category_stream(events: DataFrame) -> DataFrame:
    return _windowed(events.where(F.col("category_id").isNotNull()), "category_id", "user_id",
                     "unique_users_count")


def user_activity_stream(events: DataFrame) -> DataFrame:
    return _windowed(events, "user_id", "session_id", "sessions_count")
