"""Daily aggregates and interest deltas, all from one rollup of the events.

The rollup counts the events per day, type, category, user and session, and article where reports need it. It is combined
before the shuffle, so its rows are far fewer than the events, and every table below is a
sum over it: the events are read once however many tables are wanted. A distinct count becomes a
count of members after one more grouping, so no task holds the users of a hot group.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.functions import expressions as X

DAY = "event_date"
DAILY_KEYS = (DAY, "event_type", "category_id", "user_id", "session_id")


def rollup(events: DataFrame, *keys: str) -> DataFrame:
    """Number of events ``n`` per ``keys`` (a subset of the events' columns and their UTC day)."""
    wanted = keys or DAILY_KEYS
    if X.EVENTS in events.columns:
        return events.groupBy(*wanted).agg(X.events_sum().alias(X.EVENTS))
    dated = events.withColumn(DAY, F.to_date("event_timestamp")) if DAY in wanted else events
    return dated.groupBy(*wanted).agg(F.count("*").alias(X.EVENTS))


def counted(events: DataFrame) -> DataFrame:
    """Rows that stand for ``n`` events each: a rollup, or the events themselves.

    Conditional sums straight by a report's key combine in the map tasks and are shuffled once; a rollup first pays only
    where several reports read it.
    """
    return events if X.EVENTS in events.columns else events.withColumn(X.EVENTS, F.lit(1).cast("long"))


def with_members(events: DataFrame, keys: list[str], member: str, name: str) -> DataFrame:
    """``events_count`` and the number of distinct non-NULL members per ``keys``."""
    return rollup(events, *keys, member).groupBy(*keys).agg(
        X.events_sum().alias("events_count"), F.count(member).alias(name)
    )


def _by_window(events: DataFrame, key: str) -> DataFrame:
    day = F.col(DAY).cast("timestamp")
    daily = with_members(events, [DAY, key], "user_id", "unique_users_count").where(F.col(DAY).isNotNull())
    return daily.select(
        day.alias("window_start"), (day + F.make_dt_interval(F.lit(1))).alias("window_end"),
        key, "events_count", "unique_users_count",
    )


def daily_by_type(events: DataFrame) -> DataFrame:
    return _by_window(events, "event_type")


def daily_by_category(events: DataFrame) -> DataFrame:
    return _by_window(events.where(F.col("category_id").isNotNull()), "category_id")


def user_activity_daily(events: DataFrame) -> DataFrame:
    return with_members(events, [DAY, "user_id"], "session_id", "sessions_count")


def daily_event_stats(events: DataFrame) -> DataFrame:
    """By (date, type, category); events without a category form their own group."""
    return with_members(events, [DAY, "event_type", "category_id"], "user_id", "unique_users_count").withColumnRenamed(DAY, "date")


def category_score_deltas(events: DataFrame) -> DataFrame:
    """Change of interest per (user, category) over the given events."""
    linked = counted(events.where(F.col("category_id").isNotNull()))
    pairs = {"views_delta": ("view_article",), "likes_delta": ("like_article", "unlike_article"),
             "saves_delta": ("save_article", "unsave_article")}
    return linked.groupBy("user_id", "category_id").agg(
        X.score_sum(S.INTEREST_WEIGHTS).alias("score_delta"), *[X.net_count(*types).alias(name) for name, types in pairs.items()]
    )


def report_rollup(events: DataFrame, since: datetime | None = None) -> DataFrame:
    """The rollup all parts of a report come from; ``recent`` marks events from ``since`` on."""
    recent = F.lit(True) if since is None else F.col("event_timestamp") >= X.utc_literal(since)
    return rollup(
        events.withColumn("recent", F.coalesce(recent, F.lit(False))),
        DAY, "event_type", "category_id", "article_id", "user_id", "recent",
    )
