"""Exact distinct counts that merge: bitmaps of dense user numbers per day, type and category.

Users get dense numbers once; a bitmap holds ``BITS`` of them. Per (day, type, category) and number range there is one
stored row, made with ``bitmap_construct_agg``. Distinct users over any span of days, any types and any categories come by ``bitmap_or_agg``
over the stored rows: no event is read and no user shuffled again, only bitmaps of fixed size, combined in the map tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.operators.ranking import with_positions
from feedlens.session import written_table

#: Numbers in one bitmap, as Spark's bitmap functions have it.
BITS = 32768
DIMENSIONS = ("event_date", "event_type", "category_id")


def number_users(events: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``user_id, number``: dense numbers from 1; users in ``known`` keep theirs and new ones follow. NULL is no user."""
    users = events.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    if known is None:
        return with_positions(users, [], [F.col("user_id")], "number")
    last = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("n")).first()["n"]
    new = with_positions(users.join(known, "user_id", "left_anti"), [], [F.col("user_id")], "number")
    return known.select("user_id", "number").unionByName(new.withColumn("number", F.col("number") + last))


def daily_bitmaps(events: DataFrame, numbers: DataFrame) -> DataFrame:
    """``event_date, event_type, category_id, bucket, users, events``: one small row per day, type, category and number range.

    Events without a user are counted, in a row without a bucket. Events combine to one row per user before they meet the
    numbers, so neither a busy user nor a busy day is a hot key.
    """
    day = F.to_date("event_timestamp").alias("event_date")
    per_user = events.groupBy(day, "event_type", "category_id", "user_id").agg(F.count(F.lit(1)).alias("events"))
    numbered = per_user.where(F.col("user_id").isNotNull()).join(numbers, "user_id")
    bitmaps = numbered.groupBy(*DIMENSIONS, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users"), F.sum("events").alias("events")
    )
    nobody = per_user.where(F.col("user_id").isNull()).groupBy(*DIMENSIONS).agg(F.sum("events").alias("events")).select(
        *DIMENSIONS, F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("users"), "events"
    )
    return bitmaps.unionByName(nobody)


def merged(stored: DataFrame) -> DataFrame:
    """Rows of several batches as one row per day, type, category and bucket."""
    return stored.groupBy(*DIMENSIONS, "bucket").agg(_or("users").alias("users"), F.sum("events").alias("events"))


def _or(name: str) -> Column:
    """NULL, not an empty bitmap, where no row has one."""
    return F.when(F.count(name) > 0, F.bitmap_or_agg(name))


def distinct_users(stored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``*by, users, events`` over the stored rows given: exact distinct users by OR."""
    per_bucket = stored.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("users")).alias("users"), F.sum("events").alias("events"))
    return per_bucket.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("bucket").isNotNull(), F.col("users"))), F.lit(0)).alias("users"), F.sum("events").alias("events")
    )


def between(stored: DataFrame, first: str, last: str) -> DataFrame:
    return stored.where(F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def rolling_users(stored: DataFrame, days: int, by: Sequence[str] = ()) -> DataFrame:
    """``event_date, *by, users, events``: distinct users of the ``days`` days that end with each day that has rows.

    A day's rows are merged first; each of these bitmaps then enters the windows of at most ``days`` days.
    """
    daily = written_table(
        stored.groupBy("event_date", *by, "bucket").agg(_or("users").alias("users"), F.sum("events").alias("events")), "daily-bitmaps"
    )
    ends = daily.select("event_date").distinct()
    spread = daily.withColumn(
        "event_date", F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda step: F.date_add("event_date", step)))
    )
    return distinct_users(spread.join(ends, "event_date", "left_semi"), ["event_date", *by])


def new_users(stored: DataFrame) -> DataFrame:
    """``event_date, users, new_users, users_so_far``: each day's users, and those never seen on a day before.

    Per bucket the days' bitmaps are OR-ed up in order, a window over as many rows as there are days.
    """
    daily = stored.where(F.col("bucket").isNotNull()).groupBy("event_date", "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    so_far = Window.partitionBy("bucket").orderBy("event_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = daily.select("event_date", "bucket", F.bitmap_count("users").alias("users"), F.bitmap_count(F.bitmap_or_agg("users").over(so_far)).alias("seen"))
    # A bucket without rows on a day still counts on it: growth, not levels, is summed along the days.
    step = Window.partitionBy("bucket").orderBy("event_date")
    grown = running.withColumn("new_users", F.col("seen") - F.coalesce(F.lag("seen").over(step), F.lit(0)))
    days = grown.groupBy("event_date").agg(F.sum("users").alias("users"), F.sum("new_users").alias("new_users"))
    along = Window.orderBy("event_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.withColumn("users_so_far", F.sum("new_users").over(along))
