"""Exact quotas for synthetic rows: a keyed permutation of the row numbers, cut at the quotas' bounds.

Every row finds its place by itself, from its number alone, and no two rows share one: the permutation adds, in
turn, a keyed hash of one digit of the number to the other, in a system of two digits whose sizes are about the root of the count. Places beyond
the count, fewer than that root, are permuted again until they lie within it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 4
#: Steps back into the count. A walk has fewer steps than the larger digit; from 64 on, one of 64 has a chance below 64^-64.
MOST_STEPS = 64


def _mixed(place: Column, high: int, low: int, seed: int) -> Column:
    """A permutation of 0 .. high * low - 1."""
    left, right = F.floor(place / low).cast("long"), F.pmod(place, F.lit(low).cast("long"))
    for turn in range(ROUNDS):
        if turn % 2 == 0:
            left = F.pmod(left + F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), right), F.lit(high).cast("long")), F.lit(high).cast("long"))
        else:
            right = F.pmod(right + F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), left), F.lit(low).cast("long")), F.lit(low).cast("long"))
    return left * low + right


def permuted(number: Column, count: int, seed: int = 42) -> Column:
    """The place of a row number 0 .. count - 1 in a keyed permutation of these numbers."""
    if count < 1:
        return F.lit(0).cast("long")
    high = math.isqrt(count - 1) + 1
    low = -(-count // high)

    def step(place: Column) -> Column:
        return F.get(F.transform(F.array(place), lambda value: _mixed(value, high, low, seed)), F.lit(0))

    first = step(number.cast("long"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(min(high, MOST_STEPS))), first, lambda place, _: F.when(place < count, place).otherwise(_mixed(place, high, low, seed))
    )


def quota_bounds(weights: Mapping[str, int], count: int) -> list[tuple[str, int]]:
    """Each name with the place its share ends before: prefix sums rounded down, so that shares are exact to less than one row."""
    total = sum(weights.values())
    return [(name, count * upto // total) for name, upto in zip(weights, accumulate(weights.values()), strict=True)]


def by_quota(number: Column, count: int, weights: Mapping[str, int], seed: int = 42) -> Column:
    """One of the names for each of ``count`` numbers, each name as often as its weight has it."""
    place = permuted(number, count, seed)
    bounds = quota_bounds(weights, count)

    def chosen(value: Column) -> Column:
        choice = None
        for name, upto in bounds:
            choice = F.when(value < upto, F.lit(name)) if choice is None else choice.when(value < upto, F.lit(name))
        return choice

    return F.get(F.transform(F.array(place), chosen), F.lit(0))


def draw_profile(events: DataFrame, weights: Mapping[str, int]) -> DataFrame:
    """``event_type, events_count, expected, deviation`` of every type with a weight, ``deviation`` being its part of the chi-square statistic."""
    spark = events.sparkSession
    wanted = spark.createDataFrame(list(weights.items()), "event_type string, weight long")
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events_count"))
    total = counts.agg(F.coalesce(F.sum("events_count"), F.lit(0)).alias("n")).first()["n"]
    expected = F.col("weight") * F.lit(float(total)) / F.lit(float(sum(weights.values())))
    found = wanted.join(counts, "event_type", "left").withColumn("events_count", F.coalesce("events_count", F.lit(0)))
    rows = found.select("event_type", "events_count", expected.alias("expected"))
    off = F.col("events_count") - F.col("expected")
    return rows.withColumn("deviation", F.when(F.col("expected") > 0, off * off / F.col("expected")).otherwise(0.0))


def sessions_profile(events: DataFrame) -> DataFrame:
    """One row: users, and the fewest, most and average sessions and events of one."""
    per_user = events.where(F.col("user_id").isNotNull()).groupBy("user_id", "session_id").agg(F.count(F.lit(1)).alias("n")).groupBy("user_id").agg(
        F.count("session_id").alias("sessions"), F.sum("n").alias("events")
    )
    return per_user.agg(
        F.count(F.lit(1)).alias("users"), F.min("sessions").alias("fewest_sessions"), F.max("sessions").alias("most_sessions"),
        F.round(F.avg("sessions"), 6).alias("average_sessions"), F.min("events").alias("fewest_events"), F.max("events").alias("most_events"),
    )
