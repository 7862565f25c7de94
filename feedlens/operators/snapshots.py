"""Keyed merges of feed and saved snapshots into cached tables.

Cached articles have is_liked, is_saved, in_feed and cached_at next to the article
columns. A snapshot has the article columns, is_liked, is_saved and ``position``; of
several rows of an article the last one counts. All merges are anti joins plus unions
on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.operators.content import newest_first
from feedlens.operators.ranking import top_per_key


def _last_rows(snapshot: DataFrame) -> DataFrame:
    return top_per_key(snapshot, ["article_id"], [F.desc("position")], 1).drop("position")


def _untouched(cached: DataFrame, rows: DataFrame) -> DataFrame:
    return cached.join(rows.select("article_id"), "article_id", "left_anti")


def merge_feed_snapshot(cached: DataFrame, snapshot: DataFrame, cached_at: Column) -> DataFrame:
    """The snapshot becomes the feed: its rows replace the cached ones and are in the
    feed, all others stay cached outside of it."""
    rows = _last_rows(snapshot).withColumn("in_feed", F.lit(True)).withColumn("cached_at", cached_at)
    rest = _untouched(cached, rows).withColumn("in_feed", F.lit(False))
    return rest.select(*cached.columns).unionByName(rows.select(*cached.columns))


def merge_saved_snapshot(cached: DataFrame, snapshot: DataFrame, cached_at: Column) -> DataFrame:
    """The snapshot becomes the saved list: its rows are saved and keep whether they were
    in the feed, all others are no longer saved."""
    forced = snapshot.withColumn("is_saved", F.lit(True))
    cleared = cached.withColumn("is_saved", F.lit(False))
    return merge_article_state(cleared, forced, cached_at)


def merge_article_state(cached: DataFrame, snapshot: DataFrame, cached_at: Column) -> DataFrame:
    """Single articles seen again: their rows replace the cached ones but stay in the feed
    or outside of it; all others are untouched."""
    was_in_feed = cached.select("article_id", F.col("in_feed").alias("_in_feed"))
    rows = (
        _last_rows(snapshot).join(was_in_feed, "article_id", "left")
        .withColumn("in_feed", F.coalesce("_in_feed", F.lit(False)))
        .withColumn("cached_at", cached_at)
    )
    return _untouched(cached, rows).select(*cached.columns).unionByName(rows.select(*cached.columns))


def merge_saved_set(saved: DataFrame, snapshot: DataFrame, cached_at: Column,
                    replace: bool = False) -> DataFrame:
    """Saved relations after a snapshot. A saved snapshot replaces them (``replace``); a
    feed snapshot adds its saved articles and removes its unsaved ones."""
    rows = _last_rows(snapshot)
    if replace:
        return rows.select("article_id", cached_at.alias("saved_at"))
    added = rows.where("is_saved").select("article_id", cached_at.alias("saved_at"))
    return _untouched(saved, rows).select("article_id", "saved_at").unionByName(added)


def merge_snapshot_categories(cached: DataFrame, snapshot: DataFrame, cached_at: Column) -> DataFrame:
    """Categories seen in a snapshot (category_id, category_name) replace the cached
    ones; the last row of a category counts."""
    seen = top_per_key(
        snapshot.where(F.col("category_id").isNotNull()), ["category_id"], [F.desc("position")], 1
    ).select("category_id", F.col("category_name").alias("name"), cached_at.alias("cached_at"))
    rest = cached.join(seen.select("category_id"), "category_id", "left_anti")
    return rest.select("category_id", "name", "cached_at").unionByName(seen)


def cached_feed(cached: DataFrame) -> DataFrame:
    return cached.where("in_feed").orderBy(*newest_first())


def cached_saved(cached: DataFrame, saved: DataFrame) -> DataFrame:
    return cached.join(saved.select("article_id"), "article_id").orderBy(*newest_first())
