"""Kept reports against grouping all events anew."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedlens.operators import incremental as I
from feedlens.session import run_folder, written_table

EVENTS = "event_id long, user_id long, event_type string, article_id long, category_id long, event_timestamp timestamp"


def draw_events(seed, count, keys=20):
    draw = random.Random(seed)
    types = ["view_article", "like_article", "save_article", "open_recommended_article", "search", None]
    return [
        (number, draw.choice([None, 1, 2, 3, 4]), draw.choice(types), draw.choice([None, *range(keys)]),
         draw.choice([None, 1, 2, 3]), datetime(2024, 1, draw.randrange(1, 6)))
        for number in range(count)
    ]


def expected(rows, key):
    found = {}
    for row in rows:
        name = row[key]
        if name is None:
            continue
        own = found.setdefault(name, [0, Counter()])
        own[0] += 1
        own[1][row[1]] += 1
    return {name: (count, len([user for user in users if user is not None])) for name, (count, users) in found.items()}


def kept_rows(kept, key):
    return {row[key]: (row["events_count"], row["unique_users_count"]) for row in kept.report().collect()}


@pytest.mark.parametrize("buckets", [1, 7])
def test_batches_with_removals(spark, buckets):
    rows = draw_events(1, 240)
    kept = I.KeptReport(spark, run_folder(spark, "kept"), I.categories_spec(), buckets)
    frame = lambda part: spark.createDataFrame(part, EVENTS)
    kept.apply(0, frame(rows[:100]))
    assert kept_rows(kept, "category_id") == expected(rows[:100], 4)
    # The same batch again changes nothing.
    kept.apply(0, frame(rows[:100]))
    assert kept_rows(kept, "category_id") == expected(rows[:100], 4)
    kept.apply(1, frame(rows[100:]), frame(rows[:30]))
    assert kept_rows(kept, "category_id") == expected(rows[30:], 4)
    # Everything taken back.
    kept.apply(2, frame([]), frame(rows[30:]))
    assert kept_rows(kept, "category_id") == {}
    kept.apply(3, frame(rows[:5]))
    assert kept_rows(kept, "category_id") == expected(rows[:5], 4)
    kept.apply(4, frame([]))
    assert kept_rows(kept, "category_id") == expected(rows[:5], 4)


def test_a_removal_before_its_event(spark):
    kept = I.KeptReport(spark, run_folder(spark, "kept"), I.types_spec(), 4)
    rows = [(1, 5, "search", None, None, datetime(2024, 1, 1)), (2, 6, "search", None, None, datetime(2024, 1, 1))]
    kept.apply(0, spark.createDataFrame(rows[1:], EVENTS), spark.createDataFrame(rows[:1], EVENTS))
    kept.apply(1, spark.createDataFrame(rows[:1], EVENTS))
    assert kept_rows(kept, "event_type") == {"search": (1, 1)}


def test_half_applied_batch(spark):
    """A failure between the staged contents and their place: the batch again completes it."""
    rows = draw_events(2, 80)
    kept = I.KeptReport(spark, run_folder(spark, "kept"), I.categories_spec(), 5)
    kept.apply(0, spark.createDataFrame(rows[:40], EVENTS))
    kept._stage(1, spark.createDataFrame(rows[40:], EVENTS), None)
    kept._put(kept._staged(1, "members"), "members")
    kept.apply(1, spark.createDataFrame(rows[40:], EVENTS))
    assert kept_rows(kept, "category_id") == expected(rows, 4)


def test_only_touched_buckets_are_written(spark):
    kept = I.KeptReport(spark, run_folder(spark, "kept"), I.articles_spec(), 16)
    kept.apply(0, spark.createDataFrame(draw_events(3, 400, 200), EVENTS))
    files = set(spark.read.parquet(f"{kept.root}/sums").inputFiles())
    kept.apply(1, spark.createDataFrame([(1, 1, "search", 7, 1, datetime(2024, 1, 1))], EVENTS))
    after = set(spark.read.parquet(f"{kept.root}/sums").inputFiles())
    assert len(files - after) == 1 and len(after - files) == 1
    assert kept.changed(1).count() == 1


ORDER = (("score", True), ("views_count", True), ("article_id", False))


def test_top_lists_are_repaired(spark):
    rows = draw_events(4, 600, 40)
    kept = I.KeptReport(spark, run_folder(spark, "kept"), I.articles_spec(), 8)
    best = lambda: kept.report().orderBy(F.desc("score"), F.desc("views_count"), F.asc("article_id")).limit(5)
    kept.apply(0, spark.createDataFrame(rows[:200], EVENTS))
    top = written_table(best(), "top")
    for batch, (added, removed) in enumerate([(rows[200:230], []), (rows[230:600], rows[:10]), ([], rows[200:600])], start=1):
        kept.apply(batch, spark.createDataFrame(added, EVENTS), spark.createDataFrame(removed, EVENTS))
        top = written_table(kept.repaired_top(top, batch, ORDER, 5), "top")
        assert sorted(map(tuple, top.collect())) == sorted(map(tuple, best().collect()))
