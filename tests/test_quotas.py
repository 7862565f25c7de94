"""The keyed permutation and the exact shares cut from it."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.sources import quotas as Q
from feedlens.sources.synthetic import event_references, seed_categories, synthetic_articles, synthetic_events, synthetic_users


@pytest.mark.parametrize("count", [1, 2, 3, 7, 10, 63, 1000, 4099])
def test_a_permutation(spark, count):
    places = [row[0] for row in spark.range(count).select(Q.permuted(F.col("id"), count)).collect()]
    assert sorted(places) == list(range(count))
    if count > 100:
        other = [row[0] for row in spark.range(count).select(Q.permuted(F.col("id"), count, seed=1)).collect()]
        assert sum(a == b for a, b in zip(places, other, strict=True)) < count / 10
        # Neighbours are spread.
        assert sum(abs(a - b) < count / 50 for a, b in zip(places, places[1:], strict=False)) < count / 10


@pytest.mark.parametrize("count", [0, 1, 99, 100, 1234, 20_000])
def test_exact_shares(spark, count):
    frame = spark.range(count).select(Q.by_quota(F.col("id"), count, S.EVENT_MIX).alias("event_type"))
    found = Counter(row["event_type"] for row in frame.collect())
    bounds = dict(Q.quota_bounds(S.EVENT_MIX, count))
    below, expected = 0, {}
    for name, upto in bounds.items():
        expected[name], below = upto - below, upto
    assert dict(found) == {name: n for name, n in expected.items() if n}
    assert all(abs(expected[name] - count * share / 100) < 1 for name, share in S.EVENT_MIX.items())
    if count and count % 100 == 0:
        assert Q.draw_profile(frame, S.EVENT_MIX).agg(F.sum("deviation")).first()[0] == 0


def test_generated_events_with_exact_types(spark):
    now = datetime(2024, 1, 31, tzinfo=timezone.utc)
    users, articles = event_references(synthetic_users(spark.range(1, 21)), synthetic_articles(spark.range(1, 31), now))
    assert seed_categories(spark).count() == 12
    rows = spark.range(500).select((F.col("id") * 977).alias("event_no"))
    events = synthetic_events(rows, users, articles, now, "event_no", exact_types=True)
    assert Counter(row["event_type"] for row in events.collect()) == {name: 5 * share for name, share in S.EVENT_MIX.items()}
    profile = Q.sessions_profile(events).first()
    assert profile["users"] <= 20 and 1 <= profile["fewest_sessions"] <= profile["most_sessions"] <= 8
    by_hash = synthetic_events(rows, users, articles, now, "event_no")
    assert by_hash.count() == 500 and Q.draw_profile(by_hash, S.EVENT_MIX).agg(F.sum("deviation")).first()[0] > 0
