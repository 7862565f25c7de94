from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedlens.operators import content as C
from feedlens.operators import queue as Q
from feedlens.operators import reports as P

EVENTS = "event_id STRING, user_id BIGINT, event_type STRING, article_id BIGINT, category_id BIGINT, event_timestamp TIMESTAMP"


def at(minute):
    return datetime(2024, 1, 1, 0, minute)


@pytest.fixture(scope="module")
def seed(spark):
    """Two articles, two categories, four events of one reader."""
    categories = spark.createDataFrame([(1, "Backend"), (2, "Big Data")], "category_id BIGINT, name STRING")
    articles = spark.createDataFrame(
        [(1, 1, "FastAPI", "API text", "about apis", at(1), 10.0), (2, 2, "Spark", "Big text", "about 100% spark_x", at(0), 8.0)],
        "article_id BIGINT, category_id BIGINT, title STRING, summary STRING, content STRING, published_at TIMESTAMP, popularity_score DOUBLE")
    events = spark.createDataFrame([
        ("1", 2, "view_article", 1, 1, at(1)), ("2", 2, "like_article", 1, 1, at(2)),
        ("3", 2, "open_recommendations", None, None, at(3)), ("4", 2, "open_recommended_article", 2, 2, at(4))], EVENTS)
    return categories, articles, events


def test_search_and_pages(seed):
    _, articles, _ = seed
    assert [r.article_id for r in C.search_articles(articles, "SPARK").collect()] == [2]
    assert [r.article_id for r in C.search_articles(articles, category_id=1).collect()] == [1]
    assert C.search_articles(articles, "   ").count() == 2
    assert C.search_articles(articles, "a_i").count() == 1
    assert C.search_articles(articles, "0% spark_", escape=True).count() == 1
    assert C.search_articles(articles, "t%t", escape=True).count() == 0
    page = C.feed_page(articles, limit=1).collect()
    assert [(r.article_id, r.total) for r in page] == [(1, 2)] and "content" not in page[0]


def test_reports_on_the_seed(seed):
    categories, articles, events = seed
    row = P.recommendation_ctr(events).first()
    assert (row.recommendations_opened, row.recommended_articles_opened, row.recommendation_ctr) == (1, 1, 1.0)
    top = P.top_categories(events, categories).collect()
    assert [(r.category_id, r.score, r.events_count, r.unique_users_count) for r in top] == [(1, 4.0, 2, 1), (2, 2.0, 1, 1)]
    assert [r.article_id for r in P.top_articles(events, articles, categories).collect()] == [1, 2]
    days = P.activity_by_day(events, datetime(2024, 1, 31), 30).collect()
    assert [(str(r.date), r.events_count) for r in days] == [("2024-01-01", 4)]
    assert P.activity_by_day(events, datetime(2024, 3, 1), 30).count() == 0


def test_global_report_falls_back(spark, seed):
    categories, articles, events = seed
    scores = spark.createDataFrame([(2, 1, 9.0, 1, 2, 3)], "user_id BIGINT, category_id BIGINT, score DOUBLE, views_count BIGINT, likes_count BIGINT, saves_count BIGINT")
    report = P.global_report(events.where("false"), articles, categories, datetime(2024, 1, 31), scores=scores)
    assert [(r.category_id, r.events_count) for r in report["top_categories"].collect()] == [(1, 6)]
    assert [(r.article_id, r.score, r.views_count) for r in report["top_articles"].collect()] == [(1, 10.0, 0), (2, 8.0, 0)]


def test_recent_days_read_only_their_folders(spark, seed, tmp_path):
    events = seed[2].withColumn("event_date", F.to_date("event_timestamp"))
    older = events.withColumns({"event_timestamp": F.lit(datetime(2023, 5, 1)), "event_date": F.lit("2023-05-01").cast("date")})
    events.unionByName(older).write.partitionBy("event_date").parquet(str(tmp_path / "raw"))
    recent = P.since(spark.read.parquet(str(tmp_path / "raw")), datetime(2024, 1, 31), 30)
    assert recent.count() == 4 and len(recent.inputFiles()) > 0
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_ctr_scopes_without_events(spark, seed):
    rows = {r.scope: r.recommendation_ctr for r in P.ctr_by_scope(seed[2].where("false"), 5).collect()}
    assert rows == {"personal": 0.0, "global": 0.0}


def test_state_is_idempotent(spark):
    rows = [("1", 1, "like_article", 1, 1, at(1)), ("2", 1, "like_article", 1, 1, at(2)), ("3", 1, "unlike_article", 2, 1, at(1)),
            ("4", 1, "like_article", 2, 1, at(3)), ("5", 1, "like_article", 3, 1, at(1)), ("6", 1, "unlike_article", 3, 1, at(1))]
    events = spark.createDataFrame(rows, EVENTS)
    assert sorted(r.article_id for r in C.likes_from(events).collect()) == [1, 2]
    stored = C.likes_from(events)
    later = spark.createDataFrame([("7", 1, "unlike_article", 1, 1, at(9)), ("8", 1, "like_article", 2, 1, at(9)),
                                   ("9", 1, "like_article", 8, 1, at(9))], EVENTS)
    merged = C.merge_interaction_state(stored, later, "like_article", "unlike_article", ["user_id", "article_id"])
    assert sorted((r.article_id, r.created_at) for r in merged.collect()) == [(2, at(3)), (8, at(9))]


def test_flags(seed, spark):
    categories, articles, _ = seed
    likes = spark.createDataFrame([(2, 1), (3, 2)], "user_id BIGINT, article_id BIGINT")
    subs = spark.createDataFrame([(2, 2)], "user_id BIGINT, category_id BIGINT")
    rows = C.article_flags(articles, likes, likes.where("false"), subs, 2).orderBy("article_id").collect()
    assert [(r.is_liked, r.is_saved, r.is_subscribed) for r in rows] == [(True, False, False), (False, False, True)]
    rows = C.article_flags(articles, likes, likes, subs).collect()
    assert not any(r.is_liked or r.is_saved or r.is_subscribed for r in rows)


CHANGE = ("article_id BIGINT, op STRING, title STRING, summary STRING, content STRING, source_url STRING, "
          "category_id BIGINT, author STRING, published_at TIMESTAMP, popularity_score DOUBLE, set_fields ARRAY<STRING>")


def test_article_changes(spark):
    base = "article_id BIGINT, title STRING, summary STRING, content STRING, source_url STRING, category_id BIGINT, author STRING, published_at TIMESTAMP, popularity_score DOUBLE"
    articles = spark.createDataFrame([(1, "a", "s", "c", "u1", 1, "x", at(1), 1.0), (2, "b", "s", "c", None, 1, None, at(1), 2.0),
                                      (3, "c", "s", "c", "u3", 1, None, at(1), 2.0)], base)
    categories = spark.createDataFrame([(1, "Backend")], "category_id BIGINT, name STRING")

    def change(article_id, op, title=None, url=None, category=None, fields=()):
        return (article_id, op, title, None, None, url, category, None, None, None, list(fields))

    changes = spark.createDataFrame([
        change(1, "patch", title="A", url="ignored", fields=["title", "author"]),
        change(2, "patch", url="u1", fields=["source_url"]),
        change(3, "delete"),
        change(4, "create", title="d", url="u4", category=1),
        change(5, "create", title="e", url="u4", category=1),
        change(6, "create", title="f", category=7),
        change(7, "delete"),
        change(8, "create", title="g", category=1),
    ], CHANGE)
    after, refused = C.apply_article_changes(articles, changes, categories)
    rows = {r.article_id: (r.title, r.source_url, r.author) for r in after.collect()}
    assert rows == {1: ("A", "u1", None), 2: ("b", None, None), 4: ("d", "u4", None), 8: ("g", None, None)}
    assert {r.article_id: r.conflict for r in refused.collect()} == {
        2: "source_url_taken", 5: "source_url_taken", 6: "category_not_found", 7: "article_not_found"}


PENDING = "event_id STRING, retry_count INT, last_error STRING, created_at BIGINT"
RESPONSE = "event_id STRING, status STRING, delivery STRING, detail STRING, position INT"


@pytest.mark.parametrize("answers, error, left, result", [
    ([("a", "accepted", "kafka", None, 1), ("b", "accepted", "pending_events", None, 2)], None, {}, "SENT"),
    ([("a", "accepted", "failed", None, 1), ("b", "accepted", None, None, 2)], None, {"a": "Event delivery failed"}, "RETRY"),
    ([("a", "accepted", "failed", "x", 1), ("a", "accepted", "kafka", None, 2)], None,
     {"b": "Missing event result in batch response"}, "RETRY"),
    ([("a", "accepted", "kafka", None, 1), ("b", "accepted", "kafka", None, 2), ("z", "accepted", "failed", None, 3)],
     None, {}, "RETRY"),
    ([], "HTTP 500 while syncing events", {"a": "HTTP 500 while syncing events", "b": "HTTP 500 while syncing events"}, "RETRY"),
])
def test_settle(spark, answers, error, left, result):
    pending = spark.createDataFrame([("a", 0, None, 1), ("b", 0, None, 2)], PENDING)
    remaining, settled, outcome = Q.settle_queue(pending, spark.createDataFrame(answers, RESPONSE), error)
    assert {r.event_id: r.last_error for r in remaining.collect()} == left
    assert all(r.retry_count == 1 for r in remaining.collect())
    assert {r.event_id for r in settled.collect()} == {"a", "b"} - set(left)
    assert outcome.first().result == result


def test_settle_nothing(spark):
    pending = spark.createDataFrame([], PENDING)
    assert Q.settle_queue(pending, spark.createDataFrame([], RESPONSE))[2].first().result == "EMPTY"
