import json
from datetime import datetime

import pytest

from feedlens import schemas as S
from feedlens.jobs import generate, recommend, report, stream_events
from feedlens.sources import readers, sinks
from feedlens.sources.synthetic import synthetic_articles, synthetic_users


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Generated files and the same dimensions as tables."""
    base = tmp_path_factory.mktemp("jobs")
    generate.main(["--users", "20", "--articles", "120", "--events", "3000", "--output-dir", str(base / "data")])
    synthetic_users(spark.range(1, 21)).write.parquet(str(base / "tables/users"))
    synthetic_articles(spark.range(1, 121), datetime(2024, 1, 1)).write.parquet(str(base / "tables/articles"))
    spark.createDataFrame([(1, 1), (2, 3)], "user_id BIGINT, category_id BIGINT").write.parquet(
        str(base / "tables/user_category_subscriptions"))
    return base


def test_generated_events(spark, folder):
    rows = [json.loads(line) for path in (folder / "data/generated_events").glob("*.json") for line in path.open()]
    assert len(rows) == 3000 == len({r["event_id"] for r in rows})
    assert {r["user_id"] for r in rows} <= set(range(1, 21))
    assert len({r["event_type"] for r in rows}) == 10
    assert all(r["device"]["platform"] == "android" and r["session_id"] for r in rows)
    for r in rows:
        if "article_id" in r:
            assert r["category_id"] == (r["article_id"] - 1) % 12 + 1
    views = sum(r["event_type"] == "view_article" for r in rows)
    assert 0.40 < views / 3000 < 0.52
    sessions = {}
    for r in rows:
        sessions.setdefault(r["user_id"], set()).add(r["session_id"])
    assert all(2 <= len(s) <= 8 for s in sessions.values())


def test_stream_and_recommendation_jobs(spark, folder):
    stream_events.main(["--input-text", str(folder / "data/generated_events"), "--output-base", str(folder / "feed"),
                        "--checkpoint-dir", str(folder / "checkpoint"), "--available-now"])
    raw = spark.read.parquet(str(folder / "feed/raw_user_events"))
    assert raw.count() == 3000
    raw.selectExpr("event_id", "user_id", "session_id", "event_type", "article_id", "category_id",
                   "event_timestamp AS timestamp").write.parquet(str(folder / "tables/pending_events"))
    counts = recommend.main(["--tables", str(folder / "tables"), "--raw-events", str(folder / "feed/raw_user_events"),
                             "--output", str(folder / "recommendations"), "--top-n", "3", "--rank", "4", "--max-iter", "2"])
    assert counts["users"] == 20 and counts["recommendations"] == 60


def test_report_job(spark, folder):
    spark.createDataFrame([(number, f"Category {number}") for number in range(1, 13)], "category_id BIGINT, name STRING").write.parquet(
        str(folder / "tables/categories"))
    spark.createDataFrame([], S.USER_CATEGORY_SCORES).write.parquet(str(folder / "tables/user_category_scores"))
    parts = report.main(["--tables", str(folder / "tables"), "--raw-events", str(folder / "feed/raw_user_events"),
                         "--output", str(folder / "report"), "--until", "2030-01-01", "--limit", "4"])
    tables = {name: spark.read.parquet(str(folder / "report" / name)) for name in parts}
    assert tables["top_categories"].count() == 4 and tables["personal"].count() == 20
    assert {row.source for table in tables.values() for row in table.select("source").distinct().collect()} <= {"raw_user_events"}
    assert tables["events_by_type"].agg({"events_count": "sum"}).first()[0] == 3000
    again = report.main(["--tables", str(folder / "tables"), "--raw-events", str(folder / "nothing"), "--output", str(folder / "audit")])
    assert spark.read.parquet(str(folder / "audit" / again[0])).first().source == "pending_events"


def test_database_statements():
    swap = sinks.swap_statements("scores", ["user_id", "score"])
    assert swap == ["DELETE FROM scores", "INSERT INTO scores (user_id, score) SELECT user_id, score FROM scores_staging"]
    [insert] = sinks.insert_absent_statements("pending_events", ["event_id", "error"], "event_id")
    assert insert.endswith("WHERE NOT EXISTS (SELECT 1 FROM pending_events t WHERE t.event_id = s.event_id)")
    assert readers.bounds_query("users") == "SELECT min(id) AS low, max(id) AS high FROM users"


def test_options():
    assert generate.parse(["--fallback"]).events == 10_000
    with pytest.raises(SystemExit):
        recommend.parse(["--output", "x", "--top-n", "0"])
    with pytest.raises(SystemExit):
        stream_events.parse([])
    assert stream_events.parse(["--output-base", "x", "--checkpoint-dir", "y", "--allow-missing-session"]).allow_missing_session
