"""Search by postings, deep pages and stored bitmaps against the plain operators on small tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedlens.operators import distinct_counts as D
from feedlens.operators import rank_index as R
from feedlens.operators import search_index as S
from feedlens.operators.content import search_articles
from feedlens.session import written_table

ARTICLES = "article_id long, category_id long, title string, summary string, content string, published_at timestamp"


@pytest.fixture(scope="module")
def articles(spark):
    draw = random.Random(8)
    words = ["Alpha", "beta%", "ga_mma", "İstanbul", "ΣΑΣ", "日本語です", "🙂🙂x", "back\\slash", "ab", "", "100% sure"]
    rows = []
    for number in range(300):
        text = [" ".join(draw.choice(words) for _ in range(draw.randrange(6))) or None for _ in range(3)]
        rows.append((None if number % 50 == 0 else number * 997 - 40_000, number % 4, *text, datetime(2024, 1, 1) + timedelta(days=number % 9)))
    return written_table(spark.createDataFrame(rows + rows[1:3], ARTICLES), "articles")


@pytest.fixture(scope="module")
def index(articles):
    return written_table(S.postings(articles), "postings")


TERMS = [
    "alpha", "ALPHA beta", "beta%", "ga_mma", "istanbul", "İST", "σας", "ΣΑΣ", "本語で", "🙂🙂x", "back\\\\sl", "ab", "a%a%pha", "100% sure", "no such text",
    "   ", "", None, "pha%sta", "%", "__pha",
]


@pytest.mark.parametrize("escape", [False, True])
@pytest.mark.parametrize("term", TERMS)
def test_search_equals_the_scan(articles, index, term, escape):
    expected = sorted(search_articles(articles, term, 1, escape).collect(), key=str)
    assert sorted(S.search_indexed(articles, index, term, 1, escape).collect(), key=str) == expected


def test_only_candidates_are_compared(articles, index):
    plan = S.search_indexed(articles, index, "alpha beta")._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    # Above or in the join, but in no filter below it except that of rows without an id.
    below = [line for line in plan[join:].splitlines()[1:] if "LIKE" in line.upper() and "isnull(article_id" not in line]
    assert below == []


def test_only_folders_with_candidates_are_read(articles, index):
    stored = S.stored_by_id(articles, 10_000)
    for term in ("日本語です 日本語です", "alpha", "no such text"):
        expected = sorted(search_articles(articles, term).collect(), key=str)
        assert sorted(S.search_indexed(stored, index, term, folder_ids=10_000).collect(), key=str) == expected
    found = S.candidates(index, ["no ", "abc"]).withColumnRenamed("article_id", "_candidate")
    files = [row["file"] for row in S._near(stored, found, 10_000).select(F.input_file_name().alias("file")).distinct().collect()]
    assert files and all("HIVE_DEFAULT" in name for name in files)


def test_frequent_trigrams_are_split(spark):
    rows = spark.range(3 * S.ID_SPAN).select(F.col("id").alias("article_id"), F.lit("same").alias("title"))
    sizes = [row["articles"] for row in S.postings(rows).where("gram = 'sam'").collect()]
    assert sizes == [S.ID_SPAN] * 3


def test_pieces():
    assert S.literal_pieces(r"%a\%b_c%") == ["a%b", "c"] and S.literal_pieces("%%") == [] and S.literal_pieces(r"%x\\y%") == ["x\\y"]


def test_pages_and_seeks(spark):
    draw = random.Random(3)
    rows = [(number, draw.choice([None, 1, 2]), None if draw.random() < 0.2 else datetime(2024, 1, draw.randrange(1, 9))) for number in range(500)]
    table = spark.createDataFrame(rows, "article_id long, category_id long, published_at timestamp")

    def order(row):
        return (row[2] is None, -(row[2] - datetime(2024, 1, 1)).days if row[2] else 0, -row[0])

    whole = sorted(rows, key=order)
    index = R.rank_index(table, rows_per_range=37)
    assert index.bounds.count() > 10
    for offset, limit in ((0, 1), (36, 3), (100, 80), (490, 50), (600, 5)):
        page = R.page_at(index, limit, offset).collect()
        assert [tuple(row)[:3] for row in page] == whole[offset:offset + limit]
        assert {row["total"] for row in page} <= {500}
    for at in (0, 36, 250, 460, 499):
        last = whole[at]
        assert [tuple(row) for row in R.page_after(index, (last[2], last[0]), 60).collect()] == whole[at + 1:at + 61]
    # Rows added in front shift pages by offset, not pages by row.
    newer = spark.createDataFrame([(1000 + number, 1, datetime(2024, 2, 1)) for number in range(30)], table.schema)
    grown = R.rank_index(table.unionByName(newer), rows_per_range=37)
    assert [tuple(row) for row in R.page_after(grown, (whole[99][2], whole[99][0]), 20).collect()] == whole[100:120]
    keyed = R.rank_index(table, keys=["category_id"], rows_per_range=37)
    for key in (None, 1, 2, 9):
        own = [row for row in whole if row[1] == key]
        page = R.page_at(keyed, 30, 70, [key]).collect()
        assert [tuple(row)[:3] for row in page] == own[70:100] and {row["total"] for row in page} <= {len(own)}
        assert [tuple(row) for row in R.page_after(keyed, (datetime(2024, 1, 4), 100), 15, [key]).collect()] == [
            row for row in own if order(row) > (False, -3, -100)][:15]
    empty = R.rank_index(table.limit(0))
    assert R.page_at(empty, 5).collect() == [] and R.page_after(empty, (None, 1), 5).collect() == []


def test_a_deep_page_opens_one_range(spark):
    table = spark.range(100_000).select(F.col("id").alias("article_id"), F.timestamp_seconds("id").alias("published_at"))
    index = R.rank_index(table, rows_per_range=1000)
    page = R.page_at(index, 10, 90_100, with_total=False)
    assert [row["article_id"] for row in page.collect()] == list(range(9899, 9889, -1))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_range" in plan
    assert len(page.inputFiles()) >= 1 and page.select(F.input_file_name().alias("f")).distinct().count() == 1


def test_bitmaps(spark):
    draw = random.Random(6)
    types = ["view_article", "search", None]
    rows = [
        (draw.choice([None, *range(0, 2000, 7), 10**12 + draw.randrange(50)]), draw.choice(types), draw.choice([None, 1, 2]),
         datetime(2024, 1, draw.randrange(1, 12), draw.randrange(24)))
        for _ in range(3000)
    ]
    events = spark.createDataFrame(rows, "user_id long, event_type string, category_id long, event_timestamp timestamp")
    numbers = written_table(D.number_users(events), "numbers")
    assert sorted(row["number"] for row in numbers.collect()) == list(range(1, numbers.count() + 1))
    # Numbers of several bitmaps.
    spread = numbers.withColumn("number", F.col("number") * 1000)
    stored = written_table(D.daily_bitmaps(events, spread), "bitmaps")
    assert stored.select("bucket").distinct().count() > 3
    found = {row["event_type"]: (row["users"], row["events"]) for row in D.distinct_users(stored, ["event_type"]).collect()}
    assert found == {kind: (len({row[0] for row in rows if row[1] == kind} - {None}), sum(row[1] == kind for row in rows)) for kind in types}
    whole = D.distinct_users(stored).first()
    assert (whole["users"], whole["events"]) == (len({row[0] for row in rows} - {None}), 3000)
    for row in D.rolling_users(stored, 3).collect():
        span = [(row["event_date"] - timedelta(days=step)) for step in range(3)]
        own = [event for event in rows if event[3].date() in span]
        assert (row["users"], row["events"]) == (len({event[0] for event in own} - {None}), len(own))
    seen = set()
    for row in D.new_users(stored).orderBy("event_date").collect():
        own = {event[0] for event in rows if event[3].date() == row["event_date"]} - {None}
        assert (row["users"], row["new_users"]) == (len(own), len(own - seen))
        seen |= own
        assert row["users_so_far"] == len(seen)
    assert D.distinct_users(stored.limit(0), ["event_type"]).collect() == []
    again = D.merged(stored.unionByName(stored))
    assert D.distinct_users(again).first()["users"] == whole["users"]


def test_postings_shuffle_lists_and_not_pairs(spark, small, monkeypatch):
    """Lists are made in the tasks, also of signs beyond 16 bits and of repeated ids."""
    rows = [(40_000, "Ab\U0001f600cD", None, "xyz"), (1, "ab", "b\n\U0001f600", ""), (1, "XYZ", None, None), (3, "ab\U0001f600", "zz", "abab"), (None, "xyz", "", "")]
    articles = spark.createDataFrame(rows, "article_id BIGINT, title STRING, summary STRING, content STRING")
    wanted = {}
    for number, *texts in rows:
        for text in texts if number is not None else ():
            lowered = (text or "").lower()
            for at in range(len(lowered) - 2):
                wanted.setdefault((lowered[at:at + 3], number // S.ID_SPAN), set()).add(number)
    got = {(row["gram"], row["span"]): (row["ids"], row["articles"]) for row in S.postings(articles).collect()}
    assert got == {key: (sorted(ids), len(ids)) for key, ids in wanted.items()}
    assert "Generate" not in S.postings(articles)._jdf.queryExecution().executedPlan().toString()
    # A few pairs at a time.
    monkeypatch.setattr(S, "AT_ONCE", 4)
    monkeypatch.setattr(S, "LISTS", 3)
    named = [(number, *[text and text.lower() for text in texts]) for number, *texts in rows if number is not None]
    batch = pa.RecordBatch.from_pydict(dict(zip(("article_id", "title", "summary", "content"), map(list, zip(*named, strict=True)), strict=True)))
    parts, merged = list(S._post(iter([batch]))), {}
    for row in [row for part in parts for row in part.to_pylist()]:
        assert row["ids"] == sorted(row["ids"])
        merged.setdefault((row["gram"], row["span"]), set()).update(row["ids"])
    assert merged == wanted and len(parts) > 2


def test_articles_by_id_are_few_files(spark):
    """A task writes the folders of its own range of ids, not a file into every folder."""
    rows = spark.range(4000).select(((F.col("id") * 7919) % 4000).alias("article_id"), F.lit("t").alias("title")).repartition(8)
    stored = S.stored_by_id(rows, 100)
    assert stored.count() == 4000 and len(stored.inputFiles()) <= 40 + 2 * spark.sparkContext.defaultParallelism
