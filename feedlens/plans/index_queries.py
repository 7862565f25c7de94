"""Queries by stored indexes: text search, deep pages, distinct users; with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.operators import distinct_counts as D
from feedlens.operators import rank_index as R
from feedlens.operators import search_index as S
from feedlens.plans.content_queries import _LIST, _hit
from feedlens.plans.registry import Tables, query
from feedlens.session import written_table


# --- text search by trigram postings
def _postings(t: Tables):
    return written_table(S.postings(t.long_articles), "postings")


def _grams(name: str) -> str:
    parts = ", ".join(f"regexp_extract_all(substr(lower({name}), {start}), '(?s)...')" for start in (1, 2, 3))
    return f"list_concat({parts})"


@query("search_postings", f"""SELECT gram, count(*) AS articles FROM (SELECT DISTINCT article_id,
    unnest(list_concat({_grams('title')}, {_grams('summary')}, {_grams('content')})) AS gram FROM long_articles) GROUP BY gram""")
def search_postings(t: Tables):
    return S.postings(t.long_articles).groupBy("gram").agg(F.sum("articles").alias("articles"))


@query("article_search_indexed", f"SELECT article_id FROM long_articles WHERE {_hit('%THERON%')}")
def search_indexed(t: Tables):
    return S.search_indexed(S.stored_by_id(t.long_articles, 100), _postings(t), "  THERON ", folder_ids=100).select("article_id")


@query("article_search_indexed_wildcards", f"SELECT article_id FROM long_articles WHERE {_hit('%ther%ing_th%')} AND category_id = 4")
def search_indexed_wildcards(t: Tables):
    return S.search_indexed(t.long_articles, _postings(t), "ther%ing_th", category_id=4).select("article_id")


@query("article_search_indexed_short", f"SELECT article_id FROM long_articles WHERE {_hit('%th_r%on%')} AND category_id = 4")
def search_indexed_short(t: Tables):
    return S.search_indexed(t.long_articles, _postings(t), "th_r%on", category_id=4).select("article_id")


@query("article_search_appended", f"SELECT article_id FROM long_articles WHERE {_hit('%é, le%')}")
def search_appended(t: Tables):
    """Postings of two batches of articles, the second appended to the first."""
    old = F.col("article_id") % 3 > 0
    parts = [S.postings(t.long_articles.where(batch)) for batch in (old, ~old)]
    return S.search_indexed(t.long_articles, written_table(parts[0].unionByName(parts[1]), "postings"), "é, le").select("article_id")


@query("feed_page_search_indexed", f"""SELECT {_LIST}, (SELECT count(*) FROM long_articles WHERE {_hit('%ther%')}
    AND category_id = 3) AS total FROM long_articles WHERE {_hit('%ther%')} AND category_id = 3
  ORDER BY published_at DESC, article_id DESC LIMIT 5 OFFSET 2""")
def feed_page_search_indexed(t: Tables):
    return S.feed_page_indexed(t.long_articles, _postings(t), limit=5, offset=2, term="ther", category_id=3)


# --- deep pages by a rank index
_DATED = "CASE WHEN article_id % 7 > 0 THEN published_at END AS published_at"
_ALL_PAGES = f"SELECT article_id, title, category_id, {_DATED} FROM long_articles"


def _feed(t: Tables, rows_per_range: int = 100) -> R.RankIndex:
    """Articles of which some have no date, in ranges of few rows."""
    dated = F.when(F.col("article_id") % 7 > 0, F.col("published_at")).alias("published_at")
    return R.rank_index(t.long_articles.select("article_id", "title", "category_id", dated), rows_per_range=rows_per_range)


@query("feed_page_deep", f"""SELECT *, (SELECT count(*) FROM long_articles) AS total FROM ({_ALL_PAGES})
  ORDER BY published_at DESC NULLS LAST, article_id DESC LIMIT 20 OFFSET 790""")
def feed_page_deep(t: Tables):
    return R.page_at(_feed(t), limit=20, offset=790)


@query("feed_page_undated", f"""SELECT *, (SELECT count(*) FROM long_articles) AS total FROM ({_ALL_PAGES})
  ORDER BY published_at DESC NULLS LAST, article_id DESC LIMIT 250 OFFSET 850""")
def feed_page_undated(t: Tables):
    """A page over several ranges, with rows without a date."""
    return R.page_at(_feed(t), limit=250, offset=850)


@query("feed_page_after", f"""SELECT * FROM ({_ALL_PAGES}) WHERE published_at < TIMESTAMP '2024-01-01 09:00:00'
    OR published_at = TIMESTAMP '2024-01-01 09:00:00' AND article_id < 500 OR published_at IS NULL
  ORDER BY published_at DESC NULLS LAST, article_id DESC LIMIT 30""")
def feed_page_after(t: Tables):
    return R.page_after(_feed(t), ("2024-01-01 09:00:00", 500), limit=30)


@query("feed_page_of_category", f"""SELECT *, (SELECT count(*) FROM long_articles WHERE category_id = 3) AS total
  FROM ({_ALL_PAGES}) WHERE category_id = 3 ORDER BY published_at DESC NULLS LAST, article_id DESC LIMIT 10 OFFSET 15""")
def feed_page_of_category(t: Tables):
    dated = F.when(F.col("article_id") % 7 > 0, F.col("published_at")).alias("published_at")
    rows = t.long_articles.select("article_id", "title", "category_id", dated)
    return R.page_at(R.rank_index(rows, keys=["category_id"], rows_per_range=100), limit=10, offset=15, key=[3])


@query("saved_page_deep", """SELECT * FROM (WITH mine AS (SELECT a.article_id, a.title, a.published_at, s.user_id FROM saves s
    JOIN feed_articles a ON a.article_id = s.article_id WHERE s.user_id = (SELECT min(user_id) FROM saves))
  SELECT *, (SELECT count(*) FROM mine) AS total FROM mine ORDER BY published_at DESC, article_id DESC LIMIT 3 OFFSET 2)""")
def saved_page_deep(t: Tables):
    saved = t.saves.select("user_id", "article_id").join(t.articles.select("article_id", "title", "published_at"), "article_id")
    index = R.rank_index(saved, keys=["user_id"], rows_per_range=200)
    reader = t.saves.agg(F.min("user_id").alias("user_id")).first()["user_id"]
    return R.page_at(index, limit=3, offset=2, key=[reader])


# --- distinct users by stored bitmaps
def _stored(t: Tables):
    events = t.all_events
    return written_table(D.daily_bitmaps(events, D.number_users(events)), "daily-bitmaps")


_DAY = "CAST(event_timestamp AS DATE)"


@query("users_by_type_between", f"""SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS events FROM feed_events
  WHERE {_DAY} BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY event_type""")
def users_by_type_between(t: Tables):
    return D.distinct_users(D.between(_stored(t), "2024-01-05", "2024-01-20"), ["event_type"])


@query("users_by_category_so_far", """SELECT category_id, count(DISTINCT user_id) AS users, count(*) AS events
  FROM feed_events GROUP BY category_id""")
def users_by_category_so_far(t: Tables):
    """Bitmaps of two batches, the second with users that the first has not numbered."""
    early = F.col("event_timestamp") < F.lit("2024-01-16 00:00:00").cast("timestamp")
    first, second = t.all_events.where(early), t.all_events.where(~early)
    numbers = written_table(D.number_users(first), "user-numbers")
    batches = [D.daily_bitmaps(first, numbers), D.daily_bitmaps(second, written_table(D.number_users(second, numbers), "user-numbers"))]
    return D.distinct_users(D.merged(batches[0].unionByName(batches[1])), ["category_id"])


@query("rolling_users", f"""SELECT * FROM (WITH days AS (SELECT DISTINCT {_DAY} AS event_date FROM feed_events)
  SELECT d.event_date, e.event_type, count(DISTINCT e.user_id) AS users, count(*) AS events
  FROM days d JOIN feed_events e ON CAST(e.event_timestamp AS DATE) BETWEEN d.event_date - 6 AND d.event_date GROUP BY ALL)""")
def rolling_users(t: Tables):
    return D.rolling_users(_stored(t), 7, ["event_type"])


@query("new_users_by_day", f"""SELECT * FROM (WITH seen AS (SELECT DISTINCT user_id, {_DAY} AS event_date FROM feed_events WHERE user_id IS NOT NULL),
  firsts AS (SELECT user_id, min(event_date) AS event_date FROM seen GROUP BY user_id),
  daily AS (SELECT event_date, count(*) AS users FROM seen GROUP BY event_date)
  SELECT event_date, users, coalesce(n, 0) AS new_users, sum(coalesce(n, 0)) OVER (ORDER BY event_date) AS users_so_far
  FROM daily LEFT JOIN (SELECT event_date, count(*) AS n FROM firsts GROUP BY event_date) USING (event_date))""")
def new_users_by_day(t: Tables):
    return D.new_users(_stored(t))
