"""Check queries of the engagement reports."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.operators import reports as P
from feedlens.plans.registry import Tables, query
from feedlens.plans.views import COUNTERS, CTR, SCORE_SUM

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
READER = 7

_FAVORITES = f"""SELECT user_id, category_id, name AS category_name, count(*) AS events_count, {COUNTERS},
    {SCORE_SUM} AS score FROM events_valid JOIN feed_categories USING (category_id) GROUP BY ALL"""
_FAVORITE_SCORES = """SELECT *, name AS category_name, views_count + likes_count + saves_count AS events_count
    FROM {source} JOIN feed_categories USING (category_id)"""


@query("favorite_categories", f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY score DESC, events_count DESC, category_id) AS rank FROM ({_FAVORITES})) WHERE rank <= 5""")
def favorites(t: Tables):
    return P.favorite_categories(t.events, t.categories)


@query("favorite_categories_of_user", f"""SELECT * FROM ({_FAVORITES}) WHERE user_id = {READER}
  ORDER BY score DESC, events_count DESC, category_id LIMIT 5""")
def favorites_of_user(t: Tables):
    return P.favorite_categories(t.events, t.categories, READER)


@query("favorite_from_scores", f"""SELECT * EXCLUDE (name) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY score DESC, category_id) AS rank FROM ({_FAVORITE_SCORES.format(source='scores')})) WHERE rank <= 5""")
def favorites_from_scores(t: Tables):
    return P.favorite_from_scores(t.scores, t.categories)


@query("score_totals", """SELECT user_id, CAST(sum(views_count) AS BIGINT) AS views_count,
    CAST(sum(likes_count) AS BIGINT) AS likes_count, CAST(sum(saves_count) AS BIGINT) AS saves_count
  FROM scores GROUP BY 1""")
def score_totals(t: Tables):
    return P.score_totals(t.scores)


@query("score_totals_of_user", f"""SELECT CAST(coalesce(sum(views_count), 0) AS BIGINT) AS views_count,
    CAST(coalesce(sum(likes_count), 0) AS BIGINT) AS likes_count,
    CAST(coalesce(sum(saves_count), 0) AS BIGINT) AS saves_count FROM scores WHERE user_id = {READER}""")
def score_totals_of_user(t: Tables):
    return P.score_totals(t.scores, READER)


def _top_categories_sql(source: str) -> str:
    return f"""SELECT category_id, name AS category_name, count(*) AS events_count,
      count(DISTINCT user_id) AS unique_users_count, {SCORE_SUM} AS score
    FROM {source} JOIN feed_categories USING (category_id) GROUP BY 1, 2
    ORDER BY score DESC, events_count DESC, category_id LIMIT 10"""


@query("top_categories", _top_categories_sql("events_valid"))
def top_categories(t: Tables):
    return P.top_categories(t.events, t.categories)


@query("order_top_categories", _top_categories_sql("order_once"))
def order_top_categories(t: Tables):
    return P.top_categories(t.order_once, t.categories)


@query("top_categories_from_scores", """SELECT category_id, name AS category_name,
    count(user_id) AS unique_users_count, CAST(sum(score) AS DOUBLE) AS score,
    CAST(sum(views_count + likes_count + saves_count) AS BIGINT) AS events_count
  FROM scores JOIN feed_categories USING (category_id) GROUP BY 1, 2 ORDER BY score DESC, category_id LIMIT 10""")
def top_from_scores(t: Tables):
    return P.top_categories_from_scores(t.scores, t.categories)


def _top_articles_sql(source: str) -> str:
    return f"""SELECT e.article_id, title, a.category_id, name AS category_name, {COUNTERS},
      count(*) FILTER (event_type = 'open_recommended_article') AS opens_from_recommendations_count,
      {SCORE_SUM} AS score
    FROM {source} e JOIN feed_articles a ON a.article_id = e.article_id
    JOIN feed_categories c ON c.category_id = a.category_id GROUP BY 1, 2, 3, 4
    ORDER BY score DESC, views_count DESC, e.article_id LIMIT 10"""


@query("top_articles", _top_articles_sql("events_valid"))
def top_articles(t: Tables):
    return P.top_articles(t.events, t.articles, t.categories)


@query("order_top_articles", _top_articles_sql("order_once"))
def order_top_articles(t: Tables):
    return P.top_articles(t.order_once, t.articles, t.categories)


@query("top_articles_unknown_kept", f"""SELECT e.article_id, a.title, a.category_id, name AS category_name,
    views_count, likes_count, saves_count, opens_from_recommendations_count, score
  FROM (SELECT article_id * 3 AS article_id, {COUNTERS},
      count(*) FILTER (event_type = 'open_recommended_article') AS opens_from_recommendations_count,
      {SCORE_SUM} AS score
    FROM order_once GROUP BY 1) e LEFT JOIN feed_articles a ON a.article_id = e.article_id
  LEFT JOIN feed_categories c ON c.category_id = a.category_id
  ORDER BY score DESC, views_count DESC, e.article_id LIMIT 10""")
def top_articles_loose(t: Tables):
    moved = t.order_once.withColumn("article_id", F.col("article_id") * 3)
    return P.top_articles_loose(moved, t.articles, t.categories)


@query("top_articles_by_popularity", """SELECT article_id, title, category_id, name AS category_name,
    CAST(0 AS BIGINT) AS views_count, CAST(0 AS BIGINT) AS likes_count, CAST(0 AS BIGINT) AS saves_count,
    CAST(0 AS BIGINT) AS opens_from_recommendations_count, popularity_score AS score
  FROM feed_articles JOIN feed_categories USING (category_id)
  ORDER BY popularity_score DESC, published_at DESC, article_id LIMIT 10""")
def by_popularity(t: Tables):
    return P.top_articles_by_popularity(t.articles, t.categories)


_BY_TYPE = """SELECT event_type, count(*) AS events_count, count(DISTINCT user_id) AS unique_users_count
  FROM {source} WHERE event_type IS NOT NULL GROUP BY 1"""


@query("events_by_type", _BY_TYPE.format(source="feed_events"))
def events_by_type(t: Tables):
    return P.events_by_type(t.all_events)


@query("order_events_by_type", _BY_TYPE.format(source="order_once"))
def order_events_by_type(t: Tables):
    return P.events_by_type(t.order_once)


@query("activity_by_day", """SELECT CAST(event_timestamp AS DATE) AS date, count(*) AS events_count,
    count(DISTINCT user_id) AS unique_users_count FROM feed_events
  WHERE event_timestamp >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY GROUP BY 1""")
def activity_by_day(t: Tables):
    return P.activity_by_day(t.all_events, NOW, 14)


@query("event_counts", """SELECT event_type, count(*) AS events_count FROM feed_events
  WHERE event_type IS NOT NULL GROUP BY 1""")
def event_counts(t: Tables):
    return P.event_counts(t.all_events)


@query("event_counts_of_user", f"""SELECT event_type, count(*) AS events_count FROM feed_events
  WHERE user_id = {READER} AND event_type IS NOT NULL GROUP BY 1""")
def event_counts_of_user(t: Tables):
    return P.event_counts(t.all_events, READER)


@query("recommendation_ctr", f"SELECT {CTR} FROM events_valid")
def ctr(t: Tables):
    return P.recommendation_ctr(t.events)


@query("ctr_by_scope", f"""SELECT 'personal' AS scope, {CTR} FROM events_valid WHERE user_id = {READER}
  UNION ALL SELECT 'global', {CTR} FROM events_valid""")
def ctr_by_scope(t: Tables):
    return P.ctr_by_scope(t.events, READER)


@query("personal_report", f"""SELECT user_id,
    coalesce(nullif(e.views_count, 0), s.views_count, 0) AS views_count,
    coalesce(nullif(e.likes_count, 0), s.likes_count, 0) AS likes_count,
    coalesce(nullif(e.saves_count, 0), s.saves_count, 0) AS saves_count,
    coalesce(recommendations_opened, 0) AS recommendations_opened,
    coalesce(recommended_articles_opened, 0) AS recommended_articles_opened,
    coalesce(recommendation_ctr, CAST(0 AS DOUBLE)) AS recommendation_ctr,
    coalesce(fe.names, fs.names) AS favorites
  FROM (SELECT user_id, {COUNTERS}, {CTR} FROM events_valid GROUP BY 1) e
  FULL JOIN (SELECT user_id, CAST(sum(views_count) AS BIGINT) AS views_count,
      CAST(sum(likes_count) AS BIGINT) AS likes_count, CAST(sum(saves_count) AS BIGINT) AS saves_count
    FROM order_scores GROUP BY 1) s USING (user_id)
  LEFT JOIN (SELECT user_id, string_agg(label, ',' ORDER BY rank) AS names FROM (
      SELECT user_id, name || ':' || CAST(CAST(score AS BIGINT) AS VARCHAR) AS label, row_number() OVER (
        PARTITION BY user_id ORDER BY score DESC, events_count DESC, category_id) AS rank
      FROM (SELECT user_id, category_id, name, count(*) AS events_count, {SCORE_SUM} AS score
        FROM events_valid JOIN feed_categories USING (category_id) GROUP BY ALL)) WHERE rank <= 5
      GROUP BY 1) fe USING (user_id)
  LEFT JOIN (SELECT user_id, string_agg(label, ',' ORDER BY rank) AS names FROM (
      SELECT user_id, category_name || ':' || CAST(CAST(score AS BIGINT) AS VARCHAR) AS label, row_number() OVER (
        PARTITION BY user_id ORDER BY score DESC, category_id) AS rank FROM ({_FAVORITE_SCORES.format(source='order_scores')}))
      WHERE rank <= 5 GROUP BY 1) fs USING (user_id)""")
def personal(t: Tables):
    """Stored scores come from the orders: most of their users have no feed events."""
    report = P.personal_report(t.events, t.order_scores, t.categories)
    label = F.transform("favorite_categories", lambda c: F.concat_ws(
        ":", c["category_name"], c["score"].cast("long").cast("string")))
    return report.withColumn("favorites", F.array_join(label, ",")).drop("favorite_categories")


@query("personal_report_of_user", f"""SELECT CAST({READER} AS BIGINT) AS user_id, {COUNTERS}, {CTR},
    (SELECT count(*) FROM (SELECT DISTINCT category_id FROM events_valid JOIN feed_categories USING (category_id)
      WHERE user_id = {READER} LIMIT 5)) AS favorites_count
  FROM events_valid WHERE user_id = {READER}""")
def personal_of_user(t: Tables):
    report = P.personal_report(t.events, t.scores, t.categories, user_id=READER)
    return report.withColumn("favorites_count", F.size("favorite_categories").cast("long")).drop("favorite_categories")


@query("global_report", f"""SELECT 'top_categories' AS part, CAST(category_id AS VARCHAR) AS label,
    events_count AS measure FROM ({_top_categories_sql('events_valid')})
  UNION ALL SELECT 'top_articles', CAST(article_id AS VARCHAR), views_count
    FROM ({_top_articles_sql('events_valid')})
  UNION ALL SELECT 'events_by_type', event_type, events_count FROM ({_BY_TYPE.format(source='events_valid')})
  UNION ALL SELECT 'activity_by_day', CAST(CAST(event_timestamp AS DATE) AS VARCHAR), count(*)
    FROM events_valid WHERE event_timestamp >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY 2
  UNION ALL SELECT 'recommendation_ctr', CAST(recommendation_ctr AS VARCHAR), recommendations_opened
    FROM (SELECT {CTR} FROM events_valid)""")
def global_report(t: Tables):
    """All parts of the report as (part, label, measure) rows."""
    parts = P.global_report(t.events, t.articles, t.categories, NOW)
    keys = {"top_categories": ("category_id", "events_count"), "top_articles": ("article_id", "views_count"),
            "events_by_type": ("event_type", "events_count"), "activity_by_day": ("date", "events_count"),
            "recommendation_ctr": ("recommendation_ctr", "recommendations_opened")}
    stacked = None
    for name, (label, measure) in keys.items():
        part = parts[name].select(
            F.lit(name).alias("part"), F.col(label).cast("string").alias("label"), F.col(measure).alias("measure")
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


_PARTS_SQL = f"""SELECT 'top_categories' AS part, category_name AS label, score AS value FROM ({{categories}})
  UNION ALL SELECT 'top_articles', title, score FROM ({{articles}})
  UNION ALL SELECT 'events_by_type', event_type, CAST(events_count AS DOUBLE) FROM ({_BY_TYPE})
  UNION ALL SELECT 'activity_by_day', CAST(CAST(event_timestamp AS DATE) AS VARCHAR), CAST(count(*) AS DOUBLE)
    FROM {{source}} WHERE event_timestamp >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY 2
  UNION ALL SELECT 'recommendation_ctr', 'ctr', recommendation_ctr FROM (SELECT {CTR} FROM {{source}})"""
_VALUES = {"top_categories": ("category_name", "score"), "top_articles": ("title", "score"),
           "events_by_type": ("event_type", "events_count"), "activity_by_day": ("date", "events_count"),
           "recommendation_ctr": (None, "recommendation_ctr")}


def _parts_sql(source: str, parts: tuple[str, ...] = tuple(_VALUES)) -> str:
    sql = _PARTS_SQL.format(
        source=source, categories=_top_categories_sql(source), articles=_top_articles_sql(source))
    return f"SELECT * FROM ({sql}) WHERE part IN ({', '.join(repr(part) for part in parts)})"


def _stacked(parts, *more: str):
    """(part, label, value) rows of several parts."""
    rows = []
    for name, part in parts.items():
        label, value = _VALUES[name]
        text = F.lit("ctr") if label is None else F.col(label).cast("string")
        rows.append(part.select(F.lit(name).alias("part"), text.alias("label"), F.col(value).cast("double").alias("value"), *more))
    return reduce(DataFrame.unionByName, rows)


CHARTS = ("activity_by_day", "events_by_type", "top_categories", "recommendation_ctr")


@query("chart_frames", _parts_sql("events_valid", CHARTS))
def charts(t: Tables):
    return _stacked(P.chart_frames(P.global_report(t.events, t.articles, t.categories, NOW)))


@query("source_report", f"SELECT *, 'raw_user_events' AS source FROM ({_parts_sql('order_once')})")
def source_report(t: Tables):
    """The report job's global parts: the raw store has events, some of them twice."""
    parts = P.source_report(t.order_events, t.events, t.articles, t.categories, t.order_scores, NOW)
    return _stacked({name: parts[name] for name in _VALUES}, "source")


@query("source_report_audit", f"SELECT *, 'pending_events' AS source FROM ({_parts_sql('events_valid')})")
def source_report_audit(t: Tables):
    """An empty raw store: the audit table is read."""
    parts = P.source_report(t.order_events.where("false"), t.events, t.articles, t.categories, t.scores, NOW)
    return _stacked({name: parts[name] for name in _VALUES}, "source")
