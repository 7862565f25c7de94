"""Kept reports after batches with late and removed events, next to the SQL of the full reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.operators import incremental as I
from feedlens.operators.reports import _category_names
from feedlens.plans.registry import Tables, query
from feedlens.plans.views import COUNTERS, SCORE_SUM
from feedlens.session import run_folder, written_table

_KEPT = "(SELECT * FROM feed_events WHERE CAST(event_id AS BIGINT) % 11 <> 3)"


def _batches(t: Tables, spec: I.ReportSpec, before_last=None) -> I.KeptReport:
    """Three batches: the first half of the month without some late events, the second half with them, and removals.

    The second batch is applied twice, as after a failure. ``before_last`` sees the report before the third.
    """
    number = F.col("event_id").cast("long")
    early = F.coalesce(F.col("event_timestamp") < F.lit("2024-01-16 00:00:00").cast("timestamp"), F.lit(False))
    late, removed = number % 7 == 0, number % 11 == 3
    events = t.all_events
    kept = I.KeptReport(t.spark, run_folder(t.spark, "kept-report"), spec, buckets=16)
    kept.apply(0, events.where(early & ~late))
    for _ in range(2):
        kept.apply(1, events.where(~early | late), events.where(removed & early & ~late))
    if before_last:
        before_last(kept)
    kept.apply(2, events.limit(0), events.where(removed & (~early | late)))
    return kept


@query("kept_events_by_type", f"""SELECT event_type, count(*) AS events_count, count(DISTINCT user_id) AS unique_users_count
  FROM {_KEPT} WHERE event_type IS NOT NULL GROUP BY 1""")
def kept_events_by_type(t: Tables):
    return _batches(t, I.types_spec()).report()


@query("kept_activity_by_day", f"""SELECT CAST(event_timestamp AS DATE) AS date, count(*) AS events_count,
    count(DISTINCT user_id) AS unique_users_count FROM {_KEPT} WHERE event_timestamp IS NOT NULL GROUP BY 1""")
def kept_activity_by_day(t: Tables):
    return _batches(t, I.days_spec()).report()


@query("kept_top_categories", f"""SELECT category_id, name AS category_name, count(*) AS events_count,
    count(DISTINCT user_id) AS unique_users_count, {SCORE_SUM} AS score
  FROM {_KEPT} JOIN feed_categories USING (category_id) GROUP BY 1, 2 ORDER BY score DESC, events_count DESC, category_id LIMIT 10""")
def kept_top_categories(t: Tables):
    kept = _batches(t, I.categories_spec()).report().join(_category_names(t.categories), "category_id")
    return kept.orderBy(F.desc("score"), F.desc("events_count"), F.asc("category_id")).limit(10)


@query("kept_favorites", f"""SELECT user_id, category_id, count(*) AS events_count, {COUNTERS}, {SCORE_SUM} AS score
  FROM {_KEPT} WHERE user_id IS NOT NULL AND category_id IS NOT NULL GROUP BY 1, 2""")
def kept_favorites(t: Tables):
    return _batches(t, I.favorites_spec()).report()


_ORDER = (("score", True), ("views_count", True), ("article_id", False))


@query("kept_top_articles", f"""SELECT article_id, {COUNTERS},
    count(*) FILTER (event_type = 'open_recommended_article') AS opens_from_recommendations_count,
    {SCORE_SUM} AS score, count(*) AS events_count
  FROM {_KEPT} WHERE article_id IS NOT NULL GROUP BY 1 ORDER BY score DESC, views_count DESC, article_id LIMIT 10""")
def kept_top_articles(t: Tables):
    """The list of the first two batches, repaired from the keys that the third one touches."""
    tops = []

    def note(kept: I.KeptReport) -> None:
        best = kept.report().orderBy(F.desc("score"), F.desc("views_count"), F.asc("article_id")).limit(10)
        tops.append(written_table(best, "kept-top"))

    kept = _batches(t, I.articles_spec(), note)
    return kept.repaired_top(tops[0], 2, _ORDER, 10)
