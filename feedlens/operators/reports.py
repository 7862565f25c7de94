"""Engagement reports.

Each report is a sum over a rollup of the events, which may be given instead of the events: a
composed report reads them once. Names are attached to the grouped rows. Names come from inner joins, so events of an
unknown category or article are left out; NULL users are not counted as users.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions import expressions as X
from feedlens.operators.aggregates import DAY, counted, report_rollup, rollup, with_members
from feedlens.operators.events import choose_source, dedupe_events
from feedlens.operators.ranking import top_per_key
from feedlens.session import written_table

OPENED = "open_recommendations"
CLICKED = "open_recommended_article"


def _counters() -> list[Column]:
    return [
        X.net_count("view_article").alias("views_count"),
        X.net_count("like_article").alias("likes_count"),
        X.net_count("save_article").alias("saves_count"),
    ]


def _category_names(categories: DataFrame) -> DataFrame:
    return categories.select("category_id", F.col("name").alias("category_name"))


def _article_titles(articles: DataFrame, categories: DataFrame) -> DataFrame:
    return articles.select("article_id", "title", "category_id").join(
        _category_names(categories), "category_id"
    )


def since(events: DataFrame, now: datetime, days: int, column: str = "event_timestamp") -> DataFrame:
    """Events of the last ``days`` days up to ``now`` and beyond; the bound is inclusive.

    A table stored by ``event_date`` is read from the bound's day on.
    """
    bound = X.days_before(now, days)
    recent = events.where(F.col(column) >= bound)
    if "event_date" in events.columns:
        recent = recent.where(F.col("event_date") >= bound.cast("date"))
    return recent


# --- favourite categories ---------------------------------------------------
def favorite_categories(events: DataFrame, categories: DataFrame, user_id: int | None = None,
                        limit: int = 5) -> DataFrame:
    """Best categories of one user, or of every user with ``rank``."""
    linked = events.where(F.col("category_id").isNotNull() & F.col("user_id").isNotNull())
    if user_id is not None:
        linked = linked.where(F.col("user_id") == user_id)
    grouped = counted(linked).groupBy("user_id", "category_id").agg(
        X.events_sum().alias("events_count"), *_counters(), X.score_sum().alias("score")
    ).join(_category_names(categories), "category_id")
    order = [F.desc("score"), F.desc("events_count"), F.asc("category_id")]
    if user_id is not None:
        return grouped.orderBy(*order).limit(limit)
    return top_per_key(grouped, ["user_id"], order, limit, rank_col="rank")


def favorite_from_scores(scores: DataFrame, categories: DataFrame, limit: int = 5) -> DataFrame:
    """Best categories of every user by stored score."""
    named = scores.join(_category_names(categories), "category_id").withColumn(
        "events_count", F.col("views_count") + F.col("likes_count") + F.col("saves_count")
    )
    order = [F.desc("score"), F.asc("category_id")]
    return top_per_key(named, ["user_id"], order, limit, rank_col="rank")


def score_totals(scores: DataFrame, user_id: int | None = None) -> DataFrame:
    """Stored counters summed: one row of one user (zeros when unknown), or one per user."""
    totals = [
        F.coalesce(F.sum(name), F.lit(0)).alias(name)
        for name in ("views_count", "likes_count", "saves_count")
    ]
    if user_id is not None:
        return scores.where(F.col("user_id") == user_id).agg(*totals)
    return scores.groupBy("user_id").agg(*totals)


# --- top lists --------------------------------------------------------------
def top_categories(events: DataFrame, categories: DataFrame, limit: int = 10) -> DataFrame:
    by_user = counted(events.where(F.col("category_id").isNotNull())).groupBy("category_id", "user_id").agg(X.events_sum().alias(X.EVENTS), X.score_sum().alias("score"))
    grouped = by_user.groupBy("category_id").agg(
        X.events_sum().alias("events_count"), F.count("user_id").alias("unique_users_count"), F.sum("score").alias("score")
    )
    return grouped.join(_category_names(categories), "category_id").orderBy(
        F.desc("score"), F.desc("events_count"), F.asc("category_id")
    ).limit(limit)


def top_categories_from_scores(scores: DataFrame, categories: DataFrame, limit: int = 10) -> DataFrame:
    grouped = scores.groupBy("category_id").agg(
        F.count("user_id").alias("unique_users_count"),
        F.coalesce(F.sum("score"), F.lit(0.0)).alias("score"),
        F.coalesce(F.sum(F.col("views_count") + F.col("likes_count") + F.col("saves_count")), F.lit(0))
        .alias("events_count"),
    )
    return grouped.join(_category_names(categories), "category_id").orderBy(
        F.desc("score"), F.asc("category_id")
    ).limit(limit)


def article_counters(events: DataFrame) -> DataFrame:
    return counted(events.where(F.col("article_id").isNotNull())).groupBy("article_id").agg(
        *_counters(),
        X.net_count(CLICKED).alias("opens_from_recommendations_count"),
        X.score_sum().alias("score"),
    )


def top_articles(events: DataFrame, articles: DataFrame, categories: DataFrame, limit: int = 10) -> DataFrame:
    """Best articles with title and the article's own category."""
    return article_counters(events).join(_article_titles(articles, categories), "article_id").orderBy(
        F.desc("score"), F.desc("views_count"), F.asc("article_id")
    ).limit(limit)


def top_articles_loose(events: DataFrame, articles: DataFrame, categories: DataFrame,
                       limit: int = 10) -> DataFrame:
    """Same list where an article missing from the table keeps its place with NULL names."""
    return article_counters(events).join(
        _article_titles(articles, categories), "article_id", "left"
    ).orderBy(F.desc("score"), F.desc("views_count"), F.asc("article_id")).limit(limit)


def top_articles_by_popularity(articles: DataFrame, categories: DataFrame, limit: int = 10) -> DataFrame:
    """Seed popularity order, used when no article has events; counters are 0."""
    best = articles.join(_category_names(categories), "category_id").orderBy(
        F.desc("popularity_score"), F.desc("published_at"), F.asc("article_id")
    ).limit(limit)
    zero = F.lit(0).cast("long")
    return best.select(
        "article_id", "title", "category_id", "category_name",
        zero.alias("views_count"), zero.alias("likes_count"), zero.alias("saves_count"),
        zero.alias("opens_from_recommendations_count"),
        F.coalesce(F.col("popularity_score").cast("double"), F.lit(0.0)).alias("score"),
    )


# --- distributions ----------------------------------------------------------
def events_by_type(events: DataFrame) -> DataFrame:
    typed = with_members(events.where(F.col("event_type").isNotNull()), ["event_type"], "user_id", "unique_users_count")
    return typed.orderBy(F.desc("events_count"), F.asc("event_type"))


def activity_by_day(events: DataFrame, now: datetime, days: int = 30) -> DataFrame:
    recent = events.where("recent") if "recent" in events.columns else since(events, now, days)
    return with_members(recent, [DAY], "user_id", "unique_users_count").withColumnRenamed(DAY, "date").orderBy("date")


def event_counts(events: DataFrame, user_id: int | None = None) -> DataFrame:
    chosen = events if user_id is None else events.where(F.col("user_id") == user_id)
    return rollup(chosen.where(F.col("event_type").isNotNull()), "event_type").withColumnRenamed(X.EVENTS, "events_count")


# --- recommendation click-through -------------------------------------------
def _ctr_columns() -> list[Column]:
    opened, clicked = X.net_count(OPENED), X.net_count(CLICKED)
    return [
        opened.alias("recommendations_opened"),
        clicked.alias("recommended_articles_opened"),
        X.ratio_or_zero(clicked, opened).alias("recommendation_ctr"),
    ]


def recommendation_ctr(events: DataFrame, user_id: int | None = None) -> DataFrame:
    chosen = events if user_id is None else events.where(F.col("user_id") == user_id)
    return rollup(chosen, "event_type").agg(*_ctr_columns())


def ctr_by_scope(events: DataFrame, user_id: int) -> DataFrame:
    """The same rate for one user and for all, from one scan."""
    mine = F.col("user_id") == user_id
    scopes = F.array_compact(F.array(F.lit("global"), F.when(mine, F.lit("personal"))))
    ours = rollup(events.where(F.col("event_type").isin(OPENED, CLICKED)), "event_type", "user_id")
    ours = ours.withColumn("scope", F.explode(scopes))
    rates = ours.groupBy("scope").agg(*_ctr_columns())
    # Both scopes are listed even without events.
    listed = events.sparkSession.createDataFrame([("personal",), ("global",)], "scope STRING")
    return listed.join(rates, "scope", "left").fillna(
        {"recommendations_opened": 0, "recommended_articles_opened": 0, "recommendation_ctr": 0.0}
    )


# --- composed reports -------------------------------------------------------
def personal_report(events: DataFrame, scores: DataFrame, categories: DataFrame, limit: int = 5,
                    user_id: int | None = None) -> DataFrame:
    """One row per user with events or stored scores; exactly one row for ``user_id``.

    Counters that are 0 in the events come from the stored scores, and so do the
    favourites of a user without categorised events. Events and scores are read once.
    """
    if user_id is not None:
        events, scores = events.where(F.col("user_id") == user_id), scores.where(F.col("user_id") == user_id)
    counted = rollup(events.where(F.col("user_id").isNotNull()), "user_id", "category_id", "event_type")
    events, scores = written_table(counted, "personal-events"), written_table(scores, "personal-scores")
    from_events = events.groupBy("user_id").agg(*_counters(), *_ctr_columns())
    stored = score_totals(scores).select(
        "user_id", *[F.col(n).alias(f"stored_{n}") for n in ("views_count", "likes_count", "saves_count")]
    )
    fields = ["rank", "category_id", "category_name", "score", "events_count", "views_count",
              "likes_count", "saves_count"]

    def listed(favorites: DataFrame, name: str) -> DataFrame:
        # At most ``limit`` entries per user.
        return favorites.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))

    people = from_events.join(stored, "user_id", "full")
    if user_id is not None:
        asked = events.sparkSession.createDataFrame([(user_id,)], "user_id BIGINT")
        people = asked.join(people, "user_id", "left")
    joined = (
        people.join(listed(favorite_categories(events, categories, limit=limit), "by_events"), "user_id", "left")
        .join(listed(favorite_from_scores(scores, categories, limit=limit), "by_scores"), "user_id", "left")
    )
    counters = [
        F.coalesce(X.nonzero_or(F.col(n), F.col(f"stored_{n}")), F.lit(0)).alias(n)
        for n in ("views_count", "likes_count", "saves_count")
    ]
    return joined.select(
        "user_id", *counters,
        F.coalesce("recommendations_opened", F.lit(0)).alias("recommendations_opened"),
        F.coalesce("recommended_articles_opened", F.lit(0)).alias("recommended_articles_opened"),
        F.coalesce("recommendation_ctr", F.lit(0.0)).alias("recommendation_ctr"),
        F.coalesce("by_events", "by_scores").alias("favorite_categories"),
    )


def global_report(events: DataFrame, articles: DataFrame, categories: DataFrame, now: datetime,
                  limit: int = 10, days: int = 30, scores: DataFrame | None = None) -> dict[str, DataFrame]:
    """The parts of the global report, all from one rollup of the events, which are read once.

    Without categorised events the category list comes from the stored scores, and
    without article events the article list from the seed popularity.
    """
    counted = written_table(report_rollup(events, now - timedelta(days=days)), "global-events")
    return global_parts(counted, articles, categories, now, limit, days, scores)


def global_parts(events: DataFrame, articles: DataFrame, categories: DataFrame, now: datetime, limit: int,
                 days: int, scores: DataFrame | None) -> dict[str, DataFrame]:
    """The parts from a written ``report_rollup``."""
    categories_part = top_categories(events, categories, limit)
    if scores is not None and categories_part.isEmpty():
        categories_part = top_categories_from_scores(scores, categories, limit)
    articles_part = top_articles(events, articles, categories, limit)
    if articles_part.isEmpty():
        articles_part = top_articles_by_popularity(articles, categories, limit)
    return {
        "top_categories": categories_part,
        "top_articles": articles_part,
        "events_by_type": events_by_type(events),
        "activity_by_day": activity_by_day(events, now, days),
        "recommendation_ctr": recommendation_ctr(events),
    }


def chart_frames(report: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Report parts in plotting order: bars grow upwards, days run forward."""
    return {
        "activity_by_day": report["activity_by_day"].orderBy("date"),
        "events_by_type": report["events_by_type"].orderBy(F.asc("events_count"), F.asc("event_type")),
        "top_categories": report["top_categories"].orderBy(F.asc("score"), F.asc("category_id")),
        "recommendation_ctr": report["recommendation_ctr"],
    }


def source_report(raw: DataFrame | None, audit: DataFrame, articles: DataFrame, categories: DataFrame, scores: DataFrame,
                  now: datetime, limit: int = 10, days: int = 30) -> dict[str, DataFrame]:
    """Both reports over the store that has events, each event once; every part names its ``source``."""
    source, events = choose_source(raw, audit)
    once = dedupe_events(events.select("event_id", "user_id", "event_type", "article_id", "category_id", "event_timestamp"))
    counted = written_table(report_rollup(once, now - timedelta(days=days)), "report-events")
    parts = global_parts(counted, articles, categories, now, limit, days, scores)
    parts["personal"] = personal_report(counted, scores, categories)
    return {name: part.withColumn("source", F.lit(source)) for name, part in parts.items()}
