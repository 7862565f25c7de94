"""The recommendation batch: ratings, ALS, fallbacks, merge, replacement."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.operators import recommend as R
from feedlens.operators.als import als_candidates
from feedlens.sources.sinks import stored_versions, write_recommendations

DEFAULTS = R.RecommendationSettings()


def recommend(people: DataFrame, features: DataFrame, pairs: DataFrame, ratings: DataFrame,
              settings: R.RecommendationSettings = DEFAULTS) -> DataFrame:
    """Final (user, article, score, reason, model_version) rows, ``top_n`` per user.

    Takes active users, article features, subscription pairs and ratings. Persist pairs
    and ratings: the fit and the exclusions read them several times.
    """
    eligible = R.eligible_users(R.user_event_counts(people, ratings), settings.min_events)
    als = als_candidates(ratings, eligible, features, settings)
    fallback = R.fallback_sources(  # cut once, with the model's rows
        people, pairs, R.article_popularity(features, ratings), ratings.select("user_id", "article_id"), settings
    )
    return R.combine_candidates(als, fallback, settings)


def run_recommendations(users: DataFrame, articles: DataFrame, subscriptions: DataFrame, events: DataFrame,
                        path: str, settings: R.RecommendationSettings = DEFAULTS) -> dict[str, int]:
    """Compute and store one model version from the tables and the deduplicated
    interaction events; returns the counts of the run."""
    def kept(df: DataFrame) -> DataFrame:
        return df.persist(StorageLevel.MEMORY_AND_DISK)

    inputs = [
        kept(R.active_users(users)), kept(R.article_features(articles)),
        kept(R.subscription_pairs(subscriptions)), kept(R.build_ratings(events)),
    ]
    people, features, _, ratings = inputs
    try:
        if people.isEmpty():
            raise ValueError("no active users")
        if features.isEmpty():
            raise ValueError("no articles")
        result = recommend(*inputs, settings).withColumn("created_at", F.current_timestamp())
        write_recommendations(result, path)
        stored = stored_versions(users.sparkSession, path).where(F.col("model_version") == settings.model_version)
        return {"users": people.count(), "ratings": ratings.count(), "recommendations": stored.count()}
    finally:
        for df in inputs:
            df.unpersist()
