"""Implicit-feedback ALS candidates."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.operators.grouped_als import grouped_candidates
from feedlens.operators.inner_product import top_by_inner_product
from feedlens.operators.ranking import with_positions
from feedlens.operators.recommend import RecommendationSettings
from feedlens.session import enable_checkpoints, written_table


def _id_maps(ratings: DataFrame) -> list[DataFrame]:
    """Dense int ids of users and articles (the factorisation takes 32-bit ids only)."""
    return [
        with_positions(ratings.select(column).distinct(), [], [F.asc(column)], f"_{column}")
        for column in ("user_id", "article_id")
    ]


def _encode(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    return df.join(ids, column).withColumn(column, F.col(f"_{column}").cast("int")).drop(f"_{column}")


def _decode(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    back = ids.select(F.col(column).alias("_original"), F.col(f"_{column}").cast("int").alias(column))
    return df.join(back, column).withColumn(column, F.col("_original")).drop("_original")


def fit_als(triples: DataFrame, settings: RecommendationSettings) -> ALSModel:
    """Train on (user_id int, article_id int, rating float), with a fixed seed and number of blocks."""
    enable_checkpoints(triples.sparkSession)
    als = ALS(
        userCol="user_id", itemCol="article_id", ratingCol="rating", implicitPrefs=True,
        nonnegative=True, coldStartStrategy="drop", rank=settings.rank, maxIter=settings.max_iter,
        regParam=settings.reg_param, alpha=settings.alpha, seed=settings.seed,
        numUserBlocks=settings.blocks, numItemBlocks=settings.blocks,
    )
    return als.fit(triples)


def als_candidates(ratings: DataFrame, eligible: DataFrame, articles: DataFrame,
                   settings: RecommendationSettings, readers: DataFrame | None = None) -> DataFrame:
    """The best ``top_n`` unread known articles of each eligible user.

    ``readers`` (``user_id, open``) have read all articles but the groups in ``open``, see ``grouped_als``; ``articles`` then has the ``group``.

    Ratings of unknown articles are left out before the fit, so that they take no places. The factors are searched with the
    read articles left out, until no article left can be among a user's best.
    """
    if readers is not None:
        return grouped_candidates(ratings, eligible, articles, settings, readers)
    known = ratings.join(articles.select("article_id"), "article_id", "left_semi")
    served = eligible.join(known, "user_id", "left_semi")
    if served.isEmpty():
        return ratings.sparkSession.createDataFrame([], S.CANDIDATES)
    user_ids, item_ids = _id_maps(known)
    triples = written_table(_encode(_encode(known, "user_id", user_ids), "article_id", item_ids).select(
        "user_id", "article_id", F.col("rating").cast("float").alias("rating")
    ), "als-ratings")
    model = fit_als(triples, settings)
    asked = _encode(served.select("user_id"), "user_id", user_ids)
    people = model.userFactors.withColumnRenamed("id", "user_id").join(asked, "user_id", "left_semi")
    things = model.itemFactors.withColumnRenamed("id", "article_id")
    offers = top_by_inner_product(people, things, triples.select("user_id", "article_id"), settings.top_n)
    return (
        _decode(_decode(offers, "user_id", user_ids), "article_id", item_ids)
        .select(
            "user_id", "article_id", "score",
            F.lit(S.REASON_ALS).alias("reason"),
            F.lit(settings.model_version).alias("model_version"),
            F.lit(S.PRIORITY_ALS).alias("source_priority"),
        )
    )
