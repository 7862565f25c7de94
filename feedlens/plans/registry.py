"""Registry of the checkable queries: a Spark callable and, where one exists, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.operators import aggregates as A
from feedlens.operators import content as C
from feedlens.operators import events as E
from feedlens.operators import recommend as R
from feedlens.operators.scores import MEASURES
from feedlens.plans import views
from feedlens.sources import bridge

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The derived feed tables of one data folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def _load(self, view: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
        return view(self.spark, self.sf_dir)

    @cached_property
    def users(self) -> DataFrame:
        return self._load(bridge.feed_users)

    @cached_property
    def categories(self) -> DataFrame:
        return self._load(bridge.feed_categories)

    @cached_property
    def articles(self) -> DataFrame:
        return self._load(bridge.feed_articles)

    @cached_property
    def long_articles(self) -> DataFrame:
        return self._load(bridge.long_articles)

    @cached_property
    def all_events(self) -> DataFrame:
        """Feed events, valid or not."""
        return self._load(bridge.feed_events)

    @cached_property
    def events(self) -> DataFrame:
        """Valid feed events."""
        return E.valid_events(self.all_events)

    @cached_property
    def order_events(self) -> DataFrame:
        return self._load(bridge.order_events)

    @cached_property
    def order_once(self) -> DataFrame:
        """Order events, each event id once."""
        return E.dedupe_events(self.order_events)

    @cached_property
    def likes(self) -> DataFrame:
        return C.likes_from(self.events)

    @cached_property
    def saves(self) -> DataFrame:
        return C.saves_from(self.events)

    @cached_property
    def subscriptions(self) -> DataFrame:
        return C.subscriptions_from(self.events)

    @cached_property
    def ratings(self) -> DataFrame:
        return R.build_ratings(self.events)

    @cached_property
    def scores(self) -> DataFrame:
        """Stored scores of all feed events."""
        return self._scores_of(self.events)

    @cached_property
    def old_scores(self) -> DataFrame:
        """Stored scores before the second half of the month."""
        return self._scores_of(self.first_half)

    @cached_property
    def order_scores(self) -> DataFrame:
        """Stored scores of the order events, also of users without feed events."""
        return self._scores_of(self.order_events)

    @staticmethod
    def _scores_of(events: DataFrame) -> DataFrame:
        return A.category_score_deltas(events).select(
            "user_id", "category_id",
            *[F.greatest(F.lit(0), F.col(delta)).cast("double" if name == "score" else "long").alias(name)
              for name, delta in MEASURES.items()],
        )

    @cached_property
    def first_half(self) -> DataFrame:
        return self.events.where(F.col("event_timestamp") < F.lit(views.MIDDLE).cast("timestamp"))

    @cached_property
    def second_half(self) -> DataFrame:
        return self.events.where(F.col("event_timestamp") >= F.lit(views.MIDDLE).cast("timestamp"))

    @cached_property
    def stored_recommendations(self) -> DataFrame:
        """Stored rows: each rating moved to the next article, two model versions."""
        even = F.col("article_id") % 2 == 0
        return self.ratings.select(
            "user_id",
            (F.col("article_id") % 200 + 1).alias("article_id"),
            (F.col("rating") * F.lit(0.25)).alias("score"),
            F.lit("seeded").alias("reason"),
            F.when(even, F.lit("als-v1")).otherwise(F.lit("seed")).alias("model_version"),
            F.timestamp_add("DAY", F.col("events_count").cast("int"),
                            F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("created_at"),
        )


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name``."""
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = views.with_views(sql)
        return build

    return register
