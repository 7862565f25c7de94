"""Synthetic events and seed dimensions.

One output row per input row: the caller brings a DataFrame with a numeric row id
(``spark.range(n)`` or any table). All draws are hashes of (seed, purpose, row id), so
rows are made in parallel and a retried task makes the same rows again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.functions import expressions as X
from feedlens.operators.ranking import left_join_spread, with_positions
from feedlens.sources.quotas import by_quota


def synthetic_users(ids: DataFrame, id_col: str = "id", domain: str = "example.com") -> DataFrame:
    """Users 1, 2, ... with derived e-mail and name."""
    number = F.format_string("%04d", F.col(id_col).cast("long"))
    return ids.select(
        F.col(id_col).cast("long").alias("user_id"),
        F.concat(F.lit("generated.user"), number, F.lit(f"@{domain}")).alias("email"),
        F.concat(F.lit("Generated User "), number).alias("full_name"),
        F.lit("user").alias("role"),
        F.lit(True).alias("is_active"),
    )


def seed_categories(spark) -> DataFrame:
    rows = [(number, name, slug, f"Articles about {name}.") for number, (name, slug) in enumerate(S.SEED_CATEGORIES, start=1)]
    return spark.createDataFrame(rows, "category_id BIGINT, name STRING, slug STRING, description STRING")


def synthetic_articles(ids: DataFrame, now: datetime, id_col: str = "id", seed: int = 42) -> DataFrame:
    """Articles 1, 2, ... going round the categories and topics."""
    number = F.col(id_col).cast("long")
    padded = F.format_string("%04d", number)
    zero_based = number - 1
    names = tuple(name for name, _ in S.SEED_CATEGORIES)
    slugs = tuple(slug for _, slug in S.SEED_CATEGORIES)
    topic = X.pick(S.SEED_TOPICS, zero_based)
    title = F.concat(X.pick(names, zero_based), F.lit(": "), X.title_words(topic), F.lit(" Demo #"), padded)
    url = F.concat(
        F.lit("https://example.com/generated/"), F.format_string("%04d", "article_id"), F.lit("-"),
        X.slug(F.col("title")),
    )
    minutes = (number * 7) % 1440
    age = F.make_dt_interval((number % 30).cast("int"), F.lit(0), minutes.cast("int"))
    return ids.select(
        number.alias("article_id"),
        title.alias("title"),
        (zero_based % len(names) + 1).alias("category_id"),
        X.pick(slugs, zero_based).alias("category_slug"),
        F.concat(F.lit("Generated article about "), topic, F.lit(".")).alias("summary"),
        (X.utc_literal(now) - age).alias("published_at"),
        F.round(F.lit(1.0) + (X.draw(seed, "popularity", number) % 9901) / 100, 2).alias("popularity_score"),
    ).withColumns({
        "source_url": url,
        "author": F.concat(F.lit("Demo Author "), ((F.col("article_id") - 1) % 20 + 1).cast("string")),
        "content": F.concat(
            "title", F.lit(". Generated text for demonstrations, "), (F.col("article_id") % 9 + 1).cast("string"), F.lit(" minutes to read.")
        ),
    })


def _event_type(number: Column) -> Column:
    """Type by weight from a uniform non-negative number."""
    point = number % sum(S.EVENT_MIX.values())
    choice, upto = None, 0
    for event_type, share in S.EVENT_MIX.items():
        upto += share
        test = point < upto
        choice = F.when(test, F.lit(event_type)) if choice is None else choice.when(test, F.lit(event_type))
    return choice


def _metadata(seed: int, key: Column) -> Column:
    def chosen(values: tuple[str, ...], purpose: str) -> Column:
        return X.pick(values, X.draw(seed, purpose, key))

    def number(low: int, high: int, purpose: str) -> Column:
        return (X.draw(seed, purpose, key) % (high - low + 1) + low).cast("string")

    source = F.lit("source")
    return (
        F.when(F.col("event_type") == "search",
               F.create_map(F.lit("query"), chosen(S.SEARCH_TERMS, "term"), source, F.lit("feed_search")))
        .when(F.col("event_type") == "view_article",
              F.create_map(F.lit("duration_seconds"), number(8, 240, "duration"),
                           source, chosen(S.VIEW_SOURCES, "view source")))
        .when(F.col("event_type") == "open_recommended_article",
              F.create_map(F.lit("recommendation_rank"), number(1, 20, "rank"),
                           F.lit("reason"), chosen(S.OPEN_REASONS, "open reason")))
        .otherwise(F.create_map(source, chosen(S.OTHER_SOURCES, "source")))
    )


def event_references(users: DataFrame, articles: DataFrame, max_users: int | None = None,
                     max_articles: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Ids events may refer to, ascending and optionally only the first ones."""
    chosen_users = users.where(F.col("is_active") & (F.col("role") == "user")).select("user_id")
    chosen_articles = articles.select("article_id", "category_id")
    if max_users is not None:
        chosen_users = chosen_users.orderBy("user_id").limit(max_users)
    if max_articles is not None:
        chosen_articles = chosen_articles.orderBy("article_id").limit(max_articles)
    return chosen_users, chosen_articles


def synthetic_events(rows: DataFrame, users: DataFrame, articles: DataFrame, now: datetime,
                     id_col: str = "id", seed: int = 42, exact_types: bool = False) -> DataFrame:
    """One event per input row over the given users (user_id) and articles
    (article_id, category_id), within the 30 days before ``now``.

    Users, articles and categories are numbered once; a draw modulo their count picks a
    number and an equi join finds the id. Draws are uniform, and rows without an article or
    category are dealt by row, so no join key is hot. With ``exact_types`` every type has exactly its share of the rows (to less than one
    row), otherwise on average; rows are then numbered by their ids first.
    """
    key = F.col("row_id")
    numbered_users = with_positions(users.select("user_id"), [], [F.asc("user_id")], "user_no")
    numbered_articles = with_positions(
        articles.select("article_id", F.col("category_id").alias("article_category_id")),
        [], [F.asc("article_id")], "article_no",
    )
    numbered_categories = with_positions(
        articles.select(F.col("category_id").alias("drawn_category_id")).distinct(),
        [], [F.asc("drawn_category_id")], "category_no",
    )

    def size(df: DataFrame) -> Column:
        return df.select(F.count("*").alias("n")).scalar()

    is_article = F.col("event_type").isin(*S.ARTICLE_EVENT_TYPES)
    is_category = F.col("event_type").isin(*S.CATEGORY_EVENT_TYPES)
    keyed, event_type = rows.select(F.col(id_col).cast("long").alias("row_id")), _event_type(X.draw(seed, "type", key))
    if exact_types:
        keyed = with_positions(keyed, [], [F.asc("row_id")], "row_no")
        count = keyed.agg(F.count(F.lit(1)).alias("n")).first()["n"]
        event_type = by_quota(F.col("row_no") - 1, count, S.EVENT_MIX, seed)
    drawn = (
        keyed.withColumn("event_type", event_type)
        .withColumn("user_no", X.draw(seed, "user", key) % size(numbered_users) + 1)
        .withColumn("article_no",
                    F.when(is_article, X.draw(seed, "article", key) % size(numbered_articles) + 1))
        .withColumn("category_no",
                    F.when(is_category, X.draw(seed, "category", key) % size(numbered_categories) + 1))
    )
    linked = left_join_spread(
        drawn.join(numbered_users, "user_no"), numbered_articles.withColumnRenamed("article_no", "_article_no"),
        "article_no", "_article_no", "row_id",
    )
    linked = left_join_spread(
        linked, numbered_categories.withColumnRenamed("category_no", "_category_no"), "category_no", "_category_no", "row_id"
    )
    user = F.col("user_id")
    sessions = X.draw(seed, "sessions", user) % 7 + 2
    session = X.draw(seed, "session", key) % sessions
    age = F.make_dt_interval(
        (X.draw(seed, "day", key) % 30).cast("int"), F.lit(0), F.lit(0),
        (X.draw(seed, "second", key) % 86_400).cast("int"),
    )
    device = F.create_map(
        F.lit("platform"), F.lit("android"),
        F.lit("app_version"), X.pick(S.APP_VERSIONS, X.draw(seed, "app", key)),
        F.lit("os_version"), X.pick(S.OS_VERSIONS, X.draw(seed, "os", key)),
    )
    return linked.select(
        X.hash_uuid(F.lit(f"event {seed}"), key.cast("string")).alias("event_id"),
        "user_id",
        X.hash_uuid(F.lit(f"session {seed}"), user.cast("string"), session.cast("string")).alias("session_id"),
        "event_type",
        "article_id",
        F.coalesce("drawn_category_id", "article_category_id").alias("category_id"),
        (X.utc_literal(now) - age).alias("event_timestamp"),
        device.alias("device"),
        _metadata(seed, key).alias("metadata"),
    )
