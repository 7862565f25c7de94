"""Article search, feed and saved pages, per-user flags, interaction state, change sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.operators.ranking import left_join_spread, paged, top_per_key, total_order

NEWEST_FIRST = ("published_at", "article_id")
LIST_COLUMNS = ("article_id", "title", "summary", "source_url", "category_id", "author",
                "published_at", "created_at", "popularity_score")
SEARCHED = ("title", "summary", "content")
PATCHABLE = ("title", "summary", "content", "source_url", "category_id", "author",
             "published_at", "popularity_score")


def newest_first() -> list[Column]:
    return [F.desc(name) for name in NEWEST_FIRST]


# --- projections ------------------------------------------------------------
def article_list_view(articles: DataFrame) -> DataFrame:
    """Columns of a list item; the text stays in the files."""
    return articles.select(*[name for name in LIST_COLUMNS if name in articles.columns])


def article_detail_view(articles: DataFrame, article_id: int) -> DataFrame:
    return articles.where(F.col("article_id") == article_id).select(
        *[name for name in (*LIST_COLUMNS, "content") if name in articles.columns]
    )


def with_category(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """Nested ``category`` record of the row's ``category_id``; NULL when unknown."""
    record = categories.select("category_id", F.struct("category_id", "name").alias("category"))
    return rows.join(record, "category_id", "left")


def with_article(rows: DataFrame, articles: DataFrame, categories: DataFrame) -> DataFrame:
    """Nested ``article`` list item, itself with its ``category``, for the row's article."""
    items = with_category(article_list_view(articles), categories)
    record = items.select("article_id", F.struct(*items.columns).alias("article"))
    return rows.join(record, "article_id")


def lookup(rows: DataFrame, key: str, wanted: Sequence | DataFrame) -> DataFrame:
    """Rows whose key is in a short list of values, or in the key column of a table."""
    if isinstance(wanted, DataFrame):
        return rows.join(wanted.select(key), key, "left_semi")
    return rows.where(F.col(key).isin(*wanted))


def category_name(own_name: Column, category: Column) -> Column:
    """The row's own category name, else the one of its category record."""
    return F.coalesce(own_name, category["name"])


# --- search and pages -------------------------------------------------------
def like_pattern(term: str | None, escape: bool = False) -> str | None:
    """The LIKE pattern of a search term; None for a missing or empty one, which matches all."""
    if not term:
        return None
    text = term.strip()
    if escape:
        for special in ("\\", "%", "_"):
            text = text.replace(special, "\\" + special)
    return f"%{text}%"


def matches(articles: DataFrame, pattern: str) -> Column:
    hit = F.lit(False)
    for name in SEARCHED:
        if name in articles.columns:
            hit = hit | F.coalesce(F.col(name).ilike(pattern), F.lit(False))
    return hit


def search_articles(articles: DataFrame, term: str | None = None, category_id: int | None = None,
                    escape: bool = False) -> DataFrame:
    """Case-insensitive substring of title, summary or content, and category equality.

    ``%`` and ``_`` in the term are wildcards unless ``escape`` is set; a blank term
    matches all. ``search_index`` does the same without comparing every text.
    """
    found = articles
    if category_id is not None:
        found = found.where(F.col("category_id") == category_id)
    pattern = like_pattern(term, escape)
    return found if pattern is None else found.where(matches(found, pattern))


def feed_page(articles: DataFrame, limit: int = 20, offset: int = 0, term: str | None = None,
              category_id: int | None = None, with_total: bool = True) -> DataFrame:
    """One page, newest first, with the total number of matches.

    The page is chosen on the list columns only: the article text is read to test the
    term but never sorted or shuffled.
    """
    return paged(article_list_view(search_articles(articles, term, category_id)),
                 newest_first(), limit, offset, with_total)


def category_list(categories: DataFrame, ignore_case: bool = False) -> DataFrame:
    return categories.orderBy(F.lower("name") if ignore_case else F.col("name"), "category_id")


def saved_page(articles: DataFrame, saved: DataFrame, user_id: int, limit: int = 20,
               offset: int = 0) -> DataFrame:
    """A user's saved articles, newest first; the total counts the saved rows."""
    mine = saved.where(F.col("user_id") == user_id).select("article_id")
    total = mine.select(F.count("*").alias("total")).scalar()
    rows = article_list_view(articles).join(mine, "article_id", "left_semi")
    return rows.orderBy(*newest_first()).offset(offset).limit(limit).withColumn("total", total)


def saved_per_user(articles: DataFrame, saved: DataFrame, per_user: int) -> DataFrame:
    """First saved page of every user in one job."""
    rows = saved.select("user_id", "article_id").join(article_list_view(articles), "article_id")
    return top_per_key(rows, ["user_id"], newest_first(), per_user, rank_col="rank")


# --- per-user flags ---------------------------------------------------------
def _flag(rows: DataFrame, members: DataFrame, key: str, name: str, user_id: int | None) -> DataFrame:
    if user_id is None:
        return rows.withColumn(name, F.lit(False))
    mine = members.where(F.col("user_id") == user_id).select(key, F.lit(True).alias(name))
    return rows.join(mine.dropDuplicates([key]), key, "left").withColumn(
        name, F.coalesce(F.col(name), F.lit(False))
    )


def article_flags(articles: DataFrame, likes: DataFrame, saved: DataFrame, subscriptions: DataFrame,
                  user_id: int | None = None) -> DataFrame:
    """is_liked, is_saved, is_subscribed per article; all false for an anonymous reader."""
    flagged = _flag(articles, likes, "article_id", "is_liked", user_id)
    flagged = _flag(flagged, saved, "article_id", "is_saved", user_id)
    return _flag(flagged, subscriptions, "category_id", "is_subscribed", user_id)


def category_flags(categories: DataFrame, subscriptions: DataFrame, user_id: int | None = None) -> DataFrame:
    return _flag(categories, subscriptions, "category_id", "is_subscribed", user_id)


# --- interaction state ------------------------------------------------------
def _latest_actions(events: DataFrame, on_type: str, off_type: str, keys: Sequence[str]) -> DataFrame:
    actions = events.where(F.col("event_type").isin(on_type, off_type))
    for key in keys:
        actions = actions.where(F.col(key).isNotNull())
    order = [F.desc("event_timestamp"), F.desc("event_id"), F.desc("event_type")]
    return top_per_key(actions, keys, order, 1).select(*keys, "event_type", "event_timestamp")


def interaction_state(events: DataFrame, on_type: str, off_type: str, keys: Sequence[str]) -> DataFrame:
    """Keys whose latest action sets the relation, with the time it was set last.

    Repeated likes and likes after unlikes fall together: only the latest action counts.
    """
    latest = _latest_actions(events, on_type, off_type, keys)
    return latest.where(F.col("event_type") == on_type).select(
        *keys, F.col("event_timestamp").alias("created_at")
    )


def merge_interaction_state(current: DataFrame, events: DataFrame, on_type: str, off_type: str,
                            keys: Sequence[str]) -> DataFrame:
    """Stored relation plus a new batch of actions: set ones are kept or added, unset
    ones removed, and a relation that exists keeps its creation time."""
    latest = _latest_actions(events, on_type, off_type, keys)
    changed = latest.withColumnRenamed("event_type", "action")
    return (
        current.select(*keys, "created_at").join(changed, list(keys), "full")
        .where(F.col("action").isNull() | (F.col("action") == on_type))
        .select(*keys, F.coalesce("created_at", "event_timestamp").alias("created_at"))
    )


def likes_from(events: DataFrame) -> DataFrame:
    return interaction_state(events, "like_article", "unlike_article", ["user_id", "article_id"])


def saves_from(events: DataFrame) -> DataFrame:
    return interaction_state(events, "save_article", "unsave_article", ["user_id", "article_id"])


def subscriptions_from(events: DataFrame) -> DataFrame:
    return interaction_state(
        events, "subscribe_category", "unsubscribe_category", ["user_id", "category_id"]
    )


# --- insert-if-absent and article change sets -------------------------------
def add_missing(existing: DataFrame, wanted: DataFrame, natural_key: str) -> DataFrame:
    """Existing rows plus the wanted ones whose natural key is new (idempotent seed).

    Of repeated wanted keys the first row in the order of all columns is inserted.
    """
    first = top_per_key(wanted, [natural_key], total_order(wanted), 1)
    fresh = first.join(existing.select(natural_key), natural_key, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def apply_article_changes(articles: DataFrame, changes: DataFrame, categories: DataFrame,
                          ) -> tuple[DataFrame, DataFrame]:
    """(articles after the change set, refused changes with ``conflict``).

    A change has ``op`` (create, patch or delete), ``article_id`` (unique in the set), the
    new field values and ``set_fields``, the names a patch supplies. Checks run against
    the table as it was: a category must exist, a patched or deleted article must exist,
    a created one must not, and a source_url may not belong to another article or be
    claimed twice among the changes that pass the checks before (the lowest article_id gets it).
    """
    known_categories = categories.select(
        F.col("category_id").alias("_category"), F.lit(True).alias("category_known")
    )
    stored = articles.select(
        F.col("article_id").alias("_stored_id"), F.col("source_url").alias("_stored_url")
    )
    patches_url = (F.col("op") == "patch") & F.array_contains("set_fields", "source_url")
    claims = F.when((F.col("op") == "create") | patches_url, F.col("source_url"))
    sets_category = (F.col("op") == "create") | (
        (F.col("op") == "patch") & F.array_contains("set_fields", "category_id")
    )
    claimed = changes.withColumn("_claim", claims).withColumn(
        "_claimed_category", F.when(sets_category, F.col("category_id"))
    )
    owners = stored.where(F.col("_stored_url").isNotNull()).select(
        F.col("_stored_url").alias("_owned_url"), F.col("_stored_id").alias("_owner")
    )
    found = claimed.join(stored.select("_stored_id"), F.col("article_id") == F.col("_stored_id"), "left")
    found = left_join_spread(found, known_categories, "_claimed_category", "_category", "article_id")
    own_fault = (
        F.when((F.col("op") != "create") & F.col("_stored_id").isNull(), F.lit("article_not_found"))
        .when((F.col("op") == "create") & F.col("_stored_id").isNotNull(), F.lit("article_exists"))
        .when(F.col("_claimed_category").isNotNull() & F.col("category_known").isNull(), F.lit("category_not_found"))
    )
    found = left_join_spread(found.withColumn("_fault", own_fault), owners, "_claim", "_owned_url", "article_id")
    sound = found.where(F.col("_fault").isNull() & F.col("_claim").isNotNull())
    first_claim = sound.groupBy(F.col("_claim").alias("_claim_url")).agg(F.min("article_id").alias("_winner"))
    taken = (F.col("_owner") != F.col("article_id")) | (F.col("_winner") != F.col("article_id"))
    checked = (
        left_join_spread(found, first_claim, "_claim", "_claim_url", "article_id")
        .withColumn("conflict", F.coalesce("_fault", F.when(taken, F.lit("source_url_taken"))))
        .select(*changes.columns, "conflict")
    )
    accepted = checked.where(F.col("conflict").isNull()).drop("conflict")
    refused = checked.where(F.col("conflict").isNotNull())

    edits = accepted.where(F.col("op") != "create").select(
        "article_id", "op", "set_fields", *[F.col(name).alias(f"_new_{name}") for name in PATCHABLE]
    )

    def patched(name: str) -> Column:
        supplied = F.coalesce(F.array_contains("set_fields", name), F.lit(False))
        return F.when(supplied, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)

    kept = articles.join(edits, "article_id", "left").where(
        F.col("op").isNull() | (F.col("op") == "patch")
    ).select("article_id", *[patched(name) for name in PATCHABLE])
    created = accepted.where(F.col("op") == "create").select("article_id", *PATCHABLE)
    return kept.unionByName(created), refused
