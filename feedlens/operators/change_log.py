"""Replay of an ordered log of article changes, several per article, as if they were made one after another.

Whether a change is accepted depends on the changes before it only: on those of its article (does it exist, which url has it)
and on those of the url it claims (does another article hold it). So the decisions are found by iterating to a fixed point. Each round
takes the decisions of the round before as given, derives from them when which article held which url, as intervals of order
numbers, and judges every change anew. Decisions settle in the order of their dependence: after k rounds all chains of k refusals
are right, and a round that changes nothing has found the decisions of the sequence, which are the only fixed point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.operators.content import PATCHABLE, left_join_spread
from feedlens.session import written_table

#: Where the stored articles stand; order numbers are above it.
BEFORE_ALL = -(2**62)
NOT_FOUND, EXISTS, NO_CATEGORY, TAKEN = "article_not_found", "article_exists", "category_not_found", "source_url_taken"


def _sets(name: str) -> Column:
    """Whether a change gives the field a value: a creation sets all fields, a patch those it names."""
    return (F.col("op") == "create") | ((F.col("op") == "patch") & F.coalesce(F.array_contains("set_fields", name), F.lit(False)))


def _prepared(articles: DataFrame, changes: DataFrame, categories: DataFrame) -> DataFrame:
    """Stored articles as changes before the first (``order_no`` NULL), and the changes: ``order_no, article_id, op, url, sets_url, no_category``."""
    known = categories.select(F.col("category_id").alias("_category"), F.lit(True).alias("_known")).dropDuplicates(["_category"])
    claimed = changes.withColumn("_claimed", F.when(_sets("category_id"), F.col("category_id")))
    judged = left_join_spread(claimed, known, "_claimed", "_category", "order_no")
    own = judged.select(
        "order_no", "article_id", "op", F.when(_sets("source_url"), F.col("source_url")).alias("url"),
        (_sets("source_url") | (F.col("op") == "delete")).alias("sets_url"),
        (F.col("_claimed").isNotNull() & F.col("_known").isNull()).alias("no_category"),
    )
    touched = articles.select(
        F.lit(None).cast("long").alias("order_no"), "article_id", F.lit("create").alias("op"), F.col("source_url").alias("url"),
        F.lit(True).alias("sets_url"), F.lit(False).alias("no_category"),
    )
    return touched.unionByName(own)


def _round(log: DataFrame, decided: DataFrame) -> DataFrame:
    """``order_no, conflict`` of every change, judged by the accepted changes of ``decided``."""
    flagged = log.join(decided.select("order_no", F.col("conflict").isNull().alias("accepted")), "order_no", "left")
    # Stored articles are no changes and always stand.
    flagged = flagged.withColumn("accepted", F.coalesce("accepted", F.lit(True)))
    in_order = Window.partitionBy("article_id").orderBy(F.asc_nulls_first("order_no"))
    before, after = in_order.rowsBetween(Window.unboundedPreceding, -1), in_order.rowsBetween(1, Window.unboundedFollowing)
    accepted = F.col("accepted")
    there = F.when(accepted & (F.col("op") == "create"), F.lit(True)).when(accepted & (F.col("op") == "delete"), F.lit(False))
    holds = accepted & F.col("sets_url")
    state = flagged.select(
        "*",
        F.coalesce(F.last(there, ignorenulls=True).over(before), F.lit(False)).alias("there"),
        F.last(F.when(holds, F.struct("url")), ignorenulls=True).over(before)["url"].alias("url_before"),
        F.first(F.when(holds, F.col("order_no")), ignorenulls=True).over(after).alias("held_until"),
    )
    state = written_table(state.where("order_no is not null or url is not null"), "change-states")
    # Per url: +1 where an article gets it, -1 where the article gives it up, and the claims between them.
    zero = F.lit(0)
    held = state.where(holds & F.col("url").isNotNull())
    marks = (
        held.select("url", F.coalesce("order_no", F.lit(BEFORE_ALL)).alias("at"), F.lit(1).alias("step"), F.lit(None).cast("long").alias("claim"))
        .unionAll(held.where("held_until is not null").select("url", F.col("held_until").alias("at"), F.lit(-1).alias("step"), F.lit(None).cast("long").alias("claim")))
        .unionAll(state.where("order_no is not null and url is not null").select("url", F.col("order_no").alias("at"), zero.alias("step"), F.col("order_no").alias("claim")))
    )
    earlier = Window.partitionBy("url").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    holders = marks.withColumn("holders", F.coalesce(F.sum("step").over(earlier), zero)).where("claim is not null")
    judged = state.where("order_no is not null").join(holders.select(F.col("claim").alias("order_no"), "holders"), "order_no", "left")
    others = F.coalesce(F.col("holders"), zero) - F.coalesce(F.col("url_before") == F.col("url"), F.lit(False)).cast("int") * F.col("there").cast("int")
    creating = F.col("op") == "create"
    conflict = (
        F.when(~creating & ~F.col("there"), F.lit(NOT_FOUND)).when(creating & F.col("there"), F.lit(EXISTS))
        .when(F.col("no_category"), F.lit(NO_CATEGORY)).when(others > 0, F.lit(TAKEN))
    )
    return judged.select("order_no", conflict.alias("conflict"))


def decide(articles: DataFrame, changes: DataFrame, categories: DataFrame) -> DataFrame:
    """``order_no, conflict`` of every change: NULL if the change is accepted where it stands in the order.

    ``changes``: ``order_no`` (unique), ``op`` (create, patch, delete), ``article_id``, the new field values, and ``set_fields``, the names
    that a patch supplies. Every round reads the log's few columns and the decisions before; there are as many rounds as the longest chain
    of refusals that depend on one another, and one more.
    """
    log = written_table(_prepared(articles, changes, categories), "change-log")
    decided = written_table(
        log.where("order_no is not null").select("order_no", F.when(F.col("no_category"), F.lit(NO_CATEGORY)).alias("conflict")), "change-decisions"
    )
    while True:
        now = written_table(_round(log, decided), "change-decisions")
        old = decided.withColumnRenamed("conflict", "old")
        same = now.join(old, "order_no").where(~F.col("conflict").eqNullSafe(F.col("old"))).isEmpty()
        if same:
            return now
        decided = now


def replay_changes(articles: DataFrame, changes: DataFrame, categories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(articles after the log, refused changes with ``conflict``)."""
    decided = decide(articles, changes, categories)
    judged = changes.join(decided, "order_no")
    accepted = written_table(judged.where(F.col("conflict").isNull()).drop("conflict"), "accepted-changes")
    # Fields that the log has no column for stay as they are, or NULL in a created article.
    fields: Sequence[str] = [name for name in PATCHABLE if name in articles.columns and name in changes.columns]
    # What stands is what came last: of existence, and of every field since the article was last created.
    number = F.col("order_no")
    last = accepted.groupBy("article_id").agg(
        F.max(F.when(F.col("op") == "create", number)).alias("_created"), F.max(F.when(F.col("op") == "delete", number)).alias("_deleted"),
    )
    since = accepted.join(last, "article_id").where(F.col("_created").isNull() | (number >= F.col("_created")))
    values = since.groupBy("article_id").agg(*[
        F.max(F.when(_sets(name), F.struct(number.alias("at"), F.col(name).alias("value")))).alias(f"_new_{name}") for name in fields
    ])
    edits = last.join(values, "article_id")
    gone = F.col("_deleted").isNotNull() & (F.col("_created").isNull() | (F.col("_deleted") > F.col("_created")))
    created = F.col("_created").isNotNull()
    kept = articles.join(edits, "article_id", "left").where(~F.coalesce(gone, F.lit(False)) & ~F.coalesce(created, F.lit(False)))
    stored = kept.select(*[
        F.when(F.col(f"_new_{name}").isNotNull(), F.col(f"_new_{name}")["value"]).otherwise(F.col(name)).alias(name) if name in fields else F.col(name)
        for name in articles.columns
    ])
    fresh = edits.where(created & ~gone).select(*[
        F.col("article_id") if name == "article_id" else F.col(f"_new_{name}")["value"].alias(name) if name in fields
        else F.lit(None).cast(articles.schema[name].dataType).alias(name)
        for name in articles.columns
    ])
    return stored.unionByName(fresh), judged.where(F.col("conflict").isNotNull())
