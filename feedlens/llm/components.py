"""Connected components of links between ids, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.session import written_table


def _once(links: DataFrame) -> DataFrame:
    """Each link once, the smaller id first."""
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _neighbours(links: DataFrame, turn: int) -> DataFrame:
    """``id, next``: of an id and its neighbours the one with the lowest hash of this round."""
    def ranked(name: str):
        return F.struct(F.xxhash64(F.lit(turn), F.col(name)).alias("rank"), F.col(name).alias("id"))

    both = links.select(F.col("a").alias("id"), "b").unionAll(links.select(F.col("b").alias("id"), F.col("a").alias("b")))
    lowest = both.groupBy("id").agg(F.min(ranked("b")).alias("other"))
    return lowest.select("id", F.least("other", ranked("id"))["id"].alias("next"))


def components(links: DataFrame) -> DataFrame:
    """``id, label`` of every id in ``links`` (``a``, ``b``), the label being its component's smallest id.

    Each round moves every id to the one of its neighbours, or itself, that has the lowest hash. Both ends of
    the links move, links that become loops or equal drop out, and only what is left enters the next round. The hash, new in
    every round, makes the ids fewer by a constant factor whatever the shape: a path as well as a hub. Every round is
    written to the shared folder, so both sides of its joins are tables of known size: a small one is broadcast, and otherwise Spark splits a
    hub's rows among tasks.
    """
    id_type = links.schema["a"].dataType.simpleString()
    links = written_table(_once(links), "links")
    alone = links.where("a = b").select(F.col("a").alias("id"), F.col("a").alias("label"))
    links = links.where("a <> b")
    labels, turn = None, 0
    while not links.isEmpty():
        moves = written_table(_neighbours(links, turn), "components-moves")
        if labels is None:
            labels = moves.select("id", F.col("next").alias("label"))
        else:
            # Labels that no link holds any more stay.
            step = moves.select(F.col("id").alias("label"), "next")
            labels = written_table(
                labels.join(step, "label", "left").select("id", F.coalesce("next", "label").alias("label")), "components-labels"
            )
        for end in ("a", "b"):
            links = links.join(moves.select(F.col("id").alias(end), F.col("next").alias(f"next_{end}")), end)
        moved = links.select(F.col("next_a").alias("a"), F.col("next_b").alias("b"))
        links = written_table(_once(moved.where("a <> b")), "links")
        turn += 1
    if labels is None:
        return alone
    labels = labels.unionByName(alone.join(labels.select("id"), "id", "left_anti"))
    named = written_table(labels.groupBy("label").agg(F.min("id").alias("smallest")), "components-named")
    return labels.join(named, "label").select("id", F.col("smallest").cast(id_type).alias("label"))
