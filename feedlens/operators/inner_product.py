"""Exact best items by inner product, by norm-bounded blocks.

Items are ranked by the length of their vectors. No item can score more with a user than the product of their lengths (Cauchy-Schwarz), so once
a user's ``top_n``-th score is above that bound for the next block of items, no later block can matter and the user
is done. Long vectors come first, so most users are done early. Items a user has read are skipped while searching, not fetched in excess.

A round brings one group of ``GROUP`` items, a broadcast of bounded size, to the users that are not done, wherever these are;
within it tasks multiply block by block. What a user has read is sent per round, only as far as it lies in the group.
A task of a round has ``DEALT`` users or so, so its products are bounded, and more users are more tasks. (By their bytes
Spark would give them all to one.)
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.operators.ranking import with_positions
from feedlens.session import written_table
from feedlens.shipping import ship_package

#: Items in a broadcast (at 100 features some 100 MB), items in a product, users in a product.
GROUP, BLOCK, USERS = 1 << 18, 1 << 11, 1 << 10
#: Users in a task, and tasks per core where there are fewer users.
DEALT, PER_CORE = 1 << 13, 2
#: Products and lengths are rounded; a block is left out only when its bound is below the score by more.
SLACK = 1 + 1e-9

_STATE = "user_id {user_type}, features array<double>, scores array<double>, items array<long>, scored long, done boolean"


def vector_length(features: Column) -> Column:
    return F.sqrt(F.aggregate(features, F.lit(0.0), lambda total, value: total + value.cast("double") * value.cast("double")))


def _better(scores: np.ndarray, items: np.ndarray, found: np.ndarray, names: np.ndarray) -> None:
    """Put what is better of a block's products into the lists, best first, ties by the smaller item."""
    top = scores.shape[1]
    least = scores[:, -1]
    if found.shape[1] > top:
        least = np.maximum(least, np.partition(found, -top, axis=1)[:, -top])
    row, column = np.nonzero((found >= least[:, None]) & (found > -np.inf))
    old_row, old_column = np.nonzero(scores > -np.inf)
    rows = np.concatenate([old_row, row])
    values = np.concatenate([scores[old_row, old_column], found[row, column]])
    ids = np.concatenate([items[old_row, old_column], names[column]])
    order = np.lexsort((ids, -values, rows))
    rows, values, ids = rows[order], values[order], ids[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = place < top
    scores[rows[keep], place[keep]], items[rows[keep], place[keep]] = values[keep], ids[keep]


def search_group(users: np.ndarray, scores: np.ndarray, items: np.ndarray, read: list, names: np.ndarray, vectors: np.ndarray,
                 lengths: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Bring a group of items, longest first, to some users; ``read`` are the places in the group to skip. Returns products made per user."""
    own = np.sqrt((users * users).sum(axis=1))
    scored = np.zeros(len(users), np.int64)
    owner = np.repeat(np.arange(len(users)), [len(places) for places in read])
    places = np.concatenate([np.zeros(0, np.int64), *[np.asarray(places, np.int64) for places in read]])
    for start in range(0, len(names), block):
        open_ = np.flatnonzero(own * lengths[start] * SLACK >= scores[:, -1])
        if not len(open_):
            break
        stop = min(start + block, len(names))
        products = users[open_] @ vectors[start:stop].T
        scored[open_] += stop - start
        position = np.full(len(users), -1)
        position[open_] = np.arange(len(open_))
        inside = (places >= start) & (places < stop) & (position[owner] >= 0)
        products[position[owner[inside]], places[inside] - start] = -np.inf
        best, names_of = scores[open_], items[open_]
        _better(best, names_of, products, names[start:stop])
        scores[open_], items[open_] = best, names_of
    return scored


def _tasks(spark: SparkSession, users: int) -> int:
    return max(-(-users // DEALT), min(PER_CORE * spark.sparkContext.defaultParallelism, -(-users // USERS)), 1)


def _round(shared, top_n: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, vectors, lengths = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, USERS):
                part = batch.slice(at, USERS)
                users = np.array(part.column("features").to_pylist(), np.float64).reshape(part.num_rows, -1)
                scores = np.full((part.num_rows, top_n), -np.inf)
                items = np.zeros((part.num_rows, top_n), np.int64)
                for row, (values, ids) in enumerate(zip(part.column("scores").to_pylist(), part.column("items").to_pylist(), strict=True)):
                    scores[row, :len(values)], items[row, :len(ids)] = values, ids
                read = [places or () for places in part.column("read").to_pylist()]
                made = search_group(users, scores, items, read, names, vectors, lengths)
                bound = np.sqrt((users * users).sum(axis=1)) * lengths[-1] * SLACK
                have = (scores > -np.inf).sum(axis=1)
                yield pa.RecordBatch.from_pydict({
                    "user_id": part.column("user_id"), "features": part.column("features"),
                    "scores": pa.array([own[:count] for own, count in zip(scores, have, strict=True)], pa.list_(pa.float64())),
                    "items": pa.array([own[:count] for own, count in zip(items, have, strict=True)], pa.list_(pa.int64())),
                    "scored": pa.array(np.asarray(part.column("scored")) + made, pa.int64()),
                    "done": pa.array(last | (bound < scores[:, -1])),
                })

    return run


def searched(users: DataFrame, items: DataFrame, read: DataFrame, top_n: int, group: int = GROUP) -> DataFrame:
    """``user_id, scores, items, scored`` of every user: the best unread items, best first, and the number of products made.

    ``users``: ``user_id, features``; ``items``: ``article_id, features``; ``read``: pairs of both ids. Rows without
    an id or a vector take no part.
    """
    spark = users.sparkSession
    ship_package(spark)
    user_type = users.schema["user_id"].dataType.simpleString()
    vectors = items.dropna(subset=["article_id", "features"]).select(
        F.col("article_id").cast("long").alias("article_id"), F.col("features").cast("array<double>").alias("features")
    ).withColumn("length", vector_length(F.col("features")))
    ranked = with_positions(vectors, [], [F.desc("length"), F.asc("article_id")], "place").withColumn("place", F.col("place") - 1)
    ranked = written_table(ranked.withColumn("group", F.expr(f"place div {group}")), "ranked-items")
    where = ranked.select("article_id", "group", (F.col("place") % group).alias("place"))
    skipped = written_table(
        read.select("user_id", F.col("article_id").cast("long").alias("article_id")).join(where, "article_id")
        .groupBy("user_id", "group").agg(F.collect_set("place").alias("read")),
        "read-places",
    )
    start = users.dropna(subset=["user_id", "features"]).select(
        "user_id", F.col("features").cast("array<double>").alias("features"), F.array().cast("array<double>").alias("scores"),
        F.array().cast("array<bigint>").alias("items"), F.lit(0).cast("long").alias("scored"),
    )
    active, results, number = start, [], 0
    count, left = ranked.count(), start.count()
    if not count:
        return start.select("user_id", "scores", "items", "scored")
    while True:
        rows = ranked.where(F.col("group") == number).orderBy("place").select("article_id", "features", "length").toArrow()  # ``group`` rows
        matrix = np.array(rows.column("features").to_pylist(), np.float64).reshape(rows.num_rows, -1)
        shared = spark.sparkContext.broadcast((rows.column("article_id").to_numpy(), matrix, rows.column("length").to_numpy()))
        last = (number + 1) * group >= count
        joined = active.join(skipped.where(F.col("group") == number).select("user_id", "read"), "user_id", "left")
        state = written_table(
            joined.select("user_id", "features", "scores", "items", "scored", "read").repartition(_tasks(spark, left), "user_id").mapInArrow(
                _round(shared, top_n, last), _STATE.format(user_type=user_type)
            ),
            "search-round",
        )
        shared.destroy()
        results.append(state.where("done"))
        active = state.where("not done").drop("done")
        number += 1
        if last:
            break
        left = active.count()
        if not left:
            break
    return reduce(DataFrame.unionByName, results).select("user_id", "scores", "items", "scored")


def top_by_inner_product(users: DataFrame, items: DataFrame, read: DataFrame, top_n: int, group: int = GROUP) -> DataFrame:
    """``user_id, article_id, score`` of the best ``top_n`` unread items of every user, ties to the smaller article_id."""
    lists = searched(users, items, read, top_n, group)
    return lists.select("user_id", F.inline(F.arrays_zip("items", "scores"))).select(
        "user_id", F.col("items").alias("article_id"), F.col("scores").alias("score")
    )
