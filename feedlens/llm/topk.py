"""Exact top-k inner products by a dual walk over cover trees.

Vectors are the whole numbers floor(64 x). Equal vectors are one point with the smallest ids
that a list can need, so no hot vector is searched or gathered more than once.

Queries go in blocks of bounded size. A block's cover tree is broadcast; each task builds the cover trees of
its own points and walks both trees together. A pair of nodes is pruned if the
largest inner product that the two covering radii allow is below the worst k-th score of
the node's queries. That score starts at a bound from a few points scored before, so tasks send little
that cannot win. The tasks' lists are merged by query. An id with several vectors is a point of each of them under
its own name, of which a list holds the best alone.

Scores are exact: products are summed in floating point only where every sum is a whole number below 2^53.

Defined results: vectors that are NULL or hold a NULL or non-finite component take no part, nor do rows without an id;
shorter vectors count as padded with zeros; rows with the query's own id are no candidates; repeated rows of an id
and vector are one; several vectors of one query id share one list, the best of them; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.shipping import ship_package
from feedlens.session import written_table

TOP, EVERY, SCALE = 20, 20, 64
#: Queries in one broadcast, and points whose scores give the first bounds.
QUERY_BLOCK, SEEDS = 8192, 2048
#: Points in one cover tree of a task, and in a leaf.
TREE, LEAF = 16_384, 64
#: Queries in a leaf: few, so that its worst score says much.
QUERY_LEAF = 16
FANOUT = 8
#: Children whose radii are not below this share of their parent's prune nothing that it does not: the node stays a leaf.
LEAST_GAIN = 0.95
#: Queries and points of one product in a leaf.
PRODUCT = (1024, 4096)


@dataclass
class Node:
    """A ball: its center, covering radius and points; children cover the same points closer."""

    center: np.ndarray
    radius: float
    rows: np.ndarray
    children: list[Node]


def cover_tree(points: np.ndarray, rows: np.ndarray | None = None, leaf: int = LEAF) -> Node:
    """Nested covers: each node's points go to the nearest of a few of them that lie far apart."""
    rows = np.arange(len(points)) if rows is None else rows
    own = points[rows]
    center = own.mean(axis=0) if len(rows) else np.zeros(points.shape[1])
    # A little more than computed, for the rounding of the norms.
    radius = float(np.sqrt(((own - center) ** 2).sum(axis=1).max(initial=0.0))) * (1 + 1e-9) + 1e-9
    if len(rows) <= leaf or radius <= 1e-6:
        return Node(center, radius, rows, [])
    apart, chosen, nearest = np.full(len(rows), np.inf), [], np.zeros(len(rows), int)
    far = int(((own - center) ** 2).sum(axis=1).argmax())
    for number in range(FANOUT):
        distance = ((own - own[far]) ** 2).sum(axis=1)
        closer = distance < apart
        apart, nearest = np.where(closer, distance, apart), np.where(closer, number, nearest)
        chosen.append(far)
        far = int(apart.argmax())
    parts = [rows[nearest == number] for number in range(len(chosen))]
    parts = [part for part in parts if len(part)]
    if len(parts) < 2 or sum(len(part) * _spread(points[part]) for part in parts) > LEAST_GAIN * radius * len(rows):
        return Node(center, radius, rows, [])
    return Node(center, radius, rows, [cover_tree(points, part, leaf) for part in parts])


def _spread(own: np.ndarray) -> float:
    """The radius of points about their mean."""
    return float(np.sqrt(((own - own.mean(axis=0)) ** 2).sum(axis=1).max()))


def _most(query: Node, point: Node) -> float:
    """No pair of the two nodes has a larger inner product."""
    sizes = np.linalg.norm(query.center) * point.radius + np.linalg.norm(point.center) * query.radius
    return (float(query.center @ point.center) + sizes + query.radius * point.radius) + 1e-6 * (1 + sizes)


def _share(fixed: Node, open_: Node) -> float:
    """What the second node's radius adds to the largest inner product."""
    return float(np.linalg.norm(fixed.center)) * open_.radius


class Best:
    """Each query's k best scores so far, and the bound that a candidate must reach."""

    def __init__(self, bounds: np.ndarray, top: int) -> None:
        self.top, self.bounds = top, bounds.copy()
        self.scores: list[np.ndarray] = [np.zeros(0, np.int64)] * len(bounds)
        self.points: list[np.ndarray] = [np.zeros(0, np.int64)] * len(bounds)
        #: By point number: its name, if points may share one; of these only the best counts.
        self.names: np.ndarray | None = None

    def offer(self, query: int, scores: np.ndarray, points: np.ndarray) -> None:
        use = scores >= self.bounds[query]
        if not use.any():
            return
        scores, points = np.concatenate([self.scores[query], scores[use]]), np.concatenate([self.points[query], points[use]])
        if self.names is not None:
            order = np.lexsort((-scores, self.names[points]))
            first = order[np.unique(self.names[points[order]], return_index=True)[1]]
            scores, points = scores[first], points[first]
        if len(scores) >= self.top:
            # All points that tie with the k-th stay: ids decide later.
            limit = np.partition(scores, len(scores) - self.top)[len(scores) - self.top]
            use = scores >= limit
            scores, points = scores[use], points[use]
            self.bounds[query] = max(self.bounds[query], limit)
        self.scores[query], self.points[query] = scores, points


def exact_pair(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number rows in floating point, if all sums of their products stay exact in it, or as they are."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    return (left.astype(float), right.astype(float)) if most < 2**53 else (left, right)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left @ right.T


def _offer_leaves(left: np.ndarray, right: np.ndarray, query_rows: np.ndarray, point_rows: np.ndarray, best: Best, offset: int) -> None:
    """All pairs of two leaves, in products of bounded size."""
    for first in range(0, len(point_rows), PRODUCT[1]):
        own = point_rows[first:first + PRODUCT[1]]
        for start in range(0, len(query_rows), PRODUCT[0]):
            asked = query_rows[start:start + PRODUCT[0]]
            scores = products(left[asked], right[own])
            reached = scores >= best.bounds[asked][:, None]
            for row in np.flatnonzero(reached.any(axis=1)):
                best.offer(int(asked[row]), scores[row, reached[row]].astype(np.int64), own[reached[row]] + offset)


def dual_search(queries: np.ndarray, query_tree: Node, points: np.ndarray, best: Best, offset: int = 0) -> None:
    """Offers ``best`` every point that may be among a query's k best; point numbers start at ``offset``."""
    left, right = exact_pair(queries, points)
    stack = [(query_tree, cover_tree(points.astype(float)))]
    while stack:
        query, point = stack.pop()
        if not len(query.rows) or not len(point.rows) or _most(query, point) < best.bounds[query.rows].min():
            continue
        if not query.children and not point.children:
            _offer_leaves(left, right, query.rows, point.rows, best, offset)
        elif point.children and (not query.children or _share(query, point) >= _share(point, query)):
            # The most promising child last, so that it is searched first and raises the bounds.
            stack += [(query, child) for child in sorted(point.children, key=lambda child: float(query.center @ child.center))]
        else:
            stack += [(child, point) for child in query.children]


def whole_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, vector``: the rows that take part, as ``array<bigint>``."""
    values = F.transform(F.col(vector), lambda value: value.cast("double"))
    fine = F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & F.forall(
        values, lambda value: value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")))
    whole = F.transform(values, lambda value: F.floor(value * SCALE).cast("long"))
    return rows.where(F.coalesce(fine, F.lit(False))).select("vec_id", whole.alias("vector"))


def _matrix(vectors: list[list[int]], width: int) -> np.ndarray:
    matrix = np.zeros((len(vectors), width), np.int64)
    for row, vector in enumerate(vectors):
        matrix[row, :len(vector)] = vector
    return matrix


def _search(shared, top: int, shared_names: bool):
    """``query, point, score`` of each task's points that may win."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, queries, tree, bounds = shared.value
        best, names = Best(bounds, top), []
        for batch in batches:
            vectors, before = batch.column("vector").to_pylist(), len(names)
            names += batch.column("point").to_pylist()
            if shared_names:
                own = np.array(names[before:], np.int64)
                best.names = own if best.names is None else np.concatenate([best.names, own])
            for start in range(0, len(vectors), TREE):
                points = _matrix(vectors[start:start + TREE], queries.shape[1])
                dual_search(queries, tree, points, best, before + start)
        # Bounds rise while the task works; its early finds are checked against the last.
        for start in range(0, len(numbers), 512):
            rows = [
                (numbers[query], names[point], score)
                for query in range(start, min(start + 512, len(numbers)))
                for score, point in zip(best.scores[query].tolist(), best.points[query].tolist(), strict=True)
                if score >= best.bounds[query]
            ]
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], ["query", "point", "score"])

    return run


def _query_block(rows: list, width: int, seeds: np.ndarray, top: int) -> tuple:
    """What a task needs of a block: numbers, vectors, cover tree and first bounds."""
    queries = _matrix([row["vector"] for row in rows], width)
    bounds = np.full(len(rows), np.iinfo(np.int64).min)
    if len(seeds) >= top:
        left, right = exact_pair(queries, seeds)
        for start in range(0, len(left), PRODUCT[0]):
            scores = products(left[start:start + PRODUCT[0]], right)
            bounds[start:start + PRODUCT[0]] = np.partition(scores, len(seeds) - top, axis=1)[:, len(seeds) - top]
    return [row["query"] for row in rows], queries, cover_tree(queries.astype(float), leaf=QUERY_LEAF), bounds


def nearest(
    rows: DataFrame, top: int = TOP, every: int = EVERY, query_block: int = QUERY_BLOCK, seeds: int = SEEDS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best ``top`` of all other rows for each row whose id ``every`` divides."""
    spark = rows.sparkSession
    ship_package(spark)
    vectors = whole_vectors(rows).distinct()
    # A list needs one id more than its length, as one may be the query's own.
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    is_query = F.col("vec_id") % every == 0
    several = written_table(vectors.groupBy("vec_id").count().where("count > 1").select("vec_id", F.lit(True).alias("several")), "topk-several")
    shared_names = not several.isEmpty()
    ids = vectors.withColumn("at", F.row_number().over(by_vector)).where(F.col("at") <= top + 1).drop("at")
    ids = ids.join(several, "vec_id", "left") if shared_names else ids.withColumn("several", F.lit(None).cast("boolean"))
    # Ids with one vector are grouped by it; the others keep their own names.
    groups = ids.groupBy("vector", F.when(F.col("several"), F.col("vec_id")).alias("several")).agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids"))
    points = written_table(
        groups.select(F.element_at("ids", 1).alias("point"), F.xxhash64("vector").alias("place"), "vector", "ids",
                      F.col("several").isNotNull().alias("several")),
        "topk-points",
    )
    queries = vectors.where(is_query).select("vector").distinct()
    queries = written_table(queries.select(F.monotonically_increasing_id().alias("query"), F.xxhash64("vector").alias("place"), "vector"), "topk-queries")
    width, blocks = points.agg(F.max(F.size("vector"))).first()[0] or 0, -(-queries.count() // query_block)
    # Seeds are different ids' points: their k-th score is one that k ids reach.
    chosen = {row["point"]: row["vector"] for row in points.orderBy("place", "point").limit(seeds).collect()}
    sample = _matrix(list(chosen.values()), width)
    found = None
    for block in range(blocks):
        own = queries.where(F.pmod("place", F.lit(blocks)) == block).select("query", "vector")
        shared = spark.sparkContext.broadcast(_query_block(own.collect(), width, sample, top + 1))
        part = points.select("point", "vector").mapInArrow(_search(shared, top + 1, shared_names), "query long, point long, score long")
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = spark.createDataFrame([], "query long, point long, score long")
    if shared_names:
        found = found.groupBy("query", "point").agg(F.max("score").alias("score"))
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    # Points carry their smallest id, so the best top + 1 points hold the best top + 1 ids.
    best = found.withColumn("at", F.row_number().over(by_query)).where(F.col("at") <= top + 1)
    named = best.join(points.where("not several").select("point", "ids"), "point", "left").select(
        "query", "score", F.explode(F.coalesce("ids", F.array("point"))).alias("vec_id"))
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = written_table(
        named.withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= top + 1).groupBy("query").agg(
            F.array_sort(F.collect_list(F.struct("at", "vec_id", "score"))).alias("list")),
        "topk-lists",
    )
    asking = vectors.where(is_query).select(F.col("vec_id").alias("query_id"), "vector").join(
        queries.select("vector", "query"), "vector").select("query_id", "query")
    answers = asking.join(lists, "query").select("query_id", F.explode("list").alias("one")).where(F.col("query_id") != F.col("one.vec_id"))
    by_row = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = answers.groupBy("query_id", F.col("one.vec_id").alias("vec_id")).agg(F.max("one.score").alias("score"))
    return answers.withColumn("rank", F.row_number().over(by_row)).where(F.col("rank") <= top).select(
        F.col("query_id").cast("long"), "rank", F.col("vec_id").cast("long"), F.col("score").cast("long")
    )
