"""Implicit-feedback ALS where some users have read whole groups of articles, which is not written out.

A reader (``user_id, open``) has read every article but those of the groups in ``open``, each with rating 1, and what ``ratings`` adds.
Readers with the same ``open`` are a class. Users and articles with rows in ``ratings`` have factors of their own; the
other readers of a class have equal equations, and so equal factors, as have the other articles of a group. A half-step
adds up the rows of ``ratings`` per user or article and, for what is not written out, the sums of outer products per group or class. So its
work grows with ``ratings``, users and articles, not with readers times articles.

The equations are those of ``pyspark.ml.recommendation.ALS`` with implicit preferences and non-negative factors; only the first factors are drawn otherwise.
Groups and classes are taken to be few: sums per group and class are held by the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.operators.inner_product import top_by_inner_product
from feedlens.operators.ranking import top_per_key
from feedlens.operators.recommend import RecommendationSettings
from feedlens.session import written_table
from feedlens.shipping import ship_package

#: Sweeps over the coordinates, and the relative change at which they end.
SWEEPS, STILL = 300, 1e-7
_SOLVED = "id long, part int, factors array<double>"


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The non-negative minimisers of ``x a x / 2 - b x``, by coordinate descent over all rows at once."""
    x = np.zeros_like(b)
    diagonal = np.einsum("nii->ni", a)
    for _ in range(SWEEPS):
        moved = 0.0
        for place in range(b.shape[1]):
            slope = np.einsum("ni,ni->n", a[:, place], x) - b[:, place]
            new = np.maximum(0.0, x[:, place] - slope / np.maximum(diagonal[:, place], 1e-300))
            moved = max(moved, float(np.abs(new - x[:, place]).max(initial=0.0)))
            x[:, place] = new
        if moved <= STILL * max(float(np.abs(x).max(initial=0.0)), 1e-300):
            break
    return x


class Sums:
    """Number, sum and outer products of the factors of one side: per part (a group of articles or a class of users), and of all."""

    def __init__(self, parts: int, rank: int) -> None:
        self.n, self.s, self.g = np.zeros(parts), np.zeros((parts, rank)), np.zeros((parts, rank, rank))
        self.all = np.zeros((rank, rank))

    def add(self, part: int, n: float, s: np.ndarray, g: np.ndarray) -> None:
        self.all += g
        if part >= 0:
            self.n[part] += n
            self.s[part] += s
            self.g[part] += g

    def equation(self, whole: np.ndarray, settings) -> tuple[np.ndarray, np.ndarray]:
        """Both sides of the equations of one who has all of the parts ``whole`` with rating 1."""
        rank = len(self.all)
        return (
            self.all + settings.alpha * self.g[whole].sum(axis=0) + settings.reg_param * self.n[whole].sum() * np.eye(rank),
            (1 + settings.alpha) * self.s[whole].sum(axis=0),
        )


def _solver(bases: dict[int, tuple[np.ndarray, np.ndarray]], reg_param: float):
    """Rows ``id, part, c, w, k, factors`` in the order of id to each id's factors; ``bases`` by part are what is not written out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None  # id, part and sums of the last one, which may go on

        def solved(ids, parts, a, b, k):
            base_a = np.stack([bases[part][0] for part in parts.tolist()])
            base_b = np.stack([bases[part][1] for part in parts.tolist()])
            x = solve(a + base_a + reg_param * k[:, None, None] * np.eye(b.shape[1]), b + base_b)
            return pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "part": pa.array(parts, pa.int32()),
                                               "factors": pa.array(x.tolist(), pa.list_(pa.float64()))})

        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                ids, parts, c, w, k = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("id", "part", "c", "w", "k"))
                y = batch.column("factors").flatten().to_numpy().reshape(len(ids), -1)
                starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
                a = np.add.reduceat(c[:, None, None] * y[:, :, None] * y[:, None, :], starts)
                b, k = np.add.reduceat(w[:, None] * y, starts), np.add.reduceat(k, starts)
                ids, parts = ids[starts], parts[starts]
                if left is not None:
                    if left[0][0] == ids[0]:
                        a[0], b[0], k[0] = a[0] + left[2][0], b[0] + left[3][0], k[0] + left[4][0]
                    else:
                        yield solved(*left)
                if len(ids) > 1:
                    yield solved(ids[:-1], parts[:-1], a[:-1], b[:-1], k[:-1])
                left = ids[-1:], parts[-1:], a[-1:], b[-1:], k[-1:]
        if left is not None:
            yield solved(*left)

    return run


def _part_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list] = {}
    for batch in batches:
        parts = batch.column("part").to_numpy(zero_copy_only=False)
        for part in np.unique(parts).tolist():
            y = batch.filter(pa.array(parts == part)).column("factors").flatten().to_numpy().reshape(int((parts == part).sum()), -1)
            own = total.setdefault(part, [0, 0.0, 0.0])
            own[0], own[1], own[2] = own[0] + len(y), own[1] + y.sum(axis=0), own[2] + y.T @ y
    yield pa.RecordBatch.from_pydict({
        "part": pa.array(list(total), pa.int32()), "n": pa.array([own[0] for own in total.values()], pa.int64()),
        "s": pa.array([own[1].tolist() for own in total.values()], pa.list_(pa.float64())),
        "g": pa.array([own[2].ravel().tolist() for own in total.values()], pa.list_(pa.float64())),
    })


def _summed(factors: DataFrame, parts: int, rank: int, counts: np.ndarray, shared: np.ndarray) -> Sums:
    sums = Sums(parts, rank)
    for row in factors.mapInArrow(_part_sums, "part int, n long, s array<double>, g array<double>").collect():
        sums.add(row["part"], row["n"], np.array(row["s"]), np.array(row["g"]).reshape(rank, rank))
    for part, (count, own) in enumerate(zip(counts, shared, strict=True)):
        sums.add(part, count, count * own, count * np.outer(own, own))
    return sums


def _first_factors(rank: int, seed: int):
    """Non-negative vectors of length 1, by hash of the id."""
    values = [F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(place)), F.lit(1 << 20)).cast("double") + 1 for place in range(rank)]
    length = F.sqrt(sum((value * value for value in values), F.lit(0.0)))
    return F.array(*[value / length for value in values])


def grouped_model(pairs: DataFrame, away: np.ndarray, plain_users: np.ndarray, plain_items: np.ndarray, settings: RecommendationSettings):
    """Factors of users and articles of their own, and those shared per class and per group.

    ``pairs``: ``user_id, class, article_id, group, rating, both`` (a reader's article of a group that is not open); class -1 is no reader.
    ``away[class, group]``: whether the class has read the group. ``plain_*``: how many have no rows in ``pairs``, per class and group.
    """
    spark, rank = pairs.sparkSession, settings.rank
    ship_package(spark)
    spread = spark.sparkContext.defaultParallelism * 2
    alpha = settings.alpha
    # A rating of 1 is in the sums already.
    weighed = written_table(pairs.select(
        "user_id", "class", "article_id", "group", (alpha * (F.col("rating") - F.col("both").cast("double"))).alias("c"),
        F.when(F.col("both"), alpha * (F.col("rating") - 1.0)).otherwise(1.0 + alpha * F.col("rating")).alias("w"),
        (~F.col("both")).cast("double").alias("k"),
    ), "als-pairs")
    classes, groups = away.shape
    users = written_table(weighed.select(F.col("user_id").alias("id"), F.col("class").cast("int").alias("part")).distinct().select(
        "id", "part", _first_factors(rank, settings.seed).alias("factors")), "als-factors")
    shared_users = np.random.default_rng(settings.seed).random((classes, rank)) + 1e-6
    shared_users /= np.linalg.norm(shared_users, axis=1, keepdims=True)
    none = np.zeros(0, np.int64)

    def half(key: str, part: str, other: str, factors: DataFrame, sums: Sums, whole: np.ndarray) -> tuple[DataFrame, np.ndarray]:
        bases = {number: sums.equation(np.flatnonzero(row), settings) for number, row in enumerate(whole)}
        bases[-1] = sums.equation(none, settings)
        rows = weighed.join(factors.select(F.col("id").alias(other), "factors"), other).select(
            F.col(key).alias("id"), F.col(part).cast("int").alias("part"), "c", "w", "k", "factors")
        found = rows.repartition(spread, "id").sortWithinPartitions("id").mapInArrow(_solver(bases, settings.reg_param), _SOLVED)
        shared = np.array([solve(bases[number][0][None], bases[number][1][None])[0] for number in range(len(whole))]).reshape(-1, rank)
        return written_table(found, "als-factors"), shared

    for _ in range(settings.max_iter):
        sums = _summed(users, classes, rank, plain_users, shared_users)
        items, shared_items = half("article_id", "group", "user_id", users, sums, away.T)
        sums = _summed(items, groups, rank, plain_items, shared_items)
        users, shared_users = half("user_id", "class", "article_id", items, sums, away)
    return users, items, shared_users, shared_items


def grouped_candidates(ratings: DataFrame, eligible: DataFrame, articles: DataFrame, settings: RecommendationSettings,
                       readers: DataFrame) -> DataFrame:
    """What ``als_candidates`` lists, with the reading of ``readers`` not written out. ``articles``: ``article_id, group`` (from 0)."""
    spark = ratings.sparkSession
    groups = articles.agg(F.max("group").alias("n")).first()["n"]
    groups = 0 if groups is None else int(groups) + 1
    opened = readers.select("user_id", F.array_sort("open").alias("open"))
    sets = [row["open"] for row in opened.select("open").distinct().orderBy("open").collect()]
    away = np.ones((len(sets), groups), bool)
    for number, own in enumerate(sets):
        away[number, [group for group in own if group < groups]] = False
    numbers = spark.createDataFrame(list(enumerate(sets)), "class int, open array<bigint>")
    classed = written_table(opened.join(F.broadcast(numbers), "open").select("user_id", "class", "open"), "reader-classes")
    pairs = written_table(
        ratings.join(articles.select("article_id", "group"), "article_id").join(classed, "user_id", "left").select(
            "user_id", F.coalesce("class", F.lit(-1)).alias("class"), "article_id", "group", F.col("rating").cast("double").alias("rating"),
            F.coalesce(~F.array_contains("open", F.col("group")), F.lit(False)).alias("both"),
        ).withColumn("rating", F.when(F.col("both"), F.greatest("rating", F.lit(1.0))).otherwise(F.col("rating"))), "als-ratings")

    def counts(df: DataFrame, part: str, size: int) -> np.ndarray:
        found = np.zeros(size)
        for row in df.groupBy(part).count().collect():
            found[row[part]] = row["count"]
        return found

    plain_readers = written_table(classed.join(pairs, "user_id", "left_anti").select("user_id", "class"), "plain-readers")
    plain = written_table(articles.select("article_id", "group").join(pairs, "article_id", "left_anti"), "plain-articles")
    # An article that nobody has read has no factors.
    read_by = away.T @ counts(classed, "class", len(sets)) > 0
    plain_items = counts(plain, "group", groups) * read_by
    users, items, shared_users, shared_items = grouped_model(pairs, away, counts(plain_readers, "class", len(sets)), plain_items, settings)
    # The rest of a group have one vector and no reader of their own, so only the first can be among anybody's best.
    first = top_per_key(plain, ["group"], [F.asc("article_id")], settings.top_n)
    shared = spark.createDataFrame([(group, own.tolist()) for group, own in enumerate(shared_items) if read_by[group]], "group long, features array<double>")
    things = written_table(items.select(F.col("id").alias("article_id"), F.col("part").cast("long").alias("group"), F.col("factors").alias("features")).unionByName(
        first.select("article_id", F.col("group").cast("long").alias("group")).join(F.broadcast(shared), "group")), "als-items")
    served = users.join(eligible.select(F.col("user_id").alias("id")), "id", "left_semi")
    people = written_table(served.select(F.col("id").alias("user_id"), "part", F.col("factors").alias("features")), "als-users")
    read = pairs.select("user_id", "article_id")
    lists = top_by_inner_product(people.where("part = -1").drop("part"), things.drop("group"), read, settings.top_n)
    for number, own in enumerate(sets):
        left = things.where(F.col("group").isin(own)).drop("group")
        lists = lists.unionByName(top_by_inner_product(
            people.where(F.col("part") == number).drop("part"), left, read.join(classed.where(F.col("class") == number), "user_id", "left_semi"), settings.top_n))
        # All others of the class have one list.
        one = spark.createDataFrame([(0, shared_users[number].tolist())], "user_id long, features array<double>")
        same = top_by_inner_product(one, left, read.limit(0), settings.top_n).drop("user_id")
        members = plain_readers.where(F.col("class") == number).join(eligible, "user_id", "left_semi").select("user_id")
        lists = lists.unionByName(members.crossJoin(F.broadcast(same)))
    return lists.select(
        "user_id", "article_id", "score", F.lit(S.REASON_ALS).alias("reason"),
        F.lit(settings.model_version).alias("model_version"), F.lit(S.PRIORITY_ALS).alias("source_priority"),
    )
