"""Deep pages by a rank index: rows sorted into ranges, and each range's place in the order.

``ranked`` holds the rows, sorted, in one folder per range of about ``rows_per_range`` rows; ``bounds`` has one row
per range (and per key of a keyed index) with its first and last place in the order, its rows and the rows before it. A
page is found in the bounds and read from the one or two ranges that hold it, however deep it lies; a page after a given
row is found by that row alone, so rows that are added before it do not shift it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.operators.content import NEWEST_FIRST
from feedlens.session import run_folder, written_table

ROWS_PER_RANGE = 1 << 17


@dataclass(frozen=True)
class RankIndex:
    """``ranked``: all rows with ``_range``; ``bounds``: ``_range, *keys, first, last, rows, before``."""

    ranked: DataFrame
    bounds: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]


def _descending(names: Sequence[str]) -> list[Column]:
    """Newest first, NULL last."""
    return [F.desc_nulls_last(name) for name in names]


def _place(names: Sequence[str], values: Sequence[Column] | None = None) -> Column:
    """A row's place as a struct that ascends where the order descends: NULL, the last, is the lowest and compares as such."""
    values = values if values is not None else [F.col(name) for name in names]
    return F.struct(*[F.struct(value.isNotNull().alias("known"), value.alias("value")).alias(name) for name, value in zip(names, values, strict=True)])


def rank_index(rows: DataFrame, keys: Sequence[str] = (), order: Sequence[str] = NEWEST_FIRST,
               rows_per_range: int = ROWS_PER_RANGE) -> RankIndex:
    """Sort ``rows`` by ``keys`` and then newest first, once, into ranges.

    ``order`` must be total among a key's rows (here the article id decides ties). The sort is by ranges, so a key with a third of the rows
    is cut like any other; the bounds are one row per range and key.
    """
    spark = rows.sparkSession
    sort = [*[F.asc(key) for key in keys], *_descending(order)]
    count = rows.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    ranges = max(1, math.ceil(count / rows_per_range))
    ranged = rows.repartitionByRange(ranges, *sort).sortWithinPartitions(*sort)
    path = run_folder(spark, "rank-index")
    ranged.withColumn("_range", F.spark_partition_id()).write.partitionBy("_range").parquet(path)
    schema = rows.select("*", F.lit(0).alias("_range")).schema
    ranked = spark.read.schema(schema).parquet(path)
    runs = ranked.groupBy("_range", *keys).agg(
        F.max(_place(order)).alias("first"), F.min(_place(order)).alias("last"), F.count(F.lit(1)).alias("rows")
    )
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bounds = runs.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    return RankIndex(ranked, written_table(bounds, "rank-bounds"), tuple(keys), tuple(order))


def _of_key(rows: DataFrame, keys: Sequence[str], key: Sequence) -> DataFrame:
    for name, value in zip(keys, key, strict=True):
        rows = rows.where(F.col(name).eqNullSafe(F.lit(value)))
    return rows


def _read(index: RankIndex, ranges: list, key: Sequence) -> DataFrame:
    """The rows of some ranges; the others' folders are not opened."""
    rows = index.ranked.where(F.col("_range").isin([row["_range"] for row in ranges]))
    return _of_key(rows, index.keys, key)


def page_at(index: RankIndex, limit: int = 20, offset: int = 0, key: Sequence = (), with_total: bool = True) -> DataFrame:
    """The page from the ``offset``-th row on, from the ranges that hold it; with the number of all rows of the key."""
    if limit < 1 or offset < 0:
        raise ValueError("limit must be positive and offset not negative")
    bounds = _of_key(index.bounds, index.keys, key)
    # As many rows as the page has ranges.
    hit = bounds.where((F.col("before") < offset + limit) & (F.col("before") + F.col("rows") > offset)).orderBy("_range").collect()
    skip = offset - hit[0]["before"] if hit else 0
    rows = _read(index, hit, key).orderBy(*_descending(index.order)).offset(skip).limit(limit).drop("_range")
    if not with_total:
        return rows
    total = bounds.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    return rows.withColumn("total", F.lit(total).cast("long"))


def page_after(index: RankIndex, last: Sequence, limit: int = 20, key: Sequence = ()) -> DataFrame:
    """The page after the row whose ``order`` values are ``last``, which need not be there any more."""
    if limit < 1:
        raise ValueError("limit must be positive")
    types = [index.ranked.schema[name].dataType for name in index.order]
    place = _place(index.order, [F.lit(value).cast(kind) for value, kind in zip(last, types, strict=True)])
    bounds = _of_key(index.bounds, index.keys, key)
    behind = bounds.where(F.col("last") < place)
    # The first range may hold the row itself and all before it; those after it are needed until the page is full.
    first = behind.orderBy("_range").limit(1)
    start = first.first()
    if start is None:
        return index.ranked.limit(0).drop("_range")
    needed = start["before"] + start["rows"] + limit
    ranges = bounds.where((F.col("_range") >= start["_range"]) & (F.col("before") < needed)).select("_range").collect()
    rows = _read(index, ranges, key).where(_place(index.order) < place)
    return rows.orderBy(*_descending(index.order)).limit(limit).drop("_range")
