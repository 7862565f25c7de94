"""Ordering helpers: top rows per key, pages, and exact positions of a big table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.session import enable_checkpoints


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows of every key.

    The filter on ``row_number`` becomes a WindowGroupLimit below the shuffle: each
    map task ships ``n`` rows of a key at most, so a hot key stays small.
    """
    rank = rank_col or "_rank"
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = numbered.where(F.col(rank) <= n)
    return kept if rank_col else kept.drop(rank)


def total_order(df: DataFrame, first: Sequence[str] = ()) -> list[Column]:
    """Ascending order over all columns, ``first`` ones leading, so that the
    survivor of a dedupe does not depend on the partitioning. Maps sort as JSON."""
    types = dict(df.dtypes)
    names = [*first, *[name for name in df.columns if name not in first]]
    return [
        (F.to_json(name) if types[name].startswith("map") else F.col(name)).asc_nulls_last()
        for name in names
    ]


def left_join_spread(left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread: str) -> DataFrame:
    """Left join on one key; rows without a key, which match nothing, are dealt by ``spread``
    instead of meeting in one task."""
    salt = F.when(F.col(left_key).isNull(), F.xxhash64(spread)).otherwise(F.lit(0))
    # Always 0, but not for the optimiser, which would take the salt out of the shuffle.
    zero = F.pmod(F.xxhash64(right_key), F.lit(1))
    joined = left.withColumn("_salt", salt).join(
        right.withColumn("_zero", zero), (F.col(left_key) == F.col(right_key)) & (F.col("_salt") == F.col("_zero")), "left"
    )
    return joined.drop("_salt", "_zero")


def paged(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0,
          with_total: bool = True) -> DataFrame:
    """One page in the given (total) order, with the size of the whole result.

    The page is a distributed top-k; the total is a scalar subquery, a plain
    partial count next to it. The count is a second scan: later pages can leave it out.
    """
    if limit < 1 or offset < 0:
        raise ValueError("limit must be positive and offset not negative")
    page = df.orderBy(*order).offset(offset).limit(limit)
    if not with_total:
        return page
    return page.withColumn("total", df.select(F.count("*").alias("total")).scalar())


def with_positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   position: str = "position") -> DataFrame:
    """Exact 1-based position of every row within its key.

    A ``row_number`` window would put all rows of a key into one task. Here one
    range-partitioned sort spreads a key over many tasks; positions come from the row
    number inside the sorted partition plus the sizes of the key's earlier partitions
    (one row per partition and key, a tiny table). The sorted rows are checkpointed,
    because both branches must see the same partitioning, also after a lost executor.
    """
    enable_checkpoints(df.sparkSession)
    # Upper 31 bits: partition; lower 33 bits: row within the partition.
    ordered = (
        df.orderBy(*keys, *order)
        .withColumn("_row", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_row", 33))
    )
    runs = ordered.groupBy(*keys, "_part").agg(
        F.min("_row").alias("_first"), F.count("*").alias("_size")
    )
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        *keys, "_part", "_first",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
    )
    # NULL is a key like any other.
    offsets = offsets.select(*[F.col(key).alias(f"_of_{key}") for key in keys], F.col("_part").alias("_of"), "_first", "_before")
    same = F.col("_part") == F.col("_of")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    return ordered.join(offsets, same).select(
        *df.columns, (F.col("_row") - F.col("_first") + F.col("_before") + 1).cast("long").alias(position)
    )


def first_free_positions(taken: DataFrame, owners: DataFrame, keys: Sequence[str], n: int,
                         block: int = 1 << 14) -> DataFrame:
    """For every owner its first ``n`` positions not taken: rows (keys, position).

    ``taken`` has distinct (keys, position) rows, ``owners`` distinct keys. With the
    taken positions in order, ``position - nth`` counts the free ones before the nth
    taken one, so the j-th free position is j plus the number of taken ones with fewer
    than j free ones before them.

    An owner may have taken almost everything. Positions are therefore numbered in blocks: per-block counts give the number before each
    block, only blocks that can still hold one of the first ``n`` free positions are
    looked into, and no window group exceeds ``block`` rows.
    """
    keys = list(keys)
    marks = _numbered_in_blocks(taken.select(*keys, "position"), keys, n, block)
    # At most n groups per owner.
    steps = (
        marks.withColumn("_free", F.col("position") - F.col("_nth"))
        .where(F.col("_free") < n)
        .groupBy(*keys, "_free").agg(F.count("*").alias("_count"))
        .groupBy(*keys).agg(F.collect_list(F.struct("_free", "_count")).alias("_steps"))
    )

    def jth(j: Column) -> Column:
        before = F.filter("_steps", lambda step: step["_free"] < j)
        passed = F.aggregate(before, F.lit(0).cast("long"), lambda total, step: total + step["_count"])
        return j + F.coalesce(passed, F.lit(0))

    first = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda j: jth(j.cast("long")))
    return owners.join(steps, keys, "left").select(*keys, F.explode(first).alias("position"))


def _numbered_in_blocks(taken: DataFrame, keys: list[str], n: int, block: int) -> DataFrame:
    # One explicit shuffle that both the block sizes and the rows read.
    blocked = taken.withColumn(
        "_block", F.floor((F.col("position") - 1) / block).cast("long")
    ).repartition(*keys, "_block")
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        blocked.groupBy(*keys, "_block")
        .agg(F.count("*").alias("_size"), F.min("position").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .where(F.col("_first") - 1 - F.col("_before") < n)
        .select(*keys, "_block", "_before")
    )
    in_block = Window.partitionBy(*keys, "_block").orderBy("position")
    return blocked.join(blocks, [*keys, "_block"]).select(
        *keys, "position", (F.row_number().over(in_block) + F.col("_before")).alias("_nth")
    )
