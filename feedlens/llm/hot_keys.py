"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot with more than one thousandth of all counted rows, so there are fewer than a thousand.
HOT_SHARE = 1000


def join_split_hot(rows: DataFrame, keyed: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``rows`` to the unique keys of ``keyed``, whose ``count`` is their number of rows.

    The rows of hot keys meet a broadcast of these few keys where they are; the others are
    joined by shuffle, where no key has more than a small share. Both frames should be tables.
    """
    total = keyed.agg(F.coalesce(F.sum(count), F.lit(0)).alias("n")).first()["n"]
    hot = F.broadcast(keyed.where(F.col(count) * HOT_SHARE > total))
    cold = keyed.where(F.col(count) * HOT_SHARE <= total)
    return rows.join(hot, key).unionByName(
        rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    )
