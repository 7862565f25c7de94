"""A bounded Bloom filter of ids, to drop most other rows before a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.shipping import ship_package

BITS_PER_ID, LEAST_BITS = 16, 1 << 16
#: The broadcast filter: at most 16 MB. With more ids it lets more rows pass, which the join after it drops.
MOST_BITS = 1 << 27


def _places(key: Column, bits: int) -> Column:
    """Two bits per id."""
    value = F.xxhash64(key)
    return F.array(value.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(value, 34).bitwiseAND(F.lit(bits - 1)))


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """The filter's words of 64 bits."""
    count = ids.select(F.count(column).alias("n")).first()["n"]
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (int(count) * BITS_PER_ID).bit_length()))
    one = F.lit(1).cast("long")
    rows = ids.select(F.explode(_places(F.col(column), bits)).alias("place")).select(
        F.shiftright("place", 6).alias("word"), F.call_function("shiftleft", one, F.col("place").bitwiseAND(F.lit(63)).cast("int")).alias("bit")
    )
    words = np.zeros(bits // 64, np.int64)
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most one row per word
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words


def possible_members(rows: DataFrame, column: str, words: np.ndarray) -> DataFrame:
    """The rows whose id may be in the filter: all that are, and few others."""
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            places = np.array(batch.column("_places").to_pylist(), np.int64).reshape(-1, 2)
            hit = (bits[places >> 6] >> (places & 63) & 1).astype(bool).all(axis=1)
            yield batch.select(names).filter(pa.array(hit))

    names = rows.columns
    return rows.withColumn("_places", _places(F.col(column), len(words) * 64)).mapInArrow(run, rows.schema)
