"""Removal of lines that many documents repeat, by two Bloom filters.

Pass 1: every task hashes its line keys into two filters, for keys seen once and for keys seen
twice. The filters are cut into segments of 65,536 bits; a task sends only the set bits of a segment, and a
segment's tasks are merged by one group: a bit set by two tasks is a twice-seen bit. So the
twice filter holds every repeated key (and few others), and no task or group holds more than its segment.

Pass 2: only keys in the twice filter go on, as 128-bit digests with their doc_id; grouping them confirms
which are in enough documents and chooses the document that keeps the line. Pass 3 shuffles the texts of documents
with suspected lines alone, to meet their own list of lines to drop.

The filter has 16 bits per line up to a fixed most, so its broadcast is bounded. Beyond that more keys are
suspected and confirmed, with the same result.

Defined results: NULL and empty texts are one empty line; repeated rows of a doc_id count as one document and
are treated alike; rows without a doc_id count as one document that is never the largest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.arrow import text_bytes
from feedlens.llm.hot_keys import join_split_hot
from feedlens.llm.shipping import ship_package
from feedlens.session import written_table

LEAST_CHARS, LEAST_DOCUMENTS = 40, 5
SEGMENT = 1 << 16
BITS_PER_LINE = 16
#: The broadcast filter: at most 64 MB.
MOST_BITS = 1 << 29


def _key(line: bytes, least: int) -> bytes | None:
    """The line's key, or None if it is too short to be dropped."""
    key = line.strip(b" \t\n\v\f\r").lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return key


def _keys(text: bytes, least: int) -> set[bytes]:
    return {key for line in text.split(b"\n") if len(line) >= least and (key := _key(line, least)) is not None}


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two bits per key."""
    mask = np.uint64(bits - 1)
    return np.stack([hashes & mask, (hashes >> np.uint64(34)) & mask])


def _partial_filters(least: int, bits: int):
    """Per task and segment: the bits of its keys, and of its keys in two documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = [
            np.fromiter((xxhash.xxh3_64_intdigest(key) for text in text_bytes(batch) for key in _keys(text, least)), np.uint64)
            for batch in batches
        ]
        if not hashes:
            return
        keys, counts = np.unique(np.concatenate(hashes), return_counts=True)
        once = np.unique(_places(keys, bits))
        twice = np.unique(_places(keys[counts > 1], bits))
        edges = np.arange(0, bits + 1, SEGMENT, dtype=np.uint64)
        once_at, twice_at = np.searchsorted(once, edges), np.searchsorted(twice, edges)
        filled = np.flatnonzero(np.diff(once_at))
        low = np.uint64(SEGMENT - 1)
        cut = lambda places, at, number: (places[at[number]:at[number + 1]] & low).astype("<u2").tobytes()
        for start in range(0, len(filled), 1024):
            part = filled[start:start + 1024]
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array(part, pa.int64()),
                "once": pa.array([cut(once, once_at, number) for number in part], pa.binary()),
                "twice": pa.array([cut(twice, twice_at, number) for number in part], pa.binary()),
            })

    return run


def _merge_segment(parts: pa.Table) -> pa.Table:
    """The twice bits of one segment over all tasks."""
    places, counts = np.unique(np.frombuffer(b"".join(parts["once"].to_pylist()), "<u2"), return_counts=True)
    bits = np.zeros(SEGMENT, bool)
    bits[places[counts > 1]] = True
    bits[np.frombuffer(b"".join(parts["twice"].to_pylist()), "<u2")] = True
    packed = [np.packbits(bits).tobytes()] if bits.any() else []
    return pa.table({
        "segment": pa.array(parts["segment"].to_pylist()[:len(packed)], pa.int64()), "bits": pa.array(packed, pa.binary()),
    })


def twice_seen_filter(documents: DataFrame, least: int = LEAST_CHARS) -> np.ndarray:
    """The packed bits of the twice filter, its size a power of two by the number of lines."""
    ship_package(documents.sparkSession)
    feeds = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = documents.select(F.coalesce(F.sum(feeds + 1), F.lit(0)).alias("n")).first()["n"]
    bits = min(MOST_BITS, max(SEGMENT, 1 << (int(lines) * BITS_PER_LINE).bit_length()))
    parts = documents.select("text").mapInArrow(_partial_filters(least, bits), "segment long, once binary, twice binary")
    merged = parts.groupBy("segment").applyInArrow(_merge_segment, "segment long, bits binary")
    packed = np.zeros(bits // 8, np.uint8)
    for row in merged.collect():  # at most MOST_BITS
        start = row["segment"] * SEGMENT // 8
        packed[start:start + SEGMENT // 8] = np.frombuffer(row["bits"], np.uint8)
    return packed


def _suspected(keys: list[bytes], packed: np.ndarray) -> np.ndarray:
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(key) for key in keys), np.uint64, len(keys))
    places = _places(hashes, len(packed) * 8)
    return (packed[places >> np.uint64(3)] >> (np.uint64(7) - (places & np.uint64(7))).astype(np.uint8) & 1).all(axis=0)


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _suspects(least: int, shared):
    """``doc_id, key`` for each suspected key of a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, keys = [], []
            for number, text in enumerate(text_bytes(batch)):
                own = _keys(text, least)
                keys += own
                owner += [number] * len(own)
            hit = np.flatnonzero(_suspected(keys, shared.value))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").take(pa.array([owner[n] for n in hit], pa.int64())),
                "key": pa.array([_digest(keys[n]) for n in hit], pa.binary()),
            })

    return run


def _split(least: int, shared, wanted: bool):
    """The documents that have suspected lines, or those that have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, keys = [], []
            for number, text in enumerate(text_bytes(batch)):
                own = _keys(text, least)
                keys += own
                owner += [number] * len(own)
            has = np.zeros(batch.num_rows, bool)
            has[np.array(owner, np.int64)[_suspected(keys, shared.value)]] = True
            yield batch.filter(pa.array(has == wanted))

    return run


def _drop_lines(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, dropped, kept = [], [], []
            for text, drops in zip(text_bytes(batch), batch.column("drops").to_pylist(), strict=True):
                lines, gone = text.split(b"\n"), set(drops or ())
                stay = lines
                if gone:
                    stay = [line for line in lines if (key := _key(line, least)) is None or _digest(key) not in gone]
                total.append(len(lines))
                dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay).decode())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_lines": pa.array(total, pa.int64()),
                "n_dropped": pa.array(dropped, pa.int64()), "text": pa.array(kept, pa.string()),
            })

    return run


def dedupe_lines(documents: DataFrame, least: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text``: the documents without their repeated lines."""
    ship_package(documents.sparkSession)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast(twice_seen_filter(rows, least))
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    pairs = written_table(
        rows.mapInArrow(_suspects(least, shared), f"doc_id {doc_type}, key binary").distinct(), "line-suspects"
    )
    repeated = written_table(
        pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= least_documents),
        "line-repeats",
    )
    own = join_split_hot(pairs, repeated, "key", "n").where("doc_id is null or doc_id < keeper")
    drops = own.groupBy(F.col("doc_id").alias("of_id")).agg(F.collect_list("key").alias("drops"))
    schema = rows.schema
    suspected = rows.mapInArrow(_split(least, shared, True), schema)
    met = suspected.join(drops, F.col("doc_id").eqNullSafe(F.col("of_id")), "left").select("doc_id", "text", "drops")
    clean = rows.mapInArrow(_split(least, shared, False), schema).select(
        "doc_id", (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"), "text",
    )
    return clean.unionAll(met.mapInArrow(_drop_lines(least), f"doc_id {doc_type}, n_lines long, n_dropped long, text string"))


def line_report(documents: DataFrame) -> DataFrame:
    return dedupe_lines(documents).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
