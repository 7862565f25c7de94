"""Benchmark decontamination by suffix arrays over shards of the training text.

Each task cuts its documents into shards of bounded size. A shard's words become numbers of the benchmark's
vocabulary (0: a word no item holds), and its suffixes, cut at 13 words and at the first unknown
word, are sorted: the shard's suffix array. Suffixes shorter than every window that begins with their first word cannot match and
are left out. Every test suffix is binary-searched in it; its interval gives all places of
the window. Windows that follow each other in both texts join to longest verbatim matches.

The benchmark is broadcast in blocks of bounded size, each searched against all rows in its turn; documents are
never shuffled, so neither hot passages nor groups of copies meet in a task.

Defined results: NULL and empty texts have no words; an item without words has no window; rows of one item_id are
one item, a NULL item_id is named ``NULL``; repeated documents give repeated results; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.arrow import inner_names, text_bytes
from feedlens.llm.shipping import ship_package
from feedlens.session import written_table

WINDOW = 13
#: Contaminated: at least one in this many words is hit.
HIT_SHARE = 20
SHARD_WORDS = 2_000_000
#: Bytes of benchmark text in one broadcast block.
BLOCK_BYTES = 16_000_000

_WORD = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_TO_WORDS = bytes(
    code + 32 if 0x41 <= code <= 0x5A else code if code in _WORD else 0x20 for code in range(256)
)


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and non-ASCII characters."""
    return text.translate(_TO_WORDS).split()


@dataclass
class TestSuffixes:
    """A block of the benchmark: its vocabulary and the windows that begin its suffixes."""

    vocabulary: dict[bytes, int]
    least: np.ndarray       # by word number: the shortest window that begins with it
    low: np.ndarray         # each distinct window as bytes, and the bound above its continuations
    high: np.ndarray
    length: np.ndarray      # words of each window
    owners: list[list[tuple[str, int]]]  # item and word position of each window


def prepare_items(items: list[tuple[str, bytes]], window: int = WINDOW) -> TestSuffixes:
    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], list[tuple[str, int]]] = {}
    for name, text in items:
        numbers = [vocabulary.setdefault(word, len(vocabulary) + 1) for word in words(text)]
        for start in range(max(1, len(numbers) - window + 1) if numbers else 0):
            owners.setdefault(tuple(numbers[start:start + window]), []).append((name, start))
    least = np.full(len(vocabulary) + 1, np.iinfo(np.int32).max, np.int32)
    rows = np.zeros((len(owners), WINDOW), np.uint32)
    tops = np.full((len(owners), WINDOW), 0xFFFFFFFF, np.uint32)
    for row, numbers in enumerate(owners):
        rows[row, :len(numbers)] = tops[row, :len(numbers)] = numbers
        least[numbers[0]] = min(least[numbers[0]], len(numbers))
    return TestSuffixes(vocabulary, least, rows, tops, np.array([len(key) for key in owners], np.int64), list(owners.values()))


def suffix_array(numbers: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of the suffixes that can match, sorted, and their first words."""
    size = len(numbers)
    unknown = np.append(np.flatnonzero(numbers == 0), size)
    until = unknown[np.searchsorted(unknown, np.arange(size))]
    run = until - np.arange(size)
    starts = np.flatnonzero((numbers > 0) & (run >= least[numbers]))
    padded = np.append(numbers, np.zeros(WINDOW, numbers.dtype))
    suffixes = padded[starts[:, None] + np.arange(WINDOW)]
    suffixes[np.arange(WINDOW) >= run[starts][:, None]] = 0
    order = np.lexsort(suffixes.T[::-1])
    return starts[order], suffixes[order]


def _search(suffixes: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """The interval of the suffix array that begins with each window."""
    as_bytes = lambda rows: np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * WINDOW}").ravel()
    array = as_bytes(suffixes)
    return np.searchsorted(array, as_bytes(tests.low), "left"), np.searchsorted(array, as_bytes(tests.high), "right")


def _shard_hits(numbers: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """Every occurrence in the shard: start position and window number, by position."""
    starts, suffixes = suffix_array(numbers, tests.least)
    if not len(starts) or not len(tests.low):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = _search(suffixes, tests)
    found = np.flatnonzero(right > left)
    counts = (right - left)[found]
    which = np.repeat(found, counts)
    place = np.repeat(left[found], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[place]
    order = np.argsort(at, kind="stable")
    return at[order], which[order]


def _covered(at: np.ndarray, length: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` words lie inside an occurrence."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + length, -1)
    return np.cumsum(change[:-1]) > 0


def _matches(at: np.ndarray, which: np.ndarray, tests: TestSuffixes) -> list[dict[str, str | int]]:
    """Longest verbatim matches, from windows that overlap alike in both texts."""
    open_at: dict[tuple[str, int], list[int]] = {}
    done = []
    for place, number in zip(at.tolist(), which.tolist(), strict=True):
        size = int(tests.length[number])
        for name, start in tests.owners[number]:
            diagonal = (name, place - start)
            match = open_at.get(diagonal)
            if match and place <= match[1]:
                match[1] = place + size
            else:
                if match:
                    done.append((name, match[0] - diagonal[1], match[0], match[1] - match[0]))
                open_at[diagonal] = [place, place + size]
    done += [(name, first - offset, first, end - first) for (name, offset), (first, end) in open_at.items()]
    names = ("item", "item_word", "doc_word", "n_words")
    return [dict(zip(names, match, strict=True)) for match in sorted(done, key=lambda match: (match[2], match))]


_NONE = np.zeros(0, np.uint8)
MATCH_TYPE = "array<struct<item:string,item_word:int,doc_word:int,n_words:int>>"
_MATCH = pa.list_(pa.struct([("item", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("n_words", pa.int32())]))


STATE = ("n_words", "n_hit", "hit", "matches")


def _shards(batch: pa.RecordBatch, tests: TestSuffixes, shard_words: int) -> Iterator[tuple[list[int], np.ndarray]]:
    """The documents' sizes and their word numbers, each document closed by an unknown word."""
    number_of = tests.vocabulary.get
    sizes, parts, total = [], [], 0
    for text in text_bytes(batch):
        own = words(text)
        sizes.append(len(own))
        parts += [np.fromiter(map(number_of, own, repeat(0)), np.uint32, len(own)), np.zeros(1, np.uint32)]
        total += len(own)
        if total >= shard_words:
            yield sizes, np.concatenate(parts)
            sizes, parts, total = [], [], 0
    if sizes:
        yield sizes, np.concatenate(parts)


def _scan(shared, shard_words: int, passed: list[str]):
    """The ``passed`` columns and each document's state after this block of the benchmark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = shared.value
        for batch in batches:
            count, hit, matches = [], [], []
            for sizes, numbers in _shards(batch, tests, shard_words):
                at, which = _shard_hits(numbers, tests)
                begin = np.cumsum([0] + [size + 1 for size in sizes])
                edge = np.searchsorted(at, begin)
                for doc, size in enumerate(sizes):
                    own = slice(edge[doc], edge[doc + 1])
                    here, windows = at[own] - begin[doc], which[own]
                    count.append(size)
                    hit.append(np.packbits(_covered(here, tests.length[windows], size)) if len(here) else _NONE)
                    matches.append(_matches(here, windows, tests) if len(here) else [])
            if "matches" in batch.schema.names:  # earlier blocks
                matches = [old + new for old, new in zip(batch.column("matches").to_pylist(), matches, strict=True)]
                before = [np.frombuffer(old, np.uint8) for old in batch.column("hit").to_pylist()]
                hit = [old | new if len(old) and len(new) else old if len(old) else new for old, new in zip(before, hit, strict=True)]
            yield pa.RecordBatch.from_pydict({name: batch.column(name) for name in passed} | {
                "n_words": pa.array(count, pa.int64()),
                "n_hit": pa.array([int(np.unpackbits(bits).sum()) for bits in hit], pa.int64()),
                "hit": pa.array([bits.tobytes() for bits in hit], pa.binary()), "matches": pa.array(matches, _MATCH),
            })

    return run


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list[tuple[str, bytes]], bool]]:
    """The benchmark in blocks of bounded size, with whether it is the last one."""
    name = F.coalesce(F.col("item_id").cast("string"), F.lit("NULL"))
    items = benchmark.select(name.alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = int(size) // block_bytes + 1
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield [(row["item"], row["text"].encode()) for row in part.collect()], block == blocks - 1


def scan_documents(
    documents: DataFrame, benchmark: DataFrame, keep: list[str], block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """``keep`` columns and, of every document, ``n_words``, ``n_hit``, ``hit`` (packed bits by word) and ``matches``."""
    spark = documents.sparkSession
    ship_package(spark)
    frame = documents.select(*dict.fromkeys([*keep, "text"]))
    for items, last in item_blocks(benchmark, block_bytes):
        passed = keep if last else [name for name in frame.columns if name not in STATE]
        schema = ", ".join(f"`{name}` {frame.schema[name].dataType.simpleString()}" for name in passed)
        shared = spark.sparkContext.broadcast(prepare_items(items))
        frame = frame.mapInArrow(
            _scan(shared, shard_words, passed), f"{schema}, n_words long, n_hit long, hit binary, matches {MATCH_TYPE}"
        )
        if not last:  # one block's work at a time in a task
            frame = written_table(frame, "decontaminate")
    return frame


def _judged() -> Column:
    return (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))


def contamination(documents: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """``doc_id, n_words, n_hit, items, matches, contaminated`` of every document."""
    items = F.array_sort(F.array_distinct("matches.item"))
    return scan_documents(documents, benchmark, ["doc_id"], **options).select(
        "doc_id", "n_words", "n_hit", items.alias("items"), "matches", _judged().alias("contaminated")
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """``documents`` without the contaminated ones; the columns may have any names."""
    inner = inner_names(documents.columns)
    renamed = documents.select(*[F.col(f"`{name}`").alias(to) for name, to in inner.items()])
    clean = scan_documents(renamed, benchmark, renamed.columns, **options).where(~_judged())
    return clean.select(*[F.col(to).alias(name) for name, to in inner.items()])


def contamination_report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(documents, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )
