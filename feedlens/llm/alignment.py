"""Alignment of two tokenizers' tokens over the same text.

Byte offsets at which a token of A and one of B both end cut a text into groups; all tokens of A and of B in a group are
linked. A pair of ids counts in how many documents it is linked.

1. A task encodes its documents and puts the ends of their tokens one after another, two ascending lists A and B. Diagonals of
   their merge at equal distances, each found by binary search, cut the merge into pieces of equal work, wherever documents begin
   and however long they are. A piece merges its part of A with its part of B by itself and emits the places where both end.
   A group that crosses pieces is stitched from the last such place of one piece and the first of a later one.
2. A chunk of documents is one row of a table: its documents' results, its distinct pairs of ids, and per document which of them
   it links how often. The pairs of a group are never listed: tokens of one id in a group are one entry with its number.
3. Pairs are counted over all chunks, each chunk sending a pair once with its number of documents; a pair's count
   goes back to the chunks that hold it, and each chunk sums up its documents.

Defined results: a text that is NULL or empty, or that one of the tokenizers does not give back byte by byte, has no tokens; each row is a
document, so repeated rows count as often as they stand there, also rows without a doc_id; ties for an id's best partner are all
best; a very long text is a chunk of its own, with its pairs merged part by part; an empty table gives no rows; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.hot_keys import join_split_hot
from feedlens.llm.shipping import ship_package
from feedlens.llm.word_tokens import WordTokens, byte_level_table
from feedlens.session import written_table

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of texts in a chunk; a longer text is a chunk by itself.
CHUNK = 1 << 22
#: Steps of the merge in a piece, and links of a document merged at once.
PIECE, LINKS = 1 << 16, 1 << 20
#: Groups of more links are reduced to their distinct ids first.
LARGE = 64
#: A pair of ids as one number.
SHIFT = 32


# --- tokenizers

def piece_table(model) -> list[bytes]:
    """The bytes of every id of a piece model: its piece with U+2581 for a space, or the one byte it stands for."""
    pieces = [model.id_to_piece(number) for number in range(model.vocab_size())]
    return [
        bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace("▁", " ").encode() for number, piece in enumerate(pieces)
    ]


@functools.cache
def load_tokenizers(byte_level: str | None, pieces: str | None) -> tuple[WordTokens, WordTokens]:
    """Both tokenizers from their files (by default the public ones of each machine), once per worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    if byte_level is None or pieces is None:
        import public_tokenizers

        byte_level, pieces = byte_level or public_tokenizers.path(BYTE_LEVEL), pieces or public_tokenizers.path(PIECES)
    tokenizer = Tokenizer.from_file(byte_level)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=pieces)
    table = piece_table(model)
    # No piece may join a sign to a space after it, or words could not be encoded by themselves.
    cut = not any(b" " in piece.lstrip(b" ") for piece in table)
    return (
        WordTokens(lambda texts: [found.ids for found in tokenizer.encode_batch(texts, add_special_tokens=False)],
                   byte_level_table(tokenizer.get_vocab())),
        # The model adds the space that every text here begins with.
        WordTokens(lambda texts: model.encode([text[1:] for text in texts], num_threads=1), table, cut),
    )


# --- merge path

def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> np.ndarray:
    """How many of A's ends lie before each ``piece``-th step of the merge (A first on ties): a binary search per diagonal, all at once."""
    steps = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(steps - len(b), 0), np.minimum(steps, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        # A's end ``middle`` belongs before the diagonal if it is not above the last of B's there.
        before = a[np.minimum(middle, len(a) - 1)] <= b[np.clip(steps - middle - 1, 0, len(b) - 1)]
        going = low < high
        low = np.where(going & before, middle + 1, low)
        high = np.where(going & ~before, middle, high)
    return np.stack([low, steps - low], axis=1)


def piece_overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places (in A, in B) of the ends that both parts share, by merging the two."""
    ends = np.concatenate([a, b])
    order = np.argsort(ends, kind="stable")  # merges the two ascending runs
    ends = ends[order]
    both = np.flatnonzero(ends[1:] == ends[:-1])
    return np.stack([order[both], order[both + 1] - len(a)], axis=1)


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """Places (in A, in B) of all shared ends of two ascending lists, from independent pieces of the merge."""
    if not len(a) or not len(b):
        return np.zeros((0, 2), np.int64)
    corners = diagonals(a, b, piece)
    # A shared end whose A and B fall on two sides of a diagonal: B's goes with A's.
    inner = corners[1:-1]
    torn = (inner[:, 0] > 0) & (inner[:, 1] < len(b))
    torn[torn] = a[inner[torn, 0] - 1] == b[inner[torn, 1]]
    corners[1:-1, 1] += torn
    found = []
    for (a_from, b_from), (a_to, b_to) in zip(corners[:-1], corners[1:], strict=True):
        found.append(piece_overlaps(a[a_from:a_to], b[b_from:b_to]) + (a_from, b_from))
    return np.concatenate(found)


# --- groups and links of a chunk

class Groups(NamedTuple):
    a: np.ndarray  # ids
    b: np.ndarray
    a_from: np.ndarray  # per group
    b_from: np.ndarray
    a_size: np.ndarray
    b_size: np.ndarray


def stitched(a: np.ndarray, b: np.ndarray, cuts: np.ndarray) -> Groups:
    """The groups between neighbouring shared ends, whichever pieces they came from."""
    before = np.concatenate([[[-1, -1]], cuts[:-1]]) if len(cuts) else cuts
    sizes = cuts - before
    return Groups(a, b, before[:, 0] + 1, before[:, 1] + 1, sizes[:, 0], sizes[:, 1])


def sign_names(kinds: int) -> list[str]:
    """Every id before a comma, then before a bar, then before a semicolon."""
    return [f"{number}{sign}" for sign in (",", "|", ";") for number in range(kinds)]


def group_text(groups: Groups, first: int, stop: int, names: list[str]) -> str:
    """``a1,a2|b1;a3|b2,b3`` of the groups from ``first`` to ``stop``."""
    a_from, b_from = int(groups.a_from[first]), int(groups.b_from[first])
    a_to, b_to = int(groups.a_from[stop - 1] + groups.a_size[stop - 1]), int(groups.b_from[stop - 1] + groups.b_size[stop - 1])
    a, b = groups.a[a_from:a_to].astype(np.int64), groups.b[b_from:b_to].astype(np.int64)
    a_last = groups.a_from[first:stop] + groups.a_size[first:stop] - 1 - a_from
    b_last = groups.b_from[first:stop] + groups.b_size[first:stop] - 1 - b_from
    # Every token's place in the text, and the sign after it.
    kinds = len(names) // 3
    a[a_last] += kinds
    b[b_last] += 2 * kinds
    signs = np.empty(len(a) + len(b), np.int64)
    signs[np.arange(len(a)) + np.repeat(groups.b_from[first:stop] - b_from, groups.a_size[first:stop])] = a
    a_done = groups.a_from[first:stop] - a_from + groups.a_size[first:stop]
    signs[np.arange(len(b)) + np.repeat(a_done, groups.b_size[first:stop])] = b
    return "".join(map(names.__getitem__, signs.tolist()))[:-1]


def _merged(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their times."""
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(times, starts) if len(keys) else times


def linked_pairs(groups: Groups, first: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct id pairs (as numbers) of the groups from ``first`` to ``stop`` with their numbers of links."""
    keys, times = [], []
    links = groups.a_size[first:stop] * groups.b_size[first:stop]
    large = links > LARGE
    # Small groups, some at a time.
    small = np.flatnonzero(~large) + first
    bounds = np.searchsorted(np.cumsum(links[~large]), np.arange(LINKS, int(links[~large].sum()) + LINKS, LINKS), side="left") + 1
    start = 0
    for end in [*np.minimum(bounds, len(small)).tolist(), len(small)]:
        own = small[start:end]
        start = max(start, end)
        if not len(own):
            continue
        width = groups.b_size[own]
        count = groups.a_size[own] * width
        step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        left = groups.a[np.repeat(groups.a_from[own], count) + step // np.repeat(width, count)].astype(np.int64)
        right = groups.b[np.repeat(groups.b_from[own], count) + step % np.repeat(width, count)]
        found = _merged(left << SHIFT | right, np.ones(len(left), np.int64))
        keys.append(found[0])
        times.append(found[1])
    held = 0
    for group in np.flatnonzero(large) + first:
        a_from, b_from = groups.a_from[group], groups.b_from[group]
        left, left_times = np.unique(groups.a[a_from:a_from + groups.a_size[group]], return_counts=True)
        right, right_times = np.unique(groups.b[b_from:b_from + groups.b_size[group]], return_counts=True)
        for number, own in zip(left.astype(np.int64), left_times, strict=True):
            keys.append(number << SHIFT | right.astype(np.int64))
            times.append(own * right_times)
            held += len(right)
            if held > LINKS:
                merged = _merged(np.concatenate(keys), np.concatenate(times))
                keys, times, held = [merged[0]], [merged[1]], 0
    return _merged(np.concatenate(keys), np.concatenate(times)) if len(keys) > 1 else (keys[0], times[0])


# --- chunks

def _squeezed(values: np.ndarray) -> pa.Array:
    """One cell with many integers."""
    return pa.array([pa.compress(values.astype(np.int64).tobytes(), "zstd", asbytes=True)], pa.binary())


def _unsqueezed(cell: bytes, count: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(cell, 8 * count, "zstd"), np.int64) if count else np.zeros(0, np.int64)


_CHUNK_ROW = (
    "chunk long, doc_ids array<{doc_type}>, results binary, texts array<string>, pairs array<long>, holders array<long>, "
    "sizes binary, places binary, times binary"
)


def _chunk(number: int, doc_ids: list, texts: list[str], tokenizers: tuple[WordTokens, WordTokens], names: list[str], doc_type) -> pa.RecordBatch:
    spaced = [" " + text if text else "" for text in texts]
    tokens = [own.many(spaced) for own in tokenizers]
    good = np.array([bool(text) and a is not None and b is not None for text, a, b in zip(texts, *tokens, strict=True)], bool)
    a_ids, b_ids = ([own[at] for at in np.flatnonzero(good)] for own in tokens)
    none = np.zeros(0, np.uint32)
    a, b = np.concatenate([none, *a_ids]), np.concatenate([none, *b_ids])
    a_ends, b_ends = np.cumsum(tokenizers[0].lengths[a]), np.cumsum(tokenizers[1].lengths[b])
    groups = stitched(a, b, overlaps(a_ends, b_ends))

    # Every document's last tokens end together, so a document is a run of whole groups.
    a_counts, b_counts = np.array([len(own) for own in a_ids], np.int64), np.array([len(own) for own in b_ids], np.int64)
    stops = np.searchsorted(groups.a_from + groups.a_size, np.cumsum(a_counts))
    firsts = np.concatenate([[0], stops[:-1] + 1]) if len(stops) else stops
    links = np.concatenate([[0], np.cumsum(groups.a_size * groups.b_size)])
    results = np.zeros((len(texts), 4), np.int64)
    if len(stops):
        results[good] = np.stack([a_counts, b_counts, stops + 1 - firsts, links[stops + 1] - links[firsts]], axis=1)
    digests = [""] * len(texts)
    keys, times, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
    for at, first, stop in zip(np.flatnonzero(good).tolist(), firsts.tolist(), (stops + 1).tolist(), strict=True):
        digests[at] = hashlib.sha256(group_text(groups, first, stop, names).encode()).hexdigest()
        own = linked_pairs(groups, first, stop)
        keys.append(own[0])
        times.append(own[1])
        sizes[at] = len(own[0])
    keys, times = np.concatenate(keys), np.concatenate(times)
    pairs, places, holders = np.unique(keys, return_inverse=True, return_counts=True)
    return pa.RecordBatch.from_pydict({
        "chunk": pa.array([number], pa.int64()), "doc_ids": pa.array([doc_ids], pa.list_(doc_type)),
        "results": _squeezed(results.ravel()), "texts": pa.array([digests], pa.list_(pa.string())),
        "pairs": pa.array([pairs], pa.list_(pa.int64())), "holders": pa.array([holders], pa.list_(pa.int64())),
        # Places as steps from one to the next, which compress well.
        "sizes": _squeezed(sizes), "places": _squeezed(np.diff(places, prepend=0)), "times": _squeezed(times),
    })


def _chunks(byte_level: str | None, pieces: str | None, characters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = load_tokenizers(byte_level, pieces)
        kinds = max(len(own.token_bytes) for own in tokenizers)
        names = sign_names(kinds)
        number, part, doc_type = 0, None, None
        ids, texts, size = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part, doc_type = batch.column("part")[0].as_py(), batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = text or ""
                if ids and size + len(text) > characters:
                    yield _chunk(part << 32 | number, ids, texts, tokenizers, names, doc_type)
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
        if ids:
            yield _chunk(part << 32 | number, ids, texts, tokenizers, names, doc_type)

    return run


_SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _sums(chunks: pa.Table, counts: pa.Table) -> pa.Table:
    """A chunk's documents with the sums over their links of the pairs' counts."""
    doc_type = chunks.schema.field("doc_ids").type.value_type
    schema = pa.schema([("doc_id", doc_type), *[(name, pa.int64()) for name in _SUMS], ("groups_sha256", pa.string())])
    if not chunks.num_rows:
        return schema.empty_table()
    row = {name: chunks.column(name)[0].as_py() for name in ("doc_ids", "results", "texts", "sizes", "places", "times")}
    place = counts.column("place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], best[place] = counts.column("count").to_numpy(), counts.column("best").to_numpy()
    documents = len(row["doc_ids"])
    results = _unsqueezed(row["results"], 4 * documents).reshape(-1, 4)
    ends = np.cumsum(_unsqueezed(row["sizes"], documents))
    starts = np.concatenate([[0], ends[:-1]])
    places = np.cumsum(_unsqueezed(row["places"], int(ends[-1])))
    times = _unsqueezed(row["times"], int(ends[-1]))

    def per_document(values: np.ndarray) -> pa.Array:
        along = np.concatenate([[0], np.cumsum(values)])
        return pa.array(along[ends] - along[starts])

    columns = [
        pa.array(row["doc_ids"], doc_type), *[pa.array(results[:, at]) for at in range(4)],
        per_document(times * best[places]), per_document(times * count[places]), pa.array(row["texts"], pa.string()),
    ]
    return pa.table(columns, schema=schema)


def aligned_chunks(documents: DataFrame, byte_level: str | None = None, pieces: str | None = None, characters: int = CHUNK) -> DataFrame:
    """One row per chunk of documents, in the order the table is read; tokenizers are given by their files' paths on the executors."""
    ship_package(documents.sparkSession)
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    return rows.mapInArrow(_chunks(byte_level, pieces, characters), _CHUNK_ROW.format(doc_type=doc_type))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair, chunks, count, best`` of every linked id pair: the documents that hold it, and 1 if no partner of its A id has more."""
    held = chunks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("held")).select("held.*")
    counts = held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("count"), F.count(F.lit(1)).alias("chunks"))
    # An A id has at most as many partners as B has ids.
    of_a = Window.partitionBy(F.shiftright("pair", SHIFT))
    return counts.withColumn("best", (F.col("count") == F.max("count").over(of_a)).cast("long"))


def alignment(documents: DataFrame, byte_level: str | None = None, pieces: str | None = None, characters: int = CHUNK) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    chunks = written_table(aligned_chunks(documents, byte_level, pieces, characters), "aligned-chunks")
    counts = written_table(pair_counts(chunks), "aligned-counts")
    held = chunks.select(F.col("chunk").alias("of_chunk"), F.posexplode("pairs").alias("place", "pair"))
    back = join_split_hot(held, counts, "pair", "chunks").select("of_chunk", "place", "count", "best")
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{name} long" for name in _SUMS)
    whole = chunks.select("chunk", "doc_ids", "results", "texts", "sizes", "places", "times")
    return whole.groupBy("chunk").cogroup(back.groupBy("of_chunk")).applyInArrow(
        _sums, f"doc_id {doc_type}, {longs}, groups_sha256 string"
    )
