"""Token-id files, compressed by Re-Pair grammars with random access.

Documents are range-sorted by doc_id and encoded where they land; an end id follows each document. A shard is a run of whole
documents of about ``SHARD_IDS`` ids. Its ids are stored as grammars: frequent pairs of ids are replaced by nonterminals,
again and again, and the rules, the lengths of their expansions and the sequence left are written. A shard is one row
of a Parquet file, written under Spark's commit protocol, with the documents it holds:

``part, first, n_ids, terminals``: the range partition, the ids of this partition before the shard, the shard's ids, and the
tokenizer's number of ids, from which the nonterminals count;
``low, high, doc_ids, doc_lengths``: the documents in order and their numbers of ids;
``blocks``: per ``BLOCK_IDS`` ids ``n_ids, rules, lengths, symbols``, little-endian unsigned 32-bit integers.

A document is read without its neighbours: its place follows from ``doc_lengths``, and the sequence's expansion lengths
find the symbols that hold it. Only these are expanded.

Defined results: a NULL or empty text is the end id alone; documents without a doc_id come first; repeated rows of a
doc_id are documents of their own, in the order of a hash of their text; a text longer than a block is cut into several
blocks of one shard; an empty table gives no shards and no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.pooled_tokens import PooledTokens
from feedlens.llm.repair import Grammar, compress, expand, expand_range
from feedlens.llm.shipping import ship_package
from feedlens.llm.word_tokens import byte_level_table
from feedlens.session import written_table

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
SHARD_IDS, BLOCK_IDS = 1 << 18, 1 << 19
#: Bytes of texts encoded at once.
AT_ONCE = 1 << 22


@functools.cache
def load_tokenizer(path: str | None) -> tuple[PooledTokens, int]:
    """The tokenizer of a file (by default the public one of each machine) and its number of ids; once per worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    tokenizer = Tokenizer.from_file(path)

    def encode(texts: list[str]) -> list[list[int]]:
        return [found.ids for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    table = byte_level_table(tokenizer.get_vocab())
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    cutter = tokenizer.pre_tokenizer
    cut = (
        isinstance(tokenizer.model, BPE) and isinstance(cutter, ByteLevel) and cutter.use_regex and not cutter.add_prefix_space
        and tokenizer.normalizer is None and tokenizer.truncation is None and tokenizer.padding is None
    )
    return PooledTokens(encode, table, added, END_ID, cut), len(table)


def text_groups(batches: Iterator[pa.RecordBatch], at_once: int = AT_ONCE) -> Iterator[tuple[list, pa.Array]]:
    """``doc_ids, texts`` of some rows at a time."""
    for batch in batches:
        texts = batch.column("text")
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + at_once, side="right")), start + 1)
            yield batch.column("doc_id").slice(start, stop - start).to_pylist(), texts.slice(start, stop - start)
            start = stop


def _packed(grammar: Grammar, n_ids: int) -> dict:
    return {
        "n_ids": n_ids, "rules": grammar.rules.astype("<u4").tobytes(), "lengths": grammar.lengths.astype("<u4").tobytes(),
        "symbols": grammar.symbols.astype("<u4").tobytes(),
    }


def _unpacked(block: dict) -> Grammar:
    return Grammar(
        np.frombuffer(block["rules"], "<u4").reshape(-1, 2), np.frombuffer(block["lengths"], "<u4"), np.frombuffer(block["symbols"], "<u4")
    )


_BLOCK = pa.struct([("n_ids", pa.int64()), ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary())])
_SHARD = (
    "part int, first long, n_ids long, terminals int, low {doc_type}, high {doc_type}, doc_ids array<{doc_type}>, doc_lengths array<long>, "
    "blocks array<struct<n_ids: long, rules: binary, lengths: binary, symbols: binary>>"
)


def _write_shards(path: str | None, shard_ids: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, terminals = load_tokenizer(path)
        part, doc_type = None, None
        doc_ids, pieces, lengths = [], [], []
        first = size = 0

        def shard() -> pa.RecordBatch:
            ids = np.concatenate(pieces)
            blocks = [
                _packed(compress(ids[at:at + block_ids], terminals), min(block_ids, len(ids) - at)) for at in range(0, len(ids), block_ids)
            ]
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "first": pa.array([first], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()),
                "terminals": pa.array([terminals], pa.int32()), "low": pa.array(doc_ids[:1], doc_type), "high": pa.array(doc_ids[-1:], doc_type),
                "doc_ids": pa.array([doc_ids], pa.list_(doc_type)), "doc_lengths": pa.array([lengths], pa.list_(pa.int64())),
                "blocks": pa.array([blocks], pa.list_(_BLOCK)),
            })

        def noted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal part, doc_type
            for batch in batches:
                if batch.num_rows:
                    part, doc_type = batch.column("part")[0].as_py(), batch.schema.field("doc_id").type
                yield batch

        for ids, texts in text_groups(noted(batches)):
            encoded = (own for found, sizes in tokens.many(texts) for own in np.split(found, np.cumsum(sizes)[:-1]))
            for doc_id, own in zip(ids, encoded, strict=True):
                doc_ids.append(doc_id)
                pieces.append(own)
                lengths.append(len(own))
                size += len(own)
                if size >= shard_ids:
                    yield shard()
                    first, size = first + size, 0
                    doc_ids, pieces, lengths = [], [], []
        if doc_ids:
            yield shard()

    return run


def token_shards(documents: DataFrame, tokenizer: str | None = None, shard_ids: int = SHARD_IDS, block_ids: int = BLOCK_IDS) -> DataFrame:
    """The shards of ``documents``, rows of the file format. ``tokenizer`` is the file's path on the executors."""
    ship_package(documents.sparkSession)
    order = [F.col("doc_id"), F.xxhash64("text")]
    # The only shuffle: texts by ranges of doc_id. The hash spreads a doc_id (or NULL) that many rows share.
    ranged = documents.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    return ranged.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(
        _write_shards(tokenizer, shard_ids, block_ids), _SHARD.format(doc_type=doc_type)
    )


def write_token_files(documents: DataFrame, path: str, tokenizer: str | None = None) -> None:
    token_shards(documents, tokenizer).write.option("compression", "zstd").parquet(path)


def _wanted(low, high):
    """Decoded documents of shards from ``low`` to ``high``, only their symbols expanded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_type = batch.schema.field("doc_ids").type.value_type
            for row in batch.to_pylist():
                ends = np.cumsum(row["doc_lengths"])
                block_ends = np.cumsum([block["n_ids"] for block in row["blocks"]])
                found = []
                for number, doc_id in enumerate(row["doc_ids"]):
                    if doc_id is None or not low <= doc_id <= high:
                        continue
                    start, stop = int(ends[number] - row["doc_lengths"][number]), int(ends[number])
                    own = []
                    for block, block_end in zip(row["blocks"], block_ends, strict=True):
                        block_start = int(block_end) - block["n_ids"]
                        if start < block_end and stop > block_start:
                            own.append(expand_range(
                                _unpacked(block), row["terminals"], max(start - block_start, 0), min(stop - block_start, block["n_ids"])
                            ))
                    found.append((doc_id, np.concatenate(own).astype(np.int64).tolist()))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([doc_id for doc_id, _ in found], doc_type),
                    "ids": pa.array([ids for _, ids in found], pa.list_(pa.int64())),
                })

    return run


def read_documents(files: DataFrame, low: int, high: int) -> DataFrame:
    """``doc_id, ids`` of the documents from ``low`` to ``high``: other shards are skipped by their bounds, other documents not expanded."""
    ship_package(files.sparkSession)
    doc_type = files.schema["low"].dataType.simpleString()
    # A shard that opens with documents without a doc_id may still hold some of the range.
    near = files.where((F.col("low").isNull() | (F.col("low") <= high)) & (F.col("high") >= low))
    return near.select("terminals", "doc_ids", "doc_lengths", "blocks").mapInArrow(_wanted(low, high), f"doc_id {doc_type}, ids array<long>")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part, offset`` (in the part), ``doc_id, n_tokens, ids_crc32`` of each document of whole shards."""
    for batch in batches:
        doc_type = batch.schema.field("doc_ids").type.value_type
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            ids = np.concatenate([expand(_unpacked(block), row["terminals"]) for block in row["blocks"]]).astype("<u4")
            ends = np.cumsum(row["doc_lengths"])
            starts = ends - row["doc_lengths"]
            packed = memoryview(ids.tobytes())
            sums = [zlib.crc32(packed[4 * start:4 * end]) for start, end in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([row["part"]] * len(sums), pa.int32()), "offset": pa.array(starts + row["first"], pa.int64()),
                "doc_id": pa.array(row["doc_ids"], doc_type), "n_tokens": pa.array(row["doc_lengths"], pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
            })


def read_digests(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from the files."""
    ship_package(files.sparkSession)
    doc_type = files.schema["low"].dataType.simpleString()
    decoded = files.select("part", "first", "terminals", "doc_ids", "doc_lengths", "blocks").mapInArrow(
        _digests, f"part int, offset long, doc_id {doc_type}, n_tokens long, ids_crc32 long"
    )
    # One row per range partition, of which there are as many as the session's shuffle partitions.
    sums = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    starts = sums.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    return decoded.join(F.broadcast(starts), "part").select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def token_report(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    return read_digests(written_table(token_shards(documents, tokenizer), "token-files"))
