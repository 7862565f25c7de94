"""Token files against whole-text encoding, and grammars against the ids they stand for."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedlens.llm import repair, token_files
from feedlens.llm.word_tokens import parts
from feedlens.session import written_table

ODD = [
    "", None, " ", "  ", "a  b ", " a\n b", "it's 5 o'clock, 's", "<|endoftext|> a <|endoftext|>", "日本語 テキスト 🙂", "a  b　 c",
    "x" * 5000, "= " * 3000, "\x00 \x1c a", "a\r\n b\t c \t d", "word " * 4000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def brute(rows, tokenizer):
    """doc_id, start, n_tokens, crc32 by encoding every text whole, in order."""
    start, found = 0, []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def digests(frame):
    return sorted((row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) for row in frame.collect())


def test_report_equals_whole_texts(spark, make_documents, invented, tokenizer):
    rows = [(3 * number, text, "s") for number, text in enumerate(ODD + [invented(n, 200) for n in range(60)] + [invented(1, 200)] * 20)]
    found = token_files.token_report(make_documents(random.Random(1).sample(rows, len(rows))))
    assert digests(found) == brute([row[:2] for row in rows], tokenizer)


def test_given_documents(spark, small, tokenizer):
    table = spark.read.parquet(f"{small}/documents.parquet")
    rows = sorted((row["doc_id"], row["text"]) for row in table.select("doc_id", "text").collect())
    assert digests(token_files.token_report(table)) == brute(rows, tokenizer)


def test_nulls_repeats_and_columns(spark, make_documents, tokenizer):
    table = make_documents([(2, "b c", "s"), (1, "a", "s"), (1, "a", "s"), (None, "n o", "s"), (None, None, "s")])
    table = table.withColumn("part", F.lit(1)).withColumn("start", F.lit("x")).withColumn("n_tokens", F.lit(0))
    rows = token_files.token_report(table).collect()
    sizes = sorted((row["start"], row["doc_id"], row["n_tokens"]) for row in rows)
    assert [doc_id for _, doc_id, _ in sizes] == [None, None, 1, 1, 2]
    assert [start for start, _, _ in sizes] == [0, *np.cumsum([size for _, _, size in sizes])[:-1]]
    empty = table.limit(0)
    assert token_files.token_report(empty).collect() == []


def test_documents_over_blocks_and_random_access(spark, make_documents, invented, tokenizer):
    rows = [(number, invented(number % 7, 40 * number + 1, 50), "s") for number in range(40)]
    shards = written_table(token_files.token_shards(make_documents(rows), shard_ids=700, block_ids=300), "shards")
    assert shards.count() > 10
    assert shards.agg(F.max(F.size("blocks"))).first()[0] > 2
    assert digests(token_files.read_digests(shards)) == brute([row[:2] for row in rows], tokenizer)
    read = {row["doc_id"]: row["ids"] for row in token_files.read_documents(shards, 7, 31).collect()}
    assert read == {row[0]: [*tokenizer.encode(row[1], add_special_tokens=False).ids, 0] for row in rows[7:32]}


def test_parts_join_to_the_text():
    draw = random.Random(3)
    for _ in range(3000):
        text = "".join(draw.choice([" ", "a", "\n", " ", "é", "  "]) for _ in range(draw.randrange(12)))
        assert "".join(parts(text)) == text


def test_grammars():
    draw = np.random.default_rng(7)
    for _ in range(500):
        size, kinds = int(draw.integers(0, 80)), int(draw.integers(1, 5))
        ids = draw.integers(0, kinds, size).astype(np.uint32)
        grammar = repair.compress(ids, kinds, 2)
        assert (repair.expand(grammar, kinds) == ids).all()
        for _ in range(4):
            start = int(draw.integers(0, size + 1))
            stop = int(draw.integers(start, size + 1))
            assert (repair.expand_range(grammar, kinds, start, stop) == ids[start:stop]).all()
    ids = np.tile(draw.integers(0, 1000, 50), 200).astype(np.uint32)
    grammar = repair.compress(ids, 1000)
    assert len(grammar.symbols) + 3 * len(grammar.rules) < len(ids) / 20
    # No pair is left that would pay.
    left = np.stack([grammar.symbols[:-1], grammar.symbols[1:]], axis=1)
    _, counts = np.unique(left, axis=0, return_counts=True)
    assert counts.max(initial=0) < 2 * repair.LEAST_USES
