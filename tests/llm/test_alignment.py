"""The alignment against whole-text encoding and a plain walk over the tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedlens.llm import alignment
from feedlens.llm.word_tokens import byte_level_table

NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def brute():
    byte_level = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    byte_level.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    tables = byte_level_table(byte_level.get_vocab()), alignment.piece_table(pieces)

    def groups_of(text):
        if not text:
            return None
        ids = byte_level.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        words = [[table[number] for number in own] for table, own in zip(tables, ids, strict=True)]
        if any(b"".join(own) != (" " + text).encode() for own in words):
            return None
        ends = []
        for own in words:
            at, found = 0, []
            for word in own:
                at += len(word)
                found.append(at)
            ends.append(found)
        shared = set(ends[0]) & set(ends[1])
        groups, a, b = [], 0, 0
        for end in sorted(shared):
            a_to, b_to = ends[0].index(end, a) + 1, ends[1].index(end, b) + 1
            groups.append((ids[0][a:a_to], ids[1][b:b_to]))
            a, b = a_to, b_to
        return groups

    def report(rows):
        found = [(doc_id, groups_of(text)) for doc_id, text in rows]
        links = [Counter((a, b) for left, right in groups or () for a in left for b in right) for _, groups in found]
        counts = Counter(pair for own in links for pair in own)
        best = defaultdict(int)
        for (a, _), count in counts.items():
            best[a] = max(best[a], count)
        result = []
        for (doc_id, groups), own in zip(found, links, strict=True):
            if groups is None:
                result.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
                continue
            text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
            result.append((
                doc_id, sum(len(left) for left, _ in groups), sum(len(right) for _, right in groups), len(groups), sum(own.values()),
                sum(times for pair, times in own.items() if counts[pair] == best[pair[0]]),
                sum(times * counts[pair] for pair, times in own.items()), hashlib.sha256(text.encode()).hexdigest(),
            ))
        return sorted(result, key=str)

    return report


def rows_of(frame):
    return sorted((tuple(row[name] for name in NAMES) for row in frame.collect()), key=str)


ODD = [
    None, "", " ", "  a", "a  b ", "<|endoftext|> <s> </s>", "日本語 テキスト 🙂🙂", "a▁b", "x" * 3000, "=" * 777 + " " + "-=" * 400, "\x00 \n\n a\tb",
    "ﬁ ½ é é", "it's 5 o'clock, 'tis 12345678901234567890", "word " * 3000,
]


def test_odd_texts(spark, make_documents, invented, brute):
    rows = list(enumerate(ODD + [invented(n, 100) for n in range(30)] + ["the same copy"] * 40))
    documents = make_documents([(doc_id, text, "s") for doc_id, text in rows])
    expected = brute(rows)
    assert rows_of(alignment.alignment(documents)) == expected
    assert rows_of(alignment.alignment(documents.repartition(7), characters=500)) == expected
    assert sum(row[1] for row in expected) > 0


def test_given_documents(spark, small, brute):
    table = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(row["doc_id"], row["text"]) for row in table.select("doc_id", "text").collect()]
    assert rows_of(alignment.alignment(table)) == brute(rows)


def test_nulls_repeats_columns_and_empty(spark, make_documents, brute):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (None, None), (2, "c")]
    documents = make_documents([(doc_id, text, "s") for doc_id, text in rows])
    documents = documents.withColumn("part", F.lit("p")).withColumn("chunk", F.lit(1)).withColumn("n_a", F.lit(None))
    assert rows_of(alignment.alignment(documents)) == brute(rows)
    assert rows_of(alignment.alignment(documents.limit(0))) == []
    assert rows_of(alignment.alignment(documents.where("text is null"))) == [(None, 0, 0, 0, 0, 0, 0, "")]


def test_pieces_of_the_merge():
    draw = random.Random(5)
    for _ in range(400):
        a, b = (np.array(sorted(draw.sample(range(60), draw.randrange(0, 40))), np.int64) for _ in range(2))
        shared = sorted(set(a.tolist()) & set(b.tolist()))
        for piece in (1, 2, 3, 7, 100):
            found = alignment.overlaps(a, b, piece)
            assert a[found[:, 0]].tolist() == shared and b[found[:, 1]].tolist() == shared
            if len(a) and len(b):
                corners = alignment.diagonals(a, b, piece)
                assert set(np.diff(corners.sum(axis=1))[:-1].tolist()) <= {piece}


def test_links_in_parts(monkeypatch):
    draw = np.random.default_rng(2)
    sizes = draw.integers(1, 20, (50, 2))
    starts = np.cumsum(sizes, axis=0) - sizes
    a, b = (draw.integers(0, 9, int(count)).astype(np.uint32) for count in sizes.sum(axis=0))
    groups = alignment.Groups(a, b, starts[:, 0], starts[:, 1], sizes[:, 0], sizes[:, 1])
    expected = Counter()
    for (a_from, b_from), (a_size, b_size) in zip(starts, sizes, strict=True):
        for left in a[a_from:a_from + a_size]:
            for right in b[b_from:b_from + b_size]:
                expected[int(left) << 32 | int(right)] += 1
    for most in (10, 100, 1 << 20):
        monkeypatch.setattr(alignment, "LINKS", most)
        keys, times = alignment.linked_pairs(groups, 0, 50)
        assert dict(zip(keys.tolist(), times.tolist(), strict=True)) == expected
