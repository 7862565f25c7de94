"""Ids from pooled parts against the library's ids of whole texts, and how much is left to the library and the grammar's counts."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from feedlens.llm import pooled_tokens, repair, token_files

SIGNS = [
    " ", " ", " ", "  ", "\n", "\n\n", "\t", "\r", "\x0b", "\x1c", "\x1f", "\x7f", "\x85", "\xa0", " ", " ", " ", " ", " ",
    "　", "​", "́", "ـ", "۝", "߿", "ࠀ", "'", "'s", "'ll", "'D", "a", "b", "Z", "é", "ß", "·", "×", "ª", "א", "日", "語",
    "🙂", "ก", "0", "42", "²", "½", "٣", ".", ",", "-", "_", "***", "$", "<|", "|>", "endoftext", "<|endoftext|>", "the", "tion",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture
def pooled():
    return token_files.load_tokenizer.__wrapped__(None)[0]


def whole(texts, tokenizer):
    return [[*found.ids, 0] for found in tokenizer.encode_batch([text or "" for text in texts], add_special_tokens=False)]


def by_text(pooled, texts, kind=pa.string()):
    found = []
    for ids, lengths in pooled.many(texts if isinstance(texts, pa.Array) else pa.array(texts, kind)):
        assert lengths.sum() == len(ids)
        found += [own.tolist() for own in np.split(ids, np.cumsum(lengths)[:-1])]
    return found


def test_odd_texts_equal_whole_texts(pooled, tokenizer):
    draw = random.Random(5)
    for size in (0, 1, 2, 3, 5, 9, 30):
        texts = ["".join(draw.choices(SIGNS, k=size)) for _ in range(3000)]
        assert by_text(pooled, texts) == whole(texts, tokenizer)
        # Without added tokens every text is cut.
        texts = [text.replace("<|endoftext|>", "") for text in texts]
        assert by_text(pooled, texts, pa.large_string()) == whole(texts, tokenizer)


def test_small_steps_equal_whole_texts(pooled, tokenizer, monkeypatch):
    draw = random.Random(6)
    texts = ["".join(draw.choices(SIGNS, k=draw.randrange(12))) for _ in range(500)]
    for step in (1, 2, 3, 5, 64):
        monkeypatch.setattr(pooled_tokens, "BYTES_CUT", step)
        monkeypatch.setattr(pooled_tokens, "GATHERED", step)
        assert by_text(pooled, texts) == whole(texts, tokenizer)


def test_all_pairs_of_signs(pooled, tokenizer):
    texts = [f"x{first}{second}y {first}{second} {first} {second}\n{first}" for first in SIGNS for second in SIGNS]
    assert by_text(pooled, texts) == whole(texts, tokenizer)


def test_nulls_slices_and_long_texts(pooled, tokenizer):
    texts = [None, "", "a b", None, "x" * 5000, "word " * 4000, "日本語" * 500, " ", "", None]
    assert by_text(pooled, texts) == whole(texts, tokenizer)
    assert by_text(pooled, pa.array(["z z", *texts, "y"]).slice(1, len(texts))) == whole(texts, tokenizer)
    assert by_text(pooled, [None, ""]) == [[0], [0]]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    groups = list(token_files.text_groups([batch, batch], 600))
    assert [doc_id for ids, _ in groups for doc_id in ids] == 2 * list(range(len(texts))) and len(groups) > 4
    assert [text for _, found in groups for text in found.to_pylist()] == 2 * texts


def test_forgotten_parts_are_learned_again(pooled, tokenizer, monkeypatch):
    monkeypatch.setattr(pooled_tokens, "MOST_PARTS", 40)
    draw = random.Random(2)
    for _ in range(60):
        texts = ["".join(draw.choices(SIGNS + [" enhe", " onthe", "x" * 80], k=40)) for _ in range(4)]
        assert by_text(pooled, texts) == whole(texts, tokenizer)
        pooled._forget()
        assert len(pooled.known) <= 20 and len(pooled.starts) <= 21


def test_parts_are_found_by_their_bytes(monkeypatch):
    draw = random.Random(8)
    parts = sorted({bytes(draw.choices(b"\0ab", k=draw.randrange(1, 16))) for _ in range(4000)}) + [b"a" * 15, b"b" * 8, b"b" * 8 + b"\0"]
    parts = sorted(set(parts))
    for spreads in (pooled_tokens._SPREADS, np.zeros(3, np.uint64)):
        # Without a spread all parts meet in one slot.
        monkeypatch.setattr(pooled_tokens, "_SPREADS", spreads)
        own = parts if spreads.any() else parts[::40]
        sizes = np.array([len(part) for part in own])
        data = np.frombuffer(b"".join(own) + b"\xff" * 16, np.uint8)
        low, high = pooled_tokens.narrow_keys(data, np.cumsum(sizes) - sizes, sizes)
        table = pooled_tokens.PartTable(np.zeros(1, np.uint64), np.zeros(1, np.uint64))
        half = len(own) // 2
        table.add(low[:half], high[:half])
        assert table.find(low, high).tolist() == [*range(1, half + 1), *[-1] * (len(own) - half)]
        table.add(low[half:], high[half:])
        assert table.find(low, high).tolist() == list(range(1, len(own) + 1))


def test_each_part_is_encoded_once_whatever_stands_after_it(tokenizer):
    pooled = token_files.load_tokenizer.__wrapped__(None)[0]
    given, encode = [], pooled.encode
    pooled.encode = lambda texts: given.extend(texts) or encode(texts)
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefgh", k=8)) for _ in range(200)]
    texts = [" ".join(draw.choice(words) + draw.choice(["", ".", ",", ";", "!", "***", ".\nA"]) for _ in range(300)) for _ in range(40)]
    assert by_text(pooled, texts) == whole(texts, tokenizer)
    # At most every word once with and once without its space, and the signs.
    assert sum(map(len, given)) < 2 * 9 * len(words) + 200
    given.clear()
    assert by_text(pooled, texts[::-1]) == whole(texts[::-1], tokenizer) and not given


def test_rounds_count_what_changed(monkeypatch):
    draw = np.random.default_rng(4)
    words = [draw.integers(0, 3000, draw.integers(2, 7)) for _ in range(20000)]
    chosen = np.minimum(draw.zipf(1.2, 40000), len(words)) - 1
    ids = np.concatenate([words[number] for number in chosen]).astype(np.uint32)
    counted, frequent = [], repair._frequent
    monkeypatch.setattr(repair, "_frequent", lambda keys, *others: counted.append(len(keys)) or frequent(keys, *others))
    grammar = repair.compress(ids, 3000)
    assert (repair.expand(grammar, 3000) == ids).all()
    assert sum(counted) < 4 * len(ids)
    left = np.stack([grammar.symbols[:-1], grammar.symbols[1:]], axis=1)
    assert np.unique(left, axis=0, return_counts=True)[1].max() < 2 * repair.LEAST_USES


def test_sorted_places_are_the_same_for_wide_and_narrow_keys():
    keys = np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint64)
    for least in (4, 20):
        narrow, wide = repair._frequent(keys, 20, least), repair._frequent(keys, 64, least)
        assert all((np.asarray(one) == np.asarray(other)).all() for one, other in zip(narrow, wide, strict=True))


def test_limits_that_rise_again(monkeypatch):
    # With few counters pairs share them, and a later round's limit may be above an earlier one's.
    monkeypatch.setattr(repair, "_SLOT_BITS", 3)
    monkeypatch.setattr(repair, "ROUND_SHARE", 4)
    draw, limits, frequent = np.random.default_rng(0), [], repair._frequent

    def noted(*given):
        found = frequent(*given)
        limits.append(found[3])
        return found

    monkeypatch.setattr(repair, "_frequent", noted)
    rising = 0
    for _ in range(30):
        words = [draw.integers(0, 60, draw.integers(2, 9)) for _ in range(80)]
        ids = np.concatenate([words[min(number, 80) - 1] for number in draw.zipf(1.3, int(draw.integers(300, 2000)))]).astype(np.uint32)
        limits.clear()
        grammar = repair.compress(ids, 60)
        rising += any(limit > repair.LEAST_USES for limit in limits[limits.index(repair.LEAST_USES):])
        assert (repair.expand(grammar, 60) == ids).all()
        left = np.stack([grammar.symbols[:-1], grammar.symbols[1:]], axis=1)
        assert np.unique(left, axis=0, return_counts=True)[1].max(initial=0) < 2 * repair.LEAST_USES
    assert rising
