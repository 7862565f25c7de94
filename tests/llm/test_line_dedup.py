import hashlib
import random

import numpy as np

from feedlens.llm import line_dedup
from feedlens.llm.line_dedup import dedupe_lines, line_report, twice_seen_filter
from tests.llm.conftest import rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return line.strip(" \t\n\v\f\r").translate(LOWER)


def brute(rows, least=40, documents=5):
    owners = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= least:
                owners.setdefault(key_of(line), set()).add(doc)
    keeper = {key: max((doc for doc in docs if doc is not None), default=None) for key, docs in owners.items() if len(docs) >= documents}
    result = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if key_of(line) not in keeper or (doc is not None and keeper[key_of(line)] == doc)]
        result.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(result, key=str)


def test_equals_brute_force(spark, make_documents):
    draw = random.Random(1)
    common = ["C" * 39 + str(n) for n in range(3)] + ["É" * 40, "é" * 20, "x" * 39, "License line with more than forty characters, really"]
    rows = []
    for doc in range(120):
        lines = [draw.choice(common) if draw.random() < 0.4 else f"line {draw.randrange(60)} " + "y" * 50 for _ in range(draw.randrange(8))]
        lines = [draw.choice(["", " ", "\t"]) + (line.upper() if draw.random() < 0.3 else line) + draw.choice(["", "\r", "\x0b"]) for line in lines]
        rows.append((doc, "\n".join(lines), "s"))
    rows += [(200, None, "s"), (201, "", "s"), (None, common[0] + "\n" + common[1], "s"), (202, ("A" * 60_000 + "\n") * 3, "s")]
    found = rows_of(dedupe_lines(make_documents(rows)), "doc_id", "n_lines", "n_dropped", "text")
    assert found == brute([row[:2] for row in rows])


def test_repeated_rows_are_one_document(spark, make_documents):
    line = "the same line of more than forty characters here"
    docs = make_documents([(1, line, "s")] * 6 + [(2, line, "s"), (3, line, "s"), (4, line, "s")])
    assert {row.n_dropped for row in dedupe_lines(docs).collect()} == {0}
    more = docs.unionByName(make_documents([(5, line + "\n" + line, "s")]))
    assert rows_of(dedupe_lines(more), "doc_id", "n_dropped") == sorted([(1, 1)] * 6 + [(2, 1), (3, 1), (4, 1), (5, 0)], key=str)


def test_a_full_filter_changes_nothing(spark, make_documents, monkeypatch):
    docs = make_documents([f"line number {n % 9} with more than forty characters, yes\nown {n}" + "z" * 60 for n in range(80)])
    expected = rows_of(line_report(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    monkeypatch.setattr(line_dedup, "twice_seen_filter", lambda documents, least: np.full(1 << 13, 255, np.uint8))
    assert rows_of(line_report(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256") == expected


def test_the_filter_holds_every_repeated_key(spark, make_documents):
    texts = [f"line number {n % 40} with more than forty characters, yes" for n in range(100)]
    packed = twice_seen_filter(make_documents(texts).repartition(7))
    assert line_dedup._suspected([text.encode() for text in texts], packed).all()
    alone = [f"another line {n} with more than forty characters, yes".encode() for n in range(1000)]
    assert line_dedup._suspected(alone, packed).mean() < 0.05


def test_empty_tables_and_extra_columns(spark, make_documents):
    docs = make_documents(["a\nb"]).selectExpr("*", "1 AS key", "2 AS n_lines")
    assert rows_of(line_report(docs), "doc_id", "n_lines", "n_dropped") == [(0, 2, 0)]
    assert line_report(docs).first().kept_sha256 == hashlib.sha256(b"a\nb").hexdigest()
    assert line_report(docs.limit(0)).count() == 0
