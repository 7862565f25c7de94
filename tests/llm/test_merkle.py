"""The manifest against a tree built whole in Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from feedlens.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    def cell(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    text = row["text"]
    if lower and text is not None:
        text = "".join(sign.lower() if "A" <= sign <= "Z" else sign for sign in text)
    return sha(cell(row["doc_id"]) + cell(row["source"]) + cell(row["lang"]) + cell(row["n_chars"]) + cell(text))


def root_and_paths(leaves):
    """The root, and per leaf its siblings level by level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for number, place in enumerate(at):
            run = place // 8 * 8
            paths[number].append((level[run:place], level[place + 1:run + 8]))
        level = [sha("".join(level[run:run + 8])) for run in range(0, len(level), 8)]
        at = [place // 8 for place in at]
    return level[0], paths


def brute(rows):
    langs = sorted({row["lang"] for row in rows}, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((row for row in rows if row["lang"] == lang), key=lambda row: (row["doc_id"] is not None, row["doc_id"], leaf(row)))
        trees[lang] = own, *root_and_paths([leaf(row) for row in own])
    root, above = root_and_paths([trees[lang][1] for lang in langs])
    found = []
    for lang, upper in zip(langs, above, strict=True):
        own, subroot, paths = trees[lang]
        for row, path in zip(own, paths, strict=True):
            whole = path + upper
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
            node = leaf(row, tampered)
            for before, after in whole:
                node = sha("".join(before) + node + "".join(after))
            proof = sha("".join("".join(before) + "".join(after) for before, after in whole))
            found.append((row["doc_id"], leaf(row), subroot, root, proof, node, node == root))
    return sorted(found, key=str)


def report(documents):
    return sorted((tuple(row) for row in merkle.manifest_report(documents).collect()), key=str)


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def table(spark):
    def make(sizes):
        rows = []
        for lang, size in sizes.items():
            rows += [(None, f"Text {number} Éa" if number % 5 else None, lang, None if number % 7 == 0 else "s", number) for number in range(size)]
        return spark.createDataFrame([(7 * number % 100_003, *row[1:]) for number, row in enumerate(rows)], COLUMNS)

    return make


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, None: 9, "de": 1}, {"en": 513, "fr": 512, "": 65}, {"en": 4097}])
def test_sizes(table, sizes):
    documents = table(sizes)
    assert report(documents) == brute([row.asDict() for row in documents.collect()])


def test_three_tiers(table):
    """Small blocks, so that one lang needs three tiers."""
    documents = table({"en": 600, "fr": 70, "de": 8, "it": 64})
    found = merkle.versions(documents, steps=1).collect()
    expected = {row[0]: row[1:6] for row in brute([row.asDict() for row in documents.collect()])}
    assert {row["doc_id"]: (row["leaf"], row["subroot"], row["root"], row["proof_sha256"], row["copied"][-1]) for row in found} == expected


def test_many_langs(spark):
    documents = spark.range(700).select(
        F.col("id").alias("doc_id"), F.lit("A b").alias("text"), F.concat(F.lit("l"), (F.col("id") % 530).cast("string")).alias("lang"),
        F.lit("s").alias("source"), F.lit(3).cast("long").alias("n_chars"),
    )
    assert report(documents) == brute([row.asDict() for row in documents.collect()])


def test_nulls_repeats_columns_and_empty(spark):
    rows = [(None, "X", "en", "s", 1), (None, "Y", "en", "s", 1), (3, "Z z", "en", None, None), (3, "Z z", "en", None, None), (3, "", "en", "t", 0),
            (0, None, None, None, None)]
    documents = spark.createDataFrame(rows, COLUMNS).withColumn("leaf", F.lit(1)).withColumn("part", F.lit("p")).withColumn("position", F.lit(0))
    assert report(documents) == brute([row.asDict() for row in documents.collect()])
    assert report(documents.limit(0)) == []


def test_versions_copy_only_their_paths(table):
    documents = table({"en": 700, "fr": 20})
    rows = merkle.versions(documents).collect()
    roots = {row["root"] for row in rows}
    assert len(roots) == 1
    for row in rows:
        depth = (4 if row["part"] == "=en" else 2) + 1
        assert len(row["copied"]) == depth
        changed = row["changed_leaf"] is not None and row["changed_leaf"] != row["leaf"]
        assert (row["copied"][-1] != row["root"]) == changed
