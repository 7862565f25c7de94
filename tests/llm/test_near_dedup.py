import random

import pytest

from feedlens.llm import near_dedup
from feedlens.llm.components import components
from feedlens.llm.near_dedup import deduplicated, near_duplicates
from tests.llm.conftest import rows_of


def brute(rows, width, percent=80):
    sets = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        sets[doc] = {tuple(words[at:at + width]) for at in range(max(1, len(words) - width + 1))} if words else set()
    label = {doc: doc for doc in sets}

    def root(doc):
        while label[doc] != doc:
            doc = label[doc]
        return doc

    names = [doc for doc in sets if doc is not None]
    for place, one in enumerate(names):
        for two in names[place + 1:]:
            common = len(sets[one] & sets[two])
            if common and 100 * common >= percent * (len(sets[one]) + len(sets[two]) - common):
                a, b = sorted((root(one), root(two)))
                label[b] = a
    return sorted([(doc, len(sets[doc]), root(doc) if doc is not None else None, doc is None or root(doc) == doc) for doc, _ in rows], key=str)


def edited(text, changes, seed):
    words, draw = text.split(), random.Random(seed)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return " ".join(words)


def collection(invented):
    rows = [(number, invented(number, 30 + number % 90)) for number in range(60)]
    base = invented(1000, 150)
    rows += [(100 + number, edited(base, number % 25, number)) for number in range(120)]
    rows += [(300 + number, invented(number % 5, 60).upper()) for number in range(20)]
    rows += [(400, None), (401, ""), (402, " \n"), (403, "one"), (404, "One"), (405, "one two"), (406, "one  two"), (407, invented(7, 20_000)), (408, edited(invented(7, 20_000), 300, 1))]
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(spark, make_documents, invented, width):
    rows = collection(invented)
    docs = make_documents([(doc, text, "s") for doc, text in rows]).repartition(5)
    found = rows_of(near_duplicates(docs, width, block=16), "doc_id", "n_shingles", "component_id", "kept")
    assert found == brute(rows, width)


def test_large_buckets_give_the_same(spark, make_documents, invented, monkeypatch):
    rows = collection(invented)
    docs = make_documents([(doc, text, "s") for doc, text in rows])
    monkeypatch.setattr(near_dedup, "COMPARED", 3)
    found = rows_of(near_duplicates(docs.coalesce(1), 2), "doc_id", "n_shingles", "component_id", "kept")
    assert found == brute(rows, 2)


def test_one_document_of_each_group_stays(spark, make_documents, invented):
    rows = collection(invented) + [(407, invented(7, 20_000))]
    docs = make_documents([(doc, text, "s") for doc, text in rows] + [(None, "no id", "s")] * 2).selectExpr("*", "1 AS digest", "2 AS label")
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    expected = sorted({row[0] for row in brute(rows, 5) if row[3]} | {None}, key=str)
    found = sorted((row.doc_id for row in kept.collect()), key=str)
    assert found == sorted([*expected, None], key=str)


def test_empty_table_and_nulls(spark, make_documents):
    docs = make_documents([(None, "a b c", "s"), (None, "a b c", "s"), (5, None, "s")])
    assert rows_of(near_duplicates(docs, 2), "doc_id", "component_id", "kept") == [(5, 5, True), (None, None, True), (None, None, True)]
    assert near_duplicates(docs.limit(0), 2).count() == 0


def test_components_of_paths_stars_and_cycles(spark):
    links = [(n, n + 1) for n in range(40)] + [(100, 100 + n) for n in range(1, 30)] + [(201, 202), (202, 203), (203, 201), (300, 300)]
    found = {row.id: row.label for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[n] for n in range(41)} == {0} and {found[100 + n] for n in range(30)} == {100}
    assert {found[n] for n in (201, 202, 203)} == {201} and found[300] == 300
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_random_components(spark):
    draw = random.Random(4)
    for size, count in ((60, 50), (300, 200), (40, 400)):
        links = [(draw.randrange(size), draw.randrange(size)) for _ in range(count)]
        label = {}

        def root(node):
            while label.setdefault(node, node) != node:
                node = label[node]
            return node

        for a, b in links:
            one, two = sorted((root(a), root(b)))
            label[two] = one
        found = {row.id: row.label for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert found == {node: root(node) for node in list(label)}


@pytest.mark.parametrize("changes", [1, 4])
def test_links_of_one_group_stay_few(spark, make_documents, invented, changes):
    """2,000 near copies over many partitions: a few links per text of the 40 that its buckets could give."""
    base = invented(77, 200)
    docs = make_documents([(number, edited(base, changes, number), "s") for number in range(2000)]).repartition(60)
    classes = near_dedup.sketched_classes(docs, 5)
    assert near_dedup.candidate_links(classes, 80).count() <= 10 * 2000
    if changes == 1:  # with more, two copies of one text are below the limit
        assert near_duplicates(docs, 5).where("kept").count() == 1


def test_texts_outside_the_largest_part(spark, make_documents, invented):
    """A candidate group of several parts: what the first step leaves out is held against all blocks."""
    rows = [(number, edited(invented(5, 120), 2 + number % 30, number)) for number in range(150)]
    docs = make_documents([(doc, text, "s") for doc, text in rows])
    group = docs.selectExpr("doc_id AS id", "0L AS label")
    expected = {row[0]: row[2] for row in brute(rows, 5)}
    for block in (7, 40):
        found = {row.id: row.label for row in near_dedup.confirmed_parts(docs, group, 5, 80, block).collect()}
        assert {doc: found.get(doc, doc) for doc, _ in rows} == expected
