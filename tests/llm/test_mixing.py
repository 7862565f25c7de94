import re

from feedlens.llm.mixing import mix, mixed_documents, source_targets, word_count
from tests.llm.conftest import rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), share=1.5):
    """Sharing by rounds until none is above its cap."""
    names = sorted(sizes, key=lambda name: (name is None, name))
    weight = {name: weights[number % 3] for number, name in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[name] for name in open_)
        above = {name for name in open_ if left * weight[name] / total > 2 * sizes[name]}
        if not above:
            return target | {name: left * weight[name] / total for name in open_}
        for name in above:
            target[name] = 2 * sizes[name]
        left -= sum(2 * sizes[name] for name in above)
        open_ -= above
    return target


def test_targets_equal_sharing_by_rounds(spark):
    for sizes in ({"a": 10, "b": 500, "c": 30, "d": 7, None: 90}, {"a": 1}, {"a": 0, "b": 5}, {f"s{n}": (n * 37) % 101 for n in range(12)}):
        rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
        found = {row.source: row.target for row in source_targets(rows).collect()}
        expected = brute_targets(sizes)
        assert found.keys() == expected.keys()
        assert all(abs(found[name] - expected[name]) < 1e-6 for name in found)


def test_taken_words_meet_targets(spark, make_documents, invented):
    docs = make_documents([(n, invented(n, 1 + n % 50), f"s{n % 7}" if n % 11 else None) for n in range(600)])
    result = mix(docs).collect()
    for source in {row.source for row in result}:
        own = [row for row in result if row.source == source]
        assert sum(row.taken for row in own) == int(own[0].target)
        assert all(0 <= row.taken <= 2 * row.size for row in own)
    assert rows_of(mix(docs), "doc_id", "taken") == rows_of(mix(docs), "doc_id", "taken")


def test_mixed_documents_hold_the_taken_words(spark, make_documents, invented):
    docs = make_documents([(n, invented(n, 1 + n % 50).replace(" ", "\n ", 3), f"s{n % 7}") for n in range(300)])
    taken = {row.doc_id: row.taken for row in mix(docs).collect()}
    words, texts = {}, {row.doc_id: row.text for row in docs.collect()}
    mixed = mixed_documents(docs)
    assert mixed.schema.simpleString() == docs.schema.simpleString()
    for row in mixed.collect():
        words[row.doc_id] = words.get(row.doc_id, 0) + len(WORD.findall(row.text))
        assert texts[row.doc_id].startswith(row.text) and row.n_chars == len(row.text)
    assert words == {doc: count for doc, count in taken.items() if count}


def test_nulls_repeats_and_empty_tables(spark, make_documents):
    docs = make_documents([(1, None, "a"), (2, "", "a"), (3, "x y", None), (None, "one two three", "b")] + [(9, "same words here", "b")] * 4)
    result = mix(docs)
    assert {(row.doc_id, row.taken) for row in result.collect() if row.size == 0} == {(1, 0), (2, 0)}
    copies = [row.taken for row in result.collect() if row.doc_id == 9]
    assert len(copies) == 4 and len(set(copies)) == 1
    assert mixed_documents(docs).count() > 0
    assert mix(docs.limit(0)).count() == 0 and mixed_documents(docs.limit(0)).count() == 0
    only_empty = make_documents([(1, None, "a"), (2, " \t", "b")])
    assert rows_of(mix(only_empty), "doc_id", "taken") == [(1, 0), (2, 0)]


def test_extra_columns_with_clashing_names(spark, make_documents):
    docs = make_documents(["a b c", "d e"]).selectExpr("*", "1 AS size", "2 AS target", "3 AS key", "'x' AS epochs")
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns and {row["size"] for row in mixed.collect()} == {1}


def test_words_are_runs_between_ascii_white_space(spark):
    texts = ["a b c", "\x0bx\x1fy\x1c", " \t\n", "", "é ü\r\nß"]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    assert [row[0] for row in frame.select(word_count(frame.text)).collect()] == [len(WORD.findall(text)) for text in texts]
