import re

import numpy as np

from feedlens.llm.decontaminate import contamination, decontaminated, prepare_items, suffix_array, words
from tests.llm.conftest import rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    result = []
    for doc, text in docs:
        own, hit, found = split(text), set(), set()
        for name, item in items:
            parts = split(item)
            size = min(13, len(parts))
            for start in range(len(parts) - size + 1 if parts else 0):
                for at in range(len(own) - size + 1):
                    if own[at:at + size] == parts[start:start + size]:
                        hit.update(range(at, at + size))
                        found.add("NULL" if name is None else str(name))
        result.append((doc, len(own), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(result, key=str)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def cases(invented):
    base = [invented(seed, 40, 12) for seed in range(6)]
    items = [(1, base[0]), (2, base[1] + " tail"), (3, "Short Item"), (4, ""), (5, None), (None, base[2]), (7, "É ü 9"), (1, base[3]), (10, invented(3, 12, 12)), (11, base[4])]
    docs = [base[0], "start " + base[1].upper() + " end", invented(50, 400, 12), "a short, item b", None, "", "é ü 9 É ü 9", base[2] + "\n" + base[2],
            " ".join(base) + " " + invented(9, 3000), "short", " ".join(split(base[4])[:13]) + " " + invented(8, 230), invented(60, 30_000, 12)]
    return docs, items


def test_equals_brute_force(spark, make_documents, invented):
    docs, items = cases(invented)
    frame = make_documents(docs)
    expected = brute(list(enumerate(docs)), items)
    names = ("doc_id", "n_words", "n_hit", "items", "contaminated")
    assert rows_of(contamination(frame, bench(spark, items)), *names) == expected
    # Small shards and several blocks of the benchmark give the same.
    assert rows_of(contamination(frame, bench(spark, items), block_bytes=300, shard_words=50), *names) == expected


def test_longest_matches_and_places(spark, make_documents, invented):
    item = invented(1, 40)
    text = "before it " + " ".join(item.split()[5:30]) + " after " + item
    [row] = contamination(make_documents([text]), bench(spark, [(8, item)])).collect()
    assert [tuple(match) for match in row.matches] == [("8", 5, 2, 25), ("8", 0, 28, 40)]


def test_suffix_array_is_sorted_and_complete():
    tests = prepare_items([("x", b"a b c a b c a b c a b c a b c"), ("y", b"b c")])
    numbers = np.array([tests.vocabulary.get(word, 0) for word in words(b"a b c z b c a b a b c a b c a b c a b c a")], np.uint32)
    starts, suffixes = suffix_array(numbers, tests.least)
    assert [tuple(row) for row in suffixes] == sorted(tuple(row) for row in suffixes)
    assert set(starts) >= {at for at in range(len(numbers) - 1) if numbers[at] == 2 and numbers[at + 1] == 3}


def test_affected_documents_go_and_columns_stay(spark, make_documents, invented):
    docs, items = cases(invented)
    frame = make_documents(docs).selectExpr("*", "1 AS n_words", "2 AS hit", "'m' AS matches")
    kept = decontaminated(frame, bench(spark, items))
    assert kept.columns == frame.columns
    expected = [row[0] for row in brute(list(enumerate(docs)), items) if not row[4]]
    assert sorted(row.doc_id for row in kept.collect()) == sorted(expected)
    assert {row.n_words for row in kept.select("n_words").collect()} == {1}


def test_empty_tables_and_repeats(spark, make_documents, invented):
    docs, items = cases(invented)
    frame = make_documents([(3, docs[0], "a"), (3, docs[0], "a"), (None, docs[0], None)])
    assert [row.n_hit for row in contamination(frame, bench(spark, items)).collect()] == [40] * 3
    assert contamination(frame.limit(0), bench(spark, items)).count() == 0
    assert {row.n_hit for row in contamination(frame, bench(spark, items).limit(0)).collect()} == {0}
