import random
import time
import zlib

import numpy as np
import pytest

from feedlens.llm import lexicon
from feedlens.llm.lexicon import FuzzyTrie, most_edits
from feedlens.llm.toxicity import Lexicon, choose_lexicon, features, learn, scored, toxicity_report, without_toxic
from tests.llm.conftest import rows_of


def distance(one, two):
    row = list(range(len(two) + 1))
    for place, letter in enumerate(one, 1):
        last, row[0] = row[0], place
        for at, other in enumerate(two, 1):
            last, row[at] = row[at], min(row[at] + 1, row[at - 1] + 1, last + (letter != other))
    return row[-1]


def brute_find(terms, word):
    best = None
    for number, term in enumerate(terms):
        plain = term.rstrip("*")
        ends = [word[:length] for length in range(len(word) + 1)] if term.endswith("*") else [word]
        edits = min(distance(end, plain) for end in ends)
        if edits <= most_edits(plain):
            best = min(best or (edits, number), (edits, number))
    return best


def test_automata_equal_edit_distance():
    draw = random.Random(7)
    terms = ["abcab", "bcabca", "aaaa", "abc*", "bbcca*", "cabcabcabc", "caabcbacba*", "é" * 6]
    trie = FuzzyTrie(terms)
    for _ in range(4000):
        word = "".join(draw.choice("abcdé") for _ in range(draw.randrange(13)))
        found, expected = trie.find(word), brute_find(terms, word)
        assert (found and found[0]) == (expected and expected[0]), (word, found, expected)
        if found:
            plain = terms[found[1]].rstrip("*")
            ends = [word[:length] for length in range(len(word) + 1)] if terms[found[1]].endswith("*") else [word]
            assert min(distance(end, plain) for end in ends) == found[0]


INSULTS = ["blockhead", "nitwit", "dunderhead"]


def corpus(number=900):
    draw = random.Random(3)
    rows, labels = [], []
    for doc in range(number):
        words = [f"word{draw.randrange(400)}" for _ in range(draw.randrange(5, 60))]
        toxic = doc % 5 == 0
        if toxic:
            for _ in range(draw.randrange(1, 4)):
                words.insert(draw.randrange(len(words)), "you " + draw.choice(INSULTS))
        elif doc % 17 == 0:
            words.insert(draw.randrange(len(words)), f'he said "{draw.choice(INSULTS)}" according')
        rows.append((doc, " ".join(words), f"s{doc % 3}"))
        labels.append((doc, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark, make_documents):
    rows, labels = corpus()
    return make_documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_documents(spark, tables):
    documents, labels = tables
    toxic = {row.doc_id: row.toxic for row in labels.collect()}
    rows = [row for row in toxicity_report(documents, labels).collect()]
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in rows)
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.7) for row in rows)
    held = [row for row in rows if row.held_out]
    assert sum(row.predicted == toxic[row.doc_id] for row in held) / len(held) > 0.97


def test_misspellings_and_quotations(spark, tables, make_documents):
    documents, labels = tables
    model = learn(documents, labels)
    texts = ["you blockhaed", "you nitwlt go", "such a dunderheads", 'he said "blockhead" according', "plain words only", None, "", "BLOCKHEAD"]
    scores = {row.doc_id: row.score for row in scored(make_documents(texts), model, ["doc_id"]).collect()}
    assert min(scores[1], scores[2], scores[7]) > 0.7 > max(scores[3], scores[4], scores[5])
    assert scores[5] == scores[6] == scores[4]


def test_rare_and_short_terms_are_learned(spark, make_documents):
    draw = random.Random(5)
    rows, labels = [], []
    for doc in range(12_000):
        words = [f"word{draw.randrange(60)}" for _ in range(8)]
        if doc % 3 == 0:
            # 101 terms, each in less than a hundredth of the toxic documents; and one word of three letters.
            words.insert(draw.randrange(8), "zug" if doc % 30 == 0 else f"{doc % 101:03d}slur")
        rows.append((doc, " ".join(words), "s"))
        labels.append((doc, int(doc % 3 == 0)))
    model = learn(make_documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {"zug"} | {f"{number:03d}slur" for number in range(101)} <= set(model.lexicon.odds)
    assert not any(term.startswith("word") for term in model.lexicon.odds)
    scores = {row.doc_id: row.score for row in scored(make_documents(["word1 zug", "word2 057slur", "word3 word4"]), model, ["doc_id"]).collect()}
    assert min(scores[0], scores[1]) > 0.7 > scores[2]


def test_more_terms_than_a_fixed_number_stay():
    toxic = {f"t{number}": 50 for number in range(5000)}
    stems = {"glor*": 90, "glorab": 50, "glorix": 45, "fnord*": 60, "fnordy": 58}
    assert set(choose_lexicon(stems, dict.fromkeys(stems, 0), 1000, 1000)) == {"glor*", "fnordy"}
    assert len(choose_lexicon(toxic, dict.fromkeys(toxic, 0), 1000, 1000)) == 5000


def test_forgotten_states_change_nothing(monkeypatch):
    monkeypatch.setattr(lexicon, "MOST_KEPT", 40)
    test_automata_equal_edit_distance()


def test_quotation_is_judged_by_occurrence(spark, tables, make_documents):
    found = Lexicon({"blockhead": 5.0}).finder()

    def counted(text):
        exact, quoted = (np.expm1(features(text.encode(), found, [5.0])[at]) for at in (1, 4))
        return round(exact), round(quoted)

    far = "and so on for a while, "
    assert counted(f'"blockhead" was there, {far} you blockhead, {far} blockhead') == (2, 1)
    assert counted(f'a 5" pipe, you blockhead, {far} blockhead') == (2, 0)
    assert counted(f'"an open mark, you blockhead, {far} "an old one" blockhead') == (2, 0)
    assert counted('"' + far * 40 + 'blockhead" and more') == (0, 1)
    assert counted('“you blockhead” «blockhead» „blockhead“ blockhead “blockhead') == (2, 3)
    assert counted('" blockhead " ("blockhead") blockhead" "blockhead\nblockhead"') == (3, 2)
    model = learn(*tables)
    texts = [f'there is "blockhead", {far} you blockhead and you blockhead', 'the 5" pipe for you blockhead', 'there is "blockhead" in it']
    scores = {row.doc_id: row.score for row in scored(make_documents(texts), model, ["doc_id"]).collect()}
    assert min(scores[0], scores[1]) > 0.7 > scores[2]


def test_held_out_labels_are_never_read(spark, tables):
    documents, labels = tables
    from pyspark.sql import functions as F
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    names = ("doc_id", "predicted")
    assert rows_of(toxicity_report(documents, labels), *names) == rows_of(toxicity_report(documents, other), *names)


def test_toxic_documents_go_and_columns_stay(spark, tables):
    documents, labels = tables
    frame = documents.selectExpr("*", "1 AS score", "'t' AS toxic")
    kept = without_toxic(frame, labels)
    predicted = {row.doc_id for row in toxicity_report(documents, labels).collect() if row.predicted}
    assert kept.columns == frame.columns and {row.doc_id for row in kept.collect()} == set(range(900)) - predicted


def test_without_labels_and_empty_tables(spark, tables, make_documents):
    documents, labels = tables
    assert {row.score for row in toxicity_report(documents, labels.limit(0)).collect()} == {0.0}
    assert {row.score for row in toxicity_report(documents, labels.selectExpr("doc_id", "1 AS toxic")).collect()} == {1.0}
    assert toxicity_report(documents.limit(0), labels).count() == 0
    odd = make_documents([(None, "you blockhead", "s"), (1, "a", "s"), (1, "a", "s")])
    more = labels.unionByName(spark.createDataFrame([(None, 1), (1, None), (1, 0), (1, 1)], "doc_id long, toxic int"))
    assert len(toxicity_report(odd, more).collect()) == 3


def test_long_quotations_are_quotations():
    found = Lexicon({"blockhead": 5.0}).finder()
    for opens, closes in ('""', "“”", "«»", "„”"):
        for filler in ("and so on ", "и так далее "):
            text = f"{opens}a blockhead {filler * 3000}the end{closes} he wrote on, {filler}{filler} you blockhead"
            values = features(text.encode(), found, [5.0])
            assert (round(np.expm1(values[1])), round(np.expm1(values[4]))) == (1, 1)
    start = time.time()
    features(('"a blockhead ' * 100_000).encode(), found, [5.0])
    features(("“ blockhead " * 100_000).encode(), found, [5.0])
    assert time.time() - start < 60
