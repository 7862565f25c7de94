import hashlib
import random
import re

import numpy as np

from feedlens.llm import personal_data
from feedlens.llm.boosting import fit_logistic, fit_trees, precision_threshold, score_logistic, score_trees
from feedlens.llm.personal_data import find_personal_data, known_spans, personal_report, redacted


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def brute(text):
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(len(part.lstrip("0")) < 4 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return spans


TEXTS = [
    None, "", "a@b.c a@b @b.c x@y.z.w@q.r a..b@c-d.e_f g@h.i", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.4 1.2.3", "4692819832630923 4692-8198 3263 0923 1234567890123",
    "+1 (555) 123-4567 +12 +1((((((2 ++44 20 7946 0958", "é x@y.zz \U0001F600 10.0.0.1", "000000000000000000000.1.1.1", "9" * 40, "0" * 5000 + ".1.2.3 " + "0" * 9000 + "255.0.0." + "0" * 6000,
]


def test_known_forms_equal_brute_force():
    draw = random.Random(2)
    pieces = ["a", "b.c", "@", ".", "-", " ", "1", "23", "255", "+", "(", ")", "4692819832630923", "é", "_", "\n", "%"]
    for text in TEXTS + ["".join(draw.choice(pieces) for _ in range(draw.randrange(30))) for _ in range(3000)]:
        assert known_spans(text or "") == brute(text or ""), text


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "a" * 100_000 + "@b.c", "1." * 100_000, "+1" + "(" * 100_000):
        known_spans(text)


def test_report(spark, make_documents):
    for row in personal_report(make_documents(TEXTS)).collect():
        joined = ",".join(f"{kind}:{start}:{end}" for kind, start, end in brute(TEXTS[row.doc_id] or ""))
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and row.spans.startswith(joined)


def training(number, draw):
    """Contact lines; every fourth has a card number that fails its check."""
    digits = "".join(str(draw.randrange(10)) for _ in range(15))
    digits += next(str(check) for check in range(10) if luhn(digits + str(check)))
    return f"row {number} pay by card {digits} now, mail to n{number}@mail.example.com, version {draw.randrange(10**9, 10**10)} page"


def test_trees_add_candidates_like_the_known_and_no_others(spark, make_documents):
    draw = random.Random(4)
    texts = [training(number, draw) for number in range(400)]
    spoiled = "row 9 pay by card 4692819832630924 now, mail to none"
    assert brute(spoiled) == []
    docs = make_documents([*texts, spoiled, "plain words only", "in 1234567 cases of 7654321"])
    rows = {row.doc_id: row for row in find_personal_data(docs).collect()}
    assert [(span.start, span.end) for span in rows[400].other] == [(18, 34)]
    assert not rows[401].other and not rows[402].other and sum(len(rows[number].other) for number in range(400)) == 0


def test_trees_and_thresholds_come_from_all_candidates(spark, make_documents, monkeypatch):
    """Sums per level as numpy over every candidate, also when Spark adds them up."""
    draw = random.Random(5)
    docs = make_documents([training(number, draw) for number in range(300)])
    found = docs.select("doc_id", "text").mapInArrow(personal_data._find, f"doc_id long, base {personal_data.SPAN_TYPE}, candidates {personal_data.CANDIDATE_TYPE}")
    models, seen, add = personal_data.fit(found), [], personal_data.boost
    monkeypatch.setattr(personal_data, "TOGETHER", 0)
    monkeypatch.setattr(personal_data, "boost", lambda sums, *more: add(lambda *tree: seen.append(sums(*tree)) or seen[-1], *more, rounds=3))
    in_tasks = personal_data.fit(found)
    assert models and in_tasks.keys() == models.keys()
    fold = "pmod(xxhash64(doc_id, c.start, c.end), 5) <> 0"
    rows = found.selectExpr("doc_id", "explode(candidates) AS c").where(fold).selectExpr("c.kind", "c.known", "c.features").toPandas()
    counts = {int(cells[0, 0, :, 2].sum()) for cells in seen if len(cells) == 1}
    assert counts == {len(own) for kind, own in rows.groupby("kind") if kind in models}
    for kind, (trees, _) in in_tasks.items():
        own = rows[rows["kind"] == kind]
        plain = fit_trees(np.array(own["features"].tolist()), own["known"].to_numpy(), 3)
        assert np.allclose(np.array(trees[1]), np.array(plain[1]), rtol=0, atol=1e-4)  # sums are rounded per row of bins or per candidate
        assert (trees[0], trees[1]) == (models[kind][0][0], models[kind][0][1][:3])


def test_redaction_covers_all_spans(spark, make_documents):
    rows = {row.doc_id: row.text for row in redacted(make_documents(["write x@y.zz or +1 555 123 4567!", None, "no"])).collect()}
    assert rows == {0: "write [REDACTED] or [REDACTED]!", 1: "", 2: "no"}


def test_empty_table_repeats_and_extra_columns(spark, make_documents):
    docs = make_documents([(None, "x@y.zz", "s"), (1, "x@y.zz", "s"), (1, "x@y.zz", "s")]).selectExpr("*", "1 AS base", "2 AS kind")
    assert [row.spans for row in personal_report(docs).collect()] == ["email:0:6"] * 3
    assert personal_report(docs.limit(0)).count() == 0


def test_boosting_learns_an_interaction():
    draw = np.random.default_rng(0)
    features = draw.random((4000, 3))
    labels = ((features[:, 0] > 0.5) ^ (features[:, 1] > 0.3)).astype(float)
    trees = fit_trees(features[:3000], labels[:3000])
    assert ((score_trees(trees, features[3000:]) > 0.5) == labels[3000:]).mean() > 0.9
    weights = fit_logistic(features, (features[:, 2] > 0.5).astype(float))
    assert ((score_logistic(weights, features) > 0.5) == (features[:, 2] > 0.5)).mean() > 0.97


def test_threshold_is_the_lowest_with_the_precision():
    scores, labels = np.array([0.9, 0.8, 0.8, 0.5, 0.4]), np.array([1.0, 1, 1, 0, 1])
    assert abs(precision_threshold(scores, labels, 0.9) - 0.8) < 1e-6
    assert precision_threshold(scores, 1 - labels, 0.9) is None
