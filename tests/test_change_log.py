"""The replay against applying the changes one after another."""

from __future__ import annotations

import random

import pytest

from feedlens.operators.change_log import replay_changes

ARTICLES = "article_id long, title string, source_url string, category_id long"
CHANGES = "order_no long, op string, article_id long, title string, source_url string, category_id long, set_fields array<string>"


def sequential(articles, changes, categories):
    table = {row[0]: list(row) for row in articles}
    refused = {}
    for order_no, op, article, title, url, category, names in sorted(changes):
        sets = {"title", "source_url", "category_id"} if op == "create" else set(names or ()) if op == "patch" else set()
        if (op == "create") == (article in table):
            refused[order_no] = "article_exists" if op == "create" else "article_not_found"
        elif "category_id" in sets and category is not None and category not in categories:
            refused[order_no] = "category_not_found"
        elif "source_url" in sets and url is not None and any(row[2] == url for own, row in table.items() if own != article):
            refused[order_no] = "source_url_taken"
        elif op == "delete":
            del table[article]
        elif op == "create":
            table[article] = [article, title, url, category]
        else:
            for place, name, value in ((1, "title", title), (2, "source_url", url), (3, "category_id", category)):
                if name in sets:
                    table[article][place] = value
    return sorted(map(tuple, table.values()), key=str), refused


def replayed(spark, articles, changes, categories):
    after, refused = replay_changes(
        spark.createDataFrame(articles, ARTICLES), spark.createDataFrame(changes, CHANGES),
        spark.createDataFrame([(number,) for number in categories], "category_id long"),
    )
    return sorted((tuple(row) for row in after.collect()), key=str), {row["order_no"]: row["conflict"] for row in refused.collect()}


def test_a_freed_url_may_be_claimed(spark):
    articles = [(1, "a", "u", 1), (2, "b", "v", 1)]
    changes = [
        (10, "patch", 2, None, "u", None, ["source_url"]),  # still held by 1
        (20, "patch", 1, None, "w", None, ["source_url"]),
        (30, "patch", 2, None, "u", None, ["source_url"]),
        (40, "create", 3, "c", "v", 1, None),
        (50, "delete", 2, None, None, None, None),
        (60, "create", 2, "again", "u", 9, None),  # unknown category
        (70, "patch", 1, "t", "u", None, ["source_url", "title"]),
    ]
    after, refused = replayed(spark, articles, changes, {1})
    assert refused == {10: "source_url_taken", 60: "category_not_found"}
    assert after == [(1, "t", "u", 1), (3, "c", "v", 1)]


def test_a_refusal_that_frees_claims(spark):
    """1 cannot take v, so it keeps u, so 3 cannot take u, so 3 keeps w, and so on."""
    articles = [(number, "t", f"u{number}", 1) for number in range(6)]
    changes = [(number, "patch", number, None, f"u{number + 1}", None, ["source_url"]) for number in range(5)]
    changes.append((-1, "patch", 5, None, "u0", None, ["source_url"]))
    after, refused = replayed(spark, articles, changes, {1})
    assert (after, refused) == sequential(articles, changes, {1}) and len(refused) == 6


@pytest.mark.parametrize("seed", range(3))
def test_random_logs(spark, seed):
    draw = random.Random(seed)
    urls = [None, *[f"u{number}" for number in range(8)]]
    articles = [(number, "old", f"u{number}", draw.choice([1, 2])) for number in range(5)]
    changes = []
    for order_no in draw.sample(range(1000), 120):
        op = draw.choice(["create", "patch", "patch", "patch", "delete"])
        names = draw.choice([["source_url"], ["title"], ["source_url", "title", "category_id"], [], None])
        changes.append((order_no, op, draw.randrange(9), f"t{order_no}", draw.choice(urls), draw.choice([None, 1, 2, 2, 9]), names))
    assert replayed(spark, articles, changes, {1, 2}) == sequential(articles, changes, {1, 2})
    assert replayed(spark, articles, [], {1, 2}) == (sorted(articles, key=str), {})


def test_new_articles_of_the_log_query_meet_no_old_ones(spark):
    """The ids that the SQL gives to new articles may be taken: it still has them as new ones."""
    from types import SimpleNamespace

    from feedlens.plans import change_queries as Q

    ids = [*range(1, 9), 16, Q._NEW + 16]
    rows = [(number, f"t{number}", f"https://example.com/a/{number - 1}", 1) for number in ids]
    t = SimpleNamespace(
        articles=spark.createDataFrame(rows, ARTICLES), categories=spark.createDataFrame([(1,), (2,)], "category_id long"),
    )
    refused = {(row["order_no"], row["conflict"]) for row in Q.log_conflicts(t).collect()}
    assert refused == {(30, "source_url_taken"), (41, "source_url_taken"), (70, "source_url_taken")}
    new = [(row["article_id"], row["source_url"]) for row in Q.log_result(t).collect() if row["title"] == "new"]
    # Article 16 is replaced under the id that _NEW + 16 has, and that one in its turn.
    assert sorted(new) == [(Q._NEW + 8, rows[7][2]), (Q._NEW + 16, rows[8][2]), (2 * Q._NEW + 16, rows[9][2])]
