"""The norm-bounded search against the full product."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.operators import inner_product as P


def brute(users, items, read, top):
    found = {}
    for user, vector in users.items():
        scores = [(-float(np.dot(vector, other)), item) for item, other in items.items() if (user, item) not in read]
        found[user] = [(item, -score) for score, item in sorted(scores)[:top]]
    return found


def frames(spark, users, items, read):
    return (
        spark.createDataFrame([(user, [float(x) for x in vector]) for user, vector in users.items()], "user_id long, features array<float>"),
        spark.createDataFrame([(item, [float(x) for x in vector]) for item, vector in items.items()], "article_id long, features array<float>"),
        spark.createDataFrame(sorted(read), "user_id long, article_id long"),
    )


@pytest.mark.parametrize("group", [7, 50, 1000])
def test_equals_the_full_product(spark, group):
    draw = np.random.default_rng(3)
    # Whole numbers, so that ties are exact.
    users = {number * 10**10: draw.integers(-3, 4, 4) for number in range(40)}
    items = {number + 5: draw.integers(-3, 4, 4) * (20 if number % 9 == 0 else 1) for number in range(200)}
    read = {(user, item) for user in users for item in items if draw.random() < 0.2} | {(0, item) for item in items}
    lists = P.searched(*frames(spark, users, items, read), 6, group).collect()
    found = {row["user_id"]: list(zip(row["items"], row["scores"], strict=True)) for row in lists}
    assert found == brute(users, items, read, 6) and found[0] == []


def test_few_products_on_skewed_lengths(spark):
    draw = np.random.default_rng(4)
    users = {number: draw.random(8) for number in range(50)}
    items = {number: draw.random(8) / (1 + number) for number in range(20_000)}
    rows = P.searched(*frames(spark, users, items, {(0, 0)}), 10).collect()
    made = sum(row["scored"] for row in rows)
    assert len(rows) == 50 and made <= 50 * 20_000 / 4, made


def test_more_users_are_more_tasks(spark, monkeypatch):
    rounds, write = [], P.written_table

    def noted(df, name):
        if name == "search-round":
            rounds.append(df.groupBy(F.spark_partition_id()).count().collect())
        return write(df, name)

    monkeypatch.setattr(P, "written_table", noted)
    monkeypatch.setattr(P, "DEALT", 50)
    users = {number: [1, number % 3] for number in range(1000)}
    items = {number: [5 - number % 5, 1] for number in range(20)}
    lists = P.searched(*frames(spark, users, items, {(1, 1)}), 2, 8).collect()
    assert len(lists) == 1000 and len(rounds) > 1
    assert len(rounds[0]) > 10 and max(row["count"] for row in rounds[0]) < 100


def test_empty_and_missing(spark):
    users, items, read = frames(spark, {1: [1, 2]}, {7: [1, 1]}, set())
    assert [row["article_id"] for row in P.top_by_inner_product(users, items, read, 3).collect()] == [7]
    assert P.top_by_inner_product(users.limit(0), items, read, 3).collect() == []
    assert P.top_by_inner_product(users, items.limit(0), read, 3).collect() == []
    odd = users.unionByName(spark.createDataFrame([(None, [1.0, 1.0]), (2, None)], users.schema))
    assert {row["user_id"] for row in P.top_by_inner_product(odd, items.withColumn("extra", F.lit(1)), read, 3).collect()} == {1}
