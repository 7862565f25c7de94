import random

import pytest
from pyspark.sql import functions as F

from feedlens.operators.ranking import first_free_positions, left_join_spread, paged, top_per_key, with_positions


def test_positions_equal_row_number_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(0 if i % 3 else rng.randrange(50), rng.randrange(20), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k INT, score INT, id INT").repartition(7)
    got = {(r.k, r.id): r.position for r in
           with_positions(df, ["k"], [F.desc("score"), F.asc("id")]).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], r[2]))
        want.update({(key, r[2]): n for n, r in enumerate(group, start=1)})
    assert got == want


def test_positions_without_keys(spark):
    df = spark.range(1000).repartition(5)
    got = with_positions(df, [], [F.desc("id")]).collect()
    assert all(r.position == 1000 - r.id for r in got)


def brute_free(taken, n):
    free, position = [], 1
    while len(free) < n:
        if position not in taken:
            free.append(position)
        position += 1
    return free


@pytest.mark.parametrize("block", [8, 1 << 14])
@pytest.mark.parametrize("seed", range(3))
def test_first_free_positions(spark, block, seed):
    rng = random.Random(seed)
    taken = {
        1: set(range(1, 101)),                       # read everything
        2: set(),
        3: {1, 2, 3, 50, 51},
        4: set(range(2, 90)),
        5: set(rng.sample(range(1, 101), 60)),
        6: set(rng.sample(range(1, 101), 95)),
        7: {100},
    }
    rows = [(owner, position) for owner, places in taken.items() for position in places]
    rng.shuffle(rows)
    marks = spark.createDataFrame(rows, "owner INT, position BIGINT").repartition(3)
    owners = spark.createDataFrame([(o,) for o in taken], "owner INT")
    found = first_free_positions(marks, owners, ["owner"], 4, block=block)
    got = {}
    for row in found.collect():
        got.setdefault(row.owner, []).append(row.position)
    assert {o: sorted(p) for o, p in got.items()} == {o: brute_free(p, 4) for o, p in taken.items()}


def test_top_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 2)
    plan = top_per_key(df, ["k"], [F.desc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_paged(spark):
    df = spark.range(25)
    page = paged(df, [F.desc("id")], 10, 20).collect()
    assert [r.id for r in page] == [4, 3, 2, 1, 0] and {r.total for r in page} == {25}
    assert "CartesianProduct" not in paged(df, [F.desc("id")], 10)._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        paged(df, [F.desc("id")], 0)


def test_rows_without_a_key_are_dealt_over_the_tasks(spark):
    """A third of the rows without a key, and no broadcast: no task holds them all, and nothing is lost."""
    left = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN id % 500 END AS key")
    right = spark.range(400).selectExpr("id AS other", "id * 2 AS value")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = left_join_spread(left, right, "key", "other", "id")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        rows = {(r.id, r.value) for r in joined.collect()}
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    assert max(sizes) < 2 * sum(sizes) / 16
    assert rows == {(n, 2 * (n % 500) if n % 3 and n % 500 < 400 else None) for n in range(30_000)}


def test_positions_keep_rows_without_a_key(spark):
    rows = spark.createDataFrame([(None, 3), (None, 1), (1, 2), (1, 5)], "key INT, value INT")
    got = with_positions(rows, ["key"], [F.asc("value")])
    assert sorted((r.key or 0, r.value, r.position) for r in got.collect()) == [(0, 1, 1), (0, 3, 2), (1, 2, 1), (1, 5, 2)]
