import numpy as np
import pytest

from feedlens.llm import topk
from feedlens.llm.topk import Best, cover_tree, dual_search, exact_pair, nearest, products
from tests.llm.conftest import rows_of


def brute(rows, top, every):
    whole = {}
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(value is None or not np.isfinite(value) for value in vector):
            continue
        whole.setdefault(vec_id, set()).add(tuple(int(np.floor(64 * float(np.float32(value)))) for value in vector))
    result = []
    for query, own in whole.items():
        if query % every:
            continue
        scores = {}
        for other, vectors in whole.items():
            if other != query:
                scores[other] = max(sum(a * b for a, b in zip(one, two)) for one in own for two in vectors)
        best = sorted(scores.items(), key=lambda item: (-item[1], item[0]))[:top]
        result += [(query, rank, other, score) for rank, (other, score) in enumerate(best, 1)]
    return sorted(result, key=str)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


NAMES = ("query_id", "rank", "vec_id", "score")


@pytest.fixture(scope="module")
def some():
    draw = np.random.default_rng(1)
    centers = draw.normal(size=(6, 8))
    rows = [(number, (centers[number % 6] + 0.2 * draw.normal(size=8)).astype("float32").tolist()) for number in range(400)]
    rows += [(1000 + number, rows[5][1]) for number in range(150)]  # a third are equal
    return rows


def test_equals_brute_force(spark, some):
    expected = brute(some, 7, 5)
    assert rows_of(nearest(vectors(spark, some), 7, 5), *NAMES) == expected
    assert rows_of(nearest(vectors(spark, some).repartition(6), 7, 5, query_block=10, seeds=3), *NAMES) == expected


def test_odd_vectors(spark):
    rows = [(0, [0.5, 1.0]), (20, [0.5]), (40, []), (60, None), (80, [None, 1.0]), (100, [float("nan"), 1.0]), (120, [float("inf")]), (None, [1.0, 1.0]),
            (3, [-0.01, 0.3]), (3, [-0.01, 0.3]), (4, [0.3, -2.0]), (0, [0.5, 1.0]), (-20, [1.0, 1.0])]
    assert rows_of(nearest(vectors(spark, rows)), *NAMES) == brute(rows, 20, 20)
    assert nearest(vectors(spark, rows).limit(0)).count() == 0
    assert nearest(vectors(spark, [(1, [1.0])])).count() == 0
    extra = vectors(spark, rows[:3]).selectExpr("*", "1 AS score", "2 AS rank", "3 AS vector")
    assert rows_of(nearest(extra), *NAMES) == brute(rows[:3], 20, 20)


def test_ids_with_several_vectors(spark, some):
    shared = [(5, [1.0, 0.0]), (9, [1.0, 0.0]), (5, [0.0, 1.0]), (20, [1.0, 2.0]), (40, [0.0, 1.0]), (40, [1.0, 0.0])]
    assert rows_of(nearest(vectors(spark, shared)), *NAMES) == brute(shared, 20, 20)
    draw = np.random.default_rng(4)
    rows = some[:200] + [(5 + number % 9, (6 * draw.normal(size=8)).astype("float32").tolist()) for number in range(300)]
    rows += [(number, rows[-1 - number % 40][1]) for number in range(500, 560)]
    expected = brute(rows, 7, 5)
    assert rows_of(nearest(vectors(spark, rows), 7, 5), *NAMES) == expected
    assert rows_of(nearest(vectors(spark, rows).repartition(6), 7, 5, query_block=10, seeds=30), *NAMES) == expected


def test_every_point_is_within_its_covering_radius():
    points = np.random.default_rng(2).normal(size=(3000, 5)) * 50
    def walk(node):
        assert (np.sqrt(((points[node.rows] - node.center) ** 2).sum(axis=1)) <= node.radius).all()
        if node.children:
            assert sorted(np.concatenate([child.rows for child in node.children])) == sorted(node.rows)
        for child in node.children:
            walk(child)
    walk(cover_tree(points))


def test_the_walk_prunes_and_loses_nothing(monkeypatch):
    draw = np.random.default_rng(3)
    centers = draw.normal(size=(40, 6)) * 300
    points = np.floor(centers[draw.integers(0, 40, 8000)] + draw.normal(size=(8000, 6)) * 3).astype(np.int64)
    queries = points[::50]
    seen = []
    monkeypatch.setattr(topk, "products", lambda left, right: seen.append(len(left) * len(right)) or products(left, right))
    best = Best(np.full(len(queries), np.iinfo(np.int64).min), 10)
    dual_search(queries, cover_tree(queries.astype(float), leaf=topk.QUERY_LEAF), points, best)
    scores = queries @ points.T
    assert all(sorted(best.scores[row])[-10:] == sorted(scores[row])[-10:] for row in range(len(queries)))
    assert sum(seen) < 0.5 * scores.size


def test_large_values_are_exact():
    left = np.array([[2**30, 3], [-(2**30), 5]])
    assert products(*exact_pair(left, left)).tolist() == [[2**60 + 9, -(2**60) + 15], [-(2**60) + 15, 2**60 + 25]]
