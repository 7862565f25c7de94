import random

import pytest
from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.operators import scores as SC
from feedlens.sources.sinks import ScoreStore

CURRENT = [(1, 1, 4.0, 2, 0, 1), (1, 2, 1.0, 0, 0, 0)]


def apply(state, deltas, mode):
    out = dict(state)
    for key, change in deltas.items():
        old = out.get(key, (0, 0, 0, 0))
        if mode == "clamped":
            change = tuple(max(0, c) for c in change)
        out[key] = tuple(max(0, o + c) for o, c in zip(old, change))
    return out


def as_dict(df):
    return {(r.user_id, r.category_id): (r.score, r.views_count, r.likes_count, r.saves_count) for r in df.collect()}


@pytest.mark.parametrize("mode", ["signed", "clamped"])
@pytest.mark.parametrize("seed", range(3))
def test_merge_and_replay_equal_the_sequence(spark, mode, seed):
    rng = random.Random(seed)
    state = {(u, c): tuple(rest) for u, c, *rest in CURRENT}
    ledger, want = [], dict(state)
    for batch in range(8):
        deltas = {(rng.randrange(1, 4), rng.randrange(1, 3)): tuple(rng.randrange(-6, 6) for _ in range(4))
                  for _ in range(4)}
        ledger += [(u, c, float(d[0]), d[1], d[2], d[3], batch) for (u, c), d in deltas.items()]
        want = apply(want, deltas, mode)
    current = spark.createDataFrame(CURRENT, S.USER_CATEGORY_SCORES)
    rows = spark.createDataFrame(ledger, f"{S.SCORE_DELTAS}, batch_id BIGINT")
    assert as_dict(SC.replay_score_deltas(current, rows, mode=mode)) == want
    stepwise = current
    for batch in range(8):
        stepwise = spark.createDataFrame(
            SC.merge_category_scores(stepwise, rows.where(F.col("batch_id") == batch), mode).collect(),
            S.USER_CATEGORY_SCORES)
    assert as_dict(stepwise) == want


def test_replay_skips_applied_batches(spark):
    current = spark.createDataFrame([], S.USER_CATEGORY_SCORES)
    rows = spark.createDataFrame([(1, 1, 2.0, 1, 0, 0, 0), (1, 1, 3.0, 1, 0, 0, 1)], f"{S.SCORE_DELTAS}, batch_id BIGINT")
    assert as_dict(SC.replay_score_deltas(current, rows, applied=[0]))[(1, 1)][0] == 3.0
    done = spark.createDataFrame([(1,)], "batch_id BIGINT")
    assert as_dict(SC.replay_score_deltas(current, rows, applied=done))[(1, 1)][0] == 2.0


def test_unknown_mode(spark):
    empty = spark.createDataFrame([], S.USER_CATEGORY_SCORES)
    with pytest.raises(ValueError):
        SC.merge_category_scores(empty, empty, "other")


def test_store_repeated_batch_and_compaction(spark, tmp_path):
    store = ScoreStore(spark, str(tmp_path))
    assert store.current().count() == 0 and store.compact() == 0

    def deltas(score):
        return spark.createDataFrame([(1, 1, score, 1, 0, 0)], S.SCORE_DELTAS)

    store.append(deltas(5.0), 0)
    store.append(deltas(-9.0), 1)
    store.append(deltas(-9.0), 1)
    store.append(deltas(2.0), 2)
    assert as_dict(store.current()) == {(1, 1): (2.0, 3, 0, 0)}
    assert store.compact() == 1 and store.compact() == 1
    store.append(deltas(4.0), 3)
    assert as_dict(store.current()) == {(1, 1): (6.0, 4, 0, 0)}
    assert store.compact() == 2
    assert as_dict(store.current()) == {(1, 1): (6.0, 4, 0, 0)}
