"""User-category scores as a snapshot plus a ledger of per-batch deltas.

A stored value never drops below 0. Two rules:

* ``signed``: ``greatest(0, old + delta)``.
* ``clamped``: ``greatest(0, old + greatest(0, delta))``, the upsert whose new row is
  clamped before the conflict is resolved, so a negative batch never lowers a score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MEASURES = {
    "score": "score_delta",
    "views_count": "views_delta",
    "likes_count": "likes_delta",
    "saves_count": "saves_delta",
}
KEYS = ["user_id", "category_id"]


def _check_mode(mode: str) -> None:
    if mode not in ("signed", "clamped"):
        raise ValueError(f"unknown merge mode {mode!r}")


def _stacked(current: DataFrame, deltas: DataFrame, order: Column) -> DataFrame:
    """Snapshot rows (step NULL, sorted first) and ledger rows in one layout."""
    base = current.select(
        *KEYS, F.lit(None).cast("long").alias("step"), *[F.col(m).alias(d) for m, d in MEASURES.items()]
    )
    return base.unionByName(deltas.select(*KEYS, order.cast("long").alias("step"), *MEASURES.values()))


def merge_category_scores(current: DataFrame, deltas: DataFrame, mode: str = "signed") -> DataFrame:
    """One batch of deltas (unique keys) into the snapshot: one shuffle, no join."""
    _check_mode(mode)
    stacked = _stacked(current, deltas, F.lit(0))

    def merged(delta: str) -> Column:
        change = F.greatest(F.lit(0), F.col(delta)) if mode == "clamped" else F.col(delta)
        value = F.when(F.col("step").isNull(), F.col(delta)).otherwise(change)
        return F.greatest(F.lit(0), F.sum(value))

    return stacked.groupBy(*KEYS).agg(*[
        merged(delta).cast("double" if name == "score" else "long").alias(name)
        for name, delta in MEASURES.items()
    ])


def replay_score_deltas(current: DataFrame, ledger: DataFrame, applied: Sequence[int] | DataFrame = (),
                        mode: str = "signed") -> DataFrame:
    """All ledger batches not applied yet, in ``batch_id`` order, in one pass.

    Applying ``greatest(0, old + delta)`` batch after batch equals the last prefix sum
    less the lowest prefix sum below 0, so the batches need no loop. In ``clamped``
    mode all steps are non-negative and the sum is enough. A key has one ledger row
    per batch, so its window stays as short as the number of open batches.
    """
    _check_mode(mode)
    if isinstance(applied, DataFrame):
        open_batches = ledger.join(applied.select("batch_id").distinct(), "batch_id", "left_anti")
    elif applied:
        open_batches = ledger.where(~F.col("batch_id").isin(*applied))
    else:
        open_batches = ledger
    stacked = _stacked(current, open_batches, F.col("batch_id"))
    if mode == "clamped":
        totals = [F.sum(F.greatest(F.lit(0), F.col(delta))) for delta in MEASURES.values()]
        folded = stacked.groupBy(*KEYS).agg(*[t.alias(n) for n, t in zip(MEASURES, totals)])
    else:
        so_far = Window.partitionBy(*KEYS).orderBy(F.col("step").asc_nulls_first()).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        steps = stacked.select(
            *KEYS, F.coalesce("step", F.lit(-1)).alias("step"),
            *[F.sum(delta).over(so_far).alias(delta) for delta in MEASURES.values()],
        )
        folded = steps.groupBy(*KEYS).agg(*[
            (F.max_by(delta, "step") - F.least(F.lit(0), F.min(delta))).alias(name)
            for name, delta in MEASURES.items()
        ])
    return folded.select(
        *KEYS, *[F.col(n).cast("double" if n == "score" else "long").alias(n) for n in MEASURES]
    )


def late_events(ledger: DataFrame, delay_days: int = 2, batch_col: str = "batch_id") -> DataFrame:
    """Events a watermark would drop: older than the latest event of all earlier
    batches less the delay. Only one row per batch is sorted."""
    newest = ledger.groupBy(batch_col).agg(F.max("event_timestamp").alias("newest"))
    earlier = Window.orderBy(batch_col).rowsBetween(Window.unboundedPreceding, -1)
    marks = newest.select(
        batch_col,
        (F.max("newest").over(earlier) - F.make_dt_interval(F.lit(delay_days))).alias("watermark"),
    )
    return ledger.join(marks, batch_col).where(F.col("event_timestamp") < F.col("watermark"))
