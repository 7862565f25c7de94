"""Offline event queue: oldest rows first, settle by delivery responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions import expressions as X
from feedlens.operators.ranking import top_per_key, with_positions

BATCH_SIZE = 100
MAX_BATCHES = 10

# --- fixed values: queue errors and batch results ---------------------------
ERROR_NO_DETAIL = "Event delivery failed"
ERROR_NO_RESULT = "Missing event result in batch response"
EMPTY, SENT, RETRY = "EMPTY", "SENT", "RETRY"


def oldest_pending(pending: DataFrame, limit: int = BATCH_SIZE) -> DataFrame:
    return pending.orderBy("created_at", "event_id").limit(limit)


def sync_batches(pending: DataFrame, size: int = BATCH_SIZE, batches: int | None = MAX_BATCHES) -> DataFrame:
    """The rows one sync run sends, with their ``batch_no``: 10 batches of 100 at most.

    ``batches=None`` numbers the whole queue, as runs of 10 batches (``run_no``) would send it.
    """
    if batches is None:
        placed = with_positions(pending, [], [F.asc("created_at"), F.asc("event_id")], "_n")
        batch = F.ceil(F.col("_n") / size)
        return placed.select(
            *pending.columns, F.ceil(batch / MAX_BATCHES).alias("run_no"), (F.pmod(batch - 1, F.lit(MAX_BATCHES)) + 1).alias("batch_no")
        )
    run = oldest_pending(pending, size * batches).withColumn("_run", F.lit(0))
    numbered = top_per_key(run, ["_run"], [F.asc("created_at"), F.asc("event_id")], size * batches, "_n")
    return numbered.withColumn("batch_no", F.ceil(F.col("_n") / size)).drop("_run", "_n")


def queue_depth(pending: DataFrame) -> DataFrame:
    return pending.agg(F.count("*").alias("queue_depth"))


def settle_queue(pending: DataFrame, responses: DataFrame, transport_error: str | None = None,
                 ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows that stay, settled event ids, one-row batch result).

    ``responses`` are delivery records with their ``position`` in the batch; the last one
    of an event counts. A row leaves the queue when its delivery did not fail. The others
    get one more retry and the error of their response. With ``transport_error`` there is
    no usable response at all and every row is marked.
    """
    if transport_error is not None:
        judged = pending.withColumn("_error", F.lit(transport_error))
        reported_failures = F.lit(0)
    else:
        last = top_per_key(
            responses.where(F.col("event_id").isNotNull()), ["event_id"], [F.desc("position")], 1
        ).select(
            "event_id", F.coalesce("delivery", F.lit("")).alias("_delivery"), F.col("detail").alias("_detail")
        )
        error = (
            F.when(F.col("_delivery").isNull(), F.lit(ERROR_NO_RESULT))
            .when(F.col("_delivery") == "failed", F.coalesce("_detail", F.lit(ERROR_NO_DETAIL)))
        )
        judged = pending.join(last, "event_id", "left").withColumn("_error", error)
        reported_failures = F.coalesce(
            responses.select(F.count_if(F.col("delivery") == "failed").alias("n")).scalar(), F.lit(0)
        )
    failed = F.col("_error").isNotNull()
    remaining = judged.where(failed).select(*[
        (F.col("retry_count") + 1).alias(name) if name == "retry_count"
        else F.col("_error").alias(name) if name == "last_error"
        else F.col(name)
        for name in pending.columns
    ])
    settled = judged.where(~failed).select("event_id")
    result = judged.agg(F.count("*").alias("sent"), F.count_if(failed).alias("failed")).select(
        "sent", "failed",
        F.when(F.col("sent") == 0, F.lit(EMPTY))
        .when((F.col("failed") > 0) | (reported_failures > 0), F.lit(RETRY))
        .otherwise(F.lit(SENT)).alias("result"),
    )
    return remaining, settled, result


def queue_to_payloads(pending: DataFrame) -> DataFrame:
    """Queue rows to payload events. A broken device text becomes NULL, broken metadata
    an empty map: an optional field never blocks the queue."""
    return pending.select(
        "event_id", "session_id", "event_type", "article_id", "category_id", "timestamp",
        X.lenient_map(F.col("device_json"), null_when_bad=True).alias("device"),
        X.lenient_map(F.col("metadata_json"), null_when_bad=False).alias("metadata"),
    )


def payloads_to_queue(payloads: DataFrame, created_at_ms: int) -> DataFrame:
    """New queue rows of payload events."""
    return payloads.select(
        "event_id", "session_id", "event_type", "article_id", "category_id", "timestamp",
        F.to_json("device").alias("device_json"),
        F.coalesce(F.to_json("metadata"), F.lit("{}")).alias("metadata_json"),
        F.lit(0).alias("retry_count"), F.lit(None).cast("string").alias("last_error"),
        F.lit(created_at_ms).cast("long").alias("created_at"),
    )
