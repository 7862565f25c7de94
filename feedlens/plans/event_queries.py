"""Check queries of the event layer, daily aggregates and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.functions import expressions as X
from feedlens.operators import aggregates as A
from feedlens.operators import events as E
from feedlens.operators import scores as SC
from feedlens.plans.registry import Tables, query
from feedlens.plans.views import DELTAS, MIDDLE
from feedlens.sources import readers
from feedlens.sources.sinks import (
    ScoreStore,
    append_parquet,
    read_jsonl,
    replace_partitions,
    write_batch,
    write_both,
    write_jsonl,
)
from feedlens.session import run_folder

EVENT_COLUMNS = ("event_id", "user_id", "session_id", "event_type", "article_id", "category_id",
                 "event_timestamp")


def log_records(t: Tables):
    """All feed events as log records. Bogus ones carry text that is not JSON, untyped
    ones a time that is none, and the ids of erroneous likes are sent as text."""
    events = t.all_events.withColumns({
        "device": F.create_map(F.lit("platform"), F.lit("android")),
        "metadata": F.create_map(F.lit("day"), F.dayofmonth("event_timestamp").cast("string")),
    })
    number = F.col("key").cast("long")
    value = (
        F.when(F.col("value").contains("bogus_event"), F.concat(F.lit("not json "), F.col("value")))
        .when(~F.col("value").contains('"event_type"'),
              F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"some day"'))
        .otherwise(F.col("value"))
    )
    return E.encode_events(events).select(
        F.lit("user_events").alias("topic"), (number % 4).cast("int").alias("partition"),
        F.floor(number / 4).alias("offset"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("timestamp"), value.alias("value"),
    )


@query("decode_events", """SELECT 'user_events' AS topic, CAST(CAST(event_id AS BIGINT) % 4 AS INTEGER) AS partition,
    CAST(event_id AS BIGINT) // 4 AS "offset",
    CASE WHEN event_type IS DISTINCT FROM 'bogus_event' THEN event_id END AS event_id,
    CASE WHEN event_type IS DISTINCT FROM 'bogus_event' THEN user_id END AS user_id,
    CASE WHEN event_type IS DISTINCT FROM 'bogus_event' THEN session_id END AS session_id,
    nullif(event_type, 'bogus_event') AS event_type, article_id, category_id,
    CASE WHEN event_type IS NOT NULL AND event_type <> 'bogus_event' THEN event_timestamp END AS event_timestamp,
    CASE WHEN event_type IS DISTINCT FROM 'bogus_event' THEN 'android' END AS platform,
    CASE WHEN event_type IS DISTINCT FROM 'bogus_event'
      THEN CAST(day(event_timestamp) AS VARCHAR) END AS day_text
  FROM feed_events""")
def decode(t: Tables):
    return E.decode_events(log_records(t)).select(
        "topic", "partition", "offset", *EVENT_COLUMNS, F.col("device")["platform"].alias("platform"),
        F.col("metadata")["day"].alias("day_text"),
    )


@query("validate_events", """SELECT event_id, validation_error, validation_error IS NULL AS is_valid
  FROM events_checked""")
def validate(t: Tables):
    return E.validate_events(t.all_events).select("event_id", "validation_error", "is_valid")


@query("valid_events", "SELECT * FROM events_valid")
def valid(t: Tables):
    return t.events


@query("dead_letters", "SELECT * FROM events_checked WHERE validation_error IS NOT NULL")
def dead_letters(t: Tables):
    return E.split_events(E.validate_events(t.all_events))[1].drop("is_valid")


@query("validation_error_counts", """SELECT validation_error, count(*) AS events_count FROM events_checked
  WHERE validation_error IS NOT NULL GROUP BY 1""")
def error_counts(t: Tables):
    invalid = E.split_events(E.validate_events(t.all_events))[1]
    return invalid.groupBy("validation_error").agg(F.count("*").alias("events_count"))


@query("validate_without_session", """SELECT count(*) FILTER (event_type = 'search' OR event_type =
    'open_recommendations' OR article_id IS NOT NULL OR category_id IS NOT NULL) AS valid_count,
    0 AS valid_count_strict FROM feed_events WHERE event_type IS NOT NULL
    AND event_type <> 'bogus_event' AND user_id IS NOT NULL""")
def without_session(t: Tables):
    actions = t.all_events.withColumn("session_id", F.lit(None).cast("string"))
    loose = E.validate_events(actions, require_session=False).select(F.col("is_valid").alias("loose"), "*")
    strict = E.validate_events(loose.drop("is_valid", "validation_error"))
    return strict.agg(
        F.count_if("loose").alias("valid_count"), F.count_if("is_valid").cast("int").alias("valid_count_strict")
    )


@query("normalize_events", """SELECT event_id, user_id, session_id, event_type, article_id, category_id,
    coalesce(CASE WHEN event_type <> 'search' THEN event_timestamp END,
      TIMESTAMP '2024-02-01 00:00:00') AS event_timestamp, CAST(0 AS INTEGER) AS metadata_size
  FROM feed_events""")
def normalize(t: Tables):
    payloads = t.all_events.select(
        F.when(F.col("event_type") != "open_recommendations", F.col("event_id")).alias("eventId"),
        F.col("event_id").alias("fallback_id"), F.col("user_id").alias("reader"),
        F.col("session_id").alias("sessionId"), F.col("event_type").alias("eventType"),
        F.col("article_id").alias("articleId"), "category_id",
        F.when(F.col("event_type") != "search", F.col("event_timestamp")).alias("timestamp"),
    )
    events = E.normalize_events(
        payloads, "reader", event_id_default=F.col("fallback_id"),
        now=F.lit("2024-02-01 00:00:00").cast("timestamp"),
    )
    return events.select(*EVENT_COLUMNS, F.size("metadata").alias("metadata_size"))


@query("payload_errors", """SELECT event_id, concat_ws(',',
    CASE WHEN event_type = 'save_article' THEN 'event_id_not_uuid' END,
    CASE WHEN session_id IS NOT NULL THEN 'session_id_not_uuid' END,
    CASE WHEN event_type IS NULL OR event_type = 'bogus_event' THEN 'event_type_unknown' END,
    CASE WHEN article_id - 1 < 1 THEN 'article_id_below_one' END,
    CASE WHEN category_id - 1 < 1 THEN 'category_id_below_one' END,
    CASE WHEN contains(event_type, '_article') AND article_id IS NULL THEN 'article_id_required' END,
    CASE WHEN contains(event_type, '_category') AND category_id IS NULL THEN 'category_id_required' END
  ) AS errors FROM feed_events""")
def payload_errors(t: Tables):
    uuid_or_not = F.when(F.col("event_type") == "save_article", F.col("event_id")).otherwise(
        X.hash_uuid(F.col("event_id"))
    )
    payloads = t.all_events.withColumns({
        "key": F.col("event_id"), "event_id": uuid_or_not,
        "article_id": F.col("article_id") - 1, "category_id": F.col("category_id") - 1,
    })
    return E.payload_errors(payloads).select(
        F.col("key").alias("event_id"), F.array_join("errors", ",").alias("errors")
    )


@query("oversized_batches", """SELECT event_type, count(*) AS events_count FROM order_events
  GROUP BY 1 HAVING count(*) > 1000""")
def oversized(t: Tables):
    return E.oversized_batches(t.order_events, "event_type")


@query("dedupe_events", """SELECT event_id, user_id, session_id, event_type, article_id, category_id,
    event_timestamp FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp,
      user_id, session_id, event_type, article_id, category_id) AS rn FROM order_events) WHERE rn = 1""")
def dedupe(t: Tables):
    return E.dedupe_events(t.order_events)


@query("interaction_events", """SELECT event_id, user_id, article_id, category_id, event_type FROM (
    SELECT event_id, user_id, article_id, category_id, event_type FROM events_valid
    UNION SELECT event_id, user_id, article_id, category_id, event_type FROM feed_events
      WHERE coalesce(event_type, '') <> 'bogus_event')
  UNION ALL SELECT NULL, user_id, article_id, category_id, event_type FROM feed_events
    WHERE event_type = 'bogus_event'""")
def interactions(t: Tables):
    audit = t.all_events.withColumn(
        "event_id", F.when(F.coalesce("event_type", F.lit("")) != "bogus_event", F.col("event_id"))
    )
    return E.interaction_events(readers.raw_events_view(t.events), readers.raw_events_view(audit))


@query("ingest_new_events", f"""SELECT event_id, user_id, session_id, event_type, article_id, category_id,
    event_timestamp FROM feed_events WHERE event_id NOT IN (SELECT event_id FROM events_valid
      WHERE event_timestamp < TIMESTAMP '{MIDDLE}')""")
def ingest(t: Tables):
    resent = t.all_events.withColumn("event_timestamp", F.col("event_timestamp") + F.expr("INTERVAL 1 HOUR"))
    return E.ingest_new_events(t.first_half, t.all_events.unionByName(resent))


@query("choose_source", """SELECT 'raw_user_events' AS source, count(*) AS events_count FROM events_valid""")
def source(t: Tables):
    name, events = E.choose_source(t.events, t.all_events)
    return events.agg(F.count("*").alias("events_count")).select(F.lit(name).alias("source"), "events_count")


@query("choose_source_audit", """SELECT 'pending_events' AS source, count(*) AS events_count FROM feed_events""")
def source_audit(t: Tables):
    name, events = E.choose_source(t.events.where("event_type = 'no such type'"), t.all_events)
    return events.agg(F.count("*").alias("events_count")).select(F.lit(name).alias("source"), "events_count")


@query("event_quality_report", """SELECT e.event_type, count(*) AS events_count,
    count(*) FILTER (e.event_id IS NULL) AS missing_event_id,
    count(*) FILTER (e.session_id IS NULL) AS missing_session_id,
    count(*) FILTER (e.user_id IS NULL) AS missing_user_id,
    min(event_timestamp) AS first_event, max(event_timestamp) AS last_event,
    count(*) FILTER (e.article_id IS NOT NULL AND a.article_id IS NULL) AS unknown_article,
    count(*) FILTER (a.category_id <> e.category_id) AS category_mismatch,
    count(*) FILTER (NOT contains(coalesce(e.event_type, ''), '_article')
      AND e.article_id IS NOT NULL) AS unexpected_article
  FROM feed_events e LEFT JOIN feed_articles a USING (article_id) GROUP BY 1""")
def quality(t: Tables):
    return E.event_quality_report(t.all_events, t.articles)


@query("ingest_summary", """SELECT count(*) FILTER (coalesce(event_type, '') <> 'bogus_event') AS accepted_count,
    count(*) FILTER (event_type = 'bogus_event') AS failed_count FROM feed_events""")
def summary(t: Tables):
    failed = F.coalesce(F.col("event_type") == "bogus_event", F.lit(False))
    return E.ingest_summary(t.all_events.select(
        "event_id", F.when(failed, F.lit("failed")).otherwise(F.lit("kafka")).alias("delivery")
    ))


@query("audit_rows", """SELECT event_id, user_id, session_id, event_type, article_id, category_id,
    event_timestamp AS "timestamp", 'android' AS platform, 'generated_to_db' AS error FROM events_valid""")
def audit_rows(t: Tables):
    events = t.events.withColumns({
        "device": F.create_map(F.lit("platform"), F.lit("android")),
        "metadata": F.create_map(F.lit("source"), F.lit("feed")),
    })
    rows = E.to_audit_rows(events)
    return rows.withColumn("platform", F.col("device")["platform"]).drop("device", "metadata_json")


@query("jsonl_export", """SELECT event_id, user_id, session_id, event_type, article_id, category_id,
    event_timestamp FROM events_valid""")
def jsonl(t: Tables):
    path = run_folder(t.spark, "jsonl")
    write_jsonl(t.events, path)
    return read_jsonl(t.spark, path, (
        "event_id STRING, user_id BIGINT, session_id STRING, event_type STRING, article_id BIGINT, "
        "category_id BIGINT, event_timestamp TIMESTAMP"
    ))


@query("fan_out", """SELECT 'log' AS sink, count(*) AS events_count, count(DISTINCT event_id) AS distinct_ids
    FROM events_valid UNION ALL SELECT 'audit', count(*), count(DISTINCT event_id) FROM events_valid""")
def fan_out(t: Tables):
    """The same events into log files and into an audit table, from one computation."""
    base = run_folder(t.spark, "fan-out")
    events = t.events.withColumns({
        "device": F.create_map(F.lit("platform"), F.lit("android")),
        "metadata": F.create_map(F.lit("source"), F.lit("feed")),
    })
    write_both(
        events,
        lambda df: append_parquet(E.encode_events(df), f"{base}/log"),
        lambda df: append_parquet(E.to_audit_rows(df), f"{base}/audit"),
    )

    def counted(sink: str, key: str):
        return t.spark.read.parquet(f"{base}/{sink}").agg(
            F.count("*").alias("events_count"), F.countDistinct(key).alias("distinct_ids")
        ).select(F.lit(sink).alias("sink"), "events_count", "distinct_ids")

    return counted("log", "key").unionByName(counted("audit", "event_id"))


# --- daily aggregates -------------------------------------------------------
def _daily_sql(source: str, key: str) -> str:
    return f"""SELECT date_trunc('day', event_timestamp) AS window_start,
      date_trunc('day', event_timestamp) + INTERVAL 1 DAY AS window_end, {key},
      count(*) AS events_count, count(DISTINCT user_id) AS unique_users_count
    FROM {source} WHERE {key} IS NOT NULL GROUP BY ALL"""


@query("daily_by_type", _daily_sql("events_valid", "event_type"))
def daily_by_type(t: Tables):
    return A.daily_by_type(t.events)


@query("daily_by_category", _daily_sql("events_valid", "category_id"))
def daily_by_category(t: Tables):
    return A.daily_by_category(t.events)


@query("order_daily_by_type", _daily_sql("order_once", "event_type"))
def order_daily_by_type(t: Tables):
    return A.daily_by_type(t.order_once)


@query("order_daily_by_category", _daily_sql("order_once", "category_id"))
def order_daily_by_category(t: Tables):
    return A.daily_by_category(t.order_once)


@query("user_activity_daily", """SELECT CAST(event_timestamp AS DATE) AS event_date, user_id,
    count(*) AS events_count, count(DISTINCT session_id) AS sessions_count FROM events_valid GROUP BY ALL""")
def user_activity(t: Tables):
    return A.user_activity_daily(t.events)


@query("daily_event_stats", """SELECT CAST(event_timestamp AS DATE) AS date, event_type, category_id,
    count(*) AS events_count, count(DISTINCT user_id) AS unique_users_count FROM events_valid GROUP BY ALL""")
def event_stats(t: Tables):
    return A.daily_event_stats(t.events)


# --- scores -----------------------------------------------------------------
@query("category_score_deltas", f"""SELECT user_id, category_id, {DELTAS} FROM events_valid
  WHERE category_id IS NOT NULL GROUP BY ALL""")
def deltas(t: Tables):
    return A.category_score_deltas(t.events)


@query("order_category_score_deltas", f"""SELECT user_id, category_id, {DELTAS} FROM order_once
  WHERE category_id IS NOT NULL GROUP BY ALL""")
def order_deltas(t: Tables):
    return A.category_score_deltas(t.order_once)


def _merge_sql(change: str) -> str:
    columns = ", ".join(
        f"greatest(0, coalesce(s.{name}, 0) + {change.format(delta='coalesce(d.' + delta + ', 0)')}) AS {name}"
        for name, delta in SC.MEASURES.items()
    )
    return f"SELECT user_id, category_id, {columns} FROM old_scores s FULL JOIN deltas_second d USING (user_id, category_id)"


@query("merge_category_scores_signed", _merge_sql("{delta}"))
def merge_signed(t: Tables):
    return SC.merge_category_scores(t.old_scores, A.category_score_deltas(t.second_half), "signed")


@query("merge_category_scores_clamped", _merge_sql("greatest(0, {delta})"))
def merge_clamped(t: Tables):
    return SC.merge_category_scores(t.old_scores, A.category_score_deltas(t.second_half), "clamped")


def daily_ledger(t: Tables):
    """A ledger with one batch per day of the month."""
    linked = t.events.where(F.col("category_id").isNotNull()).withColumn(
        "batch_id", F.dayofmonth("event_timestamp").cast("long")
    )
    keyed = A.rollup(linked, "batch_id", "user_id", "category_id", "event_type").groupBy("batch_id", "user_id", "category_id")
    return keyed.agg(
        X.score_sum(S.INTEREST_WEIGHTS).alias("score_delta"),
        X.net_count("view_article").alias("views_delta"),
        X.net_count("like_article", "unlike_article").alias("likes_delta"),
        X.net_count("save_article", "unsave_article").alias("saves_delta"),
    )


_STEPS = f"""steps AS (SELECT user_id, category_id, day(event_timestamp) AS batch_id, {DELTAS} FROM events_valid
    WHERE category_id IS NOT NULL GROUP BY ALL),
  folded AS (
    SELECT user_id, category_id, 0 AS batch_id, CAST(0 AS DOUBLE) AS score, CAST(0 AS BIGINT) AS views_count,
      CAST(0 AS BIGINT) AS likes_count, CAST(0 AS BIGINT) AS saves_count
    FROM (SELECT DISTINCT user_id, category_id FROM steps)
    UNION ALL
    SELECT f.user_id, f.category_id, f.batch_id + 1,
      greatest(0, f.score + coalesce(s.score_delta, 0)),
      greatest(0, f.views_count + coalesce(s.views_delta, 0)),
      greatest(0, f.likes_count + coalesce(s.likes_delta, 0)),
      greatest(0, f.saves_count + coalesce(s.saves_delta, 0))
    FROM folded f LEFT JOIN steps s ON s.user_id = f.user_id AND s.category_id = f.category_id
      AND s.batch_id = f.batch_id + 1
    WHERE f.batch_id < 31)"""
_REPLAY_SQL = f"""SELECT user_id, category_id, score, views_count, likes_count, saves_count FROM (
  WITH RECURSIVE {_STEPS} SELECT * FROM folded WHERE batch_id = 31)"""


@query("replay_score_deltas", _REPLAY_SQL)
def replay(t: Tables):
    none = t.scores.where("false")
    return SC.replay_score_deltas(none, daily_ledger(t))


@query("score_store", _REPLAY_SQL)
def score_store(t: Tables):
    """The same through files: half of the batches compacted into a snapshot, a repeated
    batch overwritten, the rest read from the ledger."""
    store = ScoreStore(t.spark, run_folder(t.spark, "scores"))
    kept = daily_ledger(t).persist()
    first = kept.where("batch_id <= 15")
    stamped = F.current_timestamp()
    replace_partitions(first.repartition("batch_id").withColumn("processed_at", stamped), store.ledger_path, "batch_id")
    store.compact()
    later = kept.where("batch_id > 15").repartition("batch_id")
    replace_partitions(later.withColumn("processed_at", stamped), store.ledger_path, "batch_id")
    write_batch(kept.where("batch_id = 20").drop("batch_id").withColumn("processed_at", stamped), store.ledger_path, 20)
    kept.unpersist()
    return store.current()


@query("late_events", """SELECT event_id, event_timestamp, batch_id, watermark FROM (
    SELECT *, (SELECT max(o.event_timestamp) FROM events_valid o
      WHERE day(o.event_timestamp) % 7 < batch_id) - INTERVAL 2 DAY AS watermark
    FROM (SELECT event_id, event_timestamp, CAST(day(event_timestamp) % 7 AS BIGINT) AS batch_id FROM events_valid))
  WHERE event_timestamp < watermark""")
def late(t: Tables):
    ledger = t.events.select(
        "event_id", "event_timestamp", (F.dayofmonth("event_timestamp") % 7).cast("long").alias("batch_id")
    )
    return SC.late_events(ledger).select("event_id", "event_timestamp", "batch_id", "watermark")
