"""Check queries of the streaming job: run until all available input is done, return
the resulting table.

The feed events become log files in three waves. The stream runs after each wave with the
same checkpoint, so progress, watermark and state have to carry over.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.operators.events import decode_events, valid_events
from feedlens.plans.event_queries import log_records
from feedlens.plans.registry import Tables, query
from feedlens.plans.views import DELTAS
from feedlens.session import run_folder, stream_session, written_table
from feedlens.sources.readers import read_event_stream
from feedlens.sources.sinks import ScoreStore
from feedlens.streaming import aggregates as G
from feedlens.streaming.job import (
    StreamPaths, compact_closed_days, daily_totals, late_totals, run_event_job, run_stream,
)

WAVE_BOUNDS = ("2024-01-11", "2024-01-21")


def _waves(t: Tables, copies: int = 1) -> list[DataFrame]:
    """Log records of the first, second and third part of the month. With two copies
    every record is sent twice. The records are made once, not per wave and copy."""
    records = log_records(t)
    day = t.all_events.select("event_id", F.to_date("event_timestamp").alias("day"))
    placed = written_table(records.withColumn(
        "event_id", (F.col("offset") * 4 + F.col("partition")).cast("string")
    ).join(day, "event_id").drop("event_id"), "log-records")
    first, second = (F.lit(bound).cast("date") for bound in WAVE_BOUNDS)
    parts = [F.col("day") < first, (F.col("day") >= first) & (F.col("day") < second), F.col("day") >= second]
    waves = []
    for part in parts:
        wave = placed.where(part).drop("day")
        waves.append(wave if copies == 1 else wave.unionByName(wave))
    return waves


def _stream(t: Tables, log: str) -> DataFrame:
    # The folder has to exist before the stream is defined.
    t.spark.createDataFrame([], S.LOG_RECORD).write.mode("append").parquet(log)
    return read_event_stream(stream_session(t.spark), "parquet", path=log)


def _run_waves(t: Tables, start, copies: int = 1) -> str:
    """Append each wave to the log and run the stream over it; returns the base folder."""
    base = run_folder(t.spark, "stream")
    log = f"{base}/log"
    records = _stream(t, log)
    for wave in _waves(t, copies):
        wave.write.mode("append").parquet(log)
        start(records, base).awaitTermination()
    return base


def _aggregate(t: Tables, build, layout: str) -> DataFrame:
    def start(records: DataFrame, base: str):
        events = G.dedupe_stream(valid_events(decode_events(records)))
        return run_stream(build(events), f"{base}/out", f"{base}/checkpoint", available_now=True)

    base = _run_waves(t, start, copies=2)
    return t.spark.read.schema(layout).parquet(f"{base}/out")


def _closed_sql(key: str, member: str, name: str) -> str:
    """Days the watermark has closed: over before the latest event less two days. Likes
    of NULL users and untimed events never enter."""
    return f"""SELECT date_trunc('day', event_timestamp) AS window_start,
      date_trunc('day', event_timestamp) + INTERVAL 1 DAY AS window_end, {key},
      count(*) AS events_count, count(DISTINCT {member}) AS {name} FROM events_valid
    WHERE {key} IS NOT NULL AND date_trunc('day', event_timestamp) + INTERVAL 1 DAY
      <= (SELECT max(event_timestamp) FROM events_valid) - INTERVAL 2 DAY GROUP BY ALL"""


@query("stream_daily_by_type", _closed_sql("event_type", "user_id", "unique_users_count"))
def by_type(t: Tables):
    return _aggregate(t, G.daily_by_type_stream, (
        "window_start TIMESTAMP, window_end TIMESTAMP, event_type STRING, events_count BIGINT, "
        "unique_users_count BIGINT"))


@query("stream_daily_by_category", _closed_sql("category_id", "user_id", "unique_users_count"))
def by_category(t: Tables):
    return _aggregate(t, G.daily_by_category_stream, (
        "window_start TIMESTAMP, window_end TIMESTAMP, category_id BIGINT, events_count BIGINT, "
        "unique_users_count BIGINT"))


@query("stream_user_activity", _closed_sql("user_id", "session_id", "sessions_count"))
def activity(t: Tables):
    return _aggregate(t, G.user_activity_stream, (
        "window_start TIMESTAMP, window_end TIMESTAMP, user_id BIGINT, events_count BIGINT, "
        "sessions_count BIGINT"))


@query("stream_dedupe", "SELECT * FROM events_valid")
def dedupe(t: Tables):
    """Every record sent twice, every event stored once."""
    def start(records: DataFrame, base: str):
        events = G.dedupe_stream(valid_events(decode_events(records))).select(
            "event_id", "user_id", "session_id", "event_type", "article_id", "category_id", "event_timestamp"
        )
        return run_stream(events, f"{base}/out", f"{base}/checkpoint", available_now=True)

    base = _run_waves(t, start, copies=2)
    return t.spark.read.parquet(f"{base}/out")


def _run_job(t: Tables) -> StreamPaths:
    def start(records: DataFrame, base: str):
        return run_event_job(t.spark, records, f"{base}/tables", f"{base}/checkpoint",
                             available_now=True, compact_every=2)

    return StreamPaths(f"{_run_waves(t, start)}/tables")


@query("stream_micro_batch_raw_events", """SELECT event_id, user_id, session_id, event_type, article_id,
    category_id, event_timestamp, 'user_events' AS topic, CAST(event_id AS BIGINT) // 4 AS "offset"
  FROM events_valid""")
def job_raw(t: Tables):
    raw = t.spark.read.parquet(_run_job(t).raw_events)
    return raw.select("event_id", "user_id", "session_id", "event_type", "article_id", "category_id",
                      "event_timestamp", "topic", "offset")


@query("stream_micro_batch_dead_letters", """SELECT CAST(event_id AS BIGINT) // 4 AS "offset", validation_error
  FROM events_checked WHERE validation_error IS NOT NULL""")
def job_dead_letters(t: Tables):
    return t.spark.read.parquet(_run_job(t).dead_letters).select("offset", "validation_error")


@query("stream_micro_batch_aggregates", """SELECT 'type' AS kind, date_trunc('day', event_timestamp) AS window_start,
    event_type AS label, count(*) AS events_count, count(DISTINCT user_id) AS distinct_count FROM events_valid GROUP BY ALL
  UNION ALL SELECT 'category', date_trunc('day', event_timestamp), CAST(category_id AS VARCHAR), count(*),
    count(DISTINCT user_id) FROM events_valid WHERE category_id IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'user', date_trunc('day', event_timestamp), CAST(user_id AS VARCHAR), count(*),
    count(DISTINCT session_id) FROM events_valid GROUP BY ALL""")
def job_aggregates(t: Tables):
    return _totals(t, _run_job(t))


def _totals(t: Tables, paths: StreamPaths) -> DataFrame:
    """The job's event-time totals as (kind, day, label, events, distinct members) rows."""
    totals = daily_totals(t.spark, paths)

    def part(name: str, kind: str, start: str, label: str, distinct: str) -> DataFrame:
        return totals[name].select(
            F.lit(kind).alias("kind"), F.col(start).cast("timestamp").alias("window_start"),
            F.col(label).cast("string").alias("label"), "events_count", F.col(distinct).alias("distinct_count"),
        )

    return (
        part("by_type", "type", "window_start", "event_type", "unique_users_count")
        .unionByName(part("by_category", "category", "window_start", "category_id", "unique_users_count"))
        .unionByName(part("user_activity", "user", "event_date", "user_id", "sessions_count"))
    )


def _run_mixed_job(t: Tables) -> StreamPaths:
    """Waves by the last digit of the offset, each sent twice: days span batches, and most of
    the later waves is late."""
    base = run_folder(t.spark, "stream")
    log = f"{base}/log"
    records = _stream(t, log)
    sent = written_table(log_records(t), "log-records")
    for wave in range(3):
        part = sent.where(F.col("offset") % 3 == wave)
        part.unionByName(part).write.mode("append").parquet(log)
        run_event_job(t.spark, records, f"{base}/tables", f"{base}/checkpoint", available_now=True, dedupe=True).awaitTermination()
    return StreamPaths(f"{base}/tables")


_JOB_TOTALS = """SELECT 'type' AS kind, date_trunc('day', event_timestamp) AS window_start,
    event_type AS label, count(*) AS events_count, count(DISTINCT user_id) AS distinct_count FROM events_valid GROUP BY ALL
  UNION ALL SELECT 'category', date_trunc('day', event_timestamp), CAST(category_id AS VARCHAR), count(*),
    count(DISTINCT user_id) FROM events_valid WHERE category_id IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'user', date_trunc('day', event_timestamp), CAST(user_id AS VARCHAR), count(*),
    count(DISTINCT session_id) FROM events_valid GROUP BY ALL"""


@query("stream_job_daily_totals", _JOB_TOTALS)
def job_totals(t: Tables):
    """Waves that split every day, with copies and late events; closed days are compacted before the read."""
    paths = _run_mixed_job(t)
    compact_closed_days(t.spark, paths, date(2024, 1, 20))
    return _totals(t, paths)


@query("stream_late_events_kept", """SELECT * FROM (WITH waves AS (SELECT *, (CAST(event_id AS BIGINT) // 4) % 3 AS wave FROM events_checked),
  stored AS (SELECT *, (SELECT max(event_timestamp) FROM waves w WHERE w.wave < v.wave AND w.validation_error IS NULL) AS newest
    FROM waves v WHERE validation_error IS NULL)
  SELECT (SELECT count(*) FROM stored) AS raw_rows, (SELECT 2 * count(*) FROM waves WHERE validation_error IS NOT NULL) AS dead_rows,
    (SELECT count(*) FROM stored) AS events_count,
    (SELECT count(*) FROM stored WHERE event_timestamp < newest - INTERVAL 2 DAY) AS late_count)""")
def late_kept(t: Tables):
    """Every event sent is stored once or a dead letter, and the late ones are counted."""
    paths = _run_mixed_job(t)

    def size(path: str):
        return t.spark.read.parquet(path).select(F.count("*").alias("n")).scalar()

    return late_totals(t.spark, paths).select(
        size(paths.raw_events).alias("raw_rows"), size(paths.dead_letters).alias("dead_rows"), "events_count", "late_count")


@query("stream_micro_batch_scores", f"""SELECT user_id, category_id,
    greatest(0, greatest(0, greatest(0, coalesce(a.score_delta, 0)) + coalesce(b.score_delta, 0))
      + coalesce(c.score_delta, 0)) AS score,
    greatest(0, greatest(0, greatest(0, coalesce(a.views_delta, 0)) + coalesce(b.views_delta, 0))
      + coalesce(c.views_delta, 0)) AS views_count,
    greatest(0, greatest(0, greatest(0, coalesce(a.likes_delta, 0)) + coalesce(b.likes_delta, 0))
      + coalesce(c.likes_delta, 0)) AS likes_count,
    greatest(0, greatest(0, greatest(0, coalesce(a.saves_delta, 0)) + coalesce(b.saves_delta, 0))
      + coalesce(c.saves_delta, 0)) AS saves_count
  FROM (SELECT user_id, category_id, {DELTAS} FROM events_valid WHERE category_id IS NOT NULL
      AND event_timestamp < DATE '{WAVE_BOUNDS[0]}' GROUP BY ALL) a
  FULL JOIN (SELECT user_id, category_id, {DELTAS} FROM events_valid WHERE category_id IS NOT NULL
      AND event_timestamp >= DATE '{WAVE_BOUNDS[0]}' AND event_timestamp < DATE '{WAVE_BOUNDS[1]}' GROUP BY ALL) b
    USING (user_id, category_id)
  FULL JOIN (SELECT user_id, category_id, {DELTAS} FROM events_valid WHERE category_id IS NOT NULL
      AND event_timestamp >= DATE '{WAVE_BOUNDS[1]}' GROUP BY ALL) c USING (user_id, category_id)""")
def job_scores(t: Tables):
    """One batch compacted on the way, the others replayed from the ledger."""
    return ScoreStore(t.spark, _run_job(t).scores).current()
