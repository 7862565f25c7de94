"""Check queries of the offline queue and of the snapshot merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.operators import queue as Q
from feedlens.operators import snapshots as N
from feedlens.plans.registry import Tables, query

MERGED_AT = "2024-02-01 00:00:00"


def pending(t: Tables):
    """Every feed event waits in the queue."""
    return t.all_events.select(
        "event_id", "event_type", F.unix_millis("event_timestamp").alias("created_at"),
        (F.dayofmonth("event_timestamp") % 3).alias("retry_count"), F.lit(None).cast("string").alias("last_error"),
    )


def responses(t: Tables):
    """Answers for all events but searches; likes fail, half of them without detail,
    and every first answer is followed by the final one."""
    liked = F.col("event_type") == "like_article"
    known = t.all_events.where(F.coalesce(F.col("event_type") != "search", F.lit(True)))
    final = known.select(
        "event_id", F.lit("accepted").alias("status"),
        F.when(liked, F.lit("failed")).otherwise(F.lit("kafka")).alias("delivery"),
        F.when(liked & (F.dayofmonth("event_timestamp") % 2 == 0), F.lit("log unavailable")).alias("detail"),
        F.lit(2).alias("position"),
    )
    first = final.withColumns({"delivery": F.lit("failed"), "detail": F.lit("first try"), "position": F.lit(1)})
    return final.unionByName(first)


_PENDING = """pending AS (SELECT event_id, event_type, epoch_us(event_timestamp) // 1000 AS created_at,
    CAST(day(event_timestamp) % 3 AS INTEGER) AS retry_count, CAST(NULL AS VARCHAR) AS last_error,
    day(event_timestamp) AS d FROM feed_events)"""


@query("settle_queue_remaining", f"""SELECT event_id, event_type, created_at, retry_count + 1 AS retry_count,
    CASE WHEN event_type = 'search' THEN 'Missing event result in batch response'
      WHEN d % 2 = 0 THEN 'log unavailable' ELSE 'Event delivery failed' END AS last_error
  FROM (WITH {_PENDING} SELECT * FROM pending) WHERE event_type IN ('search', 'like_article')""")
def remaining(t: Tables):
    return Q.settle_queue(pending(t), responses(t))[0]


@query("settle_queue_settled", """SELECT event_id FROM feed_events
  WHERE coalesce(event_type, '') NOT IN ('search', 'like_article')""")
def settled(t: Tables):
    return Q.settle_queue(pending(t), responses(t))[1]


@query("settle_queue_result", """SELECT count(*) AS sent,
    count(*) FILTER (event_type IN ('search', 'like_article')) AS failed, 'RETRY' AS result FROM feed_events""")
def result(t: Tables):
    return Q.settle_queue(pending(t), responses(t))[2]


@query("settle_queue_transport_error", f"""SELECT event_id, event_type, created_at, retry_count + 1 AS retry_count,
    'HTTP 503 while syncing events' AS last_error FROM (WITH {_PENDING} SELECT * FROM pending)""")
def transport_error(t: Tables):
    return Q.settle_queue(pending(t), responses(t), "HTTP 503 while syncing events")[0]


@query("oldest_pending", f"""SELECT event_id, created_at FROM (WITH {_PENDING} SELECT * FROM pending)
  ORDER BY created_at, event_id LIMIT 100""")
def oldest(t: Tables):
    return Q.oldest_pending(pending(t)).select("event_id", "created_at")


@query("sync_runs", f"""SELECT event_id, CAST((n - 1) // 1000 + 1 AS BIGINT) AS run_no, CAST((n - 1) % 1000 // 100 + 1 AS BIGINT) AS batch_no
  FROM (SELECT event_id, row_number() OVER (ORDER BY created_at, event_id) AS n FROM (WITH {_PENDING} SELECT * FROM pending))""")
def sync_runs(t: Tables):
    """The whole queue, in the order in which the sync runs send it."""
    return Q.sync_batches(pending(t), batches=None).select("event_id", "run_no", "batch_no")


@query("sync_batches", f"""SELECT event_id, CAST(ceil(row_number() OVER (ORDER BY created_at, event_id) / 100)
    AS BIGINT) AS batch_no FROM (WITH {_PENDING} SELECT * FROM pending)
  ORDER BY created_at, event_id LIMIT 1000""")
def sync_batches(t: Tables):
    return Q.sync_batches(pending(t)).select("event_id", "batch_no")


@query("queue_depth", "SELECT count(*) AS queue_depth FROM feed_events")
def depth(t: Tables):
    return Q.queue_depth(pending(t))


@query("queue_round_trip", """SELECT event_id, event_type, CASE WHEN event_type <> 'bogus_event' THEN 'android' END
    AS platform, CASE WHEN event_type <> 'bogus_event' THEN event_type END AS kind, 0 AS retry_count
  FROM feed_events""")
def round_trip(t: Tables):
    """Payloads to queue rows and back; bogus events get broken texts in between."""
    events = t.all_events.withColumn("timestamp", F.col("event_timestamp").cast("string")).withColumns({
        "device": F.create_map(F.lit("platform"), F.lit("android")),
        "metadata": F.create_map(F.lit("kind"), F.col("event_type")),
    })
    queued = Q.payloads_to_queue(events, 1_700_000_000_000)
    bogus = F.coalesce(F.col("event_type") == "bogus_event", F.lit(True))
    queued = queued.withColumns({
        "device_json": F.when(~bogus, F.col("device_json")).otherwise(F.lit("{broken")),
        "metadata_json": F.when(~bogus, F.col("metadata_json")).otherwise(F.lit("  ")),
    })
    back = Q.queue_to_payloads(queued).select(
        "event_id", "event_type", F.col("device")["platform"].alias("platform"),
        F.try_element_at("metadata", F.lit("kind")).alias("kind"),
    )
    return back.join(queued.select("event_id", "retry_count"), "event_id")


# --- snapshots --------------------------------------------------------------
def cached_articles(t: Tables):
    return t.articles.select(
        "article_id", "category_id", "title", "published_at",
        (F.col("article_id") % 3 == 0).alias("is_liked"), (F.col("article_id") % 4 == 0).alias("is_saved"),
        (F.col("article_id") % 2 == 0).alias("in_feed"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("cached_at"),
    )


def snapshot(t: Tables):
    """Articles with events, each twice: the later row has the upper-case title, and is
    saved when it was ever saved. Two of three are new to the cache."""
    acted = t.order_events.groupBy("article_id").agg(
        F.max(F.col("event_type") == "save_article").alias("is_saved")
    )
    rows = t.articles.join(acted, "article_id").select(
        (F.col("article_id") * 3).alias("article_id"), "category_id", "title", "published_at",
        F.lit(False).alias("is_liked"), "is_saved", F.col("article_id").alias("position"),
    )
    later = rows.withColumns({"title": F.upper("title"), "position": F.col("position") + 1_000_000_000})
    return rows.withColumn("is_saved", ~F.col("is_saved")).unionByName(later)


def _merged_at():
    return F.lit(MERGED_AT).cast("timestamp")


_CACHED = """cached AS (SELECT article_id, category_id, title, published_at, article_id % 3 = 0 AS is_liked,
    article_id % 4 = 0 AS is_saved, article_id % 2 = 0 AS in_feed, TIMESTAMP '2024-01-01 00:00:00' AS cached_at
  FROM feed_articles),
  snap AS (SELECT a.article_id * 3 AS article_id, a.category_id, upper(title) AS title, published_at,
    false AS is_liked, bool_or(event_type = 'save_article') AS is_saved
  FROM feed_articles a JOIN order_events e ON e.article_id = a.article_id GROUP BY 1, 2, 3, 4, 5)"""


@query("merge_feed_snapshot", f"""SELECT * FROM (WITH {_CACHED}
  SELECT article_id, category_id, title, published_at, is_liked, is_saved, false AS in_feed, cached_at FROM cached
    WHERE article_id NOT IN (SELECT article_id FROM snap)
  UNION ALL SELECT article_id, category_id, title, published_at, is_liked, is_saved, true,
    TIMESTAMP '{MERGED_AT}' FROM snap)""")
def feed_snapshot(t: Tables):
    return N.merge_feed_snapshot(cached_articles(t), snapshot(t), _merged_at())


@query("merge_saved_snapshot", f"""SELECT * FROM (WITH {_CACHED}
  SELECT article_id, category_id, title, published_at, is_liked, false AS is_saved, in_feed, cached_at FROM cached
    WHERE article_id NOT IN (SELECT article_id FROM snap)
  UNION ALL SELECT s.article_id, s.category_id, s.title, s.published_at, s.is_liked, true,
    coalesce(c.in_feed, false), TIMESTAMP '{MERGED_AT}' FROM snap s LEFT JOIN cached c USING (article_id))""")
def saved_snapshot(t: Tables):
    return N.merge_saved_snapshot(cached_articles(t), snapshot(t), _merged_at())


@query("merge_article_state", f"""SELECT * FROM (WITH {_CACHED}
  SELECT article_id, category_id, title, published_at, is_liked, is_saved, in_feed, cached_at FROM cached
    WHERE article_id NOT IN (SELECT article_id FROM snap)
  UNION ALL SELECT s.article_id, s.category_id, s.title, s.published_at, s.is_liked, s.is_saved,
    coalesce(c.in_feed, false), TIMESTAMP '{MERGED_AT}' FROM snap s LEFT JOIN cached c USING (article_id))""")
def article_state(t: Tables):
    return N.merge_article_state(cached_articles(t), snapshot(t), _merged_at())


@query("merge_saved_set", f"""SELECT * FROM (WITH {_CACHED}
  SELECT article_id, cached_at AS saved_at FROM cached WHERE is_saved
    AND article_id NOT IN (SELECT article_id FROM snap)
  UNION ALL SELECT article_id, TIMESTAMP '{MERGED_AT}' FROM snap WHERE is_saved)""")
def saved_set(t: Tables):
    saved = cached_articles(t).where("is_saved").select("article_id", F.col("cached_at").alias("saved_at"))
    return N.merge_saved_set(saved, snapshot(t), _merged_at())


@query("replace_saved_set", f"""SELECT article_id, TIMESTAMP '{MERGED_AT}' AS saved_at
  FROM (WITH {_CACHED} SELECT * FROM snap)""")
def replaced_set(t: Tables):
    saved = cached_articles(t).where("is_saved").select("article_id", F.col("cached_at").alias("saved_at"))
    return N.merge_saved_set(saved, snapshot(t), _merged_at(), replace=True)


@query("merge_snapshot_categories", f"""SELECT category_id, name, TIMESTAMP '2024-01-01 00:00:00' AS cached_at
    FROM feed_categories WHERE category_id NOT IN (SELECT category_id FROM (WITH {_CACHED} SELECT * FROM snap))
  UNION ALL SELECT category_id, arg_max(title, article_id), TIMESTAMP '{MERGED_AT}'
    FROM (WITH {_CACHED} SELECT * FROM snap) GROUP BY 1""")
def snapshot_categories(t: Tables):
    cached = t.categories.withColumn("cached_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    named = snapshot(t).withColumn("category_name", F.col("title"))
    return N.merge_snapshot_categories(cached, named, _merged_at())


@query("cached_feed", f"""SELECT article_id, title FROM (WITH {_CACHED} SELECT * FROM cached) WHERE in_feed""")
def cached_feed(t: Tables):
    return N.cached_feed(cached_articles(t)).select("article_id", "title")


@query("cached_saved", f"""SELECT article_id, title FROM (WITH {_CACHED} SELECT * FROM cached) WHERE is_saved""")
def cached_saved(t: Tables):
    cached = cached_articles(t)
    return N.cached_saved(cached, cached.where("is_saved")).select("article_id", "title")
