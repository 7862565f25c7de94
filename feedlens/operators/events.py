"""Event layer: decode, normalise, validate, split, dedupe, profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.functions import expressions as X
from feedlens.operators.ranking import top_per_key, total_order

MAX_WRAPPED_BATCH = 1000

# Wire name -> names a client may send it under.
PAYLOAD_ALIASES = {
    "event_id": ("event_id", "eventId"),
    "session_id": ("session_id", "sessionId"),
    "event_type": ("event_type", "eventType"),
    "article_id": ("article_id", "articleId"),
    "category_id": ("category_id", "categoryId"),
    "timestamp": ("timestamp",),
    "device": ("device",),
    "metadata": ("metadata",),
}


def decode_events(records: DataFrame) -> DataFrame:
    """Log records (topic, partition, offset, timestamp, value) to typed events.

    Broken JSON gives NULL fields and a broken timestamp gives NULL, so bad records
    reach the dead letters instead of failing the job. The event comes out of a
    generator: a predicate on a plain projection would be pushed below it with a JSON
    parse of its own for every field it tests.
    """
    event = F.explode(F.array(F.from_json("raw_json", S.WIRE_EVENT)))
    parsed = records.select(
        "topic", "partition", "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("raw_json"),
    ).withColumn("event", event)
    return (
        parsed.select("*", "event.*")
        .withColumn("event_timestamp", F.try_to_timestamp("timestamp"))
        .drop("event", "timestamp")
    )


def encode_events(events: DataFrame) -> DataFrame:
    """Typed events to (key, value) log records: one JSON object per event."""
    names = ["event_id", "user_id", "session_id", "event_type", "article_id", "category_id"]
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp")
    extra = [name for name in ("device", "metadata") if name in events.columns]
    return events.select(
        F.col("event_id").alias("key"), F.to_json(F.struct(*names, stamp, *extra)).alias("value")
    )


def normalize_events(payloads: DataFrame, user_id: str | Column = "user_id",
                     event_id_default: Column | None = None,
                     now: Column | None = None) -> DataFrame:
    """Client payloads to wire events: aliases resolved, defaults filled, user attached."""
    present = set(payloads.columns)

    def field(name: str) -> Column:
        found = [F.col(alias) for alias in PAYLOAD_ALIASES[name] if alias in present]
        return F.coalesce(*found) if found else F.lit(None)

    empty_map = F.from_json(F.lit("{}"), "MAP<STRING, STRING>")
    return payloads.select(
        F.coalesce(field("event_id").cast("string"), F.uuid() if event_id_default is None else event_id_default)
        .alias("event_id"),
        (F.col(user_id) if isinstance(user_id, str) else user_id).cast("long").alias("user_id"),
        field("session_id").cast("string").alias("session_id"),
        field("event_type").cast("string").alias("event_type"),
        field("article_id").cast("long").alias("article_id"),
        field("category_id").cast("long").alias("category_id"),
        F.coalesce(field("timestamp").cast("timestamp"), F.current_timestamp() if now is None else now)
        .alias("event_timestamp"),
        field("device").cast("MAP<STRING, STRING>").alias("device"),
        F.coalesce(field("metadata").cast("MAP<STRING, STRING>"), empty_map).alias("metadata"),
    )


def _links_missing() -> Column:
    article_lost = F.col("event_type").isin(*S.ARTICLE_EVENT_TYPES) & F.col("article_id").isNull()
    category_lost = F.col("event_type").isin(*S.CATEGORY_EVENT_TYPES) & F.col("category_id").isNull()
    return article_lost | category_lost


def validate_events(events: DataFrame, require_session: bool = True) -> DataFrame:
    """Adds ``validation_error`` (NULL when valid) and ``is_valid`` (never NULL).

    An event without a type is invalid like any other incomplete one, so each event is
    on exactly one side of the split. API actions carry no session;
    ``require_session=False`` lets them pass.
    """
    required = ["event_id", "user_id", "event_timestamp"] + (["session_id"] if require_session else [])
    complete = F.coalesce(F.col("event_type").isin(*S.EVENT_TYPES), F.lit(False))
    for name in required:
        complete = complete & F.col(name).isNotNull()
    error = F.when(~complete, F.lit(S.ERROR_BASE)).when(_links_missing(), F.lit(S.ERROR_LINK))
    return events.withColumn("validation_error", error).withColumn(
        "is_valid", F.col("validation_error").isNull()
    )


def split_events(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid)."""
    return validated.where("is_valid"), validated.where("NOT is_valid")


def valid_events(events: DataFrame, require_session: bool = True) -> DataFrame:
    checked = validate_events(events, require_session)
    return split_events(checked)[0].drop("validation_error", "is_valid")


def payload_errors(events: DataFrame) -> DataFrame:
    """API-level checks as an array of codes in ``errors``; empty when accepted."""
    def uuid_wrong(name: str) -> Column:
        return F.col(name).isNotNull() & ~F.col(name).rlike(X.UUID_PATTERN)

    known = F.coalesce(F.col("event_type").isin(*S.EVENT_TYPES), F.lit(False))
    article = F.col("event_type").isin(*S.ARTICLE_EVENT_TYPES)
    category = F.col("event_type").isin(*S.CATEGORY_EVENT_TYPES)
    checks = {
        "event_id_not_uuid": uuid_wrong("event_id"),
        "session_id_not_uuid": uuid_wrong("session_id"),
        "event_type_unknown": ~known,
        "article_id_below_one": F.col("article_id") < 1,
        "category_id_below_one": F.col("category_id") < 1,
        "article_id_required": article & F.col("article_id").isNull(),
        "category_id_required": category & F.col("category_id").isNull(),
    }
    codes = F.array(*[F.when(failed, F.lit(code)) for code, failed in checks.items()])
    return events.withColumn("errors", F.array_compact(codes))


def oversized_batches(events: DataFrame, batch_col: str) -> DataFrame:
    """Wrapped request batches above the limit of 1000 events (a batch with a row has
    at least one)."""
    return (
        events.groupBy(batch_col).agg(F.count("*").alias("events_count"))
        .where(F.col("events_count") > MAX_WRAPPED_BATCH)
    )


def dedupe_events(events: DataFrame, first_by: tuple[str, ...] = ("event_timestamp",)) -> DataFrame:
    """One row per ``event_id``: the earliest, ties broken by all columns. Events
    without an id are all kept.

    The rows without an id go around the window; with their own window partition
    they would all meet in one task.
    """
    leading = tuple(name for name in first_by if name in events.columns)
    identified = top_per_key(
        events.where(F.col("event_id").isNotNull()), ["event_id"], total_order(events, leading), 1
    )
    return identified.unionByName(events.where(F.col("event_id").isNull()))


def ingest_new_events(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert-if-absent: the first copy of every incoming event not stored yet.

    Only stored rows from the first to the last incoming event time are looked at. Rows
    without an id cannot be told from stored ones and are always inserted.
    """
    fresh = dedupe_events(incoming)
    if {"event_timestamp"} <= set(stored.columns) & set(incoming.columns):
        span = fresh.agg(F.min("event_timestamp").alias("low"), F.max("event_timestamp").alias("high"))
        stored = stored.where(
            F.col("event_timestamp").isNull()
            | F.col("event_timestamp").between(span.select("low").scalar(), span.select("high").scalar())
        )
    return fresh.join(stored.select("event_id"), "event_id", "left_anti")


def interaction_events(raw: DataFrame | None, audit: DataFrame) -> DataFrame:
    """Raw store and audit table together, each event once.

    The caller passes ``None`` for a store that is not there; an unreadable one fails
    instead of silently halving the history.
    """
    names = ["event_id", "user_id", "article_id", "category_id", "event_type"]
    typed = {"event_id": "string", "user_id": "long", "article_id": "long",
             "category_id": "long", "event_type": "string"}

    def narrow(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(name).cast(typed[name]).alias(name) for name in names])

    both = narrow(audit) if raw is None else narrow(raw).unionByName(narrow(audit))
    return dedupe_events(both)


def choose_source(raw: DataFrame | None, audit: DataFrame) -> tuple[str, DataFrame]:
    """Reports read the raw store when it holds at least one event, else the audit."""
    if raw is not None and not raw.isEmpty():
        return "raw_user_events", raw
    return "pending_events", audit


def event_quality_report(events: DataFrame, articles: DataFrame) -> DataFrame:
    """Per event type: counts, key coverage, time bounds and link violations.

    The article's category is checked after grouping by (type, article, category), so
    the join sees one row per combination and a hot article is one row, not a third of
    the events.
    """
    unlinked = ~F.col("event_type").isin(*S.ARTICLE_EVENT_TYPES)
    combos = events.groupBy("event_type", "article_id", "category_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("event_id").isNull()).alias("no_id"),
        F.count_if(F.col("session_id").isNull()).alias("no_session"),
        F.count_if(F.col("user_id").isNull()).alias("no_user"),
        F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
    )
    home = articles.select("article_id", F.col("category_id").alias("home_category_id"))

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return combos.join(home, "article_id", "left").groupBy("event_type").agg(
        F.sum("n").alias("events_count"),
        F.sum("no_id").alias("missing_event_id"),
        F.sum("no_session").alias("missing_session_id"),
        F.sum("no_user").alias("missing_user_id"),
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
        rows_where(F.col("article_id").isNotNull() & F.col("home_category_id").isNull())
        .alias("unknown_article"),
        rows_where(F.col("home_category_id") != F.col("category_id")).alias("category_mismatch"),
        rows_where(F.coalesce(unlinked, F.lit(True)) & F.col("article_id").isNotNull())
        .alias("unexpected_article"),
    )


def ingest_summary(responses: DataFrame) -> DataFrame:
    """Accepted and failed deliveries of a batch."""
    failed = F.count_if(F.col("delivery") == "failed")
    return responses.agg(
        (F.count("*") - failed).alias("accepted_count"), failed.alias("failed_count")
    )


def to_audit_rows(events: DataFrame, error: str | None = "generated_to_db") -> DataFrame:
    """Events as audit-table rows."""
    return events.select(
        "event_id", "user_id", "session_id", "event_type", "article_id", "category_id",
        F.col("event_timestamp").alias("timestamp"), "device",
        F.col("metadata").alias("metadata_json"),
        F.lit(error).cast("string").alias("error"),
    )
