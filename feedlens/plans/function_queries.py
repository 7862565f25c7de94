"""Check queries of the scalar expressions and of the synthetic sources."""

from __future__ import annotations

from itertools import accumulate

from datetime import datetime, timezone

from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.functions import expressions as X
from feedlens.operators import events as E
from feedlens.operators import recommend as R
from feedlens.operators.aggregates import rollup
from feedlens.plans.registry import Tables, query
from feedlens.sources import quotas as Q
from feedlens.sources import synthetic as Y
from feedlens.sources.bridge import table

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)


@query("reason_labels", """SELECT event_id, CASE
    WHEN coalesce(trim(reason), '') = '' THEN 'Picked for you'
    WHEN trim(reason) = 'als_implicit_feedback' THEN 'Based on your activity in the feed'
    WHEN trim(reason) = 'fallback_global_popular' THEN 'Popular with readers'
    ELSE upper(left(trim(reason), 1)) || substr(replace(replace(trim(reason), '_', ' '), '-', ' '), 2) END AS label
  FROM (SELECT event_id, CASE event_type WHEN 'search' THEN ' als_implicit_feedback '
      WHEN 'view_article' THEN 'fallback_global_popular' WHEN 'like_article' THEN '  '
      ELSE event_type || '-' || session_id END AS reason FROM feed_events)""")
def reason_labels(t: Tables):
    kind = F.col("event_type")
    reason = (
        F.when(kind == "search", F.lit(" als_implicit_feedback "))
        .when(kind == "view_article", F.lit("fallback_global_popular"))
        .when(kind == "like_article", F.lit("  "))
        .otherwise(F.concat(kind, F.lit("-"), F.col("session_id")))
    )
    return t.all_events.select("event_id", X.reason_label(reason).alias("label"))


@query("ctr_progress", """SELECT user_id, CASE WHEN opened = 0 THEN 0
    ELSE CAST(floor(least(1, round(clicked / opened, 4)) * 100 + 0.5) AS INTEGER) END AS progress
  FROM (SELECT user_id, CAST(count(*) FILTER (event_type = 'open_recommended_article') AS DOUBLE) AS clicked,
      count(*) FILTER (event_type = 'open_recommendations') AS opened FROM events_valid GROUP BY 1)""")
def ctr_progress(t: Tables):
    rate = X.ratio_or_zero(X.net_count("open_recommended_article"), X.net_count("open_recommendations"))
    return rollup(t.events, "user_id", "event_type").groupBy("user_id").agg(rate.alias("ctr")).select("user_id", X.ctr_progress(F.col("ctr")).alias("progress"))


@query("slugs", """SELECT doc_id, trim(regexp_replace(lower(trim(text)), '[^a-z0-9]+', '-', 'g'), '-') AS slug
  FROM documents""")
def slugs(t: Tables):
    return table(t.spark, t.sf_dir, "documents").select("doc_id", X.slug(F.col("text")).alias("slug"))


@query("clean_emails", """SELECT user_id, lower(trim(email)) AS email, user_id % 10 <> 0 AS email_ok FROM feed_users""")
def emails(t: Tables):
    broken = F.when(F.col("user_id") % 10 == 0, F.regexp_replace("email", "@.*", "@")).otherwise(F.col("email"))
    return t.users.select(
        "user_id", X.clean_email(F.col("email")).alias("email"), X.email_ok(broken).alias("email_ok")
    )


@query("event_weights", """SELECT event_id, CASE event_type WHEN 'view_article' THEN 1.0 WHEN 'like_article' THEN 3.0
      WHEN 'save_article' THEN 5.0 WHEN 'open_recommended_article' THEN 2.0 END::DOUBLE AS rating,
    CASE event_type WHEN 'view_article' THEN 1.0 WHEN 'like_article' THEN 3.0 WHEN 'unlike_article' THEN -3.0
      WHEN 'save_article' THEN 5.0 WHEN 'unsave_article' THEN -5.0 WHEN 'subscribe_category' THEN 4.0
      WHEN 'unsubscribe_category' THEN -4.0 WHEN 'open_recommended_article' THEN 2.0 ELSE 0.0 END::DOUBLE AS interest
  FROM feed_events""")
def event_weights(t: Tables):
    return t.all_events.select(
        "event_id", X.weight(S.RATING_WEIGHTS, None).alias("rating"),
        X.weight(S.INTEREST_WEIGHTS, 0.0).alias("interest"),
    )


# --- synthetic sources ------------------------------------------------------
@query("synthetic_users", """SELECT user_id, printf('generated.user%04d@example.com', user_id) AS email,
    printf('Generated User %04d', user_id) AS full_name, 'user' AS role, true AS is_active FROM feed_users""")
def synthetic_users(t: Tables):
    return Y.synthetic_users(t.users, "user_id")


_TITLED = ("Event-Driven Mobile Analytics", "Recommendation Systems For It Content", "Fastapi Service Boundaries",
           "Postgresql Indexing For Feeds", "Kafka Producer Reliability", "Spark Structured Streaming Windows",
           "Mongodb Raw Event Storage", "Android Offline Sync Queues", "Feature Stores For Personalization",
           "Observability For Data Platforms", "Secure Api Design", "Cloud Cost Control For Prototypes",
           "Batch Analytics With Spark Sql", "Ranking Content For Cold Start Users", "Database Schema Evolution",
           "Mobile Ux For Saved Articles")


def _list(values) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


@query("seed_categories", f"""SELECT number AS category_id, name, {_list(s for _, s in S.SEED_CATEGORIES)}[number] AS slug,
    'Articles about ' || name || '.' AS description, events_count
  FROM (SELECT unnest(generate_series(1, {len(S.SEED_CATEGORIES)})) AS number, unnest({_list(n for n, _ in S.SEED_CATEGORIES)}) AS name)
  JOIN (SELECT category_id AS number, count(*) AS events_count FROM events_valid GROUP BY 1) USING (number)""")
def seed_categories(t: Tables):
    """The seed rows of the categories that have events, with their number."""
    counts = rollup(t.events, "category_id").withColumnRenamed("n", "events_count")
    return Y.seed_categories(t.spark).join(counts, "category_id")


@query("synthetic_articles", f"""SELECT article_id, title, category_id, category_slug, published_at,
    'Demo Author ' || ((article_id - 1) % 20 + 1) AS author,
    title || '. Generated text for demonstrations, ' || (article_id % 9 + 1) || ' minutes to read.' AS content,
    'https://example.com/generated/' || padded || '-' ||
      trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-') AS source_url
  FROM (SELECT article_id, padded, {_list(n for n, _ in S.SEED_CATEGORIES)}[(article_id - 1) % 12 + 1] || ': ' ||
      {_list(_TITLED)}[(article_id - 1) % 16 + 1] || ' Demo #' || padded AS title,
      (article_id - 1) % 12 + 1 AS category_id,
      {_list(s for _, s in S.SEED_CATEGORIES)}[(article_id - 1) % 12 + 1] AS category_slug,
      TIMESTAMP '2024-01-31 00:00:00' - to_days(CAST(article_id % 30 AS INTEGER))
        - to_minutes(article_id * 7 % 1440) AS published_at
    FROM (SELECT article_id, printf('%04d', article_id) AS padded FROM feed_articles))""")
def synthetic_articles(t: Tables):
    return Y.synthetic_articles(t.articles, NOW, "article_id").select(
        "article_id", "title", "category_id", "category_slug", "published_at", "source_url", "author", "content"
    )


def _synthetic(t: Tables):
    users, articles = Y.event_references(t.users, t.articles)
    rows = table(t.spark, t.sf_dir, "events").select("event_id")
    return Y.synthetic_events(rows, users, articles, NOW, "event_id")


def _draw(salt: str, *keys: str) -> str:
    text = " || '|' || ".join([*[f"CAST({key} AS VARCHAR)" for key in keys or ("row_id",)], f"'42:{salt}'"])
    return f"CAST(('0x' || md5({text})[:15]) AS BIGINT)"


def _pick(values, salt: str) -> str:
    return f"{_list(values)}[{_draw(salt)} % {len(values)} + 1]"


def _types(values) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


def _uuid(text: str) -> str:
    digest = f"md5({text})"
    return " || '-' || ".join(f"{digest}[{low}:{high}]" for low, high in ((1, 8), (9, 12), (13, 16), (17, 20), (21, 32)))


_MIX = "CASE " + " ".join(
    f"WHEN {_draw('type')} % {sum(S.EVENT_MIX.values())} < {upto} THEN '{name}'"
    for name, upto in zip(S.EVENT_MIX, accumulate(S.EVENT_MIX.values()), strict=True)) + " END"
_SYNTHETIC = f"""SELECT * FROM (WITH people AS (SELECT user_id, row_number() OVER (ORDER BY user_id) AS user_no
    FROM feed_users WHERE is_active AND role = 'user'),
  texts AS (SELECT article_id, category_id AS article_category_id, row_number() OVER (ORDER BY article_id) AS article_no FROM feed_articles),
  kinds AS (SELECT category_id AS drawn_category_id, row_number() OVER (ORDER BY category_id) AS category_no
    FROM (SELECT DISTINCT category_id FROM feed_articles)),
  typed AS (SELECT row_id, {_MIX} AS event_type FROM (SELECT CAST(event_id AS BIGINT) AS row_id FROM events)),
  drawn AS (SELECT *, {_draw('user')} % (SELECT count(*) FROM people) + 1 AS user_no,
    CASE WHEN event_type IN {_types(S.ARTICLE_EVENT_TYPES)} THEN {_draw('article')} % (SELECT count(*) FROM texts) + 1 END AS article_no,
    CASE WHEN event_type IN {_types(S.CATEGORY_EVENT_TYPES)} THEN {_draw('category')} % (SELECT count(*) FROM kinds) + 1 END AS category_no
    FROM typed)
  SELECT {_uuid("'event 42|' || row_id")} AS event_id, user_id,
    {_uuid(f"'session 42|' || user_id || '|' || {_draw('session')} % ({_draw('sessions', 'user_id')} % 7 + 2)")} AS session_id,
    event_type, article_id, coalesce(drawn_category_id, article_category_id) AS category_id,
    TIMESTAMP '2024-01-31 00:00:00' - to_days(CAST({_draw('day')} % 30 AS INTEGER)) - to_seconds({_draw('second')} % 86400) AS event_timestamp,
    '{{"platform":"android","app_version":"' || {_pick(S.APP_VERSIONS, 'app')} || '","os_version":"' || {_pick(S.OS_VERSIONS, 'os')} || '"}}' AS device,
    CASE event_type
      WHEN 'search' THEN '{{"query":"' || {_pick(S.SEARCH_TERMS, 'term')} || '","source":"feed_search"}}'
      WHEN 'view_article' THEN '{{"duration_seconds":"' || {_draw('duration')} % 233 + 8 || '","source":"' || {_pick(S.VIEW_SOURCES, 'view source')} || '"}}'
      WHEN 'open_recommended_article' THEN '{{"recommendation_rank":"' || {_draw('rank')} % 20 + 1 || '","reason":"' || {_pick(S.OPEN_REASONS, 'open reason')} || '"}}'
      ELSE '{{"source":"' || {_pick(S.OTHER_SOURCES, 'source')} || '"}}' END AS metadata
  FROM drawn JOIN people USING (user_no) LEFT JOIN texts USING (article_no) LEFT JOIN kinds USING (category_no))"""


@query("synthetic_events", _SYNTHETIC)
def synthetic_events(t: Tables):
    return _synthetic(t).withColumns({"device": F.to_json("device"), "metadata": F.to_json("metadata")})


@query("synthetic_event_checks", """SELECT count(*) AS events_count, count(*) AS distinct_ids, 0 AS invalid,
    0 AS unknown_users, 0 AS missing_metadata, 0 AS wrong_platform, 0 AS out_of_range,
    0 AS category_mismatch, 0 AS unexpected_article, 10 AS types_seen FROM events""")
def synthetic_checks(t: Tables):
    """Invariants of the generator over the whole output."""
    events = E.validate_events(_synthetic(t))
    quality = E.event_quality_report(events, t.articles)
    wrong_links = quality.agg(
        F.sum(F.col("category_mismatch") + F.col("unknown_article")).cast("int").alias("category_mismatch"),
        F.sum("unexpected_article").cast("int").alias("unexpected_article"),
        F.count("*").cast("int").alias("types_seen"),
    )
    low, high = X.days_before(NOW, 31), X.utc_literal(NOW)
    unknown = events.join(R.active_users(t.users), "user_id", "left_anti").select(F.count("*").alias("n"))
    totals = events.agg(
        F.count("*").alias("events_count"), F.countDistinct("event_id").alias("distinct_ids"),
        F.count_if(~F.col("is_valid")).cast("int").alias("invalid"),
        F.max(unknown.scalar()).cast("int").alias("unknown_users"),
        F.count_if(F.size("metadata") < 1).cast("int").alias("missing_metadata"),
        F.count_if(F.col("device")["platform"] != "android").cast("int").alias("wrong_platform"),
        F.count_if(~F.col("event_timestamp").between(low, high)).cast("int").alias("out_of_range"),
    )
    return totals.select(
        "*", *[wrong_links.select(name).scalar().alias(name) for name in wrong_links.columns]
    )


_TOTAL = sum(S.EVENT_MIX.values())
_QUOTAS = ", ".join(
    f"('{name}', {upto - share}, {upto}, {share})" for (name, share), upto in zip(S.EVENT_MIX.items(), accumulate(S.EVENT_MIX.values()), strict=True))


@query("synthetic_type_quotas", f"""SELECT event_type, n * upto // {_TOTAL} - n * below // {_TOTAL} AS events_count,
    n * CAST(weight AS DOUBLE) / {_TOTAL} AS expected,
    pow(n * upto // {_TOTAL} - n * below // {_TOTAL} - n * CAST(weight AS DOUBLE) / {_TOTAL}, 2) / (n * CAST(weight AS DOUBLE) / {_TOTAL}) AS deviation
  FROM (VALUES {_QUOTAS}) AS q(event_type, below, upto, weight), (SELECT count(*) AS n FROM events)""")
def synthetic_type_quotas(t: Tables):
    """Types of synthetic events with exact shares, one event per row of the events."""
    users, articles = Y.event_references(t.users, t.articles)
    rows = table(t.spark, t.sf_dir, "events").select("event_id")
    return Q.draw_profile(Y.synthetic_events(rows, users, articles, NOW, "event_id", exact_types=True), S.EVENT_MIX)
