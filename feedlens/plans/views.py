"""DuckDB text of the derived feed tables, put before a check query as needed."""

from __future__ import annotations

import re

MIDDLE = "2024-01-16 00:00:00"

_BASE_OK = """event_id IS NOT NULL AND user_id IS NOT NULL AND session_id IS NOT NULL
    AND event_timestamp IS NOT NULL AND coalesce(event_type IN ('view_article', 'like_article',
    'unlike_article', 'save_article', 'unsave_article', 'subscribe_category',
    'unsubscribe_category', 'search', 'open_recommendations', 'open_recommended_article'), false)"""
_LINKS_OK = """NOT (coalesce(event_type IN ('view_article', 'like_article', 'unlike_article',
    'save_article', 'unsave_article', 'open_recommended_article'), false) AND article_id IS NULL)
    AND NOT (coalesce(event_type IN ('subscribe_category', 'unsubscribe_category'), false)
    AND category_id IS NULL)"""

RATING = """CASE event_type WHEN 'view_article' THEN 1.0 WHEN 'like_article' THEN 3.0
    WHEN 'save_article' THEN 5.0 WHEN 'open_recommended_article' THEN 2.0 ELSE 0.0 END"""
INTEREST = """CASE event_type WHEN 'view_article' THEN 1.0 WHEN 'like_article' THEN 3.0
    WHEN 'unlike_article' THEN -3.0 WHEN 'save_article' THEN 5.0 WHEN 'unsave_article' THEN -5.0
    WHEN 'subscribe_category' THEN 4.0 WHEN 'unsubscribe_category' THEN -4.0
    WHEN 'open_recommended_article' THEN 2.0 ELSE 0.0 END"""
SCORE_SUM = f"CAST(coalesce(sum({RATING}), 0) AS DOUBLE)"
DELTAS = f"""CAST(sum({INTEREST}) AS DOUBLE) AS score_delta,
    count(*) FILTER (event_type = 'view_article') AS views_delta,
    count(*) FILTER (event_type = 'like_article')
      - count(*) FILTER (event_type = 'unlike_article') AS likes_delta,
    count(*) FILTER (event_type = 'save_article')
      - count(*) FILTER (event_type = 'unsave_article') AS saves_delta"""
COUNTERS = """count(*) FILTER (event_type = 'view_article') AS views_count,
    count(*) FILTER (event_type = 'like_article') AS likes_count,
    count(*) FILTER (event_type = 'save_article') AS saves_count"""
OPENED = "count(*) FILTER (event_type = 'open_recommendations')"
CLICKED = "count(*) FILTER (event_type = 'open_recommended_article')"
CTR = f"""{OPENED} AS recommendations_opened, {CLICKED} AS recommended_articles_opened,
    CASE WHEN {OPENED} > 0 THEN round(CAST({CLICKED} AS DOUBLE) / {OPENED}, 4)
    ELSE CAST(0 AS DOUBLE) END AS recommendation_ctr"""


def _state(on: str, off: str, key: str) -> str:
    return f"""SELECT user_id, {key}, event_timestamp AS created_at FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, {key}
          ORDER BY event_timestamp DESC, event_id DESC, event_type DESC) AS rn
        FROM events_valid WHERE event_type IN ('{on}', '{off}') AND {key} IS NOT NULL)
      WHERE rn = 1 AND event_type = '{on}'"""


def _scores(source: str) -> str:
    return f"""SELECT user_id, category_id, greatest(0, score_delta) AS score,
      greatest(0, views_delta) AS views_count, greatest(0, likes_delta) AS likes_count,
      greatest(0, saves_delta) AS saves_count
    FROM (SELECT user_id, category_id, {DELTAS} FROM {source} WHERE category_id IS NOT NULL GROUP BY ALL)"""


VIEWS = {
    "feed_users": """SELECT c_custkey + 1 AS user_id, ' ' || c_name || '@Example.COM ' AS email,
      CASE WHEN c_custkey % 50 = 0 THEN 'admin' ELSE 'user' END AS role,
      c_acctbal > 0 AS is_active FROM customer""",
    "feed_categories": "SELECT CAST(n_nationkey + 1 AS BIGINT) AS category_id, n_name AS name FROM nation",
    "feed_articles": """SELECT p_partkey + 1 AS article_id, p_partkey % 25 + 1 AS category_id,
      p_name AS title, p_brand || ' ' || p_type AS summary,
      'https://example.com/a/' || p_partkey AS source_url,
      TIMESTAMP '2024-01-01 00:00:00' + to_days(p_size) AS published_at,
      p_retailprice AS popularity_score FROM part""",
    "long_articles": """SELECT doc_id + 1 AS article_id, doc_id % 25 + 1 AS category_id,
      source || ' ' || lang AS title, lang AS summary, text AS content,
      TIMESTAMP '2024-01-01 00:00:00' + to_minutes(n_chars % 1440) AS published_at,
      CAST(n_chars AS DOUBLE) AS popularity_score FROM documents""",
    "typed_events": """SELECT event_id, user_id, ts, event_type AS kind,
      CAST(json_extract(props, '$.k') AS BIGINT) AS number, event_id % 10 AS digit,
      CASE event_type
        WHEN 'view' THEN CASE WHEN event_id % 10 < 8 THEN 'view_article'
          WHEN event_id % 10 = 8 THEN 'open_recommendations' ELSE 'search' END
        WHEN 'click' THEN CASE WHEN event_id % 10 < 4 THEN 'like_article'
          WHEN event_id % 10 < 7 THEN 'open_recommended_article'
          WHEN event_id % 10 = 7 THEN 'unlike_article' ELSE 'open_recommendations' END
        WHEN 'purchase' THEN CASE WHEN event_id % 10 < 7 THEN 'save_article' ELSE 'unsave_article' END
        WHEN 'signup' THEN CASE WHEN event_id % 10 < 7 THEN 'subscribe_category'
          ELSE 'unsubscribe_category' END
        ELSE CASE WHEN event_id % 10 < 3 THEN 'view_article'
          WHEN event_id % 10 < 6 THEN 'subscribe_category' WHEN event_id % 10 < 8 THEN 'bogus_event'
          WHEN event_id % 10 = 8 THEN NULL ELSE 'like_article' END END AS feed_type
      FROM events""",
    "feed_events": """SELECT CAST(event_id AS VARCHAR) AS event_id,
      CASE WHEN kind = 'error' AND digit = 9 THEN NULL ELSE user_id + 1 END AS user_id,
      's' || user_id || '-' || (number % 5) AS session_id, feed_type AS event_type,
      CASE WHEN kind <> 'error' AND contains(feed_type, '_article') THEN number * 2 + event_id % 2 + 1 END AS article_id,
      CASE WHEN kind = 'error' THEN NULL
        WHEN contains(feed_type, '_article') THEN (number * 2 + event_id % 2) % 25 + 1
        WHEN contains(feed_type, '_category') THEN number % 25 + 1 END AS category_id,
      CAST(ts AS TIMESTAMP) AS event_timestamp FROM typed_events""",
    "events_checked": f"""SELECT *, CASE WHEN NOT ({_BASE_OK})
        THEN 'missing_required_field_or_invalid_event_type'
        WHEN NOT ({_LINKS_OK}) THEN 'missing_required_article_or_category_link' END AS validation_error
      FROM feed_events""",
    "events_valid": """SELECT event_id, user_id, session_id, event_type, article_id, category_id,
      event_timestamp FROM events_checked WHERE validation_error IS NULL""",
    "order_events": """SELECT l_orderkey || '-' || l_linenumber AS event_id, o_custkey + 1 AS user_id,
      'o' || l_orderkey AS session_id,
      CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'view_article' WHEN 'RO' THEN 'view_article'
        WHEN 'AO' THEN 'like_article' WHEN 'NF' THEN 'save_article'
        WHEN 'NO' THEN 'open_recommended_article' WHEN 'RF' THEN 'unlike_article' END AS event_type,
      l_partkey + 1 AS article_id, l_partkey % 25 + 1 AS category_id,
      CAST(l_shipdate AS TIMESTAMP) AS event_timestamp
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "order_once": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp,
      user_id, session_id, event_type, article_id, category_id) AS rn FROM order_events) WHERE rn = 1""",
    "likes": _state("like_article", "unlike_article", "article_id"),
    "saves": _state("save_article", "unsave_article", "article_id"),
    "subscriptions": _state("subscribe_category", "unsubscribe_category", "category_id"),
    "active_users": "SELECT DISTINCT user_id FROM feed_users WHERE is_active AND role = 'user'",
    "ratings": f"""SELECT user_id, article_id, CAST(sum({RATING}) AS DOUBLE) AS rating,
      count(*) AS events_count FROM events_valid WHERE event_type IN ('view_article', 'like_article',
      'save_article', 'open_recommended_article') GROUP BY ALL HAVING sum({RATING}) > 0""",
    "popularity": """SELECT a.article_id, a.category_id, a.published_at,
      coalesce(a.popularity_score, 0) AS article_popularity_score,
      CAST(coalesce(r.s, 0) AS DOUBLE) AS interaction_score,
      CAST(coalesce(r.n, 0) AS BIGINT) AS interaction_events_count,
      CAST(coalesce(r.s, 0) AS DOUBLE) + coalesce(a.popularity_score, 0) * CAST(0.1 AS DOUBLE)
        AS fallback_score
      FROM feed_articles a LEFT JOIN (SELECT article_id, sum(rating) AS s, sum(events_count) AS n
        FROM ratings GROUP BY 1) r USING (article_id)""",
    "deltas_first": f"""SELECT user_id, category_id, {DELTAS} FROM events_valid
      WHERE category_id IS NOT NULL AND event_timestamp < TIMESTAMP '{MIDDLE}' GROUP BY ALL""",
    "deltas_second": f"""SELECT user_id, category_id, {DELTAS} FROM events_valid
      WHERE category_id IS NOT NULL AND event_timestamp >= TIMESTAMP '{MIDDLE}' GROUP BY ALL""",
    "scores": _scores("events_valid"),
    "order_scores": _scores("order_events"),
    "old_scores": """SELECT user_id, category_id, greatest(0, score_delta) AS score,
      greatest(0, views_delta) AS views_count, greatest(0, likes_delta) AS likes_count,
      greatest(0, saves_delta) AS saves_count FROM deltas_first""",
    "subscribed_ranked": """SELECT * FROM (SELECT s.user_id, p.article_id, p.fallback_score AS score,
        'fallback_subscribed_category' AS reason, 2 AS source_priority
      FROM subscriptions s JOIN active_users USING (user_id) JOIN popularity p USING (category_id)
      WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = s.user_id
        AND r.article_id = p.article_id))""",
    "pool": """SELECT article_id, fallback_score FROM popularity
      ORDER BY fallback_score DESC, published_at DESC NULLS LAST, article_id""",
    "popular_ranked": """SELECT u.user_id, p.article_id, p.fallback_score AS score,
        'fallback_global_popular' AS reason, 3 AS source_priority
      FROM active_users u CROSS JOIN pool p
      WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = u.user_id
        AND r.article_id = p.article_id)""",
    "fallback": """SELECT user_id, article_id, score, reason, source_priority FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY source_priority, score DESC, article_id) AS place FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, article_id
          ORDER BY source_priority, score DESC) AS best
        FROM (FROM subscribed_ranked UNION ALL FROM popular_ranked)) WHERE best = 1) WHERE place <= 10""",
    "stored_recs": """SELECT user_id, article_id % 200 + 1 AS article_id,
      rating * CAST(0.25 AS DOUBLE) AS score, 'seeded' AS reason,
      CASE WHEN article_id % 2 = 0 THEN 'als-v1' ELSE 'seed' END AS model_version,
      TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(events_count AS INTEGER)) AS created_at
      FROM ratings""",
    "affinities": """SELECT user_id, category_id, CAST(sum(w) AS DOUBLE) AS affinity FROM (
        SELECT user_id, article_id, 3.0 AS w FROM likes
        UNION ALL SELECT user_id, article_id, 5.0 FROM saves)
      JOIN feed_articles USING (article_id) GROUP BY ALL""",
}


def _needed(sql: str, found: list[str]) -> list[str]:
    for name, text in VIEWS.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(text, found)
            found.append(name)
    return found


def with_views(sql: str) -> str:
    """``sql`` with the views it names, and those they name, as common tables."""
    names = _needed(sql, [])
    if not names:
        return sql
    common = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in names)
    return f"WITH RECURSIVE {common}\n{sql}"
