"""Table layouts, enumerations and weights.

Layouts are DDL strings: ``spark.read.schema`` and ``from_json`` take them as they
are, so no schema is ever inferred.
"""

from __future__ import annotations

# --- fixed values: event vocabulary -----------------------------------------
ARTICLE_EVENT_TYPES = (
    "view_article",
    "like_article",
    "unlike_article",
    "save_article",
    "unsave_article",
    "open_recommended_article",
)
CATEGORY_EVENT_TYPES = ("subscribe_category", "unsubscribe_category")
UNLINKED_EVENT_TYPES = ("search", "open_recommendations")
EVENT_TYPES = ARTICLE_EVENT_TYPES + CATEGORY_EVENT_TYPES + UNLINKED_EVENT_TYPES

# --- fixed values: scores ---------------------------------------------------
INTEREST_WEIGHTS = {
    "view_article": 1.0,
    "like_article": 3.0,
    "unlike_article": -3.0,
    "save_article": 5.0,
    "unsave_article": -5.0,
    "subscribe_category": 4.0,
    "unsubscribe_category": -4.0,
    "open_recommended_article": 2.0,
}
RATING_WEIGHTS = {
    "view_article": 1.0,
    "like_article": 3.0,
    "save_article": 5.0,
    "open_recommended_article": 2.0,
}
LIKE_AFFINITY = 3.0
SAVE_AFFINITY = 5.0
SEED_POPULARITY_SHARE = 0.1

# --- fixed values: error codes, recommendation reasons ----------------------
ERROR_BASE = "missing_required_field_or_invalid_event_type"
ERROR_LINK = "missing_required_article_or_category_link"

REASON_ALS = "als_implicit_feedback"
REASON_SUBSCRIBED = "fallback_subscribed_category"
REASON_POPULAR = "fallback_global_popular"
REASON_ACTIVITY = "personalized_recent_activity"
PRIORITY_ALS, PRIORITY_SUBSCRIBED, PRIORITY_POPULAR = 1, 2, 3

# --- fixed values: generator vocabulary -------------------------------------
EVENT_MIX = {
    "view_article": 46,
    "like_article": 10,
    "save_article": 8,
    "open_recommended_article": 7,
    "search": 10,
    "open_recommendations": 7,
    "subscribe_category": 5,
    "unsubscribe_category": 2,
    "unlike_article": 2,
    "unsave_article": 3,
}
SEARCH_TERMS = (
    "spark", "kafka", "fastapi", "android offline", "postgres index",
    "recommendations", "mongodb events", "security jwt", "big data", "mobile analytics",
)
APP_VERSIONS = ("1.0.0", "1.1.0", "1.2.0")
OS_VERSIONS = ("10", "11", "12", "13", "14", "15")
VIEW_SOURCES = ("feed", "category", "saved", "push")
OPEN_REASONS = ("category_interest", "popular_now", "similar_users")
OTHER_SOURCES = ("feed", "detail", "category", "recommendations")

SEED_CATEGORIES = (
    ("Artificial Intelligence", "ai"),
    ("Machine Learning", "machine-learning"),
    ("Backend", "backend"),
    ("Frontend", "frontend"),
    ("Mobile", "mobile"),
    ("Big Data", "big-data"),
    ("Data Engineering", "data-engineering"),
    ("DevOps", "devops"),
    ("Cloud", "cloud"),
    ("Cybersecurity", "cybersecurity"),
    ("Databases", "databases"),
    ("Architecture", "architecture"),
)
SEED_TOPICS = (
    "event-driven mobile analytics",
    "recommendation systems for IT content",
    "FastAPI service boundaries",
    "PostgreSQL indexing for feeds",
    "Kafka producer reliability",
    "Spark Structured Streaming windows",
    "MongoDB raw event storage",
    "Android offline sync queues",
    "feature stores for personalization",
    "observability for data platforms",
    "secure API design",
    "cloud cost control for prototypes",
    "batch analytics with Spark SQL",
    "ranking content for cold start users",
    "database schema evolution",
    "mobile UX for saved articles",
)

# --- table layouts ----------------------------------------------------------
WIRE_EVENT = (
    "event_id STRING, user_id BIGINT, session_id STRING, event_type STRING, "
    "article_id BIGINT, category_id BIGINT, timestamp STRING, "
    "device MAP<STRING, STRING>, metadata MAP<STRING, STRING>"
)
LOG_RECORD = "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, value STRING"
RAW_EVENTS = (
    "event_id STRING, user_id BIGINT, session_id STRING, event_type STRING, "
    "article_id BIGINT, category_id BIGINT, event_timestamp TIMESTAMP, "
    "device MAP<STRING, STRING>, metadata MAP<STRING, STRING>, raw_json STRING, "
    "topic STRING, partition INT, offset BIGINT, kafka_timestamp TIMESTAMP"
)
USERS = (
    "user_id BIGINT, email STRING, full_name STRING, role STRING, is_active BOOLEAN, "
    "created_at TIMESTAMP, last_login_at TIMESTAMP"
)
CATEGORIES = "category_id BIGINT, name STRING, slug STRING, description STRING"
ARTICLES = (
    "article_id BIGINT, title STRING, summary STRING, content STRING, source_url STRING, "
    "category_id BIGINT, author STRING, published_at TIMESTAMP, created_at TIMESTAMP, "
    "popularity_score DOUBLE"
)
SUBSCRIPTIONS = "user_id BIGINT, category_id BIGINT, created_at TIMESTAMP"
ARTICLE_LIKES = "user_id BIGINT, article_id BIGINT, created_at TIMESTAMP"
SAVED_ARTICLES = ARTICLE_LIKES
PENDING_EVENTS = (
    "event_id STRING, user_id BIGINT, session_id STRING, event_type STRING, "
    "article_id BIGINT, category_id BIGINT, timestamp TIMESTAMP, "
    "device MAP<STRING, STRING>, metadata_json MAP<STRING, STRING>, error STRING, "
    "created_at TIMESTAMP"
)
USER_CATEGORY_SCORES = (
    "user_id BIGINT, category_id BIGINT, score DOUBLE, views_count BIGINT, "
    "likes_count BIGINT, saves_count BIGINT"
)
SCORE_DELTAS = (
    "user_id BIGINT, category_id BIGINT, score_delta DOUBLE, views_delta BIGINT, "
    "likes_delta BIGINT, saves_delta BIGINT"
)
DAILY_EVENT_STATS = (
    "date DATE, event_type STRING, category_id BIGINT, events_count BIGINT, "
    "unique_users_count BIGINT"
)
RECOMMENDATIONS = (
    "user_id BIGINT, article_id BIGINT, score DOUBLE, reason STRING, "
    "model_version STRING, created_at TIMESTAMP"
)
CANDIDATES = (
    "user_id BIGINT NOT NULL, article_id BIGINT NOT NULL, score DOUBLE NOT NULL, "
    "reason STRING NOT NULL, model_version STRING NOT NULL, source_priority INT NOT NULL"
)
DELIVERY_RESPONSES = "event_id STRING, status STRING, delivery STRING, detail STRING"
