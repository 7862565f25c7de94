"""Check queries of search, pages, flags, interaction state and article changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.operators import content as C
from feedlens.plans.registry import Tables, query
from feedlens.plans.views import MIDDLE
from feedlens.sources.bridge import table

READER = 7
_LIST = "article_id, title, summary, category_id, published_at, popularity_score"


def _hit(pattern: str) -> str:
    return f"(title ILIKE '{pattern}' OR summary ILIKE '{pattern}' OR content ILIKE '{pattern}')"


@query("article_search", f"SELECT article_id FROM long_articles WHERE {_hit('%THERON%')}")
def search(t: Tables):
    return C.search_articles(t.long_articles, "  THERON ").select("article_id")


@query("article_search_wildcards", f"SELECT article_id FROM long_articles WHERE {_hit('%th_r%on%')} AND category_id = 4")
def search_wildcards(t: Tables):
    return C.search_articles(t.long_articles, "th_r%on", category_id=4).select("article_id")


@query("article_search_escaped", """SELECT article_id FROM long_articles
  WHERE contains(title, '%') OR contains(summary, '%') OR contains(content, '%')""")
def search_escaped(t: Tables):
    return C.search_articles(t.long_articles, "%", escape=True).select("article_id")


@query("feed_page", f"""SELECT {_LIST}, (SELECT count(*) FROM long_articles) AS total FROM long_articles
  ORDER BY published_at DESC, article_id DESC LIMIT 20 OFFSET 40""")
def feed_page(t: Tables):
    return C.feed_page(t.long_articles, limit=20, offset=40)


@query("feed_page_search", f"""SELECT {_LIST}, (SELECT count(*) FROM long_articles WHERE {_hit('%an%')}
    AND category_id = 3) AS total FROM long_articles WHERE {_hit('%an%')} AND category_id = 3
  ORDER BY published_at DESC, article_id DESC LIMIT 5 OFFSET 2""")
def feed_page_search(t: Tables):
    return C.feed_page(t.long_articles, limit=5, offset=2, term="an", category_id=3)


@query("category_list", "SELECT category_id, name FROM feed_categories ORDER BY name")
def category_list(t: Tables):
    return C.category_list(t.categories)


@query("category_list_ignoring_case", """SELECT category_id, name FROM (
    SELECT category_id, CASE WHEN category_id % 2 = 0 THEN lower(name) ELSE name END AS name FROM feed_categories)""")
def category_list_folded(t: Tables):
    mixed = F.when(F.col("category_id") % 2 == 0, F.lower("name")).otherwise(F.col("name"))
    return C.category_list(t.categories.withColumn("name", mixed), ignore_case=True)


@query("lookup_articles", """SELECT article_id, title FROM feed_articles
  WHERE article_id IN (SELECT article_id FROM likes)""")
def lookup(t: Tables):
    return C.lookup(t.articles, "article_id", t.likes).select("article_id", "title")


@query("category_flags", f"""SELECT category_id, name, category_id IN (SELECT category_id FROM subscriptions
    WHERE user_id = {READER}) AS is_subscribed FROM feed_categories""")
def category_flags(t: Tables):
    return C.category_flags(t.categories, t.subscriptions, READER)


@query("article_detail", """SELECT article_id, title, summary, category_id, published_at, popularity_score, content
  FROM long_articles WHERE article_id = 17""")
def detail(t: Tables):
    return C.article_detail_view(t.long_articles, 17)


@query("articles_with_category", """SELECT article_id, coalesce(CASE WHEN a.category_id = 3 THEN 'own' END, c.name)
    AS category_name FROM feed_articles a LEFT JOIN feed_categories c USING (category_id)""")
def with_category(t: Tables):
    rows = C.with_category(t.articles, t.categories)
    own = F.when(F.col("category_id") == 3, F.lit("own"))
    return rows.select("article_id", C.category_name(own, F.col("category")).alias("category_name"))


@query("interaction_state_likes", "SELECT * FROM likes")
def likes(t: Tables):
    return t.likes


@query("interaction_state_saves", "SELECT * FROM saves")
def saves(t: Tables):
    return t.saves


@query("interaction_state_subscriptions", "SELECT * FROM subscriptions")
def subscriptions(t: Tables):
    return t.subscriptions


@query("merge_interaction_state", f"""SELECT * FROM (WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY half, user_id, article_id ORDER BY event_timestamp DESC, event_id DESC) AS rn
    FROM (SELECT *, event_timestamp >= TIMESTAMP '{MIDDLE}' AS half FROM events_valid
      WHERE event_type IN ('like_article', 'unlike_article'))) WHERE rn = 1)
  SELECT user_id, article_id, coalesce(CASE WHEN o.event_type = 'like_article' THEN o.event_timestamp END,
      n.event_timestamp) AS created_at
  FROM (SELECT * FROM latest WHERE NOT half) o
  FULL JOIN (SELECT * FROM latest WHERE half) n USING (user_id, article_id)
  WHERE coalesce(n.event_type, o.event_type) = 'like_article')""")
def merge_likes(t: Tables):
    return C.merge_interaction_state(
        C.likes_from(t.first_half), t.second_half, "like_article", "unlike_article", ["user_id", "article_id"]
    )


@query("article_flags", f"""SELECT article_id,
    article_id IN (SELECT article_id FROM likes WHERE user_id = {READER}) AS is_liked,
    article_id IN (SELECT article_id FROM saves WHERE user_id = {READER}) AS is_saved,
    category_id IN (SELECT category_id FROM subscriptions WHERE user_id = {READER}) AS is_subscribed
  FROM feed_articles""")
def flags(t: Tables):
    return C.article_flags(t.articles, t.likes, t.saves, t.subscriptions, READER).select(
        "article_id", "is_liked", "is_saved", "is_subscribed"
    )


@query("article_flags_anonymous", """SELECT article_id, false AS is_liked, false AS is_saved, false AS is_subscribed
  FROM feed_articles""")
def flags_anonymous(t: Tables):
    return C.article_flags(t.articles, t.likes, t.saves, t.subscriptions).select(
        "article_id", "is_liked", "is_saved", "is_subscribed"
    )


@query("saved_page", f"""SELECT article_id, title, summary, source_url, category_id, published_at, popularity_score,
    (SELECT count(*) FROM saves WHERE user_id = {READER}) AS total FROM feed_articles
  WHERE article_id IN (SELECT article_id FROM saves WHERE user_id = {READER})
  ORDER BY published_at DESC, article_id DESC LIMIT 5""")
def saved_page(t: Tables):
    return C.saved_page(t.articles, t.saves, READER, limit=5)


@query("saved_per_user", """SELECT user_id, article_id, rank FROM (SELECT user_id, article_id, row_number() OVER (
      PARTITION BY user_id ORDER BY published_at DESC, article_id DESC) AS rank
    FROM saves JOIN feed_articles USING (article_id)) WHERE rank <= 20""")
def saved_per_user(t: Tables):
    return C.saved_per_user(t.articles, t.saves, 20).select("user_id", "article_id", "rank")


# --- get-or-create and change sets ------------------------------------------
@query("add_missing_categories", """SELECT category_id, name FROM feed_categories
  UNION ALL SELECT CAST(r_regionkey + 100 AS BIGINT), r_name FROM region""")
def add_missing(t: Tables):
    regions = table(t.spark, t.sf_dir, "region").select(
        (F.col("r_regionkey") + 100).cast("long").alias("category_id"), F.col("r_name").alias("name")
    )
    wanted = t.categories.withColumn("category_id", F.col("category_id") + 500).unionByName(regions)
    once = C.add_missing(t.categories, wanted, "name")
    return C.add_missing(once, wanted, "name")


def change_set(t: Tables):
    """One change per document, spread over all ops and refusals.

    Documents outnumber or trail the articles by scale, so some ids hit and some miss.
    """
    number = F.col("article_id")
    op = F.when(number % 4 == 0, F.lit("create")).when(number % 4 == 1, F.lit("delete")).otherwise(F.lit("patch"))
    target = F.when(number % 4 == 0, number + 1_000_000).otherwise(number * 3)
    category = F.when(number % 7 == 0, F.lit(999)).otherwise(F.col("category_id"))
    url = F.when(number % 5 == 0, F.lit("https://example.com/a/0")).otherwise(
        F.concat(F.lit("https://example.com/new/"), F.floor(number / 12)))
    return t.long_articles.select(
        target.alias("article_id"), op.alias("op"), F.upper("title").alias("title"), "summary",
        F.lit(None).cast("string").alias("content"), url.alias("source_url"),
        category.cast("long").alias("category_id"), F.lit(None).cast("string").alias("author"),
        "published_at", "popularity_score",
        F.when(number % 4 == 2, F.array(F.lit("title"), F.lit("source_url")))
        .otherwise(F.array(F.lit("category_id"), F.lit("popularity_score"))).alias("set_fields"),
    )


_CHANGES = """changes AS (SELECT CASE WHEN n % 4 = 0 THEN n + 1000000 ELSE n * 3 END AS article_id,
    CASE n % 4 WHEN 0 THEN 'create' WHEN 1 THEN 'delete' ELSE 'patch' END AS op, upper(title) AS title,
    summary, CASE WHEN n % 5 = 0 THEN 'https://example.com/a/0'
      ELSE 'https://example.com/new/' || CAST(n // 12 AS VARCHAR) END AS source_url,
    CASE WHEN n % 7 = 0 THEN 999 ELSE category_id END AS category_id, published_at, popularity_score,
    n % 4 = 2 AS sets_url, n % 4 = 3 AS sets_category
  FROM (SELECT *, article_id AS n FROM long_articles)),
  checked AS (SELECT c.*, CASE
      WHEN op <> 'create' AND a.article_id IS NULL THEN 'article_not_found'
      WHEN op = 'create' AND a.article_id IS NOT NULL THEN 'article_exists'
      WHEN (op = 'create' OR sets_category) AND c.category_id NOT IN (SELECT category_id FROM feed_categories)
        THEN 'category_not_found' END AS fault
    FROM changes c LEFT JOIN feed_articles a ON a.article_id = c.article_id),
  judged AS (SELECT c.*, coalesce(fault, CASE
      WHEN (op = 'create' OR sets_url) AND (EXISTS (SELECT 1 FROM feed_articles o
          WHERE o.source_url = c.source_url AND o.article_id <> c.article_id)
        OR EXISTS (SELECT 1 FROM checked x WHERE x.fault IS NULL AND x.source_url = c.source_url
          AND (x.op = 'create' OR x.sets_url) AND x.article_id < c.article_id)) THEN 'source_url_taken' END) AS conflict
    FROM checked c)"""


@query("article_change_conflicts", f"""SELECT article_id, op, conflict FROM (WITH {_CHANGES}
  SELECT * FROM judged) WHERE conflict IS NOT NULL""")
def change_conflicts(t: Tables):
    articles = _wide_articles(t)
    return C.apply_article_changes(articles, change_set(t), t.categories)[1].select("article_id", "op", "conflict")


@query("article_changes", f"""SELECT article_id, title, summary, source_url, category_id, published_at,
    popularity_score FROM (WITH {_CHANGES}
  SELECT a.article_id, CASE WHEN sets_url THEN j.title ELSE a.title END AS title, a.summary,
    CASE WHEN sets_url THEN j.source_url ELSE a.source_url END AS source_url,
    CASE WHEN sets_category THEN j.category_id ELSE a.category_id END AS category_id, a.published_at,
    CASE WHEN sets_category THEN j.popularity_score ELSE a.popularity_score END AS popularity_score
  FROM feed_articles a LEFT JOIN (SELECT * FROM judged WHERE conflict IS NULL) j USING (article_id)
  WHERE coalesce(j.op, 'patch') = 'patch'
  UNION ALL SELECT article_id, title, summary, source_url, category_id, published_at, popularity_score
    FROM judged WHERE conflict IS NULL AND op = 'create')""")
def changes(t: Tables):
    return C.apply_article_changes(_wide_articles(t), change_set(t), t.categories)[0].drop("content", "author")


def _wide_articles(t: Tables):
    return t.articles.withColumns({
        "content": F.lit(None).cast("string"), "author": F.lit(None).cast("string"),
    })
