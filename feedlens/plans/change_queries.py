"""An ordered change log in which urls are given up and taken, derived from the articles, with the SQL of its outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.operators.change_log import replay_changes
from feedlens.plans.registry import Tables, query

_URL = "https://example.com/a/"
#: Of four neighbours the first moves away, the second takes its url, the third wants that of the fourth, which is
#: deleted or renamed; then a new article claims the fourth's url. The SQL numbers it ``_NEW`` above the old one. With more than
#: ``_NEW`` articles that id belongs to another, so in the log it is the old one's negative, which no article has.
_NEW = 1_000_000


def change_log(t: Tables) -> DataFrame:
    number = F.col("article_id")
    turn = number % 4
    none = F.lit(None).cast("string")
    url = lambda offset: F.concat(F.lit(_URL), (number + offset).cast("string"))

    def change(order, op, article, title, source_url, category, names):
        return F.struct(
            order.alias("order_no"), F.lit(op).alias("op"), article.alias("article_id"), title.alias("title"), source_url.alias("source_url"),
            category.cast("long").alias("category_id"), F.array(*[F.lit(name) for name in names]).cast("array<string>").alias("set_fields"),
        )

    no_category = F.lit(None)
    one = change(number * 10, "patch", number, none, F.concat(F.lit("https://example.com/m/"), number.cast("string")), no_category, ["source_url"])
    # An article's url ends with its id less one.
    two = change(number * 10, "patch", number, none, url(-2), no_category, ["source_url"])
    three = change(number * 10, "patch", number, none, url(0), no_category, ["source_url"])
    renamed = change(number * 10, "patch", number, F.lit("renamed"), none, no_category, ["title"])
    gone = change(number * 10, "delete", number, none, none, no_category, [])
    claim = change(
        number * 10 + 1, "create", -number, F.lit("new"), url(-1), F.when(number % 24 == 0, F.lit(99)).otherwise(F.lit(2)), [],
    )
    last = F.when(number % 8 == 0, F.array(gone, claim)).otherwise(F.array(renamed, claim))
    changes = F.when(turn == 1, F.array(one)).when(turn == 2, F.array(two)).when(turn == 3, F.array(three)).otherwise(last)
    return t.articles.select(F.inline(changes))


def _shown(df: DataFrame) -> DataFrame:
    """New articles under the ids that the SQL gives them."""
    number = F.col("article_id")
    return df.withColumn("article_id", F.when(number < 0, _NEW - number).otherwise(number))


@query("article_log_conflicts", f"""SELECT a.article_id * 10 AS order_no, 'patch' AS op, a.article_id, 'source_url_taken' AS conflict
    FROM feed_articles a JOIN feed_articles b ON b.article_id = a.article_id + 1 WHERE a.article_id % 4 = 3
  UNION ALL SELECT article_id * 10 + 1, 'create', article_id + {_NEW},
    CASE WHEN article_id % 24 = 0 THEN 'category_not_found' ELSE 'source_url_taken' END
    FROM feed_articles WHERE article_id % 24 = 0 OR article_id % 8 = 4""")
def log_conflicts(t: Tables):
    return _shown(replay_changes(t.articles, change_log(t), t.categories)[1]).select("order_no", "op", "article_id", "conflict")


@query("article_log_result", f"""SELECT a.article_id, CASE WHEN a.article_id % 8 = 4 THEN 'renamed' ELSE a.title END AS title,
    CASE WHEN a.article_id % 4 = 1 THEN 'https://example.com/m/' || a.article_id
      WHEN a.article_id % 4 = 2 OR a.article_id % 4 = 3 AND b.article_id IS NULL
        THEN '{_URL}' || (a.article_id - CASE WHEN a.article_id % 4 = 2 THEN 2 ELSE 0 END)
      ELSE a.source_url END AS source_url, a.category_id
    FROM feed_articles a LEFT JOIN feed_articles b ON b.article_id = a.article_id + 1 WHERE a.article_id % 8 <> 0
  UNION ALL SELECT article_id + {_NEW}, 'new', source_url, 2 FROM feed_articles WHERE article_id % 8 = 0 AND article_id % 24 <> 0""")
def log_result(t: Tables):
    return _shown(replay_changes(t.articles, change_log(t), t.categories)[0]).select("article_id", "title", "source_url", "category_id")
