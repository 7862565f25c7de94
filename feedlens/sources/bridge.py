"""Feed tables derived from the given tables, whole tables throughout.

customer -> users, nation -> categories, part -> articles, documents -> long articles,
events -> feed events (with broken ones), lineitem and orders -> order events (with
really repeated event ids).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.session import use_utc

CATEGORY_COUNT = 25

# Layouts of the given tables; a declared schema saves the footer-reading job per table.
GIVEN = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def feed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    admin = F.col("c_custkey") % 50 == 0
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("user_id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.COM ")).alias("email"),
        F.when(admin, F.lit("admin")).otherwise(F.lit("user")).alias("role"),
        (F.col("c_acctbal") > 0).alias("is_active"),
    )


def feed_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).cast("long").alias("category_id"), F.col("n_name").alias("name")
    )


def _category_of(zero_based: Column) -> Column:
    return zero_based % CATEGORY_COUNT + 1


def feed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("article_id"),
        _category_of(F.col("p_partkey")).alias("category_id"),
        F.col("p_name").alias("title"),
        F.concat_ws(" ", "p_brand", "p_type").alias("summary"),
        F.concat(F.lit("https://example.com/a/"), F.col("p_partkey")).alias("source_url"),
        F.timestamp_add("DAY", F.col("p_size"), F.lit("2024-01-01 00:00:00").cast("timestamp"))
        .alias("published_at"),
        F.col("p_retailprice").alias("popularity_score"),
    )


def long_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with real text: one per document."""
    return table(spark, sf_dir, "documents").select(
        (F.col("doc_id") + 1).alias("article_id"),
        _category_of(F.col("doc_id")).alias("category_id"),
        F.concat_ws(" ", "source", "lang").alias("title"),
        F.col("lang").alias("summary"),
        F.col("text").alias("content"),
        F.timestamp_add("MINUTE", (F.col("n_chars") % 1440).cast("int"),
                        F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("published_at"),
        F.col("n_chars").cast("double").alias("popularity_score"),
    )


def feed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    digit = F.col("event_id") % 10
    kind = F.col("event_type")

    def by_digit(*steps: tuple[int, str | None]) -> Column:
        choice = None
        for upto, value in steps:
            test, result = digit < upto, F.lit(value).cast("string")
            choice = F.when(test, result) if choice is None else choice.when(test, result)
        return choice

    feed_type = (
        F.when(kind == "view", by_digit((8, "view_article"), (9, "open_recommendations"), (10, "search")))
        .when(kind == "click", by_digit((4, "like_article"), (7, "open_recommended_article"),
                                        (8, "unlike_article"), (10, "open_recommendations")))
        .when(kind == "purchase", by_digit((7, "save_article"), (10, "unsave_article")))
        .when(kind == "signup", by_digit((7, "subscribe_category"), (10, "unsubscribe_category")))
        .otherwise(by_digit((3, "view_article"), (6, "subscribe_category"), (8, "bogus_event"),
                            (9, None), (10, "like_article")))
    )
    number = F.get_json_object("props", "$.k").cast("long")
    broken = F.col("broken")
    is_article = F.col("feed_type").isin(*S.ARTICLE_EVENT_TYPES)
    is_category = F.col("feed_type").isin(*S.CATEGORY_EVENT_TYPES)
    article = F.col("number") * 2 + F.col("event_id") % 2 + 1
    # Through a generator, so that predicates do not repeat the mapping per reference.
    mapped = F.explode(F.array(F.struct(feed_type.alias("feed_type"), number.alias("number"))))
    return (
        table(spark, sf_dir, "events")
        .withColumn("mapped", mapped)
        .select("event_id", "user_id", "ts", (kind == "error").alias("broken"), "mapped.*")
        .select(
            F.col("event_id").cast("string").alias("event_id"),
            F.when(~(broken & (digit == 9)), F.col("user_id") + 1).alias("user_id"),
            F.concat(F.lit("s"), F.col("user_id"), F.lit("-"), F.col("number") % 5).alias("session_id"),
            F.col("feed_type").alias("event_type"),
            F.when(~broken & is_article, article).alias("article_id"),
            F.when(~broken & is_article, _category_of(article - 1))
            .when(~broken & is_category, _category_of(F.col("number"))).alias("category_id"),
            F.col("ts").cast("timestamp").alias("event_timestamp"),
        )
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events from order lines; the (order, line) ids repeat in the data."""
    types = {
        "AF": "view_article", "RO": "view_article", "AO": "like_article", "NF": "save_article",
        "NO": "open_recommended_article", "RF": "unlike_article",
    }
    by_flags = F.create_map(*[F.lit(part) for item in types.items() for part in item])
    event_type = F.element_at(by_flags, F.concat("l_returnflag", "l_linestatus"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        (F.col("o_custkey") + 1).alias("user_id"),
        F.concat(F.lit("o"), F.col("l_orderkey")).alias("session_id"),
        event_type.alias("event_type"),
        (F.col("l_partkey") + 1).alias("article_id"),
        _category_of(F.col("l_partkey")).alias("category_id"),
        F.col("l_shipdate").cast("timestamp").alias("event_timestamp"),
    )
