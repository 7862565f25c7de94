"""Plan properties that hold the design together at scale."""

import re

import pytest
from pyspark.sql import functions as F

from feedlens import session
from feedlens.operators import aggregates as A
from feedlens.operators import content as C
from feedlens.operators import events as E
from feedlens.operators import reports as P
from feedlens.plans import catalog
from feedlens.sources import bridge


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# The model's own top-k crosses blocks of factors; streams run when they are built.
PLANNED = [name for name in catalog.QUERIES
           if not name.startswith("stream_") and "als_" not in name and "final_" not in name]


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_python_in_the_plan(spark, small, name):
    text = plan(catalog.QUERIES[name](spark, small))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


def read_schema(df):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))


def test_only_used_columns_are_read(spark, small):
    [schema] = read_schema(C.feed_page(bridge.long_articles(spark, small), with_total=False))
    assert "text" not in schema and "n_chars" in schema
    for schema in read_schema(P.events_by_type(bridge.order_events(spark, small))):
        assert "l_shipdate" not in schema and "l_quantity" not in schema and "o_totalprice" not in schema


def test_filters_reach_the_scan(spark, small):
    text = plan(bridge.feed_users(spark, small).where("is_active"))
    assert "GreaterThan(c_acctbal,0.0)" in text
    text = plan(bridge.table(spark, small, "documents").where(F.col("lang") == "en").select("doc_id"))
    assert "EqualTo(lang,en)" in text


def test_distinct_counts_split_a_hot_group_by_user(spark, small):
    text = plan(A.daily_by_type(bridge.order_events(spark, small)))
    assert re.search(r"Exchange hashpartitioning\([^)]*user_id", text) and "Expand" not in text


def test_dedupe_cuts_copies_before_the_shuffle(spark, small):
    text = plan(E.dedupe_events(bridge.order_events(spark, small)))
    inner, outer = text.rindex("WindowGroupLimit"), text.index("WindowGroupLimit")
    assert outer < text.index("Exchange hashpartitioning") < inner


def test_sums_are_combined_before_the_shuffle(spark, small):
    text = plan(A.category_score_deltas(bridge.order_events(spark, small)))
    assert "partial_sum" in text


def test_counters_are_grouped_once(spark, small):
    """Conditional sums combine in the map tasks and are shuffled once by the report's key."""
    events = bridge.feed_events(spark, small)
    for frame in (P.article_counters(events), A.category_score_deltas(events)):
        assert len(re.findall(r"\bExchange hashpartitioning", plan(frame))) == 1


def test_a_cluster_needs_a_shared_folder():
    class Conf(dict):
        def get(self, name, default=None):
            return super().get(name, default)

    class Session:
        conf = Conf({"spark.sql.warehouse.dir": "file:/home/driver/warehouse", "spark.master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
    Session.conf["spark.master"] = "local[4]"
    assert session.shared_folder(Session()) == "file:/home/driver/warehouse/_runs"
