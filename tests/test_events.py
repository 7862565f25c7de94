from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.functions import expressions as X
from feedlens.operators import events as E

GOOD = ('{"event_id":"e1","user_id":7,"session_id":"s","event_type":"search",'
        '"timestamp":"2024-01-02T03:04:05.678Z","metadata":{"n":5,"x":{"y":1},"z":null}}')


def records(spark, *values):
    rows = [("t", 0, n, datetime(2024, 1, 1), v) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, S.LOG_RECORD)


@pytest.mark.parametrize("value, error", [
    (GOOD, None),
    (GOOD.replace("search", "view_article"), S.ERROR_LINK),
    (GOOD.replace("search", "subscribe_category"), S.ERROR_LINK),
    (GOOD.replace('"search"', '"view_article","article_id":3'), None),
    (GOOD.replace("search", "bogus"), S.ERROR_BASE),
    ("not json", S.ERROR_BASE),
    (None, S.ERROR_BASE),
    (GOOD.replace('"user_id":7', '"user_id":"7"'), S.ERROR_BASE),
    (GOOD.replace("2024-01-02T03:04:05.678Z", "some day"), S.ERROR_BASE),
    (GOOD.replace('"timestamp":"2024-01-02T03:04:05.678Z",', ""), S.ERROR_BASE),
    (GOOD.replace('"event_type":"search",', ""), S.ERROR_BASE),
    (GOOD.replace('"session_id":"s",', ""), S.ERROR_BASE),
])
def test_validity(spark, value, error):
    row = E.validate_events(E.decode_events(records(spark, value))).first()
    assert row.validation_error == error and row.is_valid is (error is None)


def test_split_loses_nothing(spark):
    checked = E.validate_events(E.decode_events(records(spark, GOOD, "x", GOOD.replace('"search"', "null"))))
    valid, invalid = E.split_events(checked)
    assert valid.count() == 1 and invalid.count() == 2


def test_decode_keeps_nested_metadata_as_text(spark):
    row = E.decode_events(records(spark, GOOD)).first()
    assert row.metadata == {"n": "5", "x": '{"y":1}', "z": None}
    assert row.event_timestamp == datetime(2024, 1, 2, 3, 4, 5, 678000)


def test_decode_parses_once_under_a_filter(spark):
    df = E.valid_events(E.decode_events(records(spark, GOOD)))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_decode_round_trip(spark):
    events = E.decode_events(records(spark, GOOD))
    again = E.decode_events(E.encode_events(events).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"), "value"))
    keep = [c for c in events.columns if c not in ("raw_json", "kafka_timestamp")]
    assert again.select(keep).first() == events.select(keep).first()


EVENTS = ("event_id STRING, user_id BIGINT, session_id STRING, event_type STRING, article_id BIGINT, "
          "category_id BIGINT, event_timestamp TIMESTAMP")


def test_dedupe_is_deterministic_and_keeps_null_ids(spark):
    rows = [("a", n, "s", "search", None, None, datetime(2024, 1, 1 + n % 3)) for n in range(90)]
    rows += [(None, 1, "s", "search", None, None, datetime(2024, 1, 1))] * 3
    for parts in (1, 5):
        out = E.dedupe_events(spark.createDataFrame(rows, EVENTS).repartition(parts)).collect()
        assert sorted(r.event_id or "" for r in out) == ["", "", "", "a"]
        assert [r.user_id for r in out if r.event_id] == [0]


def test_dedupe_orders_map_columns(spark):
    rows = [("a", {"k": "2"}), ("a", {"k": "1"})]
    out = E.dedupe_events(spark.createDataFrame(rows, "event_id STRING, metadata MAP<STRING,STRING>"))
    assert out.first().metadata == {"k": "1"}


def test_ingest_first_write_wins(spark):
    old = spark.createDataFrame([("a", 1)], "event_id STRING, v INT")
    new = spark.createDataFrame([("a", 9), ("b", 5), ("b", 4)], "event_id STRING, v INT")
    assert [tuple(r) for r in E.ingest_new_events(old, new).collect()] == [("b", 4)]


def test_payload_errors(spark):
    uuid = "123e4567-e89b-12d3-a456-426614174000"
    rows = [(uuid, uuid, "search", None, None), ("x", None, "view_article", 0, 1), (None, "y", None, None, 0),
            (uuid, None, "subscribe_category", 1, None)]
    df = spark.createDataFrame(rows, "event_id STRING, session_id STRING, event_type STRING, article_id BIGINT, category_id BIGINT")
    got = [r.errors for r in E.payload_errors(df).collect()]
    assert got == [[], ["event_id_not_uuid", "article_id_below_one"],
                   ["session_id_not_uuid", "event_type_unknown", "category_id_below_one"],
                   ["category_id_required"]]


def test_normalize_defaults(spark):
    payloads = spark.createDataFrame(
        [("search", 5, None)], "eventType STRING, reader BIGINT, metadata MAP<STRING,STRING>")
    row = E.normalize_events(payloads, "reader").first()
    assert len(row.event_id) == 36 and row.user_id == 5 and row.metadata == {} and row.event_timestamp


def test_choose_source(spark):
    full, empty = spark.range(1), spark.range(0)
    assert E.choose_source(full, empty)[0] == "raw_user_events"
    assert E.choose_source(empty, full)[0] == "pending_events"
    assert E.choose_source(None, full)[0] == "pending_events"


def scalar(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("value, want", [
    (None, 0), (-1.0, 0), (0.0, 0), (float("nan"), 0), (float("inf"), 0), (0.4, 40), (0.125, 13), (0.995, 100), (7.0, 100)])
def test_ctr_progress(spark, value, want):
    assert scalar(spark, X.ctr_progress(F.lit(value).cast("double"))) == want


@pytest.mark.parametrize("value, want", [
    (None, "Picked for you"), ("  ", "Picked for you"), (" als_implicit_feedback ", "Based on your activity in the feed"),
    ("new_since-monday", "New since monday")])
def test_reason_label(spark, value, want):
    assert scalar(spark, X.reason_label(F.lit(value).cast("string"))) == want


@pytest.mark.parametrize("value, want", [
    ("event-driven mobile analytics", "Event-Driven Mobile Analytics"), ("FastAPI service", "Fastapi Service")])
def test_title_words(spark, value, want):
    assert scalar(spark, X.title_words(F.lit(value))) == want == value.title()


@pytest.mark.parametrize("value, want", [
    (" Big  Data! ", "big-data"), ("--CI/CD--", "ci-cd"), ("Ärger", "rger"), ("", "")])
def test_slug(spark, value, want):
    assert scalar(spark, X.slug(F.lit(value))) == want


@pytest.mark.parametrize("value, want", [
    (" A@b.C ", True), ("@b", False), ("a@", False), ("ab", False), (None, False), ("abc", False)])
def test_email(spark, value, want):
    assert scalar(spark, X.email_ok(F.lit(value).cast("string"))) is want


def test_ratio(spark):
    assert scalar(spark, X.ratio_or_zero(F.lit(2), F.lit(3))) == 0.6667
    assert scalar(spark, X.ratio_or_zero(F.lit(2), F.lit(0))) == 0.0
    assert scalar(spark, X.ratio_or_zero(F.lit(5), F.lit(2))) == 2.5
