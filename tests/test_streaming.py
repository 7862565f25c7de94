from datetime import date, datetime, timedelta

import pytest

from feedlens import schemas as S
from feedlens.operators.events import decode_events, encode_events, valid_events
from feedlens.session import shared_folder
from feedlens.sources.readers import read_event_stream
from feedlens.sources.sinks import ScoreStore
from feedlens.streaming import aggregates as G
from feedlens.streaming import job
from feedlens.streaming.job import StreamPaths, compact_closed_days, daily_totals, late_totals, process_batch, run_event_job, run_stream, validated_stream

EVENTS = ("event_id STRING, user_id BIGINT, session_id STRING, event_type STRING, article_id BIGINT, "
          "category_id BIGINT, event_timestamp TIMESTAMP")


def lines(spark, rows, path):
    """Write events as text files of one JSON object per line."""
    encode_events(spark.createDataFrame(rows, EVENTS)).select("value").coalesce(1).write.mode("append").text(path)


def event(n, day, user=1, kind="view_article"):
    return (f"e{n}", user, "s", kind, 5, 2, datetime(2024, 1, day) + timedelta(minutes=n))


def log(rows):
    return [("t", 0, n, datetime(2024, 2, 1), v) for n, v in enumerate(rows)]


def test_repeated_batch_changes_nothing(spark, tmp_path):
    values = [r.value for r in encode_events(spark.createDataFrame([event(n, 1 + n % 2) for n in range(6)], EVENTS)).collect()]
    batch = validated_stream(spark.createDataFrame(log(values + ["broken"]), S.LOG_RECORD))
    paths, store = StreamPaths(str(tmp_path)), ScoreStore(spark, str(tmp_path / "scores"))
    run = process_batch(paths, store)
    for _ in range(2):
        run(batch, 7)
    assert spark.read.parquet(paths.raw_events).count() == 6
    assert spark.read.parquet(paths.dead_letters).count() == 1
    assert daily_totals(spark, paths)["by_type"].count() == 2
    assert store.current().first().score == 6.0
    run(batch, 8)
    assert spark.read.parquet(paths.raw_events).count() == 12
    assert store.current().first().score == 12.0


def test_many_batches_stay_few_files(spark, tmp_path):
    """Compaction leaves one partition per closed day, and the scores' ledger only its open batches."""
    paths, store = StreamPaths(str(tmp_path)), ScoreStore(spark, str(tmp_path / "scores"))
    run = process_batch(paths, store, compact_every=5)
    for number in range(12):
        values = [r.value for r in encode_events(spark.createDataFrame([event(number, 1), event(100 + number, 2)], EVENTS)).collect()]
        run(validated_stream(spark.createDataFrame(log(values), S.LOG_RECORD)), number)
    before = daily_totals(spark, paths)["by_type"].orderBy("window_start").collect()
    compact_closed_days(spark, paths, date(2024, 1, 2))
    folders = lambda day: len(list((tmp_path / "raw_user_events" / f"event_date=2024-01-0{day}").glob("batch_id=*")))
    assert (folders(1), folders(2)) == (1, 12)
    assert spark.read.parquet(paths.raw_events).count() == 24
    assert daily_totals(spark, paths)["by_type"].orderBy("window_start").collect() == before
    assert compact_closed_days(spark, paths, date(2024, 1, 2)) == dict.fromkeys(
        (paths.raw_events, paths.rollup, paths.dead_letters), 0)
    assert sorted(int(p.name[9:]) for p in (tmp_path / "scores/user_category_score_deltas").glob("batch_id=*")) == [5, 6, 7, 8, 9, 10, 11]
    assert store.current().first().views_count == 24


def test_late_events_are_stored_and_counted(spark, tmp_path):
    paths, store = StreamPaths(str(tmp_path)), ScoreStore(spark, str(tmp_path / "scores"))
    run = process_batch(paths, store, dedupe=True)
    for number, days in enumerate([(1, 9), (1, 2, 8, 20), (20,)]):
        rows = [event(10 * number + day, day) for day in days]
        values = [r.value for r in encode_events(spark.createDataFrame(rows, EVENTS)).collect()]
        for _ in range(2):
            run(validated_stream(spark.createDataFrame(log(values), S.LOG_RECORD)), number)
    assert late_totals(spark, paths).first().asDict() == {"events_count": 7, "late_count": 2}
    assert spark.read.parquet(paths.raw_events).count() == 7


def test_newest_time_outlives_batches_without_valid_events(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(job, "LOOK_BACK", 2)
    paths = StreamPaths(str(tmp_path))
    run = process_batch(paths, ScoreStore(spark, str(tmp_path / "scores")))
    values = [r.value for r in encode_events(spark.createDataFrame([event(1, 20), event(2, 1)], EVENTS)).collect()]
    for number, value in enumerate([values[0], *["broken"] * 4, values[1]]):
        run(validated_stream(spark.createDataFrame(log([value]), S.LOG_RECORD)), number)
    assert late_totals(spark, paths).first().asDict() == {"events_count": 2, "late_count": 1}


def test_empty_batch_writes_nothing(spark, tmp_path):
    batch = validated_stream(spark.createDataFrame([], S.LOG_RECORD))
    process_batch(StreamPaths(str(tmp_path / "out")), ScoreStore(spark, str(tmp_path / "s")))(batch, 0)
    assert not (tmp_path / "out").exists()


def test_failed_batch_is_run_again_once(spark, tmp_path):
    """The scores fail after the other outputs are written; the restarted query repeats the
    batch under the same id."""
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    lines(spark, [event(n, 1) for n in range(4)], source)
    paths, store = StreamPaths(base), ScoreStore(spark, f"{base}/scores")
    good_append = store.append

    def broken_append(deltas, batch_id):
        raise RuntimeError("lost")

    store.append = broken_append
    stream = validated_stream(read_event_stream(spark, "text", path=source))
    query = run_stream(stream, process_batch(paths, store), f"{base}/checkpoint", available_now=True)
    with pytest.raises(Exception):
        query.awaitTermination()
    store.append = good_append
    run_stream(stream, process_batch(paths, store), f"{base}/checkpoint", available_now=True).awaitTermination()
    assert spark.read.parquet(paths.raw_events).count() == 4
    assert store.current().first().score == 4.0


def test_job_from_text_with_dedupe(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [event(n, 1) for n in range(5)]
    lines(spark, rows + rows, source)

    def run():
        records = read_event_stream(spark, "text", path=source)
        run_event_job(spark, records, base, f"{base}/checkpoint", available_now=True, dedupe=True,
                      compact_every=1).awaitTermination()

    run()
    lines(spark, rows[:2] + [event(9, 2)], source)
    run()
    paths = StreamPaths(base)
    assert spark.read.parquet(paths.raw_events).count() == 6
    assert ScoreStore(spark, paths.scores).current().first().views_count == 6


@pytest.mark.parametrize("salts", [1, 4])
def test_dedupe_salted_or_not(spark, tmp_path, salts):
    values = [r.value for r in encode_events(spark.createDataFrame([event(n, 1) for n in range(5)], EVENTS)).collect()]
    source = str(tmp_path / "in")
    spark.createDataFrame(log(values * 20), S.LOG_RECORD).write.parquet(source)
    events = decode_events(read_event_stream(spark, "parquet", path=source))
    out = str(tmp_path / "out")
    deduped = G.dedupe_stream(events, salts=salts).select("event_id")
    run_stream(deduped, out, str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [f"e{n}" for n in range(5)]


def test_late_rows_are_dropped(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))

    def run():
        events = G.with_watermark(valid_events(decode_events(read_event_stream(spark, "text", path=source))))
        run_stream(G.daily_by_type_stream(events), out, checkpoint, available_now=True).awaitTermination()

    lines(spark, [event(1, 1, 1), event(2, 1, 2), event(3, 9, 1)], source)
    run()
    lines(spark, [event(4, 1, 3), event(5, 20, 1)], source)
    run()
    rows = {str(r.window_start.date()): (r.events_count, r.unique_users_count) for r in spark.read.parquet(out).collect()}
    assert rows == {"2024-01-01": (2, 2), "2024-01-09": (1, 1)}


def test_no_state_grows_with_a_group(spark, tmp_path):
    (tmp_path / "in").mkdir()
    events = G.with_watermark(decode_events(read_event_stream(spark, "text", path=str(tmp_path / "in"))))
    plan = G.daily_by_type_stream(events)._jdf.queryExecution().analyzed().toString()
    assert "collect_" not in plan


def test_unknown_stream_kind(spark):
    with pytest.raises(ValueError):
        read_event_stream(spark, "socket", path="x")


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_log_records_are_made_once_for_all_waves(spark, small):
    """Waves and copies read the stored records; the events are not encoded again for each."""
    from feedlens.plans import stream_queries
    from feedlens.plans.registry import Tables

    for wave in stream_queries._waves(Tables(spark, small), copies=2):
        plan = wave._jdf.queryExecution().optimizedPlan().toString()
        assert "to_json" not in plan and "Join" not in plan
