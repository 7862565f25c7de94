import pytest

from feedlens.llm.sharding import DEFAULT_SHARDS, fill_slots, place
from tests.llm.conftest import rows_of


def brute_fill(shards, slots):
    """Preference lists written out, then turns over them."""
    import hashlib
    lists = []
    for shard in shards:
        digest = hashlib.sha256(shard.encode()).digest()
        start, step = int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1
        lists.append([(start + step * turn) % slots for turn in range(slots)])
    owner = {}
    while len(owner) < slots:
        for number, preferences in enumerate(lists):
            free = [slot for slot in preferences if slot not in owner]
            if free:
                owner[free[0]] = number
    return [owner[slot] for slot in range(slots)]


def test_table_equals_turns_over_written_out_preferences():
    shards = ["a", "b", "c", "d", "e"]
    assert fill_slots(shards, 101) == brute_fill(shards, 101)


def test_shares_are_even_and_little_moves_when_a_shard_leaves():
    full = fill_slots(DEFAULT_SHARDS)
    counts = [full.count(number) for number in range(len(DEFAULT_SHARDS))]
    assert max(counts) - min(counts) <= 1
    less = fill_slots(DEFAULT_SHARDS[:-1])
    moved = sum(1 for old, new in zip(full, less, strict=True) if old != new)
    assert moved < 0.1 * len(full)


def test_every_key_has_one_place(spark):
    rows = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (None, None), (2, "x")], "doc_id long, extra string")
    placed = place(rows)
    found = rows_of(placed, "doc_id", "slot", "shard")
    assert len(found) == 5 and len({row[1:] for row in found if row[0] == 1}) == 1 and len({row[1:] for row in found if row[0] is None}) == 1
    table = fill_slots(DEFAULT_SHARDS)
    assert all(row.shard == table[row.slot] and row.shard_name == DEFAULT_SHARDS[row.shard] for row in placed.collect())


def test_empty_tables_and_bad_settings(spark):
    empty = spark.createDataFrame([], "doc_id long")
    assert place(empty).count() == 0
    with pytest.raises(ValueError):
        place(empty.selectExpr("doc_id", "1 AS shard"))
    for shards, slots in ((["a", "a"], 101), ([], 101), (["a"], 100), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            fill_slots(shards, slots)


def test_no_python_and_no_shuffle(spark, small):
    plan = place(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "hashpartitioning" not in plan
