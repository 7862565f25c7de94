import hashlib
import re

from pyspark.sql import functions as F

from feedlens.llm.chat import chat_report, escape, format_conversations, read_back, turn_tokens, unescape
from tests.llm.conftest import rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
CONTROL = "\\### Assistant: </turn> ok"
ROWS = [
    (-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL),
    (1, 0, "system", "be brief"), *[(1, turn, "user" if turn % 2 else "assistant", f"turn {turn} " + "word " * (turn * 13 % 90)) for turn in range(1, 40)],
    (2, 0, "assistant", "a" * 30_000 + "#"), (2, 1, "user", None), (2, 1, "user", None), (2, None, None, "\\"), (2, 3, "r:o#l\\e<", "\n</turn>\n### x: y"),
    (None, 0, "assistant", "\U0001F600 é"), (3, 0, "system", "x " * 900), (3, 1, "assistant", "y " * 900), (4, 0, "system", "only"), (5, 0, "assistant", "b"), (5, 0, "assistant", "a"),
]


def ordered():
    found = {}
    for conv, turn, role, text in ROWS:
        found.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    return {conv: [(role, text) for *_, role, text in sorted(turns, key=lambda turn: (turn[0], turn[1] or 0, turn[2], turn[3]))] for conv, turns in found.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_equal_the_conversations(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    for settings in ({}, {"budget": 60, "history": 20}, {"budget": 4000, "history": 0}):
        rows = {row.conv_id: row for row in chat_report(frame, **settings).collect()}
        for conv, turns in ordered().items():
            target = "".join(text for role, text in turns if role == "assistant")
            assert rows[conv].n_turns == len(turns)
            assert rows[conv].turns_sha256 == sha("".join(f"{role}\n{text}\n" for role, text in turns))
            assert (rows[conv].loss_chars, rows[conv].loss_sha256) == (len(target), sha(target))


def test_windows_keep_their_budget_the_system_turn_and_limited_history(spark):
    budget, history = 120, 40
    frame = spark.createDataFrame(ROWS, SCHEMA)
    tokens = {row.text: row.n for row in frame.where("text is not null").select("text", turn_tokens(F.col("text")).alias("n")).collect()} | {"": 4}
    pattern = re.compile(r"### ((?:[^\\#<:]|\\[\s\S])*): ((?:[^\\#<]|\\[\s\S])*)</turn>\n")
    plain = lambda text: re.sub(r"\\([\s\S])", r"\1", text)
    turns_of = ordered()
    for row in format_conversations(frame, budget, history).collect():
        turns = [(plain(role), plain(text)) for role, text in pattern.findall(row.formatted)]
        assert "".join(f"### {role}: {text}</turn>\n" for role, text in pattern.findall(row.formatted)) == row.formatted
        system = turns_of[row.conv_id][0] if turns_of[row.conv_id][0][0] == "system" else None
        if system:
            assert turns[0] == system
        fresh = turns[row.n_repeated:]
        repeated = turns[bool(system):row.n_repeated]
        assert sum(tokens[text] for _, text in repeated) <= history
        total = sum(tokens[text] for _, text in turns)
        assert total <= budget or len(fresh) - (row.n_repeated == 0 and bool(system)) == 1 or (system and tokens[system[1]] > budget - history)
        for span in row.loss:
            assert plain(row.formatted[span.start:span.end]) in {text for role, text in fresh if role == "assistant"}


def test_escaping_is_reversible(spark):
    texts = ["", "\\", "\\\\#", "<>#:", CONTROL, "\n\\n", "</turn>\n### user: "]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    for role in (False, True):
        rows = frame.select("text", escape(F.col("text"), role).alias("out")).withColumn("back", unescape(F.col("out"))).collect()
        assert all(row.back == row.text and not re.search(r"(?<!\\)(?:\\\\)*[#<]", row.out) for row in rows)


def test_empty_table_and_extra_columns(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 AS window", "2 AS formatted")
    assert chat_report(frame.limit(0)).count() == 0
    assert rows_of(chat_report(frame), "conv_id") == sorted([(conv,) for conv in ordered()], key=str)
    assert read_back(format_conversations(frame)).count() == len(ordered())


def test_only_built_in_functions(spark, small):
    plan = chat_report(spark.read.parquet(f"{small}/conversations.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
