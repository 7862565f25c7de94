"""Chat formatting in budgeted, turn-aligned windows.

A conversation becomes one or more training strings. Prefix sums of the turns' tokens cut it:
half a window's room after the last cut a new window opens, and a turn longer than that stands
alone, so a window never exceeds its budget unless one turn does by itself. Every window
begins with the conversation's system turn and the last turns before it that fit the history
limit. Both are repeats there and masked; each assistant turn is a target once.

The template is ``### role: text</turn>`` and a line feed per turn. A backslash goes before every
backslash, ``#`` and ``<`` of a text and also before ``:`` in a role, so only the template
holds a bare ``#`` or ``<``, and removing the backslashes gives the text back.

Only window functions and expressions: one shuffle by conversation.

Defined results: NULL roles and texts are empty; rows of one conversation go by turn, then role, then
text (NULL turns first), repeated rows are repeated turns; a NULL conv_id is a
conversation; an empty table gives no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, HISTORY = 512, 128
#: Tokens of a turn's markers, so that no turn is free.
MARKERS = 4
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"
_TURN = r"### ([^\\#<:]*+(?:\\[\s\S][^\\#<:]*+)*+): ([^\\#<]*+(?:\\[\s\S][^\\#<]*+)*+)</turn>\n"


def escape(text: Column, role: bool = False) -> Column:
    return F.regexp_replace(text, r"([\\#<:])" if role else r"([\\#<])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def turn_tokens(text: Column) -> Column:
    """Words and single signs of the text, and the turn's markers."""
    return (F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")) + MARKERS).cast("long")


def _windows(conversations: DataFrame, budget: int, history: int) -> DataFrame:
    """``conv_id, window``, the masked turns ``repeated`` and the ``fresh`` ones."""
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    along = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = turns.withColumn("number", F.row_number().over(along)).withColumn("tokens", turn_tokens(F.col("text")))
    turns = turns.withColumn("is_system", (F.col("number") == 1) & (F.col("role") == SYSTEM_ROLE))
    by_number = Window.partitionBy("conv_id").orderBy("number")
    counted = F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))
    turns = turns.withColumn("system", F.first(F.when(F.col("is_system"), F.struct("number", "role", "text", "tokens"))).over(by_number))
    turns = turns.withColumn("before", F.sum(counted).over(by_number) - counted)
    room = F.greatest(F.floor((budget - history - F.coalesce(F.col("system.tokens"), F.lit(0))) / 2), F.lit(1))
    turns = turns.withColumn("step", F.floor(F.col("before") / room)).withColumn("long", ~F.col("is_system") & (F.col("tokens") > room))
    turns = turns.withColumn("last", F.lag(F.struct("step", "long", "is_system")).over(by_number))
    opens = F.col("last").isNull() | (
        ~F.col("last.is_system") & (F.col("long") | F.col("last.long") | (F.col("step") > F.col("last.step")))
    )
    turns = turns.withColumn("opens", opens).withColumn("window", F.sum(opens.cast("int")).over(by_number) - 1)
    recent = Window.partitionBy("conv_id").orderBy("before").rangeBetween(-history, -1)
    turns = turns.withColumn(
        "recent", F.collect_list(F.when(~F.col("is_system"), F.struct("number", "role", "text"))).over(recent)
    )
    kind = "struct<number:int,role:string,text:string>"
    system = F.when(
        F.col("system").isNotNull() & (F.col("window") > 0),
        F.array(F.struct(F.col("system.number").alias("number"), F.col("system.role").alias("role"), F.col("system.text").alias("text"))),
    ).otherwise(F.array().cast(f"array<{kind}>"))
    return turns.groupBy("conv_id", "window").agg(
        F.first(F.when(F.col("opens"), F.concat(system, F.array_sort("recent"))), ignorenulls=True).alias("repeated"),
        F.array_sort(F.collect_list(F.struct("number", "role", "text"))).alias("fresh"),
        F.sum("tokens").alias("fresh_tokens"),
    )


def format_conversations(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """``conv_id, window, n_repeated, formatted, loss``: training strings and their target spans.

    ``loss`` are code point spans of ``formatted`` (end exclusive), each one assistant text;
    the first ``n_repeated`` turns of the string are masked repeats.
    """
    windows = _windows(conversations, budget, history)
    head = lambda turn: F.concat(F.lit("### "), escape(turn["role"], role=True), F.lit(": "))
    parts = F.transform(
        F.concat("repeated", "fresh"),
        lambda turn, at: F.struct(
            head(turn).alias("head"), escape(turn["text"]).alias("body"),
            ((at >= F.size("repeated")) & (turn["role"] == TARGET_ROLE)).alias("target"),
        ),
    )
    tail = "</turn>\n"
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["head"])
        end = start + F.length(part["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(tail)).alias("at"), F.when(part["target"], F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    return windows.withColumn("parts", parts).select(
        "conv_id", "window", F.size("repeated").alias("n_repeated"),
        F.array_join(F.transform("parts", lambda part: F.concat(part["head"], part["body"], F.lit(tail))), "").alias("formatted"),
        F.aggregate("parts", start, step)["spans"].alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the strings alone: its turns once each, and its text under the loss mask."""
    parsed = lambda group: F.transform(
        F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(group)), unescape)
    fresh = F.expr("slice(turns, n_repeated + 1, size(turns))")
    targets = F.transform("loss", lambda span: unescape(F.substr("formatted", span["start"] + 1, span["end"] - span["start"])))
    rows = formatted.withColumn("turns", F.arrays_zip(parsed(1).alias("role"), parsed(2).alias("text"))).select(
        "conv_id", "window", fresh.alias("turns"), F.array_join(targets, "").alias("target"), F.length("formatted").alias("chars")
    )
    whole = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "target"))).alias("windows"), F.sum("chars").alias("formatted_chars"),
    )
    return whole.select(
        "conv_id", F.flatten(F.col("windows.turns")).alias("turns"), F.array_join("windows.target", "").alias("target"), "formatted_chars"
    )


def chat_report(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Digests of every conversation as read back from its formatted strings."""
    back = read_back(format_conversations(conversations, budget, history))
    lines = F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("target").cast("long").alias("loss_chars"), F.sha2("target", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
