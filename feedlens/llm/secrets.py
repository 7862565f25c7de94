"""Secret scan: known forms, and sliding-window entropy over candidate strings.

Known forms are found by leftmost, non-overlapping regular expressions. Beside them, every
candidate string (a long run of token characters) gets the Shannon entropy of a sliding window,
updated by the counts of the one character that enters and the one that leaves. A window is hot if its
entropy reaches the limit of the string's character class (hexadecimal or wider) and it holds nothing allow-listed; the
union of overlapping hot windows is a span of kind ``entropy``. Allow-listed are UUIDs and, of the parts between separators, words (of one
case, or each with a capital) and parts with a placeholder word: they are masked, and what stands beside them is judged all the same. Spans that
touch a known form are left out.

All of it is built-in SQL functions on one row: no shuffle, no Python, whole texts. Candidates are cut into pieces of ``PIECE`` windows
that share ``window - 1`` characters, so counting is bounded per character and the time grows with the length of a text.

Defined results: a NULL text is an empty one and has no spans; repeated rows give repeated results, an empty table none; spans of one
start are ordered by kind as listed; positions are code points, ends exclusive; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed forms of the contract. Each match is one whole span.
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^[A-Za-z_]+?["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
#: Bits per character of a window of 20, by character class.
HEX_LIMIT, WIDE_LIMIT = 3.0, 3.8
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Fixed forms that are no secrets though their entropy may be high: a whole match, whole parts, and words in a part.
UUID = "[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
WORD = "^(?:[A-Z]{4,}|[A-Z]?[a-z]{3,}(?:[A-Z][a-z]+)*)$"
PLACEHOLDER = "(?i)example|placeholder|sample|dummy|xxxx|changeme|abcdefgh|0123456789"
#: Stands for every masked character; no candidate holds it.
MASK = "."
#: Windows in a piece of a candidate, and matches placed at once.
PIECE, PLACED = 64, 128


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: inside another lambda, a column would be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(values: Column, size: int) -> Column:
    """An array cut into arrays of ``size``."""
    return _let(values, lambda all_: F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(all_) / size).cast("int") - 1, F.lit(0))),
        lambda number: F.slice(all_, number * size + 1, F.lit(size)),
    ))


_SPAN = "array<struct<start:int,end:int,found:string>>"


def _spans(text: Column, pattern: str) -> Column:
    """All matches as ``array<struct<start int, end int, found string>>``, in order.

    The pieces between matches and the matches alternate, so prefix sums of lengths place them: within blocks of matches, and then by the
    lengths of the blocks before.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = _let(found, lambda all_: F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(all_)).alias("gap"), all_.alias("found")))

    def step(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        end = start + F.length(pair["found"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    def placed(block: Column) -> Column:
        return F.aggregate(block, F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans")), step)

    def before(done: Column, block: Column) -> Column:
        return F.struct((done["at"] + block["at"]).alias("at"), F.concat(done["starts"], F.array(done["at"])).alias("starts"))

    def moved(block: Column) -> Column:
        return F.transform(block["block"]["spans"], lambda span: F.struct(
            (span["start"] + block["from"]).alias("start"), (span["end"] + block["from"]).alias("end"), span["found"].alias("found")))

    def whole(blocks: Column) -> Column:
        starts = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")), before)["starts"]
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), starts.alias("from")), moved))

    located = _let(F.transform(_blocks(pairs, PLACED), placed), whole)
    return F.when(text.rlike(pattern), located).otherwise(F.array().cast(_SPAN))


def _times(part: Column, letter: Column) -> Column:
    """How often a letter stands in a short string."""
    return F.length(part) - F.length(F.replace(part, letter, F.lit("")))


def window_entropies(piece: Column, window: int = WINDOW) -> Column:
    """Entropy in bits of each window of a short string, by incremental counts: ``array<double>``.

    With ``n`` equal characters in a window, its entropy is ``log2(window) - sum(n log2 n) / window``. From one window to the next,
    the characters that both share stay; what the sum changes by follows from how often these hold the one that
    enters and the one that leaves.
    """
    weight = [n * math.log2(n) if n else 0.0 for n in range(window + 2)]
    growth = F.array(*[F.lit(weight[n + 1] - weight[n]) for n in range(window + 1)])

    def change(text: Column, at: Column) -> Column:
        """What the character at ``at`` (from 0) changes, and the one ``window`` before it."""
        shared = F.substr(text, F.greatest(at - (window - 1), F.lit(0)) + 1, F.least(at, F.lit(window - 1)))

        def both(held: Column) -> Column:
            entering = F.get(growth, _times(held, F.substr(text, at + 1, F.lit(1))))
            leaving = F.get(growth, _times(held, F.substr(text, at - window + 1, F.lit(1))))
            return entering - F.when(at >= window, leaving).otherwise(F.lit(0.0))

        return _let(shared, both)

    def step(state: Column, added: Column) -> Column:
        return _let(state["bits"] + added, lambda bits: F.struct(
            bits.alias("bits"), F.concat(state["all"], F.array(F.lit(math.log2(window)) - bits / F.lit(float(window)))).alias("all")))

    def whole(text: Column) -> Column:
        changes = F.transform(F.sequence(F.lit(0), F.length(text) - 1), lambda at: change(text, at))
        start = F.struct(F.lit(0.0).alias("bits"), F.array().cast("array<double>").alias("all"))
        # The values before the first whole window are left out.
        return F.slice(F.aggregate(changes, start, step)["all"], F.lit(window), F.greatest(F.length(text) - window + 1, F.lit(0)))

    return _let(piece, whole)


def masked(candidate: Column) -> Column:
    """The string with its allow-listed parts masked, character by character."""
    def judged(part: Column) -> Column:
        return F.when(part.rlike(WORD) | part.rlike(PLACEHOLDER), F.repeat(F.lit(MASK), F.length(part))).otherwise(part)

    no_ids = F.regexp_replace(candidate, UUID, MASK * 36)
    return F.array_join(F.transform(F.regexp_extract_all(no_ids, F.lit("[A-Za-z0-9]+|[^A-Za-z0-9]+"), F.lit(0)), judged), "")


def _pieces(text: Column, window: int) -> Column:
    """``array<struct<at, piece>>``: the string cut so that every window lies in exactly one piece."""
    def joined(blocks: Column) -> Column:
        later = F.concat(F.slice(blocks, F.lit(2), F.size(blocks)), F.array(F.lit("")))
        return F.transform(F.arrays_zip(blocks.alias("own"), later.alias("next")), lambda pair, number: F.struct(
            (number * PIECE).alias("at"), F.concat(pair["own"], F.left(pair["next"], F.lit(window - 1))).alias("piece")))

    return _let(F.regexp_extract_all(text, F.lit(f".{{1,{PIECE}}}"), F.lit(0)), joined)


def _hot_places(text: Column, limit: Column, window: int) -> Column:
    """First characters of the hot windows of a masked string, ascending."""
    def of_piece(piece: Column) -> Column:
        hot = F.transform(window_entropies(piece["piece"], window), lambda value, at: F.when(
            (value >= limit - 1e-12) & ~F.contains(F.substr(piece["piece"], at + 1, F.lit(window)), F.lit(MASK)), piece["at"] + at))
        # Most pieces of masked strings have no window to judge.
        return F.when(piece["piece"].rlike(f"[^{MASK}]{{{window}}}"), F.array_compact(hot)).otherwise(F.array().cast("array<int>"))

    return F.flatten(F.transform(_pieces(text, window), of_piece))


def _hot_spans(candidate: Column, window: int) -> Column:
    """Unions of overlapping hot windows of one candidate, placed in the text."""
    limit = F.when(candidate["found"].rlike(r"^[0-9a-fA-F]+$"), F.lit(HEX_LIMIT)).otherwise(F.lit(WIDE_LIMIT))

    def unions(hot: Column) -> Column:
        none = F.array(F.lit(None).cast("int"))
        beside = F.arrays_zip(
            hot.alias("at"), F.concat(none, hot).alias("before"), F.concat(F.slice(hot, F.lit(2), F.greatest(F.size(hot), F.lit(1))), none).alias("after"))
        placed = F.filter(beside, lambda row: row["at"].isNotNull())
        opens = F.filter(placed, lambda row: row["before"].isNull() | (row["before"] + window < row["at"]))
        closes = F.filter(placed, lambda row: row["after"].isNull() | (row["at"] + window < row["after"]))
        return F.transform(F.arrays_zip(opens.alias("open"), closes.alias("close")), lambda pair: F.struct(
            (candidate["start"] + pair["open"]["at"]).cast("int").alias("start"),
            (candidate["start"] + pair["close"]["at"] + window).cast("int").alias("end")))

    return _let(_hot_places(masked(candidate["found"]), limit, window), unions)


def _as(kind: str, spans: Column) -> Column:
    order = KINDS.index(kind)
    return F.transform(spans, lambda span: F.struct(
        span["start"].alias("start"), F.lit(order).alias("order"), span["end"].alias("end"), F.lit(kind).alias("kind")))


def _computed_once(rows: DataFrame, *columns: Column) -> DataFrame:
    """``rows.select(*columns)`` through a generator, so that later uses of a column do not repeat its expression."""
    return rows.select(F.explode(F.array(F.struct(*columns))).alias("row")).select("row.*")


def find_secrets(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, assign, access, hex, entropy``: spans of each kind as arrays of (start, order, end, kind)."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    value = lambda span: F.regexp_extract(span["found"], ASSIGN_VALUE, 1)
    found = _computed_once(
        rows, F.col("doc_id"),
        F.filter(_spans(F.col("text"), ASSIGN), lambda span: F.length(value(span)) >= 6).alias("assign"),
        _spans(F.col("text"), ACCESS).alias("access"),
        _spans(F.col("text"), HEX).alias("hex"),
        _spans(F.col("text"), CANDIDATE).alias("candidates"),
    )

    hot = F.flatten(F.transform("candidates", lambda candidate: _hot_spans(candidate, window)))
    ends = lambda span: F.struct(span["start"].alias("start"), span["end"].alias("end"))
    known = F.concat(*[F.transform(name, ends) for name in KINDS[:3]])

    def fresh(span: Column) -> Column:
        return ~F.exists("known", lambda base: (base["start"] < span["end"]) & (span["start"] < base["end"]))

    placed = found.withColumn("known", known).withColumn("hot", hot)
    return _computed_once(
        placed, F.col("doc_id"), *[_as(kind, F.col(kind)).alias(kind) for kind in KINDS[:3]],
        _as("entropy", F.filter("hot", fresh)).alias("entropy"),
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"])), ",")


def secret_report(documents: DataFrame) -> DataFrame:
    """Per document: counts per kind, the digest of the base spans, and all spans as text."""
    found = find_secrets(documents)
    base = F.concat("assign", "access", "hex")
    return found.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.concat(base, F.col("entropy"))).alias("spans"),
    )
