"""Toxicity of whole texts from a learned lexicon, its misspellings and their context.

The lexicon is learned: words of any length, and stems of four to seven letters, that are far more frequent among
the documents labelled toxic than among the others, counted over all labelled documents that are
not held out. A rare term is taken if chance does not explain its counts, and all terms that pass are kept. Levenshtein automata walk its trie, so each word costs one step per letter
and misspelled terms are found too; misspellings that clean documents use as well are taken out by the same counts.
Each hit has a context: inside quotation marks or near a verb of saying it counts as quotation, next to a word of address as
abuse. This is judged by occurrence; a quotation ends at its partner mark on the same line, however far,
and a mark without a partner quotes nothing.

A logistic model on the hits' features gives the score; it is fitted on a bounded, documented sample of
the labelled documents (``SAMPLE``, lowest hashes). No label, language, source or id is a feature.

Defined results: NULL and empty texts have no hits and get the score of a text without any; documents
without a label are scored like all; several labels of a doc_id count as toxic if one is; without labels
of both kinds every score is the share of toxic labels (0 without labels); repeated rows give repeated results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.arrow import inner_names, text_bytes
from feedlens.llm.boosting import fit_logistic, score_logistic
from feedlens.llm.decontaminate import words
from feedlens.llm.id_filter import id_filter, possible_members
from feedlens.llm.lexicon import FuzzyTrie
from feedlens.llm.sampling import lowest_hashes
from feedlens.llm.shipping import ship_package
from feedlens.session import written_table

THRESHOLD = 0.7
SAMPLE = 50_000
STEMS = range(4, 8)
#: A term in this share of the toxic documents, and at least so many, needs its odds alone.
LEAST_SHARE, LEAST_DOCUMENTS = 0.01, 4
#: Rarer ones need evidence: as many chance terms among all tested ones are expected to pass, at most.
CHANCE_TERMS = 0.01
#: Log-odds from which a term is in the lexicon, and up to which a misspelling is harmless.
LEXICON_ODDS, HARMLESS_ODDS = 2.5, 1.0
#: Words on either side that make a hit's context.
CONTEXT = 4

SAYING = frozenset("said says saying called calls quote quoted quotes wrote writes word term phrase according cited".split())
ADDRESS = frozenset("you your youre u he she they him her them are is such total".split())
_LETTER = rb"[0-9A-Za-z\x80-\xff]"
#: A quotation ends at its partner mark on the line, however far: each scan stops at the next mark or line, so all are linear.
#: A straight mark opens before text and closes after it, or both stand free; one after a letter or digit (an inch mark) opens nothing.
_QUOTATION = re.compile(b"|".join([
    rb'(?<!%b)"(?=\S)[^"\n]*(?<=\S)"(?!%b)' % (_LETTER, _LETTER),
    rb'(?<!\S)"(?=\s)[^"\n]*(?<=\s)"(?!\S)',
    *["{0}(?:(?!{0}|{1})[^\n])*(?:{1})".format(*marks).encode() for marks in ("“”", "«»", ("„", "“|”"))],
]))
_MARKS = re.compile("“|”|„|«|»".encode())


def _words(text: bytes) -> list[bytes]:
    """Words in order; quotation marks beyond ASCII are not part of them."""
    return words(text if text.isascii() else _MARKS.sub(b" ", text))


def _terms(text: bytes) -> set[str]:
    """The distinct words of a text and their stems (with ``*``)."""
    found = set()
    for raw in set(_words(text)):
        word = raw.decode()
        found.add(word)
        found.update(word[:length] + "*" for length in STEMS if len(word) >= length)
    return found


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``term, toxic, clean``: a task's documents with the term, by label."""
    for batch in batches:
        counts: tuple[Counter[str], Counter[str]] = Counter(), Counter()
        for text, toxic in zip(text_bytes(batch), batch.column("toxic").to_pylist(), strict=True):
            counts[toxic].update(_terms(text))
        clean, toxic = counts
        terms = list(clean | toxic)
        yield pa.RecordBatch.from_pydict({
            "term": pa.array(terms, pa.string()),
            "toxic": pa.array([toxic[term] for term in terms], pa.int64()), "clean": pa.array([clean[term] for term in terms], pa.int64()),
        })


def _odds(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    return math.log((toxic + 0.5) / (all_toxic + 1)) - math.log((clean + 0.5) / (all_clean + 1))


def _strong(counts: DataFrame, all_toxic: int, all_clean: int) -> DataFrame:
    """The terms whose odds are high, and not by chance, of ``term, toxic, clean``."""
    n, share = F.col("toxic") + F.col("clean"), all_toxic / (all_toxic + all_clean)
    part = F.col("toxic") / n
    # Chernoff's bound of the chance that so many of n documents are toxic; exact if all are.
    evidence = F.col("toxic") * F.log(part / share) + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - part) / (1 - share))).otherwise(0.0)
    tested = counts.where("toxic > 0").count()
    odds = F.log((F.col("toxic") + 0.5) / (all_toxic + 1)) - F.log((F.col("clean") + 0.5) / (all_clean + 1))
    common = F.col("toxic") >= max(LEAST_DOCUMENTS, math.ceil(LEAST_SHARE * all_toxic))
    return counts.where(F.col("toxic") > 0).where(
        (odds >= LEXICON_ODDS) & (common | (evidence >= math.log(max(1, tested) / CHANCE_TERMS))))


def choose_lexicon(toxic: dict[str, int], clean: dict[str, int], all_toxic: int, all_clean: int) -> dict[str, float]:
    """Strong terms and their odds; a stem replaces its words where it covers clearly more than any one of them."""
    below: Counter[str] = Counter()
    for term, count in toxic.items():
        word = term.rstrip("*")
        for length in STEMS:
            if length < len(word) + (word == term):  # the word itself is below its stem, a stem is not
                below[word[:length] + "*"] = max(below[word[:length] + "*"], count)
    kept = {}
    for term in sorted(toxic, key=lambda term: (len(term.rstrip("*")), term.endswith("*") is False, term)):
        word = term.rstrip("*")
        if any(word[:length] + "*" in kept for length in STEMS if length <= len(word)):
            continue
        if term.endswith("*") and toxic[term] < 1.3 * below[term]:
            continue
        kept[term] = _odds(toxic[term], clean[term], all_toxic, all_clean)
    return dict(sorted(kept.items(), key=lambda item: (-item[1], item[0])))


@dataclass
class Lexicon:
    """The learned terms with their odds, and the misspellings that mean nothing."""

    odds: dict[str, float]
    harmless: frozenset[str] = frozenset()
    trie: FuzzyTrie | None = field(default=None, repr=False)

    def __getstate__(self) -> tuple:
        return self.odds, self.harmless

    def __setstate__(self, state: tuple) -> None:
        self.odds, self.harmless = state
        self.trie = None

    def finder(self) -> dict[bytes, tuple[int, int] | None]:
        """Hits by word: each distinct word is walked once."""
        if self.trie is None:
            self.trie = FuzzyTrie(list(self.odds))
        return _Found(self.trie, self.harmless)

    def strengths(self) -> list[float]:
        return list(self.odds.values())


class _Found(dict):
    MOST = 500_000

    def __init__(self, trie: FuzzyTrie, harmless: frozenset[str]) -> None:
        super().__init__()
        self.trie, self.harmless = trie, harmless

    def __missing__(self, raw: bytes) -> tuple[int, int] | None:
        if len(self) >= self.MOST:
            self.clear()
        word = raw.decode()
        hit = self.trie.find(word)
        if hit and hit[0] and word in self.harmless:
            hit = None
        self[raw] = hit
        return hit


def _fuzzy_words(shared):
    """``term, n``: misspelled terms of a task's documents, by documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value.finder()
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in text_bytes(batch):
                counts.update(word.decode() for word in set(_words(text)) if (hit := found[word]) and hit[0])
            yield pa.RecordBatch.from_pydict({"term": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    return run


def _quoted_places(text: bytes) -> set[int]:
    """The places, as in ``_words``, of the words inside quotations."""
    places: set[int] = set()
    at = end = 0
    for match in _QUOTATION.finditer(text):
        first = at + len(_words(text[end:match.start()]))
        at, end = first + len(_words(match.group())), match.end()
        places.update(range(first, at))
    return places


FEATURES = 9


def features(text: bytes, found: dict[bytes, tuple[int, int] | None], strengths: list[float]) -> list[float]:
    """Counts and strengths of the hits, apart by misspelling and context."""
    own = _words(text)
    hits = [(place, hit) for place, word in enumerate(own) if (hit := found[word])]
    if not hits:
        return [0.0] * FEATURES
    quoted_at = _quoted_places(text)
    exact = fuzzy = quoted = addressed = 0
    strength = []
    for place, (edits, term) in hits:
        around = {word.decode() for word in own[max(0, place - CONTEXT):place + CONTEXT + 1]}
        if place in quoted_at or around & SAYING:
            quoted += 1
            continue
        exact += edits == 0
        fuzzy += edits > 0
        addressed += bool(around & ADDRESS)
        strength.append(strengths[term] / (1 + edits))
    return [
        float(exact > 0), math.log1p(exact), float(fuzzy > 0), math.log1p(fuzzy), math.log1p(quoted), float(exact + fuzzy == 0),
        math.log1p(addressed), max(strength, default=0.0) / 10, math.log1p(100 * len(strength) / len(own)),
    ]


def _features_of(shared, named: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        found, strengths = lexicon.finder(), lexicon.strengths()
        for batch in batches:
            rows = [features(text, found, strengths) for text in text_bytes(batch)]
            columns = {name: batch.column(name) for name in batch.schema.names if name != "text"}
            yield pa.RecordBatch.from_pydict(columns | {named: pa.array(rows, pa.list_(pa.float64()))})

    return run


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray | None
    share: float


def _labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``toxic, place, text`` of the documents whose label may be learned."""
    own = labels.where("toxic is not null and doc_id is not null").where(~held_out())
    own = written_table(own.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")), "toxic-labels")
    rows = documents.where(~held_out()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Only labelled texts are shuffled: a bounded filter of their ids drops most others first.
    rows = possible_members(rows, "doc_id", id_filter(own, "doc_id")).join(own.hint("merge"), "doc_id")
    return written_table(rows.select("toxic", F.xxhash64("doc_id").alias("place"), "text"), "toxic-labelled")


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def _counted(rows: DataFrame, run) -> DataFrame:
    return rows.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The lexicon from all labelled documents that are not held out, the weights from a bounded sample of them."""
    spark = documents.sparkSession
    ship_package(spark)
    rows = _labelled(documents, labels)
    totals = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    all_toxic, all_clean = totals.get(True, 0), totals.get(False, 0)
    share = all_toxic / max(1, all_toxic + all_clean)
    if not all_toxic or not all_clean:
        return Model(Lexicon({}), None, share)
    toxic_rows, clean_rows = rows.where("toxic"), rows.where("not toxic")
    counts = rows.select("toxic", "text").mapInArrow(_count_terms, "term string, toxic long, clean long")
    counts = written_table(counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxic-terms")
    strong = _strong(counts, all_toxic, all_clean).collect()
    toxic, clean = ({row["term"]: row[name] for row in strong} for name in ("toxic", "clean"))
    lexicon = Lexicon(choose_lexicon(toxic, clean, all_toxic, all_clean))
    shared = spark.sparkContext.broadcast(lexicon)
    misspelled = _counted(clean_rows, _fuzzy_words(shared)).withColumnRenamed("n", "clean").join(
        _counted(toxic_rows, _fuzzy_words(shared)).withColumnRenamed("n", "toxic"), "term", "left").fillna(0, ["toxic"])
    lexicon = Lexicon(lexicon.odds, frozenset(
        row["term"] for row in misspelled.toLocalIterator() if _odds(row["toxic"], row["clean"], all_toxic, all_clean) <= HARMLESS_ODDS))
    shared = spark.sparkContext.broadcast(lexicon)
    chosen = rows.where(lowest_hashes("place", sample, all_toxic + all_clean)).mapInArrow(
        _features_of(shared, "features"), "toxic boolean, place long, features array<double>")
    fitted = chosen.orderBy("place", "toxic", "features").limit(sample).toPandas()
    labels_of = fitted["toxic"].to_numpy(float)
    if labels_of.min() == labels_of.max():
        return Model(lexicon, None, share)
    return Model(lexicon, fit_logistic(np.array(fitted["features"].tolist()), labels_of), share)


def _scores(shared, passed: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        found, strengths = model.lexicon.finder(), model.lexicon.strengths()
        for batch in batches:
            rows = np.array([features(text, found, strengths) for text in text_bytes(batch)]).reshape(-1, FEATURES)
            score = np.full(len(rows), model.share) if model.weights is None else score_logistic(model.weights, rows)
            yield pa.RecordBatch.from_pydict({name: batch.column(name) for name in passed} | {"score": pa.array(score, pa.float64())})

    return run


def scored(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score`` of every document."""
    ship_package(documents.sparkSession)
    frame = documents.select(*dict.fromkeys([*keep, "text"]))
    schema = ", ".join(f"`{name}` {frame.schema[name].dataType.simpleString()}" for name in keep)
    return frame.mapInArrow(_scores(documents.sparkSession.sparkContext.broadcast(model), keep), f"{schema}, score double")


def without_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` below the threshold; the columns may have any names."""
    model = learn(documents, labels)
    inner = inner_names(documents.columns)
    renamed = documents.select(*[F.col(f"`{name}`").alias(to) for name, to in inner.items()])
    clean = scored(renamed, model, renamed.columns).where(F.col("score") < threshold)
    return clean.select(*[F.col(to).alias(name) for name, to in inner.items()])


def toxicity_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(documents, learn(documents, labels), ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
