"""Personal data: known forms, and candidates judged by boosted trees.

Known forms (``email``, ``ip``, ``card``, ``phone``) are found leftmost and non-overlapping and always
reported. High-recall generators propose further, overlapping spans: written-out addresses, digit groups,
dotted numbers. Each candidate has features of its format and context, no outcome of a known form's
check. Boosted trees learn from candidates that coincide with a known form (1) and those that
do not (0); per kind, a held-out fold sets the threshold at which ``PRECISION`` of what is above are
known forms, and only candidates above it become spans of kind ``other``.

The trees are fitted on all candidates of all documents. Features are cut at quantiles of all their values, candidates of the same
bins are counted together, and each level of a tree needs only sums per node, feature and bin: over at most ``TOGETHER``
distinct rows of bins on the driver, else as a Spark job. Thresholds come from all candidates of the held-out fold, by counts per
score in steps of 1 / ``STEPS``. Documents are scored where they are. No text is shuffled.

Defined results: a NULL text is an empty one; empty tables and texts without candidates give no spans; a kind without
enough examples has no threshold and adds none; repeated rows give repeated results; positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.boosting import Trees, bins_of, boost, in_values, level_sums, precision_threshold, quantile_cuts, score_trees
from feedlens.llm.shipping import ship_package
from feedlens.session import written_table

KINDS = ("email", "ip", "card", "phone")
#: Distinct rows of bins that are boosted on the driver (3 MB), steps of a score, features of a candidate.
TOGETHER, STEPS, N_FEATURES = 1 << 16, 1 << 16, 18
#: Tasks whose sums the driver adds up.
SUMMED = 64
PRECISION = 0.95

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
#: High-recall proposals, by the kind they may turn out to be.
_PROPOSALS = (
    ("email", re.compile(
        r"[A-Za-z0-9._%+-]{1,64}(?: ?[\[(] ?at ?[\])] ?|@)[A-Za-z0-9-]{1,63}"
        r"(?:(?: ?[\[(] ?dot ?[\])] ?|\.)[A-Za-z0-9-]{1,63}){0,4}"
    )),
    ("number", re.compile(r"(?<![0-9A-Za-z])\+?[0-9](?:[ ().-]{0,2}[0-9]){6,24}(?![0-9A-Za-z])")),
)
_CONTEXT = (
    re.compile(r"e-?mail|mail|contact|write|@", re.I), re.compile(r"phone|tel|call|mobile|fax", re.I),
    re.compile(r"card|visa|credit|account|iban", re.I), re.compile(r"ssn|social|passport|tax|\bid\b", re.I),
    re.compile(r"\bip\b|host|server|addr|login", re.I), re.compile(r"version|release|v\.|isbn|page|fig", re.I),
)
#: Characters of context on either side.
AROUND = 24


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: the local part is the run before it, up to the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def _luhn(digits: str) -> bool:
    total = sum(int(digit) if place % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(digit)] for place, digit in enumerate(reversed(digits)))
    return total % 10 == 0


def known_spans(text: str) -> list[tuple[str, int, int]]:
    """The known forms by kind as listed, then start."""
    spans = [("email", start, end) for start, end in _emails(text)]
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in match.group().split(".")):
            spans.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *match.span()))
    for match in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", match.group())) <= 15:
            spans.append(("phone", *match.span()))
    return spans


def _features(text: str, start: int, end: int) -> list[float]:
    found = text[start:end]
    digits = sum(sign.isdigit() for sign in found)
    groups = [len(group) for group in re.findall(r"[0-9]+", found)]
    before, after = text[max(0, start - AROUND):start], text[end:end + AROUND]
    return [
        end - start, digits, len(groups), max(groups, default=0), min(groups, default=0),
        found.count("."), found.count("-"), found.count(" "), found.count("@"), found.startswith("+"),
        sum(sign.isalpha() for sign in found), found.count("("),
        *[bool(pattern.search(before)) + 0.5 * bool(pattern.search(after)) for pattern in _CONTEXT],
    ]


def proposals(text: str, known: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, float, list[float]]]:
    """Candidates: (kind, start, end, whether a known form covers it, features)."""
    for kind, pattern in _PROPOSALS:
        if kind == "email" and "@" not in text and "at" not in text:
            continue
        for match in pattern.finditer(text):
            start, end = match.span()
            if kind == "email" and "@" not in match.group() and "(" not in match.group() and "[" not in match.group():
                continue
            covered = any(first < end and start < last for _, first, last in known)
            yield kind, start, end, float(covered), _features(text, start, end)


_CANDIDATE = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("known", pa.float64()), ("features", pa.list_(pa.float64())),
]))
CANDIDATE_TYPE = "array<struct<kind:string,start:int,end:int,known:double,features:array<double>>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"
_MAY_HOLD = re.compile(r"[0-9@]|[\[(] ?at ?[\])]")


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, more = [], []
        for text in batch.column("text").to_pylist():
            if not text or not _MAY_HOLD.search(text):
                base.append([])
                more.append([])
                continue
            known = known_spans(text)
            base.append([dict(zip(("kind", "start", "end"), span, strict=True)) for span in known])
            more.append([dict(zip(("kind", "start", "end", "known", "features"), span, strict=True)) for span in proposals(text, known)])
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "base": pa.array(base, _SPAN), "candidates": pa.array(more, _CANDIDATE),
        })


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all candidates of a batch: the number of the kind, whether held out, whether known, and the features."""
    found = batch.column("candidates").flatten()
    kinds = pc.index_in(found.field("kind"), pa.array([kind for kind, _ in _PROPOSALS])).to_numpy(zero_copy_only=False)
    features = found.field("features").flatten().to_numpy(zero_copy_only=False).reshape(len(kinds), -1)
    return kinds, batch.column("held").flatten().to_numpy(zero_copy_only=False).astype(bool), found.field("known").to_numpy(zero_copy_only=False), features


def _value_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often a feature of a kind has a value, in the fold that is learned from."""
    for batch in batches:
        kinds, held, _, features = _columns(batch)
        rows = []
        for kind in np.unique(kinds[~held]):
            for number, column in enumerate(features[~held & (kinds == kind)].T):
                rows += [(int(kind), number, value, count) for value, count in zip(*map(np.ndarray.tolist, np.unique(column, return_counts=True)), strict=True)]
        yield pa.RecordBatch.from_pydict(dict(zip(
            ("kind", "feature", "value", "n"), (list(part) for part in zip(*rows, strict=True)) if rows else ([],) * 4, strict=True)),
            pa.schema([("kind", pa.int32()), ("feature", pa.int32()), ("value", pa.float64()), ("n", pa.int64())]))


def _bin_counts(cuts: dict[int, list[np.ndarray]]):
    """Candidates, and known ones, per kind, fold and row of bins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, held, known, features = _columns(batch)
            for kind, own_cuts in cuts.items():
                for fold in (False, True):
                    own = (kinds == kind) & (held == fold)
                    if not own.any():
                        continue
                    rows, place = np.unique(bins_of(features[own], own_cuts), axis=0, return_inverse=True)
                    place = place.reshape(-1)
                    yield pa.RecordBatch.from_pydict({
                        "kind": pa.array([kind] * len(rows), pa.int32()), "held": pa.array([fold] * len(rows)),
                        "bins": pa.array([row.tobytes() for row in rows], pa.binary()), "n": pa.array(np.bincount(place), pa.int64()),
                        "known": pa.array(np.rint(np.bincount(place, known[own])).astype(np.int64)),
                    })

    return run


def _matrix(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    return bins, batch.column("n").to_numpy(), batch.column("known").to_numpy()


def _over_all(groups: DataFrame, sums):
    """``sums(bins, n, known, *more)`` over all rows of ``groups``, added up: at once if they are few, else in Spark's tasks."""
    if groups.count() <= TOGETHER:
        parts = _matrix(groups.toArrow())
        return lambda *more: sums(*parts, *more)

    def added(*more):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = sum((sums(*_matrix(batch), *more) for batch in batches if batch.num_rows), np.int64(0))
            if np.ndim(total):
                yield pa.RecordBatch.from_pydict({"cells": pa.array([total.tobytes()], pa.binary())})

        rows = groups.coalesce(SUMMED).mapInArrow(run, "cells binary").collect()  # 1 MB a row at most
        total = sum(np.frombuffer(row["cells"], np.int64) for row in rows)
        return total.reshape(sums(np.zeros((0, N_FEATURES), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), *more).shape)

    return added


def _score_sums(bins: np.ndarray, counts: np.ndarray, ones: np.ndarray, trees: Trees) -> np.ndarray:
    """Candidates and known ones per step of the score."""
    step = np.floor(score_trees(trees, bins) * STEPS).astype(np.int64)
    cells = np.zeros((STEPS + 1, 2), np.int64)
    np.add.at(cells, step, np.stack([counts, ones], axis=1))
    return cells


def fit(found: DataFrame) -> dict[str, tuple[Trees, float]]:
    """Trees and threshold by kind of proposal, from all candidates."""
    fold = F.transform("candidates", lambda c: F.pmod(F.xxhash64("doc_id", c["start"], c["end"]), F.lit(5)) == 0)
    rows = found.where(F.size("candidates") > 0).select("candidates", fold.alias("held"))
    # The patterns bound a candidate's length and so the number of values.
    values = rows.mapInArrow(_value_counts, "kind int, feature int, value double, n long").groupBy("kind", "feature", "value").agg(
        F.sum("n").alias("n")).orderBy("kind", "feature", "value").toPandas()
    cuts = {int(kind): [quantile_cuts(column["value"].to_numpy(), column["n"].to_numpy()) for _, column in own.groupby("feature")]
            for kind, own in values.groupby("kind")}
    if not cuts:
        return {}
    counted = rows.mapInArrow(_bin_counts(cuts), "kind int, held boolean, bins binary, n long, known long")
    groups = written_table(counted.groupBy("kind", "held", "bins").agg(F.sum("n").alias("n"), F.sum("known").alias("known")), "candidate-bins")
    sizes = {(row["kind"], row["held"]): row for row in groups.groupBy("kind", "held").agg(F.sum("n").alias("n"), F.sum("known").alias("known")).collect()}
    models = {}
    for kind, own_cuts in cuts.items():
        learned, held = sizes[kind, False], sizes.get((kind, True))
        if held is None or min(learned["known"], learned["n"] - learned["known"], held["n"]) < 10:
            continue
        own = groups.where(F.col("kind") == kind)
        # In bins, so that the held-out rows can be scored as they are counted.
        steps = [np.arange(len(cut), dtype=float) for cut in own_cuts]
        first, trees = boost(_over_all(own.where("not held"), level_sums), steps, learned["known"] / learned["n"])
        cells = _over_all(own.where("held"), _score_sums)((first, trees))
        met = np.flatnonzero(cells[:, 0])
        limit = precision_threshold(met / STEPS, cells[met, 1], PRECISION, cells[met, 0])
        if limit is not None:
            models[_PROPOSALS[kind][0]] = ((first, in_values(trees, own_cuts)), limit)
    return models


def _select(shared):
    """Keeps of the candidates those above their kind's threshold that no span before covers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            lists = batch.column("candidates").to_pylist()
            flat = pd.DataFrame([(number, *candidate.values()) for number, own in enumerate(lists) for candidate in own if not candidate["known"]],
                                columns=["row", "kind", "start", "end", "known", "features"])
            chosen: list[list[dict]] = [[] for _ in lists]
            for kind, (trees, limit) in models.items():
                own = flat[flat["kind"] == kind]
                if own.empty:
                    continue
                score = score_trees(trees, np.array(own["features"].tolist(), float))
                for row, start, end in own.loc[score >= limit, ["row", "start", "end"]].itertuples(index=False):
                    chosen[row].append({"kind": "other", "start": start, "end": end})
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "base": batch.column("base"), "other": pa.array([_apart(own) for own in chosen], _SPAN),
            })

    return run


def _apart(spans: list[dict]) -> list[dict]:
    """The spans by start, each that overlaps an earlier one left out."""
    kept: list[dict] = []
    for span in sorted(spans, key=lambda span: (span["start"], -span["end"])):
        if not kept or span["start"] >= kept[-1]["end"]:
            kept.append(span)
    return kept


def find_personal_data(documents: DataFrame) -> DataFrame:
    """``doc_id, base, other``: the known forms and the spans that the trees add, as arrays of (kind, start, end)."""
    ship_package(documents.sparkSession)
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    found = written_table(
        documents.select("doc_id", "text").mapInArrow(_find, f"doc_id {doc_type}, base {SPAN_TYPE}, candidates {CANDIDATE_TYPE}"),
        "personal-data",
    )
    shared = documents.sparkSession.sparkContext.broadcast(fit(found))
    return found.mapInArrow(_select(shared), f"doc_id {doc_type}, base {SPAN_TYPE}, other {SPAN_TYPE}")


def redacted(documents: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """``doc_id, text`` with all spans of a document's own text replaced; needs unique doc_ids."""
    spans = find_personal_data(documents).select("doc_id", F.array_sort(F.transform(
        F.concat("base", "other"), lambda span: F.struct(span["start"].alias("start"), span["end"].alias("end")))).alias("spans"))
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substr(F.col("text"), done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(span["start"] >= done["at"], F.concat(done["text"], gap, F.lit(mark))).otherwise(done["text"]).alias("text"),
        )

    clean = F.aggregate("spans", empty, step, lambda done: F.concat(done["text"], F.substr(F.col("text"), done["at"] + 1, F.length(F.col("text")))))
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(spans, "doc_id").select("doc_id", clean.alias("text"))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"])), ",")


def personal_report(documents: DataFrame) -> DataFrame:
    """Per document: known forms per kind, their digest, and all spans as text."""
    found = find_personal_data(documents)
    count = lambda kind: F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.size("other").cast("long").alias("n_other"),
        F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(F.concat("base", "other")).alias("spans"),
    )
