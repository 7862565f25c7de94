"""Mixing sources to target weights by cuts in a hash-random order.

Each document gets a hash-random key. The hash space is cut into fixed ranges, which are a
range partitioning known beforehand: keys are uniform, so every range of a source holds an even share
of it, also of a source with a third of all rows. Token counts are summed per (source, range);
the prefix sums of these sums find the range in which a source's budget ends, and an exact sort
of that one range finds the document. The decision for any other document is then a
comparison of its key with the cut of its source: no text is shuffled and no source meets in one task.

A budget above the source's size is met by whole epochs, the rest by one more, cut as above.
The document at the cut gives the words still missing.

Defined results: a NULL or empty text has size 0 and takes 0; the NULL source is a source, last
in order; repeated rows of a document (same source, id and size) share one key and, at the cut, share
the missing words evenly (rounded down); empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.session import written_table

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_EPOCHS = 2
RANGES = 4096


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT, most: int = MOST_EPOCHS
) -> DataFrame:
    """``source, source_size, target`` from rows ``source, size``.

    Sources in code point order (NULL last) weigh ``weights`` in turn and share ``percent`` of
    all sizes. A target stops at ``most`` times its source's size; what is above is shared
    again by weight. The end of that sharing has a closed form: with the sources ordered by
    cap per weight, the first k are capped and the others get one common level per weight.
    One row per source: the sums before are combined by source in every task.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    # cap / weight in whole numbers: times a multiple of every weight.
    multiple = math.prod(weights)
    weighed = by_source.select(
        "source", "source_size", (F.col("source_size") * most).alias("cap"),
        F.get(F.array(*[F.lit(weight).cast("long") for weight in weights]), turn).alias("weight"),
        F.get(F.array(*[F.lit(multiple // weight).cast("long") for weight in weights]), turn).alias("per_weight"),
    )
    by_level = Window.orderBy(F.col("cap") * F.col("per_weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    levels = (
        weighed
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("budget", F.sum("source_size").over(everything) * percent / F.lit(100.0))
        .withColumn("level", (F.col("budget") - F.col("caps_before")) / F.col("weight_left"))
        .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
        # From the first open source on, all are open, at that source's level.
        .withColumn("common", F.min(F.when(F.col("open"), F.struct(F.col("caps_before"), F.col("level")))).over(everything)["level"])
    )
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("common") * F.col("weight"), F.col("cap").cast("double")))
    return levels.select("source", "source_size", target.alias("target"))


def _sized(documents: DataFrame, seed: int) -> DataFrame:
    """``documents`` with ``_size`` and ``_key``, the hash-random key in [0, 2^52)."""
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"#{seed}"))
    key = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return documents.withColumn("_size", word_count(F.col("text"))).withColumn("_key", key)


def cuts(sizes: DataFrame, targets: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Where each source's budget ends: ``source, epochs, cut_key, cut_id, cut_size, cut_taken``.

    ``epochs`` whole epochs, then every document before (cut_key, cut_id, cut_size) in order; the
    documents equal to it give ``cut_taken`` words each. NULL cuts: the epochs meet the budget.
    """
    width = 2**52 // ranges
    keyed = sizes.where("size > 0").withColumn("range", F.expr(f"key div {width}L"))
    sums = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    along = Window.partitionBy("source").orderBy("range")
    budgets = targets.where("source_size > 0").select(
        F.col("source").alias("s"), F.expr("cast(floor(target) as bigint) div source_size").alias("epochs"),
        F.expr("cast(floor(target) as bigint) % source_size").alias("rest"),
    )
    before = sums.withColumn("before", F.sum("range_size").over(along) - F.col("range_size"))
    ends = before.join(budgets, F.col("source").eqNullSafe(F.col("s"))).where(
        "rest >= before and rest < before + range_size"
    ).select("s", "epochs", "rest", F.col("range").alias("end_range"), "before")
    equal = ["key", "doc_id", "size"]
    ends = written_table(ends, "mixing-ends")
    inside = (
        keyed.join(ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("end_range")))
        .groupBy("s", "epochs", "rest", "before", *equal).agg(F.count(F.lit(1)).alias("copies"))
    )
    inner = Window.partitionBy("s").orderBy(*equal)
    inside = inside.withColumn(
        "before", F.col("before") + F.sum(F.col("size") * F.col("copies")).over(inner) - F.col("size") * F.col("copies")
    )
    return inside.where("rest >= before and rest < before + size * copies").select(
        F.col("s").alias("source"), "epochs", F.col("key").alias("cut_key"), F.col("doc_id").alias("cut_id"),
        F.col("size").alias("cut_size"), F.expr("(rest - before) div copies").alias("cut_taken"),
    )


def _budgets(documents: DataFrame, seed: int, weights: tuple[int, ...], percent: int) -> tuple[DataFrame, DataFrame]:
    """Narrow sizes of all documents, and one row per source with its target and cut."""
    sizes = written_table(
        _sized(documents, seed).select("doc_id", "source", F.col("_size").alias("size"), F.col("_key").alias("key")),
        "mixing-sizes",
    )
    targets = written_table(source_targets(sizes, weights, percent), "mixing-targets")
    ends = cuts(sizes, targets).withColumnRenamed("source", "s")
    per_source = targets.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return sizes, written_table(per_source.withColumnRenamed("source", "of"), "mixing-cuts")


def _decided(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """``rows`` (with source, doc_id, size, key) with ``epochs`` and ``last_taken``."""
    place, cut = F.struct("key", "doc_id", "size"), F.struct("cut_key", "cut_id", "cut_size")
    last = (
        F.when(F.col("cut_key").isNull() | (F.col("size") == 0), 0).when(place < cut, F.col("size"))
        .when(place == cut, F.col("cut_taken")).otherwise(0)
    )
    return (
        rows.join(per_source, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("last_taken", last.cast("long"))
        .withColumn("epochs", F.coalesce("epochs", F.lit(0)).cast("long"))
    )


def mix(
    documents: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT
) -> DataFrame:
    """Per document ``doc_id, source, size, source_size, target, epochs, last_taken, taken``.

    ``epochs`` whole repeats and ``last_taken`` words of one more; ``taken`` are all its words.
    """
    sizes, per_source = _budgets(documents, seed, weights, percent)
    return _decided(sizes, per_source).select(
        "doc_id", "source", "size", "source_size", "target", "epochs", "last_taken",
        (F.col("epochs") * F.col("size") + F.col("last_taken")).alias("taken"),
    )


def mixed_documents(
    documents: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT
) -> DataFrame:
    """The mix itself, with the columns of ``documents``.

    Each document stands there once per epoch that takes it; the one at a source's cut ends
    after the words that the budget has left.
    """
    _, per_source = _budgets(documents, seed, weights, percent)
    rows = _sized(documents.select(F.struct("*").alias("_row"), "doc_id", "source", "text"), seed).select(
        "_row", "doc_id", "source", F.col("_size").alias("size"), F.col("_key").alias("key")
    )
    pieces = F.concat(
        F.array_repeat("size", F.when(F.col("size") > 0, F.col("epochs")).otherwise(0).cast("int")),
        F.filter(F.array("last_taken"), lambda words: words > 0),
    )
    taken = _decided(rows, per_source).select("_row", "size", F.explode(pieces).alias("words"))
    whole = F.col("words") == F.col("size")
    # Words with the white space before them, so that the cut text keeps its form.
    words = F.regexp_extract_all("_row.text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.when(whole, F.col("_row.text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.col("words").cast("int")), ""))
    result = taken.select("_row", "words", "size", text.alias("_text"))
    columns = []
    for name in documents.columns:
        old = F.col(f"_row.`{name}`")
        new = {"text": F.col("_text"), "n_chars": F.when(whole, old).otherwise(F.length("_text"))}.get(name, old)
        columns.append(new.cast(documents.schema[name].dataType).alias(name))
    return result.select(*columns)
