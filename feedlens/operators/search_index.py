"""Text search by trigram postings: only rows that hold the pattern's rarest trigrams are compared.

The index is a table of postings: per trigram of the lower-cased title, summary or content and per range of
``ID_SPAN`` article ids, the sorted ids that hold it. A frequent trigram is thus many rows of bounded size, and ids
combine in the map tasks. Indexes of further articles are appended as further rows.

A search takes the literal pieces of its pattern, looks up how many articles each of their trigrams has, intersects the
rarest ones range by range, and compares the text of the candidates only. Patterns without a piece of three characters
have no trigram and are compared with every row. Articles stored in folders by id (``stored_by_id``) are read only where
candidates are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.operators.content import NEWEST_FIRST, SEARCHED, article_list_view, like_pattern, matches, search_articles
from feedlens.operators.ranking import paged
from feedlens.session import run_folder, written_table
from feedlens.shipping import ship_package

GRAM = 3
#: Article ids per row of postings.
ID_SPAN = 1 << 15
#: Article ids per folder of stored articles: some thousand folders at ten thousand million articles.
FOLDER_IDS = 1 << 21
FOLDER = "_folder"
#: Pairs of articles and trigrams that a task turns into lists at once, and lists in a batch.
AT_ONCE, LISTS = 1 << 22, 1 << 14
#: Trigrams intersected: the rarest few leave little to the exact comparison.
MOST_GRAMS = 6


def _texts_grams(texts: list[str | None]) -> list[np.ndarray]:
    """The overlapping trigrams of every text, each as a number of three 21-bit code points, with repetitions."""
    lengths = np.array([len(text) if text else 0 for text in texts], np.int64)
    signs = np.frombuffer("".join(text for text in texts if text).encode("utf-32-le"), np.uint32).astype(np.int64)
    keys = signs[:-2] << 42 | signs[1:-1] << 21 | signs[2:]
    ends = np.cumsum(lengths)
    return [keys[end - length:max(end - GRAM + 1, end - length)] for end, length in zip(ends.tolist(), lengths.tolist(), strict=True)]


def _gram_texts(keys: np.ndarray) -> list[str]:
    signs = np.stack([keys >> 42, keys >> 21 & 0x1FFFFF, keys & 0x1FFFFF], axis=1).astype("<u4").tobytes().decode("utf-32-le")
    return [signs[at:at + GRAM] for at in range(0, len(signs), GRAM)]


def _lists(rows: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """``gram, span, ids`` of some articles and their distinct trigrams, ids ascending."""
    rows.sort(key=itemgetter(0))
    keys = np.concatenate([own for _, own in rows])
    ids = np.repeat(np.array([number for number, _ in rows], np.int64), [len(own) for _, own in rows])
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    spans = ids // ID_SPAN
    starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (spans[1:] != spans[:-1])])) if len(keys) else np.zeros(0, np.int64)
    offsets = np.append(starts, len(keys))
    grams = _gram_texts(keys[starts])
    for at in range(0, len(starts), LISTS):
        part = offsets[at:at + LISTS + 1]
        yield pa.RecordBatch.from_pydict({
            "gram": pa.array(grams[at:at + LISTS], pa.string()), "span": pa.array(spans[starts[at:at + LISTS]], pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array(part - part[0], pa.int32()), pa.array(ids[part[0]:part[-1]], pa.int64())),
        })


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for batch in batches:
        fields = [_texts_grams(batch.column(place).to_pylist()) for place in range(1, batch.num_columns)]
        for number, *own in zip(batch.column(0).to_pylist(), *fields, strict=True):
            found = np.unique(np.concatenate(own))
            rows.append((number, found))
            size += len(found)
            if size >= AT_ONCE:
                yield from _lists(rows)
                rows, size = [], 0
    if rows:
        yield from _lists(rows)


def postings(articles: DataFrame) -> DataFrame:
    """``gram, span, ids, articles``: the index of ``articles``. Rows without an article_id are not indexed.

    Tasks make the lists of their own articles, ``AT_ONCE`` pairs at a time; only lists are shuffled, not a row per pair.
    """
    ship_package(articles.sparkSession)
    held = [F.lower(F.col(name)).alias(name) for name in SEARCHED if name in articles.columns]
    rows = articles.where(F.col("article_id").isNotNull()).select(F.col("article_id").cast("long").alias("article_id"), *held)
    lists = rows.mapInArrow(_post, "gram string, span long, ids array<long>")
    return lists.groupBy("gram", "span").agg(
        F.array_distinct(F.sort_array(F.flatten(F.collect_list("ids")))).alias("ids")
    ).withColumn("articles", F.size("ids"))


def literal_pieces(pattern: str) -> list[str]:
    """The parts of a LIKE pattern between its wildcards, escapes undone."""
    pieces = [""]
    for escaped, plain in re.findall(r"\\(.)|(.)", pattern, re.DOTALL):
        if plain in ("%", "_"):
            pieces.append("")
        else:
            pieces[-1] += escaped or plain
    return [piece for piece in pieces if piece]


def pattern_grams(spark: SparkSession, pattern: str) -> list[str]:
    """Distinct trigrams that every match of the pattern holds, lower-cased as the index is."""
    lowered = spark.sql("SELECT lower(:pattern) AS pattern", args={"pattern": pattern}).first()["pattern"]
    return sorted({piece[at:at + GRAM] for piece in literal_pieces(lowered) for at in range(len(piece) - GRAM + 1)})


def candidates(index: DataFrame, grams: list[str]) -> DataFrame:
    """``article_id, span`` of the articles that hold the rarest of ``grams``."""
    own = index.where(F.col("gram").isin(*grams))
    sizes = {row["gram"]: row["n"] for row in own.groupBy("gram").agg(F.sum("articles").alias("n")).collect()}  # a row per gram of the pattern
    if len(sizes) < len(grams):
        return index.limit(0).select(F.explode("ids").alias("article_id"), "span")
    rarest = sorted(grams, key=lambda gram: (sizes[gram], gram))[:MOST_GRAMS]
    # Appended indexes may hold a trigram of a span in several rows.
    of_gram = own.where(F.col("gram").isin(*rarest)).groupBy("span", "gram").agg(F.flatten(F.collect_list("ids")).alias("ids"))
    lists = of_gram.groupBy("span").agg(F.collect_list("ids").alias("lists")).where(F.size("lists") == len(rarest))
    common = F.reduce(F.slice("lists", 2, len(rarest)), F.array_distinct(F.element_at("lists", 1)), F.array_intersect)
    return lists.select(F.explode(common).alias("article_id"), "span")


def stored_by_id(articles: DataFrame, folder_ids: int = FOLDER_IDS) -> DataFrame:
    """``articles`` written once in folders by article_id, with the folder's number in ``_folder``."""
    spark = articles.sparkSession
    path = run_folder(spark, "articles-by-id")
    rows = articles.withColumn(FOLDER, F.expr(f"cast(floor(article_id / {folder_ids}) AS BIGINT)"))
    # Tasks write ranges of ids, or each would put a file into every folder. A large folder is cut into several
    # ranges, so that none is one task's; the hash cuts the rows without an id.
    text = [F.col(name) for name in SEARCHED if name in articles.columns]
    rows.repartitionByRange("article_id", F.xxhash64(*text)).write.partitionBy(FOLDER).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _near(articles: DataFrame, found: DataFrame, folder_ids: int) -> DataFrame:
    """The folders that hold candidates, and that of the rows without an id."""
    own = F.expr(f"cast(floor(_candidate / {folder_ids}) AS BIGINT)").alias(FOLDER)
    folders = [row[FOLDER] for row in found.select(own).distinct().collect()]  # at most as many as folders
    return articles.where(F.col(FOLDER).isin(folders) | F.col(FOLDER).isNull()).drop(FOLDER)


def search_indexed(articles: DataFrame, index: DataFrame, term: str | None = None, category_id: int | None = None,
                   escape: bool = False, folder_ids: int = FOLDER_IDS) -> DataFrame:
    """What ``search_articles`` finds, the text of candidates only being compared.

    ``index`` holds the postings of (at least) these articles. Rows without an article_id are always compared.
    """
    pattern = like_pattern(term, escape)
    grams = pattern_grams(articles.sparkSession, pattern) if pattern else []
    if not grams:
        return search_articles(articles, term, category_id, escape).drop(FOLDER)
    found = candidates(index, grams).select(F.col("article_id").alias("_candidate"), F.col("span").alias("_span"))
    if FOLDER in articles.columns:
        found = written_table(found, "candidates")
        articles = _near(articles, found, folder_ids)
    if category_id is not None:
        articles = articles.where(F.col("category_id") == category_id)
    hit = matches(articles, pattern)
    # The comparison also names the other side, or it would be done before the join, on every row.
    compared = articles.join(found, F.col("article_id") == F.col("_candidate")).where(
        F.when(F.col("_span") * ID_SPAN <= F.col("article_id"), hit)
    )
    unnamed = articles.where(F.col("article_id").isNull() & hit)
    return compared.select(*articles.columns).unionAll(unnamed)


def feed_page_indexed(articles: DataFrame, index: DataFrame, limit: int = 20, offset: int = 0, term: str | None = None,
                      category_id: int | None = None, with_total: bool = True) -> DataFrame:
    """``feed_page`` by the index."""
    found = article_list_view(search_indexed(articles, index, term, category_id))
    return paged(found, [F.desc(name) for name in NEWEST_FIRST], limit, offset, with_total)
