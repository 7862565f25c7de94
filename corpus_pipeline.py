"""A corpus pipeline of five stages over ``documents``.

Every stage works on all that the one before kept, written as Parquet and read again; a stage's
decisions take effect. All but the last return the columns of ``documents``; the last adds the shard.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedlens.llm import decontaminate, mixing, near_dedup, sharding, toxicity
from feedlens.session import written_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, by a model of this table's labels."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts alike to 0.8 in five-word shingles."""
    return near_dedup.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without much verbatim benchmark text."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the sources' weights take, repeated by epoch and cut at the budgets."""
    return mixing.mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its slot and shard; input columns of these names are kept with ``input_`` in front."""
    taken = {name.lower() for name in docs.columns}
    renamed = {}
    for name in docs.columns:
        if name.lower() in sharding.RESULTS:
            renamed[name] = f"input_{name}"
            while renamed[name].lower() in taken:
                renamed[name] = f"input_{renamed[name]}"
    return sharding.place(docs.withColumnsRenamed(renamed))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: The stages learn and search, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
