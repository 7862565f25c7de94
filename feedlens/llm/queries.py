"""The operators' queries over the given tables, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import (
    alignment, chat, decontaminate, line_dedup, merkle, mixing, near_dedup, personal_data, secrets, sharding, token_files, topk, toxicity,
)
from feedlens.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(_table(spark, sf_dir, "embeddings"))


#: A conversation made of the template's own control strings.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    roles = F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role")
    own = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), roles)
    own = own.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.lit(CONTROL_TEXT).alias("text"))
    return chat.chat_report(given.unionByName(own))


def op3_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents").select("doc_id"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op8_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_report(_table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_report(_table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_report(_table(spark, sf_dir, "documents"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(_table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_nearest_vectors, op2_chat_windows, op3_contamination, op4_shards, op5_toxicity, op6_mix, op7_secrets,
        op8_repeated_lines, op9_personal_data, op10_near_duplicates, op11_token_files, op12_manifest,
        op13_alignment,
    )
}
