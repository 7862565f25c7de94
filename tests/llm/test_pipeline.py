"""Every stage's decisions against its operator's own rows, and run() against its stages one by one."""

import corpus_pipeline
from feedlens.llm import decontaminate, mixing, near_dedup, sharding, toxicity
from tests.llm.conftest import rows_of


def test_stages_take_effect(spark, tmp_path):
    small = "/root/testdata/sf0.01"  # labels enough to learn from
    documents = spark.read.parquet(f"{small}/documents.parquet")
    labels, benchmark = spark.read.parquet(f"{small}/labels.parquet"), spark.read.parquet(f"{small}/benchmark.parquet")
    kept = {}
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, small)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents.columns
        ids = sorted(row.doc_id for row in docs.select("doc_id").collect())
        if name == "toxicity":
            judged = toxicity.toxicity_report(before, labels)
            assert ids == sorted(row.doc_id for row in judged.where("predicted = 0").collect())
        elif name == "near_dedup":
            assert ids == sorted(row.doc_id for row in near_dedup.near_duplicates(before).where("kept").collect())
        elif name == "decontamination":
            assert ids == sorted(row.doc_id for row in decontaminate.contamination(before, benchmark).where("not contaminated").collect())
        elif name == "mixing":
            taken = {row.doc_id: row.taken for row in mixing.mix(before).collect() if row.taken}
            assert set(ids) == set(taken)
        else:
            table = sharding.fill_slots(sharding.DEFAULT_SHARDS)
            assert all(row.shard == table[row.slot] for row in docs.collect())
        kept[name] = len(ids)
    assert kept["toxicity"] < documents.count() and kept["near_dedup"] < kept["toxicity"] and kept["decontamination"] < kept["near_dedup"]
    assert rows_of(corpus_pipeline.run(spark, small), "doc_id", "n_chars", "shard") == rows_of(docs, "doc_id", "n_chars", "shard")


def test_clashing_columns_are_kept_under_another_name(spark, tmp_path):
    small = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{small}/documents.parquet")
    documents.selectExpr("*", "doc_id + 1 AS shard", "'x' AS input_shard", "'y' AS Slot").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert done.columns == [*documents.columns, "input_input_shard", "input_shard", "input_Slot", "slot", "shard", "shard_name"]
    table = sharding.fill_slots(sharding.DEFAULT_SHARDS)
    rows = done.collect()
    assert rows and all(row.input_input_shard == row.doc_id + 1 and row.shard == table[row.slot] for row in rows)
