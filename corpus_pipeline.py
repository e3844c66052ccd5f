"""From raw documents to packed sequences: four stages, each a written table for the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.common import small_batches, table, tokenizer_path, written
from tallylake.llm.decontaminate import contamination
from tallylake.llm.jaccard import jaccard_components, representatives
from tallylake.llm.packing import packed_documents
from tallylake.llm.registry import let_workers_import
from tallylake.llm.stages import once, text_key, without
from tallylake.llm.toxicity import THRESHOLD, score_toxicity, toxicity_model

#: Near duplicates share this percentage of all their n-grams of so many words.
NEAR_NGRAM, NEAR_PERCENT = 5, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; null and empty texts are scored like others."""
    let_workers_import(spark)
    # Only keys go through Python beside the text; the rows themselves stay in the JVM.
    keyed = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text")
    with small_batches(spark):
        model = toxicity_model(docs, table(spark, sf_dir, "labels"))
        toxic = score_toxicity(keyed, model).where(f"score >= {THRESHOLD}")
        return without(docs, toxic.select("row.doc_id", "row.text_key"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links connect, the one with the smallest doc_id, once; all without words."""
    let_workers_import(spark)
    decided = written(representatives(jaccard_components(docs, ngram=NEAR_NGRAM, percent=NEAR_PERCENT)), "representatives")
    return once(without(docs, decided.where("NOT keep")), decided.where("keep AND copies > 1"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with any item of the benchmark."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    let_workers_import(spark)
    with small_batches(spark):
        return packed_documents(docs, tokenizer_path())[0]


STAGES = [
    ("toxicity", toxicity), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]
#: Learned scores and tokenizers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
