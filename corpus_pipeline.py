"""Cleaning pipeline over documents: each stage takes what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm import crf_language, line_spread, mixing
from intentloom.llm.decontaminate import drop_contaminated
from intentloom.llm.jaccard_join import jaccard_groups
from intentloom.llm.runtime import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no letter, or no language with three tenths of the words."""
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    field = crf_language.learned(docs, F.col("doc_id"), F.col("text"), F.col("lang"), ~held_out)
    return crf_language.with_language(docs, field)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from the texts, and n_chars follows; every document stays."""
    out = line_spread.remove_boilerplate(docs).drop("line_dedup")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id stays; a repeated id stays once."""
    groups = stored(jaccard_groups(docs), "groups")
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    repeated = groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    return kept if repeated.isEmpty() else kept.where("doc_id is not null").dropDuplicates(["doc_id"]).union(kept.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_rates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents with tokens, posteriors and rate: how often to take each so that the mix meets its targets."""
    labels = table(spark, sf_dir, "labels").select("doc_id", mixing.domain_of_labels().alias("domain"))
    return mixing.mix(docs, labels, whole=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("mixing", mixing_rates),
]

#: The learned stages can't be written in SQL; tests/llm checks them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
