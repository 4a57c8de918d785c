"""The registered queries of the numbered operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm import context_mixing, crf_language, divergence, html_blocks, line_spread, mixing, phrases, prefix_trie, quotes, suffix_dedup, virtual_slots
from intentloom.llm.decontaminate import contaminated
from intentloom.llm.jaccard_join import jaccard_groups
from intentloom.llm.runtime import stored, table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    field = crf_language.learned(docs, F.col("doc_id"), F.col("text"), F.col("lang"), ~held_out)
    return crf_language.languages(docs, field).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    found = found.groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.max("coverage").alias("coverage"))
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10)) != 0
    return context_mixing.score(table(spark, sf_dir, "documents"), learn)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_spread.remove_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "line_dedup.*", F.md5("text").alias("kept_md5"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", mixing.domain_of_labels().alias("domain"))
    return mixing.mix(table(spark, sf_dir, "documents"), labels)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


def op10_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op11_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return virtual_slots.deal(docs, shards=24).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(prefix_trie.turns(table(spark, sf_dir, "conversations")), "numbered")
    heads = F.crc32(F.col("c").cast("string")) % 4
    rows, members = prefix_trie.rebuilt(turns, heads, F.col("c") - F.col("c") % 20)
    return prefix_trie.prefix_trie(rows, members)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_language_id, op3_divergence, op4_decontamination, op5_html_extraction,
        op6_context_mixing, op7_line_dedup, op8_mixing, op9_jaccard_join, op10_quote_linking,
        op11_virtual_slots, op12_prefix_trie, op13_collocations,
    )
}
ORACLES: dict[str, str] = {
    "op7_line_dedup": line_spread.oracle(), "op12_prefix_trie": prefix_trie.oracle(), "op13_collocations": phrases.oracle(),
}
