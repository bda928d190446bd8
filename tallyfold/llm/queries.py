"""The operators as queries over the corpus tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import counts, decontamination, divergence, language, negatives, packing, pages, pieces, pii, quality, repeats, rules, simhash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    best = found.groupBy("doc_id", "item_id", "item_shingles").agg(F.max("shared").cast("long").alias("shared"))
    return best.select("doc_id", "item_id", F.col("item_shingles").cast("long").alias("item_shingles"), "shared", (F.col("shared") / F.col("item_shingles")).alias("containment"))


ORACLES["op1_benchmark_decontamination"] = decontamination.ORACLE


@query
def op2_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(quality.sample(docs, table(spark, sf_dir, "labels")))
    found = quality.scored(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.round("expected_grade", 9).alias("expected_grade"), F.round("p_top", 9).alias("p_top"), "accepted")


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages")
    return pages.extracted(found, pages.fitted(found))


@query
def op4_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.found_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", pii.spans_text().alias("spans"))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.deduplicated(table(spark, sf_dir, "documents"))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), TOKENIZER, public_tokenizers.PATTERN))


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = rules.judged(docs, rules.fitted(docs, table(spark, sf_dir, "labels")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & (F.col("rule") == 0)).alias("kept"), "rule")


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.documents_of(*counts.flat_files(table(spark, sf_dir, "documents"), TOKENIZER, public_tokenizers.PATTERN))


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op11_source_divergence"] = divergence.ORACLE


@query
def op12_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.round_trip(table(spark, sf_dir, "documents"), PIECES)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(rows.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


ORACLES["op13_hard_negatives"] = negatives.ORACLE
