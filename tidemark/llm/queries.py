"""The operators as queries over the given tables, and their SQL where there is any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    conversation_repair, decontaminate, html_render, licenses, lm_scoring, mixing, ngram_join, quality_classifier,
    quality_rules, suffix_dedup, token_files, warc, whitening,
)
from tidemark.sources.storage import materialise, scratch_path

POLICY = "v3"
THRESHOLD = 0.3
# Bytes of the shortest repeated passage that is reported: short enough for fifty short words.
PASSAGE_BYTES = 240


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(_table(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(rows, POLICY).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "fail_bits", quality_rules.only_rule(POLICY).alias("only_rule"),
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "class_id", "n_links")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels.filter(quality_classifier.fold(F.col("doc_id"), 5) != 0))
    return quality_classifier.score(docs, model).select(
        "doc_id", (quality_classifier.fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.without_repeats(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), keep_first=False, passage_bytes=PASSAGE_BYTES
    )
    return rows.select(
        "doc_id", F.col("dedup_bytes").alias("n_bytes"), F.col("dedup_removed").alias("n_removed"),
        F.col("dedup_spans").alias("n_spans"), F.col("dedup_sha256").alias("kept_sha256"), "text",
        F.col("dedup_passages").alias("n_passage_bytes"),
    )


def op7_html_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.rendered(_table(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = mixing.mixed_sample(_table(spark, sf_dir, "documents"))
    return sample.select("doc_id", "source", "lang", "topic", "probability", "copies")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = quality_classifier.fold(F.col("doc_id"), 10) == 0
    texts = materialise(lm_scoring.encode(docs, held), "lm-ids")
    model = lm_scoring.fit_encoded(texts.filter(~F.col("held_out")))
    scores = lm_scoring.score_encoded(texts, model).groupBy("doc_id", "text_hash").agg(F.first("score").alias("score"))
    scores = scores.withColumnsRenamed({"doc_id": "__doc", "text_hash": "__hash"})
    base = lm_scoring.base_scores(docs, held)
    return base.join(
        scores, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash"))
    ).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(_table(spark, sf_dir, "conversations"))
    return conversation_repair.reports(rows).select(
        F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256",
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    vocabulary = token_files.load_vocabulary(public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    token_files.write(_table(spark, sf_dir, "documents"), path, vocabulary)
    documents = materialise(token_files.read(spark, path), "token-documents")
    return token_files.offsets(documents).select(F.col("doc").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return whitening.whitened(rows, whitening.fit(rows)).select(
        "vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened", "explained",
        "identity_error",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_ngram_jaccard_join, op3_quality_classifier, op4_warc_revisits, op5_decontaminate,
        op6_suffix_dedup, op7_html_render, op8_license_scan, op9_mixture, op10_lm_scoring, op11_conversation_repair, op12_token_files,
        op13_whitening,
    )
}

ORACLE_SQL = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op4_warc_revisits": warc.ORACLE,
    "op5_decontaminate": decontaminate.ORACLE,
    "op11_conversation_repair": conversation_repair.ORACLE,
}
