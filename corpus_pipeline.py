"""A training corpus in five stages, each written and read back before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, ngram_join, quality_rules, suffix_dedup
from tidemark.sources.storage import materialise

# Bytes of the shortest passage whose later copies go: short enough for fifty short words.
PASSAGE_BYTES = 240


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps."""
    return quality_rules.keep_good(docs, "v3")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies, the one with the smallest id."""
    return ngram_join.one_per_class(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of passages; those of which nothing is left go."""
    cut = suffix_dedup.without_repeats(docs, min_bytes=PASSAGE_BYTES, keep_first=True)
    changed = F.col("dedup_removed") > 0
    rest = cut.withColumn(
        "n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    )
    return rest.filter(~changed | F.col("text").rlike("[^\\x20\\x09-\\x0D]")).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(docs, items).filter(decontaminate.is_contaminated())
    gone = materialise(
        found.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).distinct(), "contaminated"
    )
    return docs.join(
        gone,
        F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__hash")), "left_anti",
    )


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents by calibrated weights of source, language and topic."""
    return mixing.mixed_sample(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", decontaminated),
    ("mixture_weights", mixture),
]

# Near duplicates by components, byte-exact cuts and iterative fitting are not SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
