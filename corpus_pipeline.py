"""From raw documents to packed training sequences, one operator of `tickloom.llm` per stage."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import mixing, near_dedup, packing, quality_rules, secret_scan
from tickloom.llm.common import read, small_batches
from tickloom.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality_rules.keep_good(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return near_dedup.deduplicated(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced; n_chars follows the text."""
    small_batches(spark)
    clean = secret_scan.redacted(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, with the ids of the documents in them."""
    small_batches(spark)
    return packing.sequences(packing.packed(packing.tokenized(docs, ranked=True, narrow=True), narrow=True))


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", dedup),
    ("secret_scan", secrets),
    ("source_mix", mix),
    ("best_fit_packing", pack),
]

# Packing has no SQL form; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each over all that the one before it has kept, written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
