"""A training corpus from raw documents: drop bad, equal, similar and leaked texts, pack the rest.

Each stage takes (spark, docs, folder of the other tables) and returns a DataFrame, which is written and read again
for the next one. All but the last return rows of ``docs`` with its columns unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from custlens.llm import decontamination, exact_dedup, packing, quality, simhash
from custlens.llm.tokens import public_tokenizer
from custlens.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Bradley-Terry ranking accepts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.drop_repeats(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (three-word shingles) are linked by two differing bits or fewer."""
    return simhash.drop_near_duplicates(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens; one row per piece of a document."""
    return packing.pack(docs, public_tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("best-fit packing", packed),
]

ORACLE_SQL = None  # a learned classifier, similarity search and a tokenizer: tested against a plain version instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"), compression="zstd")
    return STAGES[-1][1](spark, docs, sf_dir)
