"""From raw documents to packed training sequences: filter, remove copies and repeats, mix sources, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkkit.llm import mix, packing, quality, simhash, suffix
from sparkkit.llm.common import store


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on the rated ones among them, does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group whose fingerprints of three-word shingles are linked at 3 or fewer bits."""
    return simhash.drop_near_duplicates(docs, words=3, max_bits=3)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings that start earlier in the corpus."""
    return suffix.drop_repeats(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight says."""
    return mix.mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality classifier", good_documents),
    ("SimHash near-dedup", one_of_each_group),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", mixed_sources),
    ("best-fit packing", sequences),
]

# fingerprints, transforms and token ids have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs
