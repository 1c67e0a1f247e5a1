"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage reads what the one before kept, as a Parquet table.  All but the last
return the columns of ``documents``, and any further ones, whatever their names, as
they are; ``n_chars`` follows the text.  Nulls, empty and long texts, ties, repeated
rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import packing, quality_rules, secret_scan, simhash_dedup, substring_dedup
from loomgraph.llm.common import discard, written
from loomgraph.llm.queries import trusted_ids


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the texts now are."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs, trusted_ids(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return simhash_dedup.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each without the passages that one of smaller id has."""
    return _counted(substring_dedup.strip(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of each secret."""
    return _counted(secret_scan.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed in sequences of at most 4096 tokens."""
    import public_tokenizers

    return packing.digest(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", passages),
    ("secret scans", secrets),
    ("best-fit packing", pack),
]

#: Hashing, near duplicates and tokenisers are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = None
    for name, stage in STAGES[:-1]:
        docs, next_path = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if path:
            discard(spark, path)
        path = next_path
    return STAGES[-1][1](spark, docs, sf_dir)
