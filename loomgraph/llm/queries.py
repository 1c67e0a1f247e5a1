"""The registered queries of the training-data operators, with their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm import byte_bpe, flac, packing, quality_rules, secret_scan, simhash_dedup, substring_dedup, token_counts, url_filters, warc_index


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    # 49407 closes documents
    return token_counts.count(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 49407)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(_table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(_table(spark, sf_dir, "pages"))


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_index.digest(_table(spark, sf_dir, "pages"))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that the labels call good and not toxic."""
    return _table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0").selectExpr("doc_id AS id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(_table(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))


def op6_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.digest(_table(spark, sf_dir, "documents"))


def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passages(_table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digest(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.groups(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_separator_scan": op1_separator_scan,
    "op2_secret_scan": op2_secret_scan,
    "op3_url_filters": op3_url_filters,
    "op4_warc_index": op4_warc_index,
    "op5_quality_rules": op5_quality_rules,
    "op6_flac": op6_flac,
    "op7_compact_windows": op7_compact_windows,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_simhash": op9_simhash,
    "op10_packing": op10_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op3_url_filters": url_filters.oracle_sql(),
}
