"""From raw documents to sampled token ids: each stage works on what its predecessor kept, stored as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.llm import mixing, near_dedup, quality_rules, secret_scan, segment_sampling
from quitanda.llm.queries import tokenizer_path
from quitanda.llm.tables import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the current policy keeps."""
    rows = quality_rules.ledger(docs, keep=docs.columns)
    return rows.where(quality_rules.passes()).select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, five words and 80%."""
    return near_dedup.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by a mark, ``n_chars`` counted anew."""
    clean = secret_scan.redacted(docs, secret_scan.scan(docs, []))
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources by weights 1, 2, 3 takes them."""
    return mixing.mixed_rows(docs)


def sampled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two segmentations of every document, with their ids; a repeated document repeats its rows."""
    return segment_sampling.segmentations(docs, tokenizer_path("piece_bpe_32k.model"), ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_duplicates", deduplicated),
    ("secrets", without_secrets),
    ("mix", mixed),
    ("segmentations", sampled),
]
# Sampling and hashing have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
