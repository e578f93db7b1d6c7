"""The operators of this package as queries over whole benchmark tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.llm import (
    byte_pairs,
    conversation_repair,
    line_quality,
    mixing,
    multiset_hash,
    near_dedup,
    prefix_trie,
    quality_rules,
    secret_scan,
    segment_sampling,
    sharding,
    token_files,
    warc,
)
from quitanda.llm.tables import stored, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def llm_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_warc_revisits(spark, sf_dir):
    """All pages as archived records, repeated payloads as revisits, read back."""
    records = warc.deduplicated(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op2_quality_rule_ledger(spark, sf_dir):
    """The ledger of all documents with the current policy's verdict."""
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base = ~quality_rules.passes("base")
    return rows.select(
        "doc_id",
        *quality_rules.MEASURES[:5],
        base.alias("base_failed"),
        quality_rules.passes().alias("kept"),
        "failed_bits",
    )


@query
def op3_line_crf_quality(spark, sf_dir):
    """Quality of every document by a random field over lines, fitted on labelled rows."""
    documents = table(spark, sf_dir, "documents")
    return line_quality.scored(documents, line_quality.learned(documents, table(spark, sf_dir, "labels")))


@query
def op4_hash_threshold_mix(spark, sf_dir):
    """All documents mixed by weights 1, 2, 3; no document more than three times."""
    placed = stored(mixing.placed_sizes(table(spark, sf_dir, "documents")), "placed")
    mixed = mixing.mix(placed, placed)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("taken_copies") * F.col("size")).alias("taken")
    )


@query
def op5_token_shards(spark, sf_dir):
    """Ids of all documents in binary shards, read back through the index."""
    return token_files.token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op6_blob_ledger_secrets(spark, sf_dir):
    """Spans of secrets in every document, each distinct text scanned once."""
    return secret_scan.report(secret_scan.scan(table(spark, sf_dir, "documents"), ["doc_id"]))


@query
def op7_sampled_segmentations(spark, sf_dir):
    """Two segmentations of every document, drawn without replacement."""
    return segment_sampling.segmentations(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op8_hyperminhash_dedup(spark, sf_dir):
    """Components of near-duplicate documents, three words and 85%; kept are rows under their component's id."""
    rows = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.withColumn("kept", F.col("doc_id") == F.col("component_id"))


@query
def op9_multiset_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    return multiset_hash.fingerprints(table(spark, sf_dir, "documents"))


SHARDS = [f"shard-{i:03d}" for i in range(128)]


@query
def op10_lookup_table_shards(spark, sf_dir):
    """Every document's shard, and its shard should the first one be taken away."""
    without = sharding.fill_table(SHARDS[1:])
    tables = {"shard": sharding.fill_table(SHARDS), "shard_without_first": [s + 1 for s in without]}
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.place(documents, "doc_id", tables, "text").drop("text")


@query
def op11_audited_repair(spark, sf_dir):
    """All conversations, damaged by a checksum of their keys and repaired by the cheapest edits."""
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.report(conversation_repair.repaired(rows))


@query
def op12_recursive_byte_pairs(spark, sf_dir):
    """Ids of all documents by ranks of byte strings, and their texts from the ids."""
    from public_tokenizers import PATTERN

    return byte_pairs.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), PATTERN)


@query
def op13_prefix_trie(spark, sf_dir):
    """The trie of all rebuilt conversations, with sums over subtrees."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
