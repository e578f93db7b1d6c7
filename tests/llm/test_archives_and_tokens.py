"""Web archives and token shards: exact round trips."""

from __future__ import annotations

import base64
import hashlib
import os
import subprocess
import sys
import zlib
from pathlib import Path

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quitanda.llm import token_files, warc
from quitanda.llm.queries import op5_token_shards, tokenizer_path
from quitanda.session import new_location

PAGES = [
    (1, "http://a/", "<p>same</p>"),
    (2, "http://b/\r\nWARC-Type: forged", "<p>same</p>"),
    (3, None, "<p>same</p>"),
    (4, "http://c/", None),
    (5, "http://d/", ""),
    (6, "http://e/", "WARC/1.1\r\nContent-Length: 9\r\n\r\nnot a record\r\n\r\n\r\n\r\n"),
    (7, "http://f/é", "漢字 😀 " * 5000),
    (None, "http://g/", "<p>same</p>"),
    (None, "http://h/", "alone"),
    (8, "http://i/", "twice"),
    (8, "http://i/", "twice"),
]


def pages(spark, rows=PAGES):
    schema = "page_id bigint, url string, html string, payload int, record_type int, _k int, copies int"
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], schema).repartition(2)


def digest(text: str | None) -> str:
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("broadcast_rows", [0, 10_000])
@pytest.mark.parametrize("archive_bytes", [100, 32_000_000])
def test_records_come_back(spark, archive_bytes, broadcast_rows):
    got = warc.deduplicated(pages(spark), archive_bytes=archive_bytes, broadcast_rows=broadcast_rows)
    largest = {}
    for i, _, html in PAGES:
        if i is not None:
            largest[html or ""] = max(largest.get(html or "", -1), i)
    wanted = []
    for i, _, html in PAGES:
        original = largest.get(html or "")
        older = original is not None and (i is None or i < original)
        size = len((html or "").encode())
        wanted.append((i, size, digest(html), "revisit" if older else "response", original if older else None))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(str, cases.rows(got.select(columns)))) == sorted(map(str, wanted))


def test_small_payloads_stay_responses(spark):
    got = warc.deduplicated(pages(spark), least_bytes=6).collect()
    kinds = {(r.page_id, r.record_type) for r in got}
    assert (4, "response") in kinds and (5, "response") in kinds and (1, "revisit") in kinds


def test_payloads_and_headers(spark):
    path = new_location(spark, "archives")
    warc.deduplicated(pages(spark), path)
    rows = warc.read_archives(spark, path, payloads=True).collect()
    kept = {r.page_id: bytes(r.payload).decode() for r in rows if r.record_type == "response"}
    assert kept[3] == "<p>same</p>" and kept[6] == PAGES[5][2] and kept[7] == PAGES[6][2] and kept[5] == ""
    assert all(r.payload is None and r.payload_bytes is None for r in rows if r.record_type == "revisit")
    assert {r.url for r in rows if r.page_id == 2} == {"http://b/WARC-Type:forged"}


def test_revisits_without_their_response_have_no_size(spark):
    rows = [("response", "D", 1, 10, None), ("revisit", "D", 2, None, 1), ("revisit", "E", 3, None, 9), ("revisit", "E", 4, None, 9)]
    headers = spark.createDataFrame(rows, "record_type string, payload_digest string, page_id bigint, payload_bytes bigint, refers_to bigint")
    got = {r.page_id: r.payload_bytes for r in warc.revisited(headers).collect()}
    assert got == {1: 10, 2: 10, 3: None, 4: None}


def test_no_pages(spark):
    assert warc.deduplicated(pages(spark, []).limit(0)).count() == 0


def test_damage_is_noticed():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 6\r\n\r\n\r\n\r\nhi\r\n\r\n"
    with pytest.raises(ValueError, match="damaged"):
        list(warc.parse(record))
    with pytest.raises(ValueError, match="no record"):
        list(warc.parse(b"something else\r\n\r\n"))


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


def plain(tokenizer, text: str) -> list[int]:
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    import random

    draw = random.Random(5)
    parts = [" ", "  ", "a", "b1", "\n", "\t", " ", "é", "'s", ".", "漢", "　", "😀", "!", "\x1f", "\x00", "<|endoftext|>", "Word", ","]
    texts = ["", " ", "\n", "x", "a  <|endoftext|>  b", *["".join(draw.choices(parts, k=draw.randint(1, 16))) for _ in range(2000)]]
    texts += [" ".join(draw.choices(["one,", "two.", "three", "it's", "Four!", "5,5", "six\nSeven;", "...", "a."], k=30)) for _ in range(50)]
    encoder = token_files.Encoder(tokenizer_path("byte_bpe_50k.json"))
    for _ in range(2):  # unknown, then remembered
        got = encoder.encode(pa.array(texts)).to_pylist()
        assert all(np.frombuffer(g, "<u2").tolist() == plain(tokenizer, t) for t, g in zip(texts, got, strict=True))


def test_forgetting_does_not_change_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 5)
    encoder = token_files.Encoder(tokenizer_path("byte_bpe_50k.json"))
    texts = [cases.words(40, i) for i in range(20)]
    got = [encoder.encode(pa.array([t])).to_pylist()[0] for t in texts]
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [plain(tokenizer, t) for t in texts]


def test_all_documents_come_back_through_the_index(spark, tiny, tokenizer):
    docs = sorted(spark.read.parquet(f"{tiny}/documents.parquet").collect(), key=lambda r: r.doc_id)
    wanted, start = {}, 0
    for r in docs:
        ids = [*plain(tokenizer, r.text or ""), 2]
        wanted[r.doc_id] = (start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op5_token_shards(spark, tiny).collect()}
    assert got == wanted


def test_a_lost_key_is_missed(spark):
    """Rows come through the index, which holds first records; only later copies and keyless ones come beside it."""
    rows = [(0, 0, 7, 3, 1), (0, 3, 8, 2, 2), (1, 0, 8, 2, 3), (1, 2, None, 4, 4), (1, 6, 9, 1, 5)]
    records = spark.createDataFrame(rows, "shard bigint, offset bigint, key bigint, n_tokens bigint, ids_crc32 bigint")
    keys = spark.createDataFrame([(7,), (8,), (8,), (None,), (9,)], "doc_id bigint")

    def got(index):
        return sorted(r.ids_crc32 for r in token_files.fetched(records, index, keys, 3, "doc_id").collect())

    assert got(token_files.build_index(records, 3)) == [1, 2, 3, 4, 5]
    assert got(token_files.build_index(records.where("key IS NULL OR key <> 8"), 3)) == [1, 3, 4, 5]


def test_pieces_used_longest_ago_go_first(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 60)
    encoder = token_files.Encoder(tokenizer_path("byte_bpe_50k.json"))
    texts = [f"so often, used {cases.words(20, i)}\noften" for i in range(20)]
    got = [encoder.encode(pa.array([t])).to_pylist()[0] for t in texts]
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [plain(tokenizer, t) for t in texts]
    assert {"often,", "used", "\noften"} <= encoder.known.keys() and len(encoder.known) <= 120


def test_odd_documents(spark, tokenizer):
    docs = cases.documents(spark)
    got = cases.rows(token_files.token_files(docs, tokenizer_path("byte_bpe_50k.json")))
    assert len(got) == len(cases.TEXTS)
    sizes = {i: len(plain(tokenizer, t or "")) + 1 for i, t, _ in cases.TEXTS if i is not None}
    assert all(n == sizes[i] for i, _, n, _ in got if i is not None)
    by_start = sorted(got, key=lambda r: r[1])
    assert [s for _, s, _, _ in by_start] == np.cumsum([0, *[n for _, _, n, _ in by_start[:-1]]]).tolist()
    keys = [i for i, *_ in by_start]
    assert keys[:3] == [None] * 3 and keys[3:] == sorted(keys[3:])
    assert token_files.token_files(cases.empty(spark), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_ids_are_in_the_files(spark, tokenizer):
    path = new_location(spark, "shards")
    token_files.write_shards(cases.documents(spark), tokenizer_path("byte_bpe_50k.json"), path, shard_bytes=50_000)
    rows = token_files.read_shards(spark, path, ids=True).where("key = 9 OR key = 4").collect()
    found = {r.key: list(r.ids) for r in rows}
    text = next(t for i, t, _ in cases.TEXTS if i == 9)
    assert found == {9: [*plain(tokenizer, text), 2], 4: [2]}


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.arange(n, dtype=np.int64) * 7919 - 5000
    levels = token_files.build_levels(keys)
    assert sorted(token_files.number(levels, keys).tolist()) == list(range(n))
    assert sum(len(b) for b in levels) <= max(10, 4 * n)


def test_foreign_keys_are_not_found(spark):
    records = spark.range(0, 500).select(
        (F.col("id") * 3).alias("key"), (F.col("id") % 4).alias("shard"), F.col("id").alias("offset"), F.lit(1).cast("bigint").alias("n_tokens")
    )
    index = token_files.build_index(records, 7)
    found = token_files.find(index, spark.range(0, 1600).withColumnRenamed("id", "key"), 7).collect()
    assert {r.key: (r.shard, r.offset) for r in found} == {3 * i: (i % 4, i) for i in range(500)}


def test_encoder_starts_no_threads_of_its_own():
    """Each thread of the tokenizer library would keep memory beside the one core of a task."""
    code = """
import threading, os, pyarrow as pa
from quitanda.llm.queries import tokenizer_path
from quitanda.llm.token_files import Encoder
encoder, count = Encoder(tokenizer_path("byte_bpe_50k.json")), lambda: len(os.listdir("/proc/self/task"))
encoder.plain("one"); before = count()
encoder.encode(pa.array([" ".join(f"word{i}x{j}" for j in range(3000)) for i in range(9)]))
assert count() <= before, (before, count())
"""
    env = {k: v for k, v in os.environ.items() if k not in ("TOKENIZERS_PARALLELISM", "RAYON_NUM_THREADS")}
    env["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[2]), env.get("PYTHONPATH", "")])
    subprocess.run([sys.executable, "-c", code], check=True, env=env, timeout=120)
