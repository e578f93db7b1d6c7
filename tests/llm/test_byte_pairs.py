"""Byte pairs against the tiktoken library: ids, decoded texts, odd texts, and the registered query."""

from __future__ import annotations

import base64
import random
from hashlib import sha256

import cases
import numpy as np
import pytest
import regex
import tiktoken
from public_tokenizers import PATTERN

from quitanda.llm import byte_pairs
from quitanda.llm.queries import llm_queries, tokenizer_path

PATH = tokenizer_path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(text: str, own) -> tuple[int, str, str]:
    ids = own.encode_ordinary(text)
    return len(ids), sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), sha256(own.decode_bytes(ids)).hexdigest()


def test_query_equals_the_library(spark, tiny, own):
    seen = {r.doc_id: tuple(r)[1:] for r in llm_queries()["op12_recursive_byte_pairs"](spark, tiny).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    assert seen == {i: digest(t or "", own) for i, t in texts.items()}


def odd_texts() -> list[str]:
    draw = random.Random(5)
    alphabets = ["ab", "aab ", "0123456789", "漢字かな交じり文", "😀🏽👩‍👩‍👧 ", "   \t\r\n\x1c\x85", "éèêçà'sT've", "=-_#/<>.", "\x00﻿́e"]
    found = ["", " ", "  x  ", "a" * 5_000, "ab" * 3_000 + "aab" * 1_000, "don't I'll WE'VE x's", "=" * 3_000, "no\n\n\nend\n "]
    for letters in alphabets + ["".join(alphabets)]:
        found += ["".join(draw.choices(letters, k=draw.choice([3, 30, 300, 2_000]))) for _ in range(6)]
    return found


def test_odd_texts_equal_the_library(own):
    pairs, texts = byte_pairs.byte_pairs(PATH, PATTERN), odd_texts()
    ids = pairs.encode(texts)
    for text, found in zip(texts, ids, strict=True):
        assert np.frombuffer(found, "<u4").tolist() == own.encode_ordinary(text), text[:80]
    assert pairs.decode(ids) == [t.encode() for t in texts]


def test_long_words_in_parts_and_long_texts_in_runs(own, monkeypatch):
    monkeypatch.setattr(byte_pairs, "ROWS", 20_000)
    monkeypatch.setattr(byte_pairs, "TOGETHER", 50)
    monkeypatch.setattr(byte_pairs, "AT_ONCE", 7)
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 40)
    pairs = byte_pairs.BytePairs(PATH, PATTERN)
    texts = ["".join(random.Random(1).choices("abcdefgh", k=4_000)), "x" * 3_001, cases.PLAIN, cases.LONG[:20_000]]
    ids = pairs.encode(texts)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [own.encode_ordinary(t) for t in texts]
    assert pairs.decode(ids) == [t.encode() for t in texts]


def test_contraction_is_the_leftmost_pair_of_least_rank():
    """A made-up vocabulary in which a new pair may rank below the pair it came from."""
    words = ["a", "b", "c", "d", "cd", "abc", "ab", "abcd", "dd", "bb", "aa", "aaa", "bcd"]
    singles = [bytes([i]) for i in range(256) if chr(i) not in "abcd"]
    ranks = {w.encode(): i for i, w in enumerate(words)} | {s: len(words) + i for i, s in enumerate(singles)}

    def plain(word: bytes) -> list[int]:
        parts = [bytes([b]) for b in word]
        if word in ranks:
            return [ranks[word]]
        while True:
            ways = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not ways:
                return [ranks[p] for p in parts]
            i = min(ways)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    import tempfile

    with tempfile.NamedTemporaryFile("w", suffix=".tiktoken") as file:
        file.write("".join(f"{base64.b64encode(w).decode()} {r}\n" for w, r in ranks.items()))
        file.flush()
        pairs = byte_pairs.BytePairs(file.name, r"\S+|\s+")
    draw = random.Random(3)
    texts = ["".join(draw.choices("abcd", k=k)) for k in (2, 3, 5, 9, 30, 90, 150, 400) for _ in range(25)]
    for text, found in zip(texts, pairs.encode(texts), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == plain(text.encode()), text


def test_operators_on_odd_documents(spark, own):
    docs = cases.documents(spark)
    rows = byte_pairs.encoded(docs, PATH, PATTERN)
    assert rows.columns == ["doc_id", "n_tokens", "ids"]
    wanted = sorted((str(i), tuple(own.encode_ordinary(t or ""))) for i, t, _ in cases.TEXTS)
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in rows.collect()) == wanted
    assert all(r.n_tokens == len(r.ids) for r in rows.collect())
    back = byte_pairs.decoded(rows, PATH, PATTERN)
    assert sorted((str(r.doc_id), bytes(r.bytes)) for r in back.collect()) == sorted(
        (str(i), (t or "").encode()) for i, t, _ in cases.TEXTS
    )
    assert byte_pairs.round_trip(cases.empty(spark), PATH, PATTERN).count() == 0
    assert byte_pairs.encoded(cases.empty(spark), PATH, PATTERN).count() == 0


def test_pattern_covers_every_text():
    split = regex.compile(PATTERN)
    assert all("".join(split.findall(t)) == t for t in odd_texts())
