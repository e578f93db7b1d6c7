"""Byte-level BPE by recursive DuckDB queries: every partition contracts its words until nothing merges."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import cache
from hashlib import sha256
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.llm.hashing import groups
from quitanda.llm.tables import small_batches

# Bytes of text encoded together, words a worker remembers the ids of, and words cut from a text at a time.
TOGETHER, REMEMBERED, AT_ONCE = 2_000_000, 1_000_000, 400_000
# A longer word (in bytes) contracts many pairs per round; rows that such a recursion may gather.
LONG, ROWS = 100, 2_000_000
MEMORY = "300MB"

# One round: rows (word, pos, token) of words that still have a pair in the merge table, contracted.
# `line` shows every token its successor; `pick` holds the pairs to contract; a pair's second row goes.
# The leftmost pair of least rank of each word; positions go up from word to word.
_ONE = """
line AS (SELECT round, word, pos, token, lead(word) OVER w AS next_word, lead(token) OVER w AS after, lag(pos) OVER w AS prior
         FROM step WINDOW w AS (ORDER BY pos)),
pick AS (SELECT word, min(t::BIGINT << 32 | pos) AS first
         FROM line JOIN merges ON pair = (token::BIGINT << 32 | after) WHERE word = next_word GROUP BY word)
SELECT (round + 1)::INTEGER, line.word, pos, CASE WHEN pos = first & 4294967295 THEN (first >> 32)::INTEGER ELSE token END
FROM line JOIN pick ON pick.word = line.word WHERE prior IS DISTINCT FROM first & 4294967295
"""
# All pairs of least rank that do not overlap, from the left, up to the first whose contraction makes
# a pair of lower rank with a neighbour, which would come next: as many steps of _ONE in one round.
_MANY = """
line AS (SELECT round, word, pos, token, lead(token) OVER w AS after, lead(pos) OVER w AS gone,
                lag(token) OVER w AS before, lead(token, 2) OVER w AS beyond
         FROM step WINDOW w AS (PARTITION BY word ORDER BY pos)),
hit AS (SELECT line.*, t FROM line JOIN merges ON l = token AND r = after),
least AS (SELECT word, min(t) AS t FROM hit GROUP BY word),
best AS (SELECT hit.*, coalesce(lag(gone) OVER w = pos, false) AS touches
         FROM hit SEMI JOIN least ON hit.word = least.word AND hit.t = least.t
         WINDOW w AS (PARTITION BY hit.word ORDER BY pos)),
runs AS (SELECT *, count(*) FILTER (WHERE NOT touches) OVER (PARTITION BY word ORDER BY pos) AS run FROM best),
apart AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY word, run ORDER BY pos) % 2 = 1),
risky AS (SELECT apart.*, CASE WHEN x.t < apart.t OR y.t < apart.t OR z.t < apart.t THEN pos END AS risk
          FROM apart LEFT JOIN merges x ON x.l = before AND x.r = apart.t
          LEFT JOIN merges y ON y.l = apart.t AND y.r = beyond LEFT JOIN merges z ON z.l = apart.t AND z.r = apart.t),
pick AS (SELECT * FROM risky QUALIFY pos <= coalesce(min(risk) OVER (PARTITION BY word), pos))
SELECT (line.round + 1)::INTEGER, line.word, line.pos, coalesce(pick.t, line.token)
FROM line SEMI JOIN least ON least.word = line.word
LEFT JOIN pick ON pick.word = line.word AND pick.pos = line.pos
ANTI JOIN pick AS second ON second.word = line.word AND second.gone = line.pos
WHERE line.round < {rounds}
"""
_RECURSION = """
WITH RECURSIVE step AS (
SELECT 0 AS round, word, pos, token FROM base
UNION ALL
(WITH {contract}))
SELECT step.word AS word, pos, token, round FROM step
JOIN (SELECT word, max(round) AS last FROM step GROUP BY word) AS ends ON ends.word = step.word AND round = last
ORDER BY step.word, pos
"""
SHORT_WORDS = _RECURSION.format(contract=_ONE)
DECODED = """
SELECT text, unhex(string_agg(digits, '' ORDER BY pos)) AS bytes
FROM tokens JOIN vocabulary USING (id) GROUP BY text ORDER BY text
"""


class BytePairs:
    """Ids of texts by ranks of byte strings, as the tiktoken library gives them, and texts of ids.

    A text is split by the pattern and every match encoded by itself, so ids of words are remembered.
    A word that is in the vocabulary as a whole has that id; all others start as single bytes and
    contract their leftmost pair of least rank until no pair is in the merge table.
    """

    def __init__(self, path: str, pattern: str):
        import regex

        self.split = regex.compile(pattern)
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        ranks = self.ranks
        cuts = [(word, i) for word in ranks for i in range(1, len(word)) if word[:i] in ranks and word[i:] in ranks]
        merges = pa.table(
            {
                "l": pa.array([ranks[w[:i]] for w, i in cuts], pa.int32()),
                "r": pa.array([ranks[w[i:]] for w, i in cuts], pa.int32()),
                "t": pa.array([ranks[w] for w, _ in cuts], pa.int32()),
            }
        )
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.known: dict[str, bytes] = {}
        self.duck = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self._load("merges", merges, "l, r, l::BIGINT << 32 | r AS pair, t")
        vocabulary = pa.table({"id": pa.array(ranks.values(), pa.int32()), "bytes": pa.array(ranks, pa.binary())})
        self._load("vocabulary", vocabulary, "id, hex(bytes) AS digits")

    def _load(self, name: str, rows: pa.Table, columns: str) -> None:
        self.duck.register("given", rows)
        self.duck.execute(f"CREATE TABLE {name} AS SELECT {columns} FROM given")
        self.duck.unregister("given")

    def _query(self, sql: str, name: str, rows: pa.Table) -> pa.Table:
        self.duck.register(name, rows)
        found = self.duck.sql(sql).to_arrow_table()
        self.duck.unregister(name)
        return found

    def _contracted(self, words: Sequence[bytes]) -> list[bytes]:
        """Ids of words that are not in the vocabulary, none of them empty."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        base = {"word": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "pos": np.arange(len(token)), "token": token}
        if len(words) > 1 or sizes[0] <= LONG:
            rows = self._query(SHORT_WORDS, "base", pa.table(base))
        else:
            while True:  # in parts of so many rounds that what they gather stays bounded
                rounds = max(2, ROWS // len(base["token"]))
                sql = _RECURSION.format(contract=_MANY.format(rounds=rounds))
                rows = self._query(sql, "base", pa.table(base))
                if rows["round"][0].as_py() < rounds:
                    break
                base = {c: rows[c].to_numpy() for c in base}
        ids = rows["token"].to_numpy().astype("<u4").tobytes()
        counts = np.bincount(rows["word"].to_numpy(), minlength=len(words))
        ends = (4 * np.cumsum(counts)).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, words: set[str]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, words
        words = list(new)
        data = [word.encode() for word in words]
        whole = list(map(self.ranks.get, data))
        self.known.update((w, r.to_bytes(4, "little")) for w, r in zip(words, whole) if r is not None)
        rest = [(w, d) for w, d, r in zip(words, data, whole) if r is None]
        short = [x for x in rest if len(x[1]) <= LONG]
        for run in [short, *([x] for x in rest if len(x[1]) > LONG)]:
            if run:
                names, coded = zip(*run)
                self.known.update(zip(names, self._contracted(coded), strict=True))

    def _matches(self, text: str) -> Iterator[list[str]]:
        if len(text) <= TOGETHER:
            yield self.split.findall(text)
        else:
            found = (match[0] for match in self.split.finditer(text))
            while run := list(islice(found, AT_ONCE)):
                yield run

    def encode(self, texts: list[str]) -> list[bytes]:
        """Every text's ids, as little-endian unsigned 32-bit numbers."""
        if sum(map(len, texts)) <= 2 * TOGETHER:
            split = [self.split.findall(t) for t in texts]
            self.learn(set().union(*split))
            return [b"".join(map(self.known.__getitem__, words)) for words in split]
        return [b"".join(self._long(t)) for t in texts]

    def _long(self, text: str) -> Iterator[bytes]:
        for words in self._matches(text):
            self.learn(set(words))
            yield b"".join(map(self.known.__getitem__, words))

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of every sequence of ids."""
        counts = [len(i) // 4 for i in ids]
        result = [b""] * len(ids)
        if not any(counts):
            return result
        token = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        text = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
        parts: dict[int, list[bytes]] = {}
        for at in range(0, len(token), ROWS):  # a very long text in parts
            run = slice(at, at + ROWS)
            rows = pa.table({"text": text[run], "pos": np.arange(len(token[run]), dtype=np.int32), "id": token[run]})
            found = self._query(DECODED, "tokens", rows)
            for number, data in zip(found["text"].to_pylist(), found["bytes"].to_pylist(), strict=True):
                parts.setdefault(number, []).append(data)
        for number, data in parts.items():
            result[number] = b"".join(data)
        return result


@cache
def byte_pairs(path: str, pattern: str) -> BytePairs:
    return BytePairs(path, pattern)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    at = 0
    for texts in groups(batch["_text"], TOGETHER):
        yield batch["_key"].slice(at, len(texts)), [t or "" for t in texts.to_pylist()]
        at += len(texts)


def _keyed(docs: DataFrame, key: str, column: str) -> DataFrame:
    return small_batches(docs.select(F.col(key).alias("_key"), F.col(column).alias("_text")))


def encoded(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids) for every row; NULL and empty texts have no ids.

    Rows are independent: keys may be NULL or repeated and come back as often as they are there;
    further columns are left out. Every text is encoded whole. Groups of about 2 MB of text are
    split and their new words contracted together; a worker remembers a bounded number of words, and
    a text of more than 2 MB is encoded in runs of words, so memory holds one batch of texts, or the
    longest text with its ids. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(path, pattern)
        for batch in batches:
            for keys, texts in _texts(batch):
                ids = [np.frombuffer(i, "<u4").astype(np.int32) for i in pairs.encode(texts)]
                n = pa.array(map(len, ids), pa.int64())
                yield pa.record_batch([keys, n, pa.array(ids, pa.list_(pa.int32()))], ["_key", "n_tokens", "ids"])

    rows = _keyed(docs, key, text)
    kind = rows.schema["_key"].dataType.simpleString()
    found = rows.mapInArrow(run, f"_key {kind}, n_tokens bigint, ids array<int>")
    return found.withColumnRenamed("_key", key)


def decoded(rows: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, bytes) for every row of ids; no ids or NULL give empty bytes. An unknown id is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(path, pattern)
        size = len(pairs.ranks)
        for batch in batches:
            given = [np.asarray(i if i is not None else [], "<u4") for i in batch["_ids"].to_pylist()]
            if any(len(i) and i.max() >= size for i in given):
                raise ValueError("an id is not in the vocabulary")
            data = pairs.decode([i.tobytes() for i in given])
            yield pa.record_batch([batch["_key"], pa.array(data, pa.binary())], ["_key", "bytes"])

    given = small_batches(rows.select(F.col(key).alias("_key"), F.col(ids).alias("_ids")))
    kind = given.schema["_key"].dataType.simpleString()
    return given.mapInArrow(run, f"_key {kind}, bytes binary").withColumnRenamed("_key", key)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): texts encoded and their ids decoded, in one pass.

    As `encoded` and `decoded`; ids are hashed as little-endian unsigned 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(path, pattern)
        for batch in batches:
            for keys, texts in _texts(batch):
                ids = pairs.encode(texts)
                counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                sums = pa.array([sha256(i).hexdigest() for i in ids])
                back = pa.array([sha256(b).hexdigest() for b in pairs.decode(ids)])
                yield pa.record_batch([keys, counts, sums, back], ["_key", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = _keyed(docs, key, text)
    kind = rows.schema["_key"].dataType.simpleString()
    found = rows.mapInArrow(run, f"_key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return found.withColumnRenamed("_key", key)
