"""Token ids as raw binary shards, reached through a minimal perfect hash of the document keys."""

from __future__ import annotations

import math
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.llm.hashing import groups, mixed
from quitanda.llm.tables import small_batches, stored, tasks
from quitanda.operators.ordered import ordered_totals
from quitanda.session import new_location

END_ID = 2
SHARD_TEXT_BYTES = 32_000_000
KEYS_PER_BUCKET = 1_000
# Pieces of text a worker remembers the ids of.
REMEMBERED = 500_000
# Texts of so many bytes are encoded together and share their distinct pieces.
ENCODED_BYTES = 2_000_000
MAGIC = b"QIDS"


# White space that makes a text irregular: doubled, at an end, or anything but blanks and line feeds; and
# the characters that mark pieces below.
IRREGULAR = (
    r"[ \n][ \n]|\A[ \n]|[ \n]\z|[\x00\t\x0B-\x0D\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


class Encoder:
    """Ids of whole texts by a byte-level tokenizer that splits before a blank that precedes a word.

    Such a piece is encoded alike wherever it stands, so its ids are remembered. The tokenizer also
    splits around a line feed between words and before a mark that ends a word, so pieces are put
    together from the ids of words. New words are encoded together; ids that begin with a blank, or
    are a line feed, tell them apart again. Texts with other white space are encoded as a whole.
    """

    MARKS = frozenset(".,;:!?")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # A task has one core; threads of the library's own would each keep memory of what they encoded.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.begins = np.zeros(size, bool)
        self.begins[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.feeds = np.arange(size) == vocabulary["Ċ"]
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.irregular = "|".join([IRREGULAR, *special])
        self.marks = {m: self.plain(m) for m in self.MARKS}
        self.feed = self.plain("\n")
        # Numbers of pieces: "word" after a blank, "\0word" after nothing, "\nword" with the line feed before it.
        # By number: where the ids stand in the arena, how many they are, and the group that used them last.
        self.known: dict[str, int] = {"\0": 0}
        self.arena = np.empty(0, self.dtype)
        self.starts, self.sizes, self.used = (np.zeros(1, np.int64) for _ in range(3))
        self.group = 0

    def plain(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered pieces in a row, and where each piece's ids end."""
        lengths = self.sizes[numbers]
        ends = np.cumsum(lengths)
        source = np.repeat(self.starts[numbers] - ends + lengths, lengths)
        source += np.arange(len(source))
        return self.arena[source], ends

    def numbers_of(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece, -1 if it is not known."""
        return np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))

    def add(self, pieces: list[str], ids: list[bytes]) -> None:
        """Numbers new pieces; their ids go to the arena's end."""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.arena) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.used = np.concatenate([self.used, np.full(len(ids), self.group)])
        self.arena = np.concatenate([self.arena, np.frombuffer(b"".join(ids), self.dtype)])

    def forget(self) -> None:
        """Drops the half of the pieces that were used longest ago."""
        late = np.argsort(self.used, kind="stable")[len(self.used) // 2 :]
        keep, pieces = np.union1d([0], late), list(self.known)
        self.known = {pieces[old]: new for new, old in enumerate(keep.tolist())}
        self.arena, ends = self.ids_of(keep)
        self.sizes, self.used = self.sizes[keep], self.used[keep]
        self.starts = ends - self.sizes

    def learn(self, words: list[str], lead: str, begins: np.ndarray, skip: int, prefix: str) -> None:
        """Ids of words, each after ``lead``, without the first ``skip`` ids; known as prefix + word."""
        width, learnt = self.dtype.itemsize, []
        runs = [words[at : at + 200] for at in range(0, len(words), 200)]
        encoded = self.tokenizer.encode_batch_fast([lead + lead.join(r) for r in runs], add_special_tokens=False)
        for run, found in zip(runs, encoded, strict=True):
            ids = np.asarray(found.ids, self.dtype)
            starts = np.flatnonzero(begins[ids])
            if len(starts) == len(run) and starts[0] == 0:
                data = ids.tobytes()
                cuts = [*(starts * width).tolist(), len(data)]
                learnt += [data[a + skip * width : b] for a, b in zip(cuts, cuts[1:])]
            else:
                learnt += [self.plain(lead + w)[skip * width :] for w in run]
        self.add([prefix + w for w in words] if prefix else words, learnt)

    def remember(self, new: list[str]) -> None:
        """Learns pieces that are not known yet."""
        known, marks, width = self.known, self.MARKS, self.dtype.itemsize
        stems = [p[:-1] if p[-1] in marks and p[-2:-1].isalpha() else p for p in new]
        blank = {s for s in stems if s[0] not in "\0\n"}
        bare = {s[1:] for s in stems if s[0] in "\0\n"}
        self.learn([w for w in blank if w not in known], " ", self.begins, 0, "")
        self.learn([w for w in bare if "\0" + w not in known], "\n", self.feeds, 1, "\0")
        joined = [(p, s) for p, s in zip(new, stems, strict=True) if s[0] == "\n" or s is not p]
        bases = (known["\0" + s[1:] if s[0] == "\n" else s] for _, s in joined)
        ids, ends = self.ids_of(np.fromiter(bases, np.int64, len(joined)))
        data, cuts, whole = ids.tobytes(), [0, *(ends * width).tolist()], []
        for (piece, stem), a, b in zip(joined, cuts, cuts[1:]):
            base = self.feed + data[a:b] if stem[0] == "\n" else data[a:b]
            whole.append(base if len(stem) == len(piece) else base + self.marks[piece[-1]])
        self.add([p for p, _ in joined], whole)

    def regular(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids begin and end."""
        marked = pc.replace_substring(pc.binary_join_element_wise("\0", texts, ""), "\n", " \n")
        split = pc.split_pattern(marked, " ")
        pieces = split.flatten().dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.group += 1
        numbers = self.numbers_of(distinct)
        self.used[numbers[numbers >= 0]] = self.group
        if len(self.known) + np.count_nonzero(numbers < 0) > REMEMBERED:
            self.forget()
            numbers = self.numbers_of(distinct)
        missing = np.flatnonzero(numbers < 0)
        new = [distinct[i] for i in missing.tolist()]
        self.remember(new)
        numbers[missing] = self.numbers_of(new)
        ids, ends = self.ids_of(numbers[pieces.indices.to_numpy()])
        edges = np.concatenate([[0], ends])[split.offsets.to_numpy()]
        return ids, edges

    def encode(self, texts: pa.Array) -> pa.Array:
        """The ids of every text, as the bytes of little-endian numbers."""
        texts = texts.cast(pa.string())
        odd = pc.match_substring_regex(texts, self.irregular)
        ids, edges = self.regular(texts.filter(pc.invert(odd)))
        data, width = ids.tobytes(), self.dtype.itemsize
        cuts = iter((edges * width).tolist())
        at, result = next(cuts), []
        for is_odd, text in zip(odd.to_pylist(), texts, strict=True):
            if is_odd:
                result.append(self.plain(text.as_py()))
            else:
                end = next(cuts)
                result.append(data[at:end])
                at = end
        return pa.array(result, pa.binary())


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def footer(keys: list[int | None], sizes: list[int], width: int) -> bytes:
    """Keys, whether there is one, and numbers of ids, end id included; then their count and the id width."""
    n = len(keys)
    return b"".join(
        [
            np.asarray([k or 0 for k in keys], "<i8").tobytes(),
            np.asarray([k is not None for k in keys], "<u1").tobytes(),
            np.asarray(sizes, "<i8").tobytes(),
            struct.pack("<qi4s", n, width, MAGIC),
        ]
    )


def parse_footer(shard: memoryview, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(keys, has key, numbers of ids, bytes of an id); ``end`` bytes follow the footer."""
    at = len(shard) - end - 16
    n, width, magic = struct.unpack("<qi4s", shard[at : at + 16])
    if magic != MAGIC:
        raise ValueError("not a shard of ids")
    sizes = np.frombuffer(shard[at - 8 * n : at], "<i8")
    has = np.frombuffer(shard[at - 9 * n : at - 8 * n], "<u1")
    keys = np.frombuffer(shard[at - 17 * n : at - 9 * n], "<i8")
    return keys, has, sizes, width


def write_shards(
    df: DataFrame,
    tokenizer: str,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    shard_bytes: int = SHARD_TEXT_BYTES,
) -> None:
    """Encodes whole texts into shard files below ``path``, in ascending key order over all shards.

    A shard is the ids of its documents, 2 or 4 bytes each, every document followed by the end id,
    and a footer that lists keys and lengths. Rows are range-partitioned by key, then text hash, so
    a repeated key is cut as well; NULL keys come first. The end id is the line separator of
    Spark's text writer, which reaches any file system; its bytes must be ASCII.
    """
    dtype = encoder(tokenizer).dtype
    separator = int(end_id).to_bytes(dtype.itemsize, "little")
    if max(separator) > 127:
        raise ValueError("the end id's bytes must be below 128")
    texts = df.select(F.col(key).cast("bigint").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    total = texts.agg(F.sum(F.octet_length("_text").cast("bigint"))).first()[0] or 0
    shards = max(tasks(df.sparkSession), math.ceil(total / shard_bytes))
    tie = F.xxhash64("_text")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, keys, sizes = encoder(tokenizer).encode, [], []
        for batch in batches:
            keys += batch.column(0).to_pylist()
            for run in groups(batch.column(1), ENCODED_BYTES):
                ids = encode(run)
                sizes += (pc.binary_length(ids).to_numpy().astype(np.int64) // dtype.itemsize + 1).tolist()
                yield pa.RecordBatch.from_arrays([ids], ["ids"])
        if keys:
            tail = footer(keys, sizes, dtype.itemsize)
            yield pa.RecordBatch.from_arrays([pa.array([tail], pa.binary())], ["ids"])

    ordered = texts.repartitionByRange(shards, F.col("_key").asc(), tie.asc()).sortWithinPartitions("_key", tie)
    raw = small_batches(ordered).mapInArrow(encoded, "ids binary").select(F.col("ids").cast("string").alias("value"))
    raw.write.option("lineSep", separator.decode()).text(path)


def read_shards(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """(shard, offset, key, n_tokens, ids_crc32[, ids]) of every document in the shards at ``path``.

    Offsets count ids from the shard's start. A shard is read as one value, which its writer bounds.
    """
    schema = "shard bigint, offset bigint, key bigint, n_tokens bigint, ids_crc32 bigint"
    names = ["shard", "offset", "key", "n_tokens", "ids_crc32"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                data = memoryview(content.as_buffer())
                if not len(data):
                    continue
                shard = int(re.search(r"part-(\d+)", name.as_py())[1])
                width = next(w for w in (2, 4) if bytes(data[len(data) - w - 4 : len(data) - w]) == MAGIC)
                keys, has, sizes, width = parse_footer(data, width)
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                flat = np.frombuffer(data, f"<u{width}", offsets[-1])
                spans = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
                wide = [flat[a:b].astype("<u4") for a, b in spans]
                arrays = [
                    pa.array(np.full(len(keys), shard, np.int64)),
                    pa.array(offsets[:-1].astype(np.int64)),
                    pa.array(keys, mask=has == 0),
                    pa.array(sizes),
                    pa.array([zlib.crc32(w) for w in wide], pa.int64()),
                ]
                if ids:
                    arrays.append(pa.array([w.astype(np.int32) for w in wide], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names + ["ids"] * ids)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return small_batches(files).select("path", "content").mapInArrow(read, schema + ", ids array<int>" * ids)


# Minimal perfect hash: keys alone in their slot of a bit array keep it, the others go on to the next,
# smaller array; a key's number is the rank of its bit. Two bits per key and level.
GAMMA = 2.0


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """The bit arrays, as booleans, of distinct ``keys``."""
    levels, left = [], keys
    while len(left):
        size = max(1, int(GAMMA * len(left)))
        slot = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(slot, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[slot]]
    return levels


def number(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The number of each key, 0 to n - 1; any value, or -1, for other keys."""
    result, open_, before = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, bits in enumerate(levels):
        slot = (mixed(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
        rank = np.cumsum(bits) - 1
        hit = bits[slot]
        result[open_[hit]] = before + rank[slot[hit]]
        open_ = open_[~hit]
        before += int(bits.sum())
    return result


INDEX_SCHEMA = "bucket bigint, level_sizes array<int>, bits binary, prints binary, shards binary, offsets binary, sizes binary"


def first_records(records: DataFrame) -> DataFrame:
    """(key, _at): the place of every key's first record in shard order, which the index holds."""
    return records.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("shard", "offset", "n_tokens")).alias("_at"))


def build_index(records: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket of keys: the bits of its hash, and per key number the fingerprint and place.

    Of records with equal keys the first in shard order is indexed; those without a key are not.
    """

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows["key"].to_numpy(np.int64)
        levels = build_levels(keys)
        order = np.argsort(number(levels, keys))
        put = lambda c, t: rows[c].to_numpy(t)[order].tobytes()
        row = {
            "bucket": key[0],
            "level_sizes": [len(b) for b in levels],
            "bits": np.packbits(np.concatenate(levels)).tobytes(),
            "prints": fingerprint(keys)[order].tobytes(),
            "shards": put("shard", np.int64),
            "offsets": put("offset", np.int64),
            "sizes": put("n_tokens", np.int64),
        }
        return pd.DataFrame([row])

    first = first_records(records).select(bucket_of("key", buckets).alias("bucket"), "key", "_at.*")
    return first.groupBy("bucket").applyInPandas(build, INDEX_SCHEMA)


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(buckets)).cast("bigint")


def find(index: DataFrame, keys: DataFrame, buckets: int, key: str = "key") -> DataFrame:
    """(key, shard, offset, n_tokens) of the ``keys`` that are in the index.

    Asked for once each, whatever their repetitions. A key takes constant time: its bucket, its
    number, and one comparison of fingerprints, which lets a foreign key pass once in 2**32.
    """

    def look(group: tuple, asked: pd.DataFrame, bucket: pd.DataFrame) -> pd.DataFrame:
        wanted = asked["key"].to_numpy(np.int64)
        columns = {"key": wanted, "shard": wanted, "offset": wanted, "n_tokens": wanted}
        if not len(bucket) or not len(wanted):
            return pd.DataFrame(columns)[:0]
        row = bucket.iloc[0]
        sizes = np.asarray(row["level_sizes"], np.int64)
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
        at = number(np.split(bits, np.cumsum(sizes)[:-1]), wanted)
        prints = np.frombuffer(row["prints"], np.uint32)
        good = (at >= 0) & (prints[np.maximum(at, 0)] == fingerprint(wanted))
        for name, stored_as in (("shard", "shards"), ("offset", "offsets"), ("n_tokens", "sizes")):
            columns[name] = np.frombuffer(row[stored_as], np.int64)[np.maximum(at, 0)]
        return pd.DataFrame(columns)[good]

    asked = keys.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key")).distinct()
    asked = asked.withColumn("bucket", bucket_of("key", buckets))
    return (
        asked.groupBy("bucket")
        .cogroup(index.groupBy("bucket"))
        .applyInPandas(look, "key bigint, shard bigint, offset bigint, n_tokens bigint")
    )


def bucket_count(records: DataFrame, per_bucket: int = KEYS_PER_BUCKET) -> int:
    return max(1, math.ceil(records.count() / per_bucket))


def fetched(records: DataFrame, index: DataFrame, keys: DataFrame, buckets: int, key: str) -> DataFrame:
    """The records found for ``keys`` through the index, and those that it does not hold: copies of a
    key after its first record, and records without a key. What these are follows from the records
    alone, so a key that the index lost is missing from the result."""
    place = ["shard", "offset"]
    found = find(index, keys, buckets, key)
    hit = records.drop("n_tokens").join(found, [*place, "key"])
    held = first_records(records).select("_at.shard", "_at.offset")
    return hit.unionByName(records.join(held, place, "left_anti"))


def token_files(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Writes shards of ids of ``df`` and their index, and returns per document what they give back:
    key, start, n_tokens (end id included) and ids_crc32 (of the ids as 4-byte integers).

    NULL texts are empty and have the end id alone. NULL keys come first; repeated rows are documents
    of their own. Extra columns are ignored. An empty table gives no shards and no rows.
    """
    spark = df.sparkSession
    path = path or new_location(spark, "shards")
    write_shards(df, tokenizer, path, key, text)
    records = stored(read_shards(spark, path), "records")
    buckets = bucket_count(records)
    index = stored(build_index(records, buckets), "index")
    totals = records.groupBy("shard").agg(F.sum("n_tokens").alias("_ids"))
    base = ordered_totals(totals, [F.col("shard").asc()], sums={"_through": ("_ids", [])})
    rows = fetched(records, index, df, buckets, key).join(
        base.select("shard", (F.col("_through") - F.col("_ids")).alias("_base")), "shard"
    )
    start = (F.col("_base") + F.col("offset")).cast("bigint")
    return rows.select(F.col("key").alias(key), start.alias("start"), "n_tokens", "ids_crc32")
