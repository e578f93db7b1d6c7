"""Near-duplicate documents by HyperMinHash: compressed registers, banded, estimated, then verified."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quitanda.llm.hashing import groups, mixed, word_hashes
from quitanda.llm.tables import small_batches, stored, with_key_values

BANDS = 48
# Chance of a linked pair to share no band, and deviations below the threshold an estimate may lie.
MISSED, DEVIATIONS = 1e-6, 6
MANTISSA = 10
EMPTY = 0xFFFF
PROBES = 64
# Documents without an id get one from here on, by their text's hash. Texts to verify are first sieved by this many hash values.
SURROGATE, SIEVE = 1 << 62, 1 << 20
LEADERS = 16
# Elements of differences handed on at once.
ELEMENTS = 200_000


def band_rows(percent: int, bands: int = BANDS) -> int:
    """Most registers per band so that a pair at the threshold shares a band but for a chance MISSED."""
    return max(1, math.floor(math.log(1 - MISSED ** (1 / bands)) / math.log(min(percent, 99.9) / 100)))


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the texts' shingles, ascending in each text, and where each text's begin and end.

    A text of fewer words is one shingle, its whole sequence; a text without words has none.
    """
    hashes, edges = word_hashes(texts)
    counts = np.diff(edges)
    factors = mixed(np.arange(words, dtype=np.uint64), 7) | np.uint64(1)
    with np.errstate(over="ignore"):
        total = len(hashes)
        run = np.zeros(max(total - words + 1, 0), np.uint64)
        for i in range(words):
            run += hashes[i : i + len(run)] * factors[i]
        document = np.repeat(np.arange(len(counts)), np.maximum(counts - words + 1, 0))
        first = np.repeat(edges[:-1], np.maximum(counts - words + 1, 0))
        inside = np.arange(len(document)) - np.searchsorted(document, document, "left")
        values = [mixed(run[first + inside])]
        short = np.flatnonzero((counts > 0) & (counts < words))
        whole = np.zeros(len(short), np.uint64)
        for i in range(words - 1):
            has = counts[short] > i
            whole[has] += hashes[edges[short[has]] + i] * factors[i]
        values.append(mixed(whole, 100) ^ mixed(counts[short].astype(np.uint64), 200))
    value, document = np.concatenate(values), np.concatenate([document, short])
    order = np.lexsort((value, document))
    value, document = value[order], document[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (document[1:] != document[:-1])
    value, document = value[new], document[new]
    return value, np.searchsorted(document, np.arange(len(counts) + 1), "left")


def registers(sets: np.ndarray, edges: np.ndarray, k: int) -> np.ndarray:
    """k registers of 16 bits per set: leading zeros and the mantissa after them of the bucket's least hash.

    Hashes are sorted, and a bucket is a range of hashes, so its least is the first in it. An empty
    bucket takes the register of another one, tried in an order all sets share, so that two sets
    still agree in a register with the probability of their similarity.
    """
    document = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    wide = (sets >> np.uint64(32)) * np.uint64(k)
    bucket = (wide >> np.uint64(32)).astype(np.int64)
    rest = (wide << np.uint64(32)) | (sets & np.uint64(0xFFFFFFFF))
    first = np.ones(len(sets), bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (document[1:] != document[:-1])
    document, bucket, rest = document[first], bucket[first], rest[first]
    # As a float the number shows its leading zeros as exponent; its first bits are exact enough.
    fraction, exponent = np.frexp(rest.astype(np.float64) + 1.0)
    zeros = np.clip(64 - exponent, 0, 62).astype(np.uint16)
    mantissa = np.minimum((fraction - 0.5) * 2 * (1 << MANTISSA), (1 << MANTISSA) - 1).astype(np.uint16)
    result = np.full((len(edges) - 1, k), EMPTY, np.uint16)
    result[document, bucket] = zeros << np.uint16(MANTISSA) | mantissa
    given = result != EMPTY
    has_any = given.any(axis=1)
    d, b = np.nonzero(~given & has_any[:, None])
    for attempt in range(PROBES):
        if not len(d):
            break
        other = (mixed(np.arange(k, dtype=np.uint64), 1000 + attempt) % np.uint64(k)).astype(np.int64)[b]
        hit = given[d, other]
        result[d[hit], b[hit]] = result[d[hit], other[hit]]
        d, b = d[~hit], b[~hit]
    for step in range(1, k):
        if not len(d):
            break
        other = (b + step) % k
        hit = given[d, other]
        result[d[hit], b[hit]] = result[d[hit], other[hit]]
        d, b = d[~hit], b[~hit]
    return result


def collisions(n_a: np.ndarray, n_b: np.ndarray, k: int) -> np.ndarray:
    """Chance that registers of two sets without common elements agree after compression."""
    a, b = np.maximum(n_a / k, 1.0), np.maximum(n_b / k, 1.0)
    total = np.zeros(len(a))
    for zeros in range(40):
        upper = 2.0**-zeros
        total += upper * (np.exp(-(a + b) * upper / 2) - np.exp(-(a + b) * upper))
    return total * a * b / (a + b) / (1 << (MANTISSA + 1))


def may_reach(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the collision-corrected estimate leaves room for the threshold.

    A set smaller than its registers fills them with copies, so it counts as a sample of its size.
    """
    k = regs_a.shape[1]
    by_chance = collisions(n_a, n_b, k)
    similarity = ((regs_a == regs_b).mean(axis=1) - by_chance) / (1 - by_chance)
    goal = percent / 100
    sample = np.minimum(np.minimum(n_a, n_b), k)
    return similarity >= goal - DEVIATIONS * np.sqrt(max(goal * (1 - goal), 0.01) / sample)


def sketches(docs: DataFrame, words: int, k: int) -> DataFrame:
    """(row, id, n_shingles, set_key, registers) of (row, id, text); set_key is equal for equal sets, NULL for empty ones."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in groups(batch.column(2)):
                sets, edges = shingle_sets(texts, words)
                regs, sizes = registers(sets, edges, k), np.diff(edges)
                with np.errstate(over="ignore"):
                    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(sets, s))]) for s in (11, 13)]
                    digests = [s[edges[1:]] - s[edges[:-1]] for s in sums]
                keys = [f"{a:016x}{b:016x}{n:x}" if n else None for a, b, n in zip(*digests, sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        batch.column(1).slice(at, len(texts)),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.string()),
                        pa.array([r.tobytes() for r in regs], pa.binary()),
                    ],
                    ["row", "id", "n_shingles", "set_key", "registers"],
                )
                at += len(texts)

    schema = "row bigint, id bigint, n_shingles bigint, set_key string, registers binary"
    return small_batches(docs).mapInArrow(sketch, schema)


def bands(representatives: DataFrame, rows: int, count: int = BANDS) -> DataFrame:
    """(band, id, n) for every band of the registers; a band is the hash of its registers and position."""

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            regs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(len(batch), count, rows)
            keys = np.broadcast_to(mixed(np.arange(count, dtype=np.uint64), 17), (len(batch), count)).copy()
            for i in range(rows):
                keys = mixed(keys ^ regs[:, :, i].astype(np.uint64), 23 + i)
            repeat = lambda c: pa.array(np.repeat(batch.column(c).to_numpy(), count))
            arrays = [pa.array(keys.reshape(-1).view(np.int64)), repeat(0), repeat(1)]
            yield pa.RecordBatch.from_arrays(arrays, ["band", "id", "n"])

    columns = representatives.select("id", F.col("n_shingles").alias("n"), "registers")
    return columns.mapInArrow(band, "band bigint, id bigint, n bigint")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of ``edges`` (a, b): the least id it is connected to.

    Each round takes the least label among neighbours, then the label of the label, so chains
    shorten by more than half a round. All rounds are stored.
    """
    both = stored(
        edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
        .unionByName(edges.select(F.col("b").alias("src"), F.col("a").alias("dst")))
        .distinct(),
        "links",
    )
    start = both.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("_d"))
    labels = stored(start.select("id", F.least("id", "_d").alias("component"), F.lit(True).alias("_new")), "labels")
    while labels.where("_new").take(1):
        near = both.join(labels, F.col("src") == F.col("id")).groupBy("dst").agg(F.min("component").alias("_near"))
        of = labels.select(F.col("id").alias("_of"), F.col("component").alias("_up"))
        up = labels.join(of, F.col("component") == F.col("_of"), "left")
        least = F.least("component", F.coalesce("_up", "component"), "_near")
        labels = stored(
            up.join(near, F.col("id") == F.col("dst")).select(
                "id", least.alias("component"), (least < F.col("component")).alias("_new")
            ),
            "labels",
        )
    return labels.drop("_new")


class Linker:
    """Tests pairs of representatives: first by registers, then on full sets."""

    def __init__(self, docs: DataFrame, representatives: DataFrame, words: int, percent: int):
        self.docs, self.representatives, self.words, self.percent = docs, representatives, words, percent

    def likely(self, pairs: DataFrame) -> DataFrame:
        percent = self.percent

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    n = [batch.column(i).to_numpy() for i in (2, 3)]
                    regs = [
                        np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(len(batch), -1)
                        for i in (4, 5)
                    ]
                    mask = pa.array(may_reach(*regs, *n, percent))
                    yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

        def side(name: str) -> DataFrame:
            return self.representatives.select(
                F.col("id").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}")
            )

        joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
        return joined.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(keep, "a bigint, b bigint")

    def sets(self, ids: DataFrame) -> DataFrame:
        """(id, elements) for each of ``ids``: the whole sets, ascending hashes one after another."""
        words = self.words
        ids = stored(ids.distinct(), "ids")
        # A sieve of bounded size keeps most other texts out of the shuffle; the join after it is exact.
        sieve = ids.select(F.pmod(F.xxhash64("id"), F.lit(SIEVE)).alias("_sieve")).distinct()
        hashed = self.docs.withColumn("_s", F.pmod(F.xxhash64("id"), F.lit(SIEVE)))
        texts = hashed.join(F.broadcast(sieve), F.col("_s") == F.col("_sieve"), "left_semi").drop("_s")

        def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = 0
                for some in groups(batch.column(1)):
                    values, edges = shingle_sets(some, words)
                    sets = [values[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(at, len(some)), pa.array(sets, pa.binary())], ["id", "elements"]
                    )
                    at += len(some)

        return stored(texts.join(ids, "id", "left_semi").mapInArrow(sets_of, "id bigint, elements binary"), "sets")

    def differences(self, pairs: DataFrame) -> DataFrame:
        """(spot, leader, id, n, size, last) for each element in which the sets of (leader, id) differ.

        spot is a hash of leader and element, n the size of id's set, size that of the difference, and
        last the last position at which the first element shared with the difference of a linked
        document can stand, in an order of elements that all documents of the leader have.
        """
        percent = self.percent

        def rows(spots: list[np.ndarray], values: list[tuple[int, ...]]) -> pa.RecordBatch:
            numbers = np.repeat(np.array(values, np.int64), [len(s) for s in spots], axis=0)
            columns = [np.concatenate(spots).view(np.int64), *numbers.T]
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)

        def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                spots, values, total = [], [], 0
                seeds = mixed(batch.column(0).to_numpy().view(np.uint64), 31)
                numbers = (batch.column(i).to_pylist() for i in (0, 1))
                for seed, leader, name, x, y in zip(seeds, *numbers, batch.column(2), batch.column(3), strict=True):
                    a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                    other = np.setxor1d(a, b, assume_unique=True)
                    size = len(other)
                    shared = max(1, -(((100 - percent) * (len(a) + len(b)) - (100 + percent) * size) // 200))
                    spots.append(mixed(other ^ seed, 37))
                    values.append((leader, name, len(b), size, size - shared))
                    total += size
                    if total > ELEMENTS:
                        yield rows(spots, values)
                        spots, values, total = [], [], 0
                if spots:
                    yield rows(spots, values)

        names = ["spot", "leader", "id", "n", "size", "last"]
        sets = self.sets(pairs.select(F.col("leader").alias("id")).union(pairs.select("id")))
        joined = pairs.join(sets.select(F.col("id").alias("leader"), F.col("elements").alias("_a")), "leader").join(
            sets.select("id", F.col("elements").alias("_b")), "id"
        )
        schema = ", ".join(f"{c} bigint" for c in names)
        return joined.select("leader", "id", "_a", "_b").mapInArrow(differ, schema)

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets reach the threshold."""
        percent = self.percent
        likely = stored(self.likely(pairs), "likely")
        ids = likely.select(F.col("a").alias("id")).union(likely.select("b"))
        sets = self.sets(ids)

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = []
                for x, y in zip(batch.column(2), batch.column(3), strict=True):
                    a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                    common = len(a) + len(b) - len(np.union1d(a, b))
                    good.append(100 * common >= percent * (len(a) + len(b) - common))
                mask = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

        joined = likely.join(sets.select(F.col("id").alias("a"), F.col("elements").alias("_a")), "a").join(
            sets.select(F.col("id").alias("b"), F.col("elements").alias("_b")), "b"
        )
        return stored(joined.select("a", "b", "_a", "_b").mapInArrow(verify, "a bigint, b bigint").distinct(), "linked")


def pairs_with(members: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b, of members and leaders of one spot that differ in component, whose sizes allow a link
    and whose differences can share enough from their positions in the spot on."""
    leader = leaders.select(*[F.col(c).alias(f"_{c}") for c in leaders.columns])
    meet = (F.col("band") == F.col("_band")) & (F.col("component") != F.col("_component"))
    meet &= 100 * F.least("n", "_n") >= percent * F.greatest("n", "_n")
    rest = F.least(F.col("size") - F.col("position"), F.col("_size") - F.col("_position"))
    both = (100 + percent) * (F.col("size") + F.col("_size")) - (100 - percent) * (F.col("n") + F.col("_n"))
    meet &= 2 * (100 + percent) * rest >= both
    pairs = members.join(leader, meet)
    return pairs.select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b")).distinct()


def with_leaders(members: DataFrame, slot: Column) -> DataFrame:
    """The ``members`` of bands that are not in one component, of whom the least id of every band and slot
    ``leads``. Both are told where a band's members lie, in one shuffle and without a join."""
    band, slots = Window.partitionBy("band"), Window.partitionBy("band", "_slot")
    marked = members.withColumn("_slot", slot).withColumns(
        {"_split": F.min("component").over(band) < F.max("component").over(band), "leads": F.col("id") == F.min("id").over(slots)}
    )
    return marked.where("_split").drop("_slot", "_split")


def spots(linker: Linker, followers: DataFrame) -> DataFrame:
    """(band, id, n, size, position) of (leader, id): where documents that both differ from their
    leader must meet, if they are linked.

    Sets A and B are linked if they differ in at most c(|A| + |B|) elements, c = (1 - t) / (1 + t).
    The elements in which they differ are those in just one of their differences D(A), D(B) from the
    leader L, so the differences share o >= (|D(A)| + |D(B)| - c(|A| + |B|)) / 2 elements. Where B
    is not linked with L, |D(B)| > c(|B| + |L|), and as |A| <= |L| + |D(A)|, o is positive and at
    least (|D(B)| - c(|B| + |L|)) / (1 + c). So with the elements of all differences in one order,
    rarest first, the first shared one is among the first |D| - o + 1 of both. Elements of one
    document alone need no row; a passage that all share with L is in no difference, one that they
    all lack comes last.
    """
    differences = stored(linker.differences(followers), "differences")
    shared = stored(differences.groupBy("spot").agg(F.count("*").alias("rows")).where("rows > 1"), "shared")
    counted = with_key_values(differences, shared, "spot", "rows", ["rows"]).where("rows IS NOT NULL")
    own = Window.partitionBy("leader", "id")
    position = F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("rows", "spot")) - 1
    placed = counted.withColumn("position", position.cast("bigint")).where("position <= last")
    return stored(placed.select(F.col("spot").alias("band"), "id", "n", "size", "position"), "spots")


def links(docs: DataFrame, representatives: DataFrame, words: int, percent: int, rows: int) -> DataFrame:
    """(id, component) of the representatives that have a link.

    Documents that share a band are candidates. A band's members are first paired with one leader
    of it. Where they are in different components after that, they are not paired with each other
    but meet at the `spots` of their differences from the leader. A spot's members are again paired
    with leaders, 16 times as many in each round. A leader that met all other members of its spot
    has done its work there. It ends when every spot's members are in one component or have all
    been leaders, so no candidate pair is left that could be linked, large bands of like documents
    need one round, and documents of one band that differ each in its own way never meet.
    """
    linker = Linker(docs, representatives, words, percent)
    banded = bands(representatives, rows)
    first = F.min(F.struct("id", "n")).alias("_l")
    repeated = stored(
        banded.groupBy("band").agg(F.count("*").alias("size"), first)
        .where("size > 1")
        .select("band", "size", F.col("_l.id").alias("leader"), F.col("_l.n").alias("leader_n")),
        "bands",
    )
    led = with_key_values(banded, repeated, "band", "size", ["leader", "leader_n"]).where("leader <> id")
    members = stored(led, "members")
    alike = 100 * F.least("n", "leader_n") >= percent * F.greatest("n", "leader_n")
    pairs = members.where(alike).select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b"))
    tested = stored(pairs.distinct(), "pairs")
    found = linker.linked(tested)
    labels = components(found)

    def labelled(members: DataFrame) -> DataFrame:
        known = labels.withColumnRenamed("id", "_id")
        joined = members.join(known, F.col("id") == F.col("_id"), "left").drop("_id")
        return joined.withColumn("component", F.coalesce("component", "id"))

    followers = stored(labelled(members), "labelled")
    split = followers.groupBy("band").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    split = stored(split.where("_low < _high").select("band"), "split")
    if not split.take(1):
        return labels
    members = spots(linker, followers.join(split, "band", "left_semi").select("leader", "id").distinct())
    per_band = 1
    while True:
        per_band *= LEADERS
        slot = F.pmod(F.xxhash64("id", F.lit(per_band)), F.lit(per_band))
        crowded = stored(with_leaders(labelled(members), slot), "crowded")
        if not crowded.take(1):
            return labels
        leaders = crowded.where("leads").drop("leads")
        pairs = stored(pairs_with(crowded, leaders, percent).join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(pairs)
        new = linker.linked(pairs)
        if new.take(1):
            found = found.unionByName(new)
            labels = components(found)
        members = crowded.where("NOT leads").select("band", "id", "n", "size", "position")


def id_of(key: str, text: str) -> Column:
    """The key, or from 2**62 on a number made from the text."""
    made_up = F.lit(SURROGATE) + F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(SURROGATE >> 1))
    return F.coalesce(F.col(key).cast("bigint"), made_up).alias("id")


def grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(row, id, n_shingles, first_id, first_row) of every row of (row, id, text), see `near_duplicates`:
    the least id connected to the row, and the least row that has it. Rows are numbers of their own
    and stored, so a class goes by one of its rows, whatever ids are repeated."""
    rows = band_rows(percent)
    sketched = stored(sketches(docs, words, BANDS * rows), "sketches")
    classes = stored(
        sketched.where("set_key IS NOT NULL")
        .groupBy("set_key", "n_shingles")
        .agg(F.count("*").alias("rows"), F.min(F.struct("id", "row")).alias("_l"), F.first("registers").alias("registers"))
        .select("set_key", "n_shingles", "rows", "_l.*", "registers"),
        "classes",
    )
    nodes = classes.select(F.col("row").alias("id"), "n_shingles", "registers")
    labels = links(docs.select(F.col("row").alias("id"), "text"), nodes, words, percent, rows)
    known = labels.withColumnRenamed("id", "_node")
    labelled = stored(
        classes.select("set_key", "rows", "id", "row")
        .join(known, F.col("row") == F.col("_node"), "left")
        .select("set_key", "rows", "id", "row", "component"),
        "labelled",
    )
    firsts = stored(
        labelled.where("component IS NOT NULL")
        .groupBy("component")
        .agg(F.count("*").alias("classes"), F.min(F.struct("id", "row")).alias("_l"))
        .select("component", "classes", F.col("_l.id").alias("first_id"), F.col("_l.row").alias("first_row")),
        "firsts",
    )
    own = [F.coalesce(f"first_{c}", c).alias(f"first_{c}") for c in ("id", "row")]
    resolved = stored(
        with_key_values(labelled, firsts, "component", "classes", ["first_id", "first_row"]).select("set_key", "rows", *own),
        "resolved",
    )
    joined = with_key_values(sketched.drop("registers"), resolved, "set_key", "rows", ["first_id", "first_row"])
    return joined.select("row", "id", "n_shingles", *own)


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 3,
    percent: int = 85,
    per_row: bool = True,
) -> DataFrame:
    """Per row: key, n_shingles, component_id and kept, for links of ``percent`` similar sets of
    ``words``-word shingles, A-Z in lower case.

    Rows with equal sets are one class, whatever their number; representatives of classes are
    linked as in `links`, and links confirmed on whole sets of 64-bit hashes. component_id is the
    smallest key connected to the row, itself included; kept says that the row is the one of its
    component that stays or, not ``per_row``, that component_id is its own key. Keys lie below 2**62.

    A pair at the threshold shares no band once in a million, one well above it never. Rows without
    words or text (NULL) have an empty set, are linked with nothing and kept. Rows without a key are
    linked like others under a made-up one, which is greater than any key and equal for equal texts:
    component_id is NULL if nothing they are connected to has a key. Rows with equal keys are linked
    by their own texts. ``per_row``, as in `one_of_each`, one row is kept of each component; without it
    every row under the component's key is, made-up ones included. Extra columns are ignored; an empty table
    gives no rows.
    """
    text_of = F.coalesce(F.col(text), F.lit("")).alias("text")
    docs = stored(df.select(F.monotonically_increasing_id().alias("row"), id_of(key, text), text_of), "documents")
    is_key = lambda c: F.when(F.col(c) < SURROGATE, F.col(c))
    least = "row" if per_row else "id"
    return grouped(docs, words, percent).select(
        is_key("id").alias(key),
        "n_shingles",
        is_key("first_id").alias("component_id"),
        (F.col(least) == F.col(f"first_{least}")).alias("kept"),
    )


def one_of_each(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``df`` that `near_duplicates` keeps ``per_row``, with all their columns.

    Rows are numbered and stored first, since a row is dropped by its number: repeated keys, or none,
    neither save a copy nor drop an unlike text. Only rows whose number may be among those dropped,
    by a sieve of bounded size, are shuffled to find out.
    """
    whole = stored(
        df.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("row"), id_of(key, text)), "numbered"
    )
    docs = whole.select("row", "id", F.coalesce(F.col("_row").getField(text), F.lit("")).alias("text"))
    dropped = stored(grouped(docs, words, percent).where("row <> first_row").select("row"), "dropped")
    sieve = F.broadcast(dropped.select(F.pmod(F.xxhash64("row"), F.lit(SIEVE)).alias("_sieve")).distinct())
    hashed = whole.withColumn("_s", F.pmod(F.xxhash64("row"), F.lit(SIEVE)))
    clear = hashed.join(sieve, F.col("_s") == F.col("_sieve"), "left_anti")
    doubtful = hashed.join(sieve, F.col("_s") == F.col("_sieve"), "left_semi").join(dropped, "row", "left_anti")
    return clear.select("_row.*").unionByName(doubtful.select("_row.*"))
