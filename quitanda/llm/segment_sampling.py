"""SentencePiece segmentations sampled without replacement by perturbed best-first search over the lattice."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.llm.hashing import ALL, groups, mixed
from quitanda.llm.tables import small_batches

BLANK = "▁"
# Texts whose units are looked up together, and of those, characters sampled at a time.
GROUP_BYTES, SAMPLED_CHARS = 1_000_000, 400_000
# Characters below this code, and the blank mark, have a place in the table of adjacent pairs.
SMALL = 0x250
# Cells of the units a worker remembers, 20 bytes each.
REMEMBERED_CELLS = 2_000_000
TABLE_BITS = 19


class Lattice:
    """What a model's pieces say: which substrings are pieces, their log weights, where text can be cut.

    A unigram model scores pieces by log probability. A BPE model scores them by rank (0, -1, -2, ...);
    a piece then weighs 1 / (rank + 2), after Zipf's law. A character without a piece is spelled in
    byte pieces, or is the unknown piece if the model has none.
    """

    def __init__(self, path: str, temperature: float = 1.0):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)]
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        usual = [i for i in range(size) if i not in set(special) and not model.is_byte(i)]
        pieces = [model.id_to_piece(i) for i in usual]
        scores = np.array([model.get_score(i) for i in usual])
        if np.all(scores == np.round(scores)) and scores.min() < -100:
            scores = -np.log(2.0 - scores)
        self.temperature = temperature
        scores = scores / temperature
        self.spelled = scores.min() - 1.0
        self.longest = max(map(len, pieces))
        # Beginnings of pieces by a hash of their characters, which grows character by character. A table of
        # the hash's first bits leads to one of them, a sorted list to the others with the same bits.
        self.power = int(mixed(np.array([5], np.uint64), 5)[0]) | 1
        self.ids, self.scores = np.array(usual), scores
        begins = dict.fromkeys((p[:n] for p in pieces for n in range(1, len(p))), -1)
        begins.update((p, i) for i, p in enumerate(pieces))
        keys = np.array([self.hash_of(p) for p in begins], np.uint64)
        order = np.argsort(keys)
        self.keys, self.piece = keys[order], np.array(list(begins.values()))[order]
        slot = self.keys >> np.uint64(64 - TABLE_BITS)
        self.table = np.full(1 << TABLE_BITS, len(self.keys) - 1, np.int32)
        self.table[slot[::-1]] = np.arange(len(self.keys), dtype=np.int32)[::-1]
        self.crowded = np.bincount(slot.astype(np.int64), minlength=1 << TABLE_BITS) > 1
        self.allowed = np.zeros((SMALL + 2, SMALL + 2), bool)
        self.allowed[SMALL + 1, :] = self.allowed[:, SMALL + 1] = True
        for piece in pieces:
            small = self.small(np.frombuffer(piece.encode("utf-32-le"), np.uint32))
            self.allowed[small[:-1], small[1:]] = True
        self.spelling = [model.id_to_piece(i).encode() for i in range(size)]
        for value, i in self.bytes.items():
            self.spelling[i] = bytes([value])
        self.unknown = model.unk_id()
        plain = [b.replace(BLANK.encode(), b" ") for b in self.spelling]
        self.plain = np.frombuffer(b"".join(plain), np.uint8)
        self.plain_size = np.array([len(b) for b in plain])
        self.plain_start = np.cumsum(self.plain_size) - self.plain_size
        self.known: dict[str, int] = {}
        self.units = units_of([], self)

    def numbered(self, texts: list[str]) -> np.ndarray:
        """The number of each of the distinct units ``texts`` in ``self.units``; new ones are appended.

        Beyond a bound, only those of the units met before that are met again now stay. A change makes
        a new ``Units``, so whoever holds an earlier one may go on with it.
        """
        numbers = np.fromiter(map(self.known.get, texts, repeat(-1)), np.int64, len(texts))
        missing = np.flatnonzero(numbers < 0)
        if not len(missing):
            return numbers
        if len(self.units.chance) > REMEMBERED_CELLS:
            met = np.flatnonzero(numbers >= 0)
            keep, pieces = np.unique(numbers[met]), list(self.known)
            self.known = {pieces[old]: new for new, old in enumerate(keep.tolist())}
            self.units = self.units.only(keep)
            numbers[met] = np.searchsorted(keep, numbers[met])
        new = [texts[i] for i in missing.tolist()]
        first = len(self.known)
        self.units = self.units.followed_by(units_of(new, self))
        self.known.update(zip(new, range(first, first + len(new)), strict=True))
        numbers[missing] = np.arange(first, first + len(new))
        return numbers

    def texts_of(self, ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
        """The texts of segmentations in UTF-8, each between two ``cuts`` of the ids; the blank that encoding
        puts before a text is left out."""
        size = self.plain_size[ids]
        ends = np.cumsum(size)
        source = np.repeat(self.plain_start[ids] - ends + size, size)
        source += np.arange(len(source))
        data, at = self.plain[source].tobytes(), np.concatenate([[0], ends])[cuts].tolist()
        return [data[a + 1 : b] for a, b in zip(at, at[1:])]

    def hash_of(self, piece: str) -> int:
        value = 0
        for c in mixed(np.frombuffer(piece.encode("utf-32-le"), np.uint32), 9).tolist():
            value = (value * self.power + c) & ALL
        return value

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are those of a piece's beginning, and their pieces, -1 for a mere beginning."""
        slot = hashes >> np.uint64(64 - TABLE_BITS)
        at = self.table[slot]
        missed = np.flatnonzero(self.crowded[slot] & (self.keys[at] != hashes))
        at[missed] = np.minimum(np.searchsorted(self.keys, hashes[missed]), len(self.keys) - 1)
        found = np.flatnonzero(self.keys[at] == hashes)
        return found, self.piece[at[found]]

    @staticmethod
    def small(codes: np.ndarray) -> np.ndarray:
        return np.where(codes < SMALL, codes, np.where(codes == ord(BLANK), SMALL, SMALL + 1)).astype(np.int64)


@cache
def lattice_of(path: str, temperature: float = 1.0) -> Lattice:
    return Lattice(path, temperature)


class Units(NamedTuple):
    """Distinct stretches of text between forced cuts. A node is a place in a unit; its edges are cells, one
    for every number of characters up to the unit's end or the longest piece."""

    begin: np.ndarray  # first node of each unit
    length: np.ndarray  # characters of each unit
    cell: np.ndarray  # first cell of each node, and the end
    chance: np.ndarray  # per cell: probability of the edge at its node
    upto: np.ndarray  # running sums of the chances of a node
    edge: np.ndarray  # its piece id; -1 - code point for a character spelled in bytes

    def only(self, units: np.ndarray) -> "Units":
        length = self.length[units]
        begin = np.cumsum(length) - length
        node = np.repeat(self.begin[units] - begin, length) + np.arange(length.sum())
        width = self.cell[node + 1] - self.cell[node]
        cell = np.concatenate([[0], np.cumsum(width)])
        at = np.repeat(self.cell[node] - cell[:-1], width) + np.arange(cell[-1])
        return Units(begin, length, cell, self.chance[at], self.upto[at], self.edge[at])

    def followed_by(self, more: "Units") -> "Units":
        nodes, cells = len(self.cell) - 1, len(self.chance)
        moved = more._replace(begin=more.begin + nodes, cell=more.cell[1:] + cells)
        return Units(*map(np.concatenate, zip(self, moved, strict=True)))

    def open_cells(self, node: np.ndarray, tried: np.ndarray) -> np.ndarray:
        """Chances of each node's edges, a row per node, 0 for those tried."""
        width = self.cell[node + 1] - self.cell[node]
        slots = np.arange(int(width.max()) if len(width) else 1)
        inside = slots < width[:, None]
        cells = np.where(inside, self.cell[node][:, None] + slots, 0)
        return np.where(inside & (tried[:, None] >> slots & 1 == 0), self.chance[cells], 0.0)


def units_of(texts: list[str], lattice: Lattice) -> Units:
    """Edge probabilities of every node: the weight of all segmentations that begin with the edge."""
    length = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(length) - length
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    n = len(codes)
    left = np.repeat(begin + length, length) - np.arange(n)  # characters to the unit's end
    width = np.minimum(left, lattice.longest)
    cell = np.concatenate([[0], np.cumsum(width)])
    edge, score = np.zeros(cell[-1], np.int32), np.full(cell[-1], -np.inf)
    hashed = mixed(codes, 9)
    fits, run, power = np.arange(n), np.zeros(n, np.uint64), np.uint64(lattice.power)
    with np.errstate(over="ignore"):
        for slot in range(int(width.max()) if n else 0):
            more = width[fits] > slot
            fits, run = fits[more], run[more]
            run = run * power + hashed[fits + slot]
            found, piece = lattice.find(run)
            fits, run = fits[found], run[found]  # others begin no piece
            whole = np.flatnonzero(piece >= 0)
            cells = cell[fits[whole]] + slot
            edge[cells], score[cells] = lattice.ids[piece[whole]], lattice.scores[piece[whole]]
    bare = np.flatnonzero(np.isneginf(score[cell[:-1]]))
    edge[cell[bare]], score[cell[bare]] = -1 - codes[bare].astype(np.int64), lattice.spelled
    # Backward sums, all units at once, from their ends.
    total, chance, upto = np.zeros(n + 1), np.zeros(len(score)), np.zeros(len(score))
    order = np.argsort(left, kind="stable")
    bounds = np.searchsorted(left[order], np.arange(1, (int(left.max()) if n else 0) + 2), "left")
    for far, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), 1):
        rows = order[a:b]
        slots = np.arange(min(far, lattice.longest))
        cells = cell[rows][:, None] + slots
        ways = score[cells]
        ways += np.where(slots + 1 == far, 0.0, total[np.minimum(rows[:, None] + slots + 1, n)])
        top = ways.max(1)
        part = np.exp(ways - top[:, None])
        sums = np.cumsum(part, 1)
        total[rows] = top + np.log(sums[:, -1])
        chance[cells], upto[cells] = part / sums[:, -1:], sums / sums[:, -1:]
    return Units(begin, length, cell, chance, upto, edge)


class Path(NamedTuple):
    """Edges of one segmentation per document, in text order. T is the greatest perturbed score among
    segmentations that leave the path at the edge and were not emitted; -inf where there are none."""

    document: np.ndarray
    unit: np.ndarray  # occurrence of a unit in the texts
    offset: np.ndarray  # first character of the edge inside its unit
    slot: np.ndarray
    log: np.ndarray  # log probability of the edge at its node
    T: np.ndarray
    tried: np.ndarray  # bits of slots that were emitted at this node on this prefix


class Region:
    """Texts cut into units. Neighbouring documents share most units, so many are looked at together."""

    def __init__(self, texts: list[str], lattice: Lattice):
        self.texts, self.lattice = texts, lattice
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        self.char = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        cut = np.ones(len(codes) + 1, bool)
        if len(codes):
            small = lattice.small(codes)
            cut[1:-1] = ~lattice.allowed[small[:-1], small[1:]]
        cut[self.char] = True
        cuts = np.flatnonzero(cut) if len(codes) else np.zeros(1, np.int64)
        wide = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        offsets = np.concatenate([[0], np.cumsum(wide)])[cuts].astype(np.int32)
        data = pa.py_buffer("".join(texts).encode())
        pieces = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(offsets), data).dictionary_encode()
        numbers = lattice.numbered(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        self.units = lattice.units
        self.kind = numbers[pieces.indices.to_numpy()]  # of every occurrence of a unit
        self.begin = cuts[:-1]  # first character of every occurrence
        self.first = np.searchsorted(self.begin, self.char, "left")  # first occurrence of every document


class Group:
    """Some documents of a region, sampled together. Random numbers depend on the document's seed, the
    round and the place in the document only, so neighbours do not matter."""

    def __init__(self, region: Region, a: int, b: int, seeds: np.ndarray):
        self.lattice, self.units, self.n = region.lattice, region.units, b - a
        self.seeds = seeds[a:b]
        low, high = region.first[a], region.first[b]
        self.kind = region.kind[low:high]
        self.first = region.first[a : b + 1] - low
        self.owner = np.repeat(np.arange(self.n), np.diff(self.first))
        self.begin = region.begin[low:high] - region.char[a]  # in the group
        self.place = self.begin - (region.char[a:b] - region.char[a])[self.owner]  # in the document
        self.size = int(region.char[b] - region.char[a])

    def uniform(self, round_: int, document: np.ndarray, place: np.ndarray, purpose: int) -> np.ndarray:
        bits = mixed(mixed(self.seeds[document] ^ np.uint64(round_ * 2 + purpose + 1)) ^ place.astype(np.uint64), 3)
        return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53

    def walk(self, unit: np.ndarray, offset: np.ndarray, round_: int) -> tuple[np.ndarray, ...]:
        """Edges of a random segmentation from a place in each unit to the unit's end."""
        found = []
        kind, units = self.kind, self.units
        live = offset < units.length[kind[unit]]
        unit, offset = unit[live], offset[live]
        while len(unit):
            node = units.begin[kind[unit]] + offset
            u = self.uniform(round_, self.owner[unit], self.place[unit] + offset, 0)
            cell = units.cell[node]
            at, on = cell.copy(), np.flatnonzero(units.upto[cell] < u)
            while len(on):  # the last sum of a node is 1
                at[on] += 1
                on = on[units.upto[at[on]] < u[on]]
            slot, p = at - cell, units.chance[at]
            found.append((unit, offset, slot, p))
            offset = offset + slot + 1
            live = offset < units.length[kind[unit]]
            unit, offset = unit[live], offset[live]
        if not found:
            empty = np.zeros(0, np.int64)
            return empty, empty, empty, np.zeros(0)
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def bounded(self, mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
        """Gumbel numbers located at the log mass, given that they lie below the bound."""
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            return np.where(np.isneginf(mass), -np.inf, mass - np.log(np.exp(mass - bound) - np.log(u)))

    def path(
        self, parts: list[tuple[np.ndarray, ...]], tried: list[np.ndarray], fresh: list[np.ndarray], bound: np.ndarray, round_: int
    ) -> Path:
        """A path of the given edges; those marked fresh get a T below their document's bound."""
        unit, offset, slot, p = (np.concatenate(c) for c in zip(*parts, strict=True))
        tried, fresh = np.concatenate(tried), np.concatenate(fresh)
        # Edges begin at different characters, which puts them in order.
        order = np.full(self.size, -1)
        order[self.begin[unit] + offset] = np.arange(len(unit))
        order = order[order >= 0]
        unit, offset, slot, p, tried, fresh = (x[order] for x in (unit, offset, slot, p, tried, fresh))
        document, log = self.owner[unit], np.log(p)
        before = np.cumsum(log) - log
        starts = np.searchsorted(document, np.arange(self.n), "left")
        has = starts < len(document)
        base = np.zeros(self.n)
        base[has] = before[starts[has]]
        at = np.flatnonzero(fresh)
        rest = 1 - p[at]
        # Sums of what is left, where that is little or where more than the edge itself is gone.
        fine = np.flatnonzero((rest > 0) & (rest < 1e-10) | (tried[at] != 1 << slot[at]))
        node = self.units.begin[self.kind[unit[at[fine]]]] + offset[at[fine]]
        rest[fine] = self.units.open_cells(node, tried[at[fine]]).sum(1)
        with np.errstate(divide="ignore"):
            mass = before[at] - base[document[at]] + np.log(rest)
        T = np.full(len(document), -np.inf)
        u = self.uniform(round_, document[at], self.place[unit[at]] + offset[at], 1)
        T[at] = self.bounded(mass, bound[document[at]], u)
        return Path(document, unit, offset, slot, log, T, tried)

    def samples(self, k: int) -> tuple[list[tuple[Path, np.ndarray, np.ndarray]], np.ndarray]:
        """Per round: the path, the documents that have one, their perturbed scores. Then per document the
        score of the next segmentation, -inf if there is none."""
        everyone = np.arange(self.n)
        score = -np.log(-np.log(self.uniform(0, everyone, everyone * 0, 1)))
        whole = self.walk(np.arange(len(self.kind)), np.zeros(len(self.kind), np.int64), 1)
        paths = [self.path([whole], [1 << whole[2]], [np.ones(len(whole[0]), bool)], score, 1)]
        found = [(paths[0], everyone, score)]
        for round_ in range(2, k + 2):
            best, source, edge = np.full(self.n, -np.inf), np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
            for i, path in enumerate(paths):
                if not len(path.T):
                    continue
                starts = np.flatnonzero(np.concatenate([[True], path.document[1:] != path.document[:-1]]))
                top = np.maximum.reduceat(path.T, starts)
                owner = path.document[starts]
                is_top = path.T == np.repeat(top, np.diff(np.append(starts, len(path.T))))
                first = np.full(self.n, -1)
                rows = np.flatnonzero(is_top)[::-1]
                first[path.document[rows]] = rows
                better = top > best[owner]
                best[owner[better]], source[owner[better]] = top[better], i
                edge[owner[better]] = first[owner[better]]
            if round_ == k + 1:
                return found, best
            documents = np.flatnonzero(best > -np.inf)
            parts, tried, fresh = [], [], []
            for i, path in enumerate(paths):
                mine = documents[source[documents] == i]
                if not len(mine):
                    continue
                at = edge[mine]
                path.T[at] = -np.inf
                upto = np.full(self.n, -1)
                upto[mine] = at
                keep = np.flatnonzero(np.arange(len(path.document)) < upto[path.document])
                parts.append((path.unit[keep], path.offset[keep], path.slot[keep], np.exp(path.log[keep])))
                tried.append(path.tried[keep])
                fresh.append(np.zeros(len(keep), bool))
                unit, offset = path.unit[at], path.offset[at]
                node = self.units.begin[self.kind[unit]] + offset
                open_ = self.units.open_cells(node, path.tried[at])
                u = self.uniform(round_, mine, self.place[unit] + offset, 0) * open_.sum(1)
                slot = np.minimum((np.cumsum(open_, 1) < u[:, None]).sum(1), open_.shape[1] - 1)
                wrong = open_[np.arange(len(slot)), slot] <= 0  # rounding led past the last open edge
                slot[wrong] = open_[wrong].argmax(1)
                parts.append((unit, offset, slot, self.units.chance[self.units.cell[node] + slot]))
                tried.append(path.tried[at] | 1 << slot)
                fresh.append(np.ones(len(slot), bool))
                later = [np.arange(a + 1, b) for a, b in zip(unit.tolist(), self.first[mine + 1].tolist(), strict=True)]
                later = np.concatenate(later) if later else np.zeros(0, np.int64)
                starts = np.concatenate([unit, later])
                rest = self.walk(starts, np.concatenate([offset + slot + 1, np.zeros(len(later), np.int64)]), round_)
                parts.append(rest)
                tried.append(1 << rest[2])
                fresh.append(np.ones(len(rest[0]), bool))
            if not parts:
                empty = np.zeros(0, np.int64)
                parts, tried, fresh = [(empty, empty, empty, np.zeros(0))], [empty], [np.zeros(0, bool)]
            path = self.path(parts, tried, fresh, best, round_)
            paths.append(path)
            found.append((path, documents, best[documents]))
        raise AssertionError

    def ids(self, path: Path) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all edges, spelled characters as their bytes, and each id's document."""
        edge = self.units.edge[self.units.cell[self.units.begin[self.kind[path.unit]] + path.offset] + path.slot]
        odd = np.flatnonzero(edge < 0)
        if not len(odd):
            return edge.astype(np.int32), path.document
        lattice, count = self.lattice, np.ones(len(edge), np.int64)
        spelled = []
        for row in odd.tolist():
            data = chr(-1 - int(edge[row])).encode()
            known = all(b in lattice.bytes for b in data)
            spelled.append([lattice.bytes[b] for b in data] if known else [lattice.unknown])
            count[row] = len(spelled[-1])
        result = np.repeat(edge, count)
        begin = np.cumsum(count) - count
        for row, some in zip(odd.tolist(), spelled, strict=True):
            result[begin[row] : begin[row] + len(some)] = some
        return result.astype(np.int32), np.repeat(path.document, count)


SCHEMA = (
    "sample int, n_pieces bigint, log_prob double, perturbed double, inclusion double, ids_crc32 bigint, round_trip boolean"
)


def segmentations(
    df: DataFrame,
    model: str,
    key: str = "doc_id",
    text: str = "text",
    k: int = 2,
    seed: int = 1,
    temperature: float = 1.0,
    ids: bool = False,
) -> DataFrame:
    """Up to ``k`` distinct segmentations of every text, drawn without replacement, one row each.

    Segmentations have the probability of their pieces' weights. The scores of all of them are
    perturbed by Gumbel noise, and the search emits them from the greatest on: a node of the search
    is the set of segmentations that leave an emitted one at an edge, its bound the noise of the set's
    total weight, below that of the set it came from. So sample 1 is an ordinary draw, and k samples
    are k draws without replacement. Per row: key, sample (1 to k), n_pieces, log_prob, perturbed
    (descending by sample), inclusion (the chance to lie above the next score, by which a sum over samples is
    weighed), ids_crc32 (of the ids as 4-byte integers), round_trip (decoding gives the model's normal
    form of the text), and ``ids`` if asked for.

    Noise is seeded by the row's key, or its text where the key is NULL: reruns and repeated rows
    give equal samples. A NULL or empty text has one segmentation without pieces; a text with fewer
    than k gives all it has, with inclusion 1. Extra columns are ignored; an empty table gives no
    rows. Nothing is shuffled; whole texts are cut only where no piece of the model reaches across.
    """

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        lattice = lattice_of(model, temperature)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            at = 0
            for some in groups(batch.column(1), GROUP_BYTES):
                own = keys[at : at + len(some)]
                at += len(some)
                plain = [t or "" for t in some.to_pylist()]
                texts = [lattice.model.normalize(t) for t in plain]
                seeds = [
                    xxh3_64_intdigest((t if k_ is None else str(k_)).encode(), seed)
                    for k_, t in zip(own, plain, strict=True)
                ]
                yield from rows_of(own, texts, np.array(seeds, np.uint64), lattice, k, ids)

    rows = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    result = small_batches(rows).mapInArrow(sample, f"_key {kind}, {SCHEMA}" + ", ids array<int>" * ids)
    return result.withColumnRenamed("_key", key)


def rows_of(
    keys: list, texts: list[str], seeds: np.ndarray, lattice: Lattice, k: int, ids: bool
) -> Iterator[pa.RecordBatch]:
    """The result rows of a group of texts in the model's normal form."""
    region, at = Region(texts, lattice), 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(region.char, region.char[at] + SAMPLED_CHARS, "right")) - 1)
        yield from _sampled(Group(region, at, end, seeds), keys[at:end], texts[at:end], k, ids)
        at = end


def _sampled(group: Group, keys: list, texts: list[str], k: int, ids: bool) -> Iterator[pa.RecordBatch]:
    lattice = group.lattice
    found, after = group.samples(k)
    for number, (path, documents, score) in enumerate(found, 1):
        flat, owner = group.ids(path)
        cuts = np.searchsorted(owner, np.arange(group.n + 1), "left")
        log = np.bincount(path.document, path.log, group.n)[documents]
        # The noise that the next score leaves: certain where there is no next segmentation.
        with np.errstate(over="ignore"):
            inclusion = -np.expm1(-np.exp(log - after[documents]))
        spelled = lattice.texts_of(flat, cuts)
        pieces = [flat[cuts[d] : cuts[d + 1]] for d in documents.tolist()]
        wanted = [texts[d].replace(BLANK, " ")[1:].encode() for d in documents.tolist()]
        columns = [
            [keys[d] for d in documents.tolist()],
            np.full(len(documents), number, np.int32),
            [len(p) for p in pieces],
            np.round(log, 6),
            np.round(score, 6),
            np.round(inclusion, 6),
            [zlib.crc32(p.astype("<i4").tobytes()) for p in pieces],
            [spelled[d] == w for d, w in zip(documents.tolist(), wanted, strict=True)],
        ]
        names = ["_key", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", "ids_crc32", "round_trip"]
        arrays = [pa.array(c) for c in columns]
        if not any(key is not None for key in columns[0]):
            arrays[0] = pa.nulls(len(documents), pa.int64())
        if ids:
            arrays.append(pa.array([p.tolist() for p in pieces], pa.list_(pa.int32())))
        if len(documents):
            yield pa.RecordBatch.from_arrays(arrays, names + ["ids"] * ids)
