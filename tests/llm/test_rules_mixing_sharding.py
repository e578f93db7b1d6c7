"""The rule ledger, mixing and sharding against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import cases
import pytest
import xxhash
from pyspark.sql import functions as F

from quitanda.llm import mixing, quality_rules, sharding
from quitanda.llm.queries import SHARDS, llm_queries, op4_hash_threshold_mix
from quitanda.llm.tables import with_key_values

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text: str) -> tuple:
    found = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_and_verdicts(spark):
    got = quality_rules.ledger(cases.documents(spark)).collect()
    by_key = defaultdict(list)
    for i, t, _ in cases.TEXTS:
        by_key[i].append(measured(t or ""))
    assert len(got) == len(cases.TEXTS)
    for r in got:
        assert tuple(r[m] for m in quality_rules.MEASURES[:5]) in by_key[r.doc_id]
        assert bool(r.failed_bits & 1) == (r.n_words < 50)
    assert quality_rules.ledger(cases.empty(spark)).count() == 0


def test_policies_and_ablations_need_only_the_bits(spark):
    rows = [(1, 0, 10), (2, 1, 5), (3, 1 | 2, 7), (4, 4, 9), (5, 4, 9)]
    ledger = spark.createDataFrame(rows, "doc_id int, failed_bits bigint, n_words bigint")
    kept = ledger.where(quality_rules.passes("base")).select("doc_id").collect()
    assert {r.doc_id for r in kept} == {1, 4, 5}
    table = {(r.policy, r.rule): r for r in quality_rules.ablations(ledger).collect()}
    few = table["base", "too_few_words"]
    assert (few.failed, few.failed_alone, few.words_failed_alone, few.kept, few.kept_without) == (2, 1, 5, 3, 4)
    symbols = table["v1", "symbols"]
    assert (symbols.failed, symbols.failed_alone, symbols.kept, symbols.kept_without) == (2, 2, 1, 3)
    assert quality_rules.ablations(ledger.limit(0)).count() == 0


def filled(sizes: dict[str, int], weights, most: float, total: float) -> dict[str, float]:
    """Targets by sharing the excess again and again."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes))}
    capped: dict[str, float] = {}
    while True:
        free = [s for s in sizes if s not in capped]
        if not free:
            return capped
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 1}, {"a": 5, "b": 1, "c": 1, "d": 1000, "e": 0}, {"x": 3}])
def test_targets_fill_up_to_the_cap(spark, sizes):
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source_key string, source_size bigint")
    got = {r.source_key: r.target for r in mixing.targets(frame, (1, 2, 3), 3).collect()}
    wanted = filled(sizes, (1, 2, 3), 3, sum(sizes.values()))
    assert got.keys() == wanted.keys()
    assert all(abs(got[s] - wanted[s]) < 1e-6 for s in sizes)


def test_thresholds_are_nested_and_nearest(spark):
    placed = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source_key"),
        F.xxhash64("id").bitwiseAND(F.lit(mixing.PLACES - 1)).alias("place"),
        (F.col("id") % 17 + 1).alias("size"),
    )
    rows = placed.collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source_key].append((r.place, r.size))
    asked = [(s, float(share * sum(n for _, n in docs))) for s, docs in by.items() for share in (0.0, 0.1, 0.5, 0.501, 1.5)]
    got = mixing.thresholds(placed, spark.createDataFrame(asked, "source_key string, budget double")).collect()
    assert len(got) == len(asked)
    for r in got:
        total, best = 0, 0
        for _, size in sorted(by[r.source_key]):
            total += size
            best = total if abs(total - r.budget) < abs(best - r.budget) else best
        taken = sum(n for p, n in by[r.source_key] if p < r.threshold)
        assert abs(abs(taken - r.budget) - abs(best - r.budget)) < 1e-9
    for s in by:
        cuts = [r.threshold for r in sorted(got, key=lambda r: r.budget) if r.source_key == s]
        assert cuts == sorted(cuts)


def test_mix_of_all_documents(spark, small):
    got = op4_hash_threshold_mix(spark, small).collect()
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    size = {d.doc_id: len(WORD.findall(d.text or "")) for d in docs}
    source = {d.doc_id: d.source for d in docs}
    per = Counter()
    for i in size:
        per[source[i]] += size[i]
    wanted = filled(per, (1, 2, 3), 3, sum(per.values()))
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == per[source[r.doc_id]]
        assert abs(r.target - wanted[source[r.doc_id]]) < 1e-6
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r.size)
    assert len(got) == len(docs)
    assert all(abs(taken[s] - wanted[s]) <= largest[s] for s in per)
    assert sorted(got) == sorted(op4_hash_threshold_mix(spark, small).collect())


def test_mix_of_odd_documents(spark):
    docs = cases.documents(spark)
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    sources = {r.source for r in mixing.mixed_rows(docs).collect()}
    assert sources <= {"s1", "s2", "s3", "s4", "é", None}
    assert mixing.mixed_rows(cases.empty(spark)).count() == 0
    nothing = docs.where("text IS NULL OR text = ''")
    assert mixing.mixed_rows(nothing).count() >= 0


def test_table_is_even_and_moves_little():
    names = [f"n{i}" for i in range(50)]
    table = sharding.fill_table(names, 5003)
    counts = Counter(table)
    assert set(counts) == set(range(50)) and max(counts.values()) - min(counts.values()) <= 1
    less = sharding.fill_table(names[1:], 5003)
    moved = sum(a != b + 1 for a, b in zip(table, less, strict=True) if a != 0)
    assert moved < 0.05 * 5003
    heavy = Counter(sharding.fill_table(["a", "b"], 1009, {"a": 3}))
    assert abs(heavy[0] - 3 * heavy[1]) <= 4
    for bad in (lambda: sharding.fill_table(names, 5000), lambda: sharding.fill_table(["a", "a"]), lambda: sharding.fill_table([])):
        with pytest.raises(ValueError):
            bad()


def test_turns_claim_the_next_free_slot():
    names, slots = ["x", "y", "z"], 7
    walks = [[(s + i * step) % slots for i in range(slots)] for s, step in (sharding._preference(n, slots) for n in names)]
    wanted = [-1] * slots
    while -1 in wanted:
        for i, walk in enumerate(walks):
            free = [s for s in walk if wanted[s] < 0]
            if free:
                wanted[free[0]] = i
    assert sharding.fill_table(names, slots) == wanted


def test_placement(spark):
    table = sharding.fill_table(["a", "b", "c"], 101)
    docs = cases.documents(spark)
    got = sharding.place(docs, "doc_id", {"shard": table}, "text")
    assert set(got.columns) == set(docs.columns)
    rows = got.collect()
    assert len(rows) == len(cases.TEXTS) and all(r.shard == table[r.slot] for r in rows)
    assert len({r.slot for r in rows if r.doc_id == 8}) == 1
    assert sharding.place(cases.empty(spark), "doc_id", {"shard": table}).count() == 0


def test_all_documents_are_placed_as_by_hand(spark, tiny):
    """Slots by an own hash of the key, the table by an own filling, over the registered query's rows."""

    def walk(name, slots):
        digest = hashlib.sha256(name.encode()).digest()
        start, step = int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1
        return ((start + k * step) % slots for k in range(slots))

    def filled(names, slots):
        walks, table = [walk(name, slots) for name in names], {}
        while len(table) < slots:
            for i, way in enumerate(walks):
                if len(table) < slots:
                    table[next(s for s in way if s not in table)] = i
        return table

    both, without = filled(SHARDS, sharding.SLOTS), filled(SHARDS[1:], sharding.SLOTS)
    rows = llm_queries()["op10_lookup_table_shards"](spark, tiny).collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    for r in rows:
        hashed = xxhash.xxh64_intdigest(str(r.doc_id).encode(), 42)
        slot = (hashed - (1 << 64) if hashed >> 63 else hashed) % sharding.SLOTS
        assert (r.slot, r.shard, r.shard_without_first) == (slot, both[slot], without[slot] + 1)


def test_hot_keys_join_as_any_join_does(spark):
    facts = spark.range(0, 4000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, None)
        .otherwise((F.col("id") % 400).cast("string"))
        .alias("k"),
    )
    per_key = facts.where("k IS NOT NULL AND k <> '17'").groupBy("k").agg(F.count("*").alias("c"), F.max("n").alias("v"))
    wanted = sorted(map(str, facts.join(per_key.drop("c"), "k", "left").select("n", "k", "v").collect()))
    for limit in (0, 10_000):
        got = with_key_values(facts, per_key, "k", "c", ["v"], limit)
        assert sorted(map(str, got.collect())) == wanted
    numbers = facts.select("n", F.col("k").try_cast("bigint").alias("k"))
    per_number = numbers.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("c"), F.max("n").alias("v"))
    got = with_key_values(numbers, per_number, "k", "c", ["v"], 0)
    assert sorted(map(str, got.collect())) == sorted(
        map(str, numbers.join(per_number.drop("c"), "k", "left").select("n", "k", "v").collect())
    )
