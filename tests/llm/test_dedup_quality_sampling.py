"""Near duplicates, line quality and sampled segmentations against brute force."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_registered import groups as brute_groups
from test_registered import shingles

from quitanda.llm import line_quality, near_dedup, segment_sampling
from quitanda.llm.hashing import word_hashes
from quitanda.llm.queries import op3_line_crf_quality, op7_sampled_segmentations, tokenizer_path

# Near duplicates


@pytest.mark.parametrize("n", [1, 3, 5])
def test_shingle_sets(n):
    texts = ["", "a", "A a", "a b c a b c a b c", " x\ty\nz x y z ", None, "é É b", cases.words(50, 1)]
    values, edges = near_dedup.shingle_sets(pa.array(texts, pa.string()), n)
    sizes = np.diff(edges).tolist()
    assert sizes == [len(shingles(t or "", n)) for t in texts]
    hashes, words = word_hashes(pa.array(texts, pa.string()))
    assert len(hashes) == words[-1] and np.diff(words).tolist() == [len((t or "").split()) for t in texts]


def test_registers_agree_as_often_as_sets_do():
    draw = np.random.default_rng(1)
    for size, shared in ((2000, 1800), (2000, 400), (60, 50)):
        agree, wanted = [], shared / (2 * size - shared)
        for _ in range(40):
            pool = draw.integers(0, 1 << 63, 2 * size - shared, dtype=np.uint64)
            a, b = np.sort(pool[:size]), np.sort(pool[size - shared :])
            regs = near_dedup.registers(np.concatenate([a, b]), np.array([0, size, 2 * size]), 384)
            by_chance = near_dedup.collisions(np.array([size]), np.array([size]), 384)[0]
            agree.append(((regs[0] == regs[1]).mean() - by_chance) / (1 - by_chance))
        assert abs(np.mean(agree) - wanted) < 0.04


def test_bands_catch_pairs_at_the_threshold():
    assert near_dedup.band_rows(85) == 8 and near_dedup.band_rows(80) == 6
    for percent in (80, 85, 95):
        rows = near_dedup.band_rows(percent)
        assert (1 - (percent / 100) ** rows) ** near_dedup.BANDS <= 1e-6


def altered(text: str, n: int, seed: int) -> str:
    draw, found = random.Random(seed), text.split()
    for at in draw.sample(range(len(found)), n):
        found[at] = f"new{seed}x{at}"
    return " ".join(found)


def test_components_of_copies_chains_and_shared_passages(spark):
    texts, base, passage = [], cases.words(400, 11), cases.words(150, 12)
    texts += [base] * 30  # copies
    texts += [altered(base, 3 + i % 9, i) for i in range(60)]  # near copies, some too far from others
    chain = cases.words(300, 13)
    for i in range(12):  # neighbours are linked, ends are not
        texts.append(chain)
        chain = altered(chain, 6, 100 + i)
    texts += [passage + " " + cases.words(60 + i, 200 + i) for i in range(40)]  # half shared, not linked
    texts += [f"short {i % 7} text of six words" for i in range(20)]
    texts += [" ".join(cases.words(9, 5).split()[:k]) for k in range(10)]
    random.Random(2).shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    for words, percent in ((3, 85), (5, 80)):
        got = {r.doc_id: r for r in near_dedup.near_duplicates(frame, words=words, percent=percent).collect()}
        wanted = brute_groups(dict(enumerate(texts)), words, percent)
        assert {i: r.component_id for i, r in got.items()} == wanted
        assert all(r.kept == (r.component_id == i) for i, r in got.items())
        assert all(r.n_shingles == len(shingles(texts[i], words)) for i, r in got.items())


def test_a_band_of_unlike_documents_is_searched_to_the_end(spark):
    """All members share one band, none is the leader of the links: rounds go on until each pair is tested."""
    texts = [cases.words(200, i // 2 + 50) + (f" tail{i}" if i % 2 else "") for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    representatives = docs.select(
        "id", F.lit(200).cast("bigint").alias("n_shingles"), F.lit(bytes(2 * near_dedup.BANDS * 8)).alias("registers")
    )
    labels = {r.id: r.component for r in near_dedup.links(docs, representatives, 3, 85, 8).collect()}
    assert labels == {i: i - i % 2 for i in range(40)}


def test_documents_with_a_common_passage_meet_leaders_only(spark, monkeypatch):
    """Unlinked documents of one band: twice as many give twice the pairs, and pairs that are linked are found."""
    tested, linked = [], near_dedup.Linker.linked
    monkeypatch.setattr(near_dedup.Linker, "linked", lambda self, pairs: tested.append(pairs.count()) or linked(self, pairs))
    passage, counts = cases.words(328, 61), []
    for n in (125, 250, 500):
        texts = [passage + " " + " ".join(f"own{i}x{k}" for k in range(72)) for i in range(n)]
        texts += [altered(t, 5, 900 + i) for i, t in enumerate(texts[: n // 25])]
        docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(4)
        same = bytes(2 * near_dedup.BANDS * 8)
        nodes = docs.select("id", F.lit(398).cast("bigint").alias("n_shingles"), F.lit(same).alias("registers"))
        tested.clear()
        labels = {r.id: r.component for r in near_dedup.links(docs, nodes, 3, 85, 8).collect()}
        assert labels == {i: i % n for k in range(n // 25) for i in (k, n + k)}
        counts.append(sum(tested))
    assert counts[0] < 2 * 125 and counts[2] < 2.2 * counts[1] < 5 * counts[0]


def test_edits_of_one_text_that_are_linked_with_each_other_only(spark):
    """The leader is linked with none of the others, which are all its edits; some share theirs."""
    base, texts = cases.words(300, 71), []
    for i in range(40):  # 22 words change as in the pair's other text, 2 more do not
        texts.append(altered(altered(base, 22, 500 + i // 2), 2, 700 + i))
    texts = [base, *texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    same = bytes(2 * near_dedup.BANDS * 8)
    nodes = frame.select("id", F.lit(298).cast("bigint").alias("n_shingles"), F.lit(same).alias("registers"))
    labels = {r.id: r.component for r in near_dedup.links(frame, nodes, 3, 85, 8).collect()}
    wanted = brute_groups(dict(enumerate(texts)), 3, 85)
    assert len(set(wanted.values())) > 15
    assert {i: labels.get(i, i) for i in wanted} == wanted


def test_components_of_a_long_path(spark):
    ids = list(range(50))
    random.Random(4).shuffle(ids)
    edges = [(min(a, b), max(a, b)) for a, b in zip(ids, ids[1:])] + [(100, 101), (101, 102)]
    got = near_dedup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.id: r.component for r in got} == {**{i: 0 for i in ids}, 100: 100, 101: 100, 102: 100}


def test_odd_documents_in_groups(spark):
    rows = cases.rows(near_dedup.near_duplicates(cases.documents(spark)))
    assert len(rows) == len(cases.TEXTS)
    found = {(i, n > 0): (component, kept) for i, n, component, kept in rows if i is not None}
    assert found[0, True] == (0, True) and found[1, True] == (0, False) and found[2, True] == (0, False)
    assert found[3, False] == (3, True) and found[4, False] == (4, True) and found[5, False] == (5, True)
    assert found[7, True] == (7, True) and found[8, True] == (7, False)
    keyless = sorted((str(component), kept) for i, _, component, kept in rows if i is None)
    assert keyless == [("0", False), ("None", False), ("None", True)]
    assert near_dedup.near_duplicates(cases.empty(spark)).count() == 0


def test_one_row_of_each_component_whatever_the_keys(spark):
    a, b, c, d = (cases.words(100, i) for i in range(301, 305))
    rows = [(3, a), (5, a), (5, b), (6, b + " more"), (7, d), (7, d), (8, None), (8, None), *[(None, c)] * 4]
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id bigint, text string, row int").repartition(3)
    kept = near_dedup.one_of_each(frame)
    assert kept.columns == frame.columns
    wanted = sorted(map(str, [(3, a), (5, b), (7, d), (8, None), (8, None), (None, c)]))
    assert sorted(str(tuple(r)) for r in kept.drop("row").collect()) == wanted
    got = near_dedup.near_duplicates(frame).collect()
    assert Counter((r.component_id, r.n_shingles > 0) for r in got if r.kept) == {
        (3, True): 1, (5, True): 1, (7, True): 1, (8, False): 2, (None, True): 1
    }
    assert len(got) == len(rows) and Counter(r.component_id for r in got) == {3: 2, 5: 2, 7: 2, 8: 2, None: 4}


# Line quality


def test_marginals_are_those_of_all_labellings():
    draw = np.random.default_rng(3)
    for length in (1, 2, 5):
        scores, step = draw.normal(size=length) * 2, draw.normal(size=(2, 2))
        total, good = 0.0, np.zeros(length)
        for states in itertools.product((0, 1), repeat=length):
            weight = math.exp(
                sum(s * x for s, x in zip(states, scores)) + sum(step[a, b] for a, b in zip(states, states[1:]))
            )
            total += weight
            good += weight * np.array(states)
        assert np.allclose(line_quality.marginals(scores, step), good / total)


def test_gradient_is_that_of_the_likelihood():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(3, 4, line_quality.WIDTH))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], bool)
    x[~mask] = 0
    y = np.array([1, 0, 1])

    def likelihood(weights):
        total = 0.0
        step = weights[-4:].reshape(2, 2)
        for i in range(3):
            n = mask[i].sum()
            scores = x[i, :n] @ weights[:-4]
            ways = [
                sum(s * v for s, v in zip(states, scores)) + sum(step[a, b] for a, b in zip(states, states[1:]))
                for states in itertools.product((0, 1), repeat=n)
            ]
            total += y[i] * scores.sum() + step[y[i], y[i]] * (n - 1) - np.logaddexp.reduce(ways)
        return total

    weights = draw.normal(size=line_quality.WIDTH + 4) * 0.1
    model = line_quality.Model(weights[:-4], weights[-4:].reshape(2, 2))
    emission, steps = line_quality._gradient(x, mask, y, model)
    found = np.concatenate([emission, steps.ravel()])
    for at in (0, 7, 33, line_quality.WIDTH, line_quality.WIDTH + 3):
        up, down = weights.copy(), weights.copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        assert abs((likelihood(up) - likelihood(down)) / 2e-5 - found[at]) < 1e-5


def test_quality_of_documents_held_out(spark, small):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    got = op3_line_crf_quality(spark, small).collect()
    assert len(got) == spark.read.parquet(f"{small}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    tested = [r for r in got if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in tested)
    bad, good = ([r.score for r in tested if labels[r.doc_id] == y] for y in (0, 1))
    ordered = sum(b < g for b in bad for g in good) / (len(bad) * len(good))
    assert right >= 0.95 * len(tested) and ordered > 0.97


def test_held_out_labels_are_never_learned(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    labels = spark.read.parquet(f"{tiny}/labels.parquet")
    turned = labels.withColumn("quality", F.when(line_quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = line_quality.learned(docs, labels), line_quality.learned(docs, turned)
    assert np.array_equal(a.emission, b.emission) and np.array_equal(a.step, b.step)
    one_class = line_quality.learned(docs, labels.where("quality = 1"))
    assert not one_class.emission.any()
    assert line_quality.scored(docs, one_class).where("score <> 0.5").count() == 0


def test_odd_documents_score(spark, tiny):
    model = line_quality.Model(np.full(line_quality.WIDTH, 0.1), np.eye(2))
    rows = line_quality.scored(cases.documents(spark), model).collect()
    assert len(rows) == len(cases.TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 5)}) == 1
    assert all(r.held_out is False for r in rows if r.doc_id is None)
    assert line_quality.scored(cases.empty(spark), model).count() == 0
    nothing = cases.empty(spark).withColumn("quality", F.lit(1)).withColumn("toxic", F.lit(None).cast("int"))
    assert not line_quality.learned(cases.documents(spark), nothing).emission.any()


# Sampled segmentations


@pytest.fixture(scope="module")
def lattice():
    return segment_sampling.lattice_of(tokenizer_path("piece_bpe_32k.model"))


def all_segmentations(text: str, lattice) -> dict[tuple, float]:
    """Every segmentation of a short text and its probability."""
    pieces = dict(zip(lattice.ids.tolist(), lattice.scores.tolist()))
    by_text = {lattice.model.id_to_piece(i): (i, w) for i, w in pieces.items()}
    found = {}

    def grow(at, ids, weight):
        if at == len(text):
            found[tuple(ids)] = math.exp(weight)
        for end in range(at + 1, min(len(text), at + lattice.longest) + 1):
            if text[at:end] in by_text:
                i, w = by_text[text[at:end]]
                grow(end, [*ids, i], weight + w)

    grow(0, [], 0.0)
    total = sum(found.values())
    return {k: v / total for k, v in found.items()}


def drawn(texts, lattice, k):
    seeds = np.arange(len(texts), dtype=np.uint64) * np.uint64(7919)
    group = segment_sampling.Group(segment_sampling.Region(texts, lattice), 0, len(texts), seeds)
    found, after = group.samples(k)
    result = [[] for _ in texts]
    for path, documents, score in found:
        flat, owner = group.ids(path)
        cuts = np.searchsorted(owner, np.arange(group.n + 1))
        log = np.bincount(path.document, path.log, group.n)
        for d, s in zip(documents.tolist(), score.tolist()):
            result[d].append((tuple(flat[cuts[d] : cuts[d + 1]].tolist()), log[d], s))
    return result, after


def test_samples_follow_the_distribution_without_replacement(lattice):
    text, n = lattice.model.normalize("to a cat"), 6000
    wanted = all_segmentations(text, lattice)
    got, after = drawn([text] * n, lattice, 3)
    first = Counter(r[0][0] for r in got)
    top = max(wanted, key=wanted.get)
    for ids, p in wanted.items():
        assert abs(first[ids] / n - p) < 4 * math.sqrt(p / n) + 1e-3
    second = Counter(r[1][0] for r in got if r[0][0] == top)
    total = sum(second.values())
    for ids, p in wanted.items():
        q = 0 if ids == top else p / (1 - wanted[top])
        assert abs(second[ids] / total - q) < 4 * math.sqrt(q / total) + 1e-3
    estimates = []
    for rows, bound in zip(got, after, strict=True):
        assert len({r[0] for r in rows}) == 3
        assert rows[0][2] >= rows[1][2] >= rows[2][2] >= bound
        assert all(abs(math.exp(r[1]) - wanted[r[0]]) < 1e-9 for r in rows)
        estimates.append(sum(math.exp(r[1]) / -math.expm1(-math.exp(r[1] - bound)) for r in rows))
    assert abs(np.mean(estimates) - 1) < 0.02


def test_all_segmentations_come_out_when_enough_are_asked_for(lattice):
    text = lattice.model.normalize("to it")
    wanted = all_segmentations(text, lattice)
    got, after = drawn([text, ""], lattice, len(wanted) + 3)
    assert {r[0] for r in got[0]} == set(wanted) and len(got[0]) == len(wanted)
    assert [r[0] for r in got[1]] == [()] and after.tolist() == [-math.inf, -math.inf]


def test_neighbours_do_not_matter(lattice):
    texts = [lattice.model.normalize(t) for t in ("one two three", cases.words(60, 3), "", "漢字 😀\nça va", cases.PLAIN)]
    together, _ = drawn(texts, lattice, 3)
    for i, text in enumerate(texts):
        group = segment_sampling.Group(segment_sampling.Region([text], lattice), 0, 1, np.array([i * 7919], np.uint64))
        found, _ = group.samples(3)
        assert [tuple(group.ids(p)[0].tolist()) for p, d, _ in found if len(d)] == [r[0] for r in together[i]]


def test_remembered_units_do_not_matter(lattice, monkeypatch):
    texts = [lattice.model.normalize(cases.words(50, i % 7) + " again and again") for i in range(20)]
    together, _ = drawn(texts, lattice, 2)
    monkeypatch.setattr(segment_sampling, "REMEMBERED_CELLS", 300)
    monkeypatch.setattr(lattice, "known", {})
    monkeypatch.setattr(lattice, "units", segment_sampling.units_of([], lattice))
    for i, text in enumerate(texts):
        group = segment_sampling.Group(segment_sampling.Region([text], lattice), 0, 1, np.array([i * 7919], np.uint64))
        found, _ = group.samples(2)
        assert [tuple(group.ids(p)[0].tolist()) for p, _, _ in found] == [r[0] for r in together[i]]
        assert len(lattice.known) == len(lattice.units.begin) <= 200


def test_every_sample_decodes_to_its_text(spark, tiny, lattice):
    got = op7_sampled_segmentations(spark, tiny).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    assert Counter(r.doc_id for r in got) == {i: 2 for i in texts}
    assert all(r.round_trip and 0 <= r.inclusion <= 1 for r in got)
    assert len({(r.doc_id, r.ids_crc32) for r in got}) == len(got)
    docs = spark.read.parquet(f"{tiny}/documents.parquet").where("doc_id < 20")
    with_ids = segment_sampling.segmentations(docs, tokenizer_path("piece_bpe_32k.model"), ids=True).collect()
    known = {(r.doc_id, r.sample): r.ids_crc32 for r in got}
    for r in with_ids:
        assert lattice.model.decode(list(r.ids)) == texts[r.doc_id]
        assert zlib.crc32(np.asarray(r.ids, "<i4").tobytes()) == known[r.doc_id, r.sample] == r.ids_crc32
        assert r.n_pieces == len(r.ids)


def test_odd_documents_are_sampled(spark):
    path = tokenizer_path("piece_bpe_32k.model")
    rows = segment_sampling.segmentations(cases.documents(spark), path, k=3).collect()
    per = Counter(r.doc_id for r in rows)
    assert per[3] == per[4] == 1 and per[8] == 6 and per[6] == 3 and per[None] == 9
    assert all(r.round_trip for r in rows) and all(r.inclusion == 1 for r in rows if r.doc_id in (3, 4))
    assert len({(r.sample, r.ids_crc32) for r in rows if r.doc_id == 8}) == 3
    assert segment_sampling.segmentations(cases.empty(spark), path).count() == 0


def test_leaders_are_marked_without_a_join(spark):
    from pyspark.sql import functions as F

    from quitanda.llm.near_dedup import with_leaders

    rows = [(band, i, 5 if band == 2 else i // 7) for band in range(4) for i in range(band * 20)]
    members = spark.createDataFrame(rows, "band bigint, id bigint, component bigint")
    marked = with_leaders(members, F.col("id") % 4)
    assert "Join" not in marked._jdf.queryExecution().optimizedPlan().toString()
    split = [(b, i) for b, i, _ in rows if b in (1, 3)]  # band 2 is one component
    found = marked.collect()
    assert sorted((r.band, r.id) for r in found) == split
    assert {(r.band, r.id) for r in found if r.leads} == {(b, i) for b, i in split if i < 4}
