"""Registered queries against SQL, and the pipeline's stages against plain Python."""

from __future__ import annotations

import re
from collections import Counter

import cases
import pytest
from compare import differences, duck
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from quitanda.llm import quality_rules, segment_sampling
from quitanda.llm.oracle import llm_oracles
from quitanda.llm.queries import llm_queries, tokenizer_path


def test_every_operator_is_registered():
    names = [n for n in registered.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(llm_queries()) == set(names) and "pipeline" in registered.queries()


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_matches_sql(name, spark, tiny):
    assert differences(llm_queries()[name](spark, tiny), duck(tiny), llm_oracles()[name]) is None


def shingles(text: str, n: int) -> set:
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not found:
        return set()
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if len(found) >= n else {tuple(found)}


def groups(texts: dict[int, str], n: int, percent: int) -> dict[int, int]:
    """The least id of every document's component, by comparing all pairs."""
    sets, least = {i: shingles(t, n) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                least[y] = x
    return {i: find(i) for i in ids}


def test_pipeline_stages_do_what_they_say(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "secrets", "mix", "segmentations"]
    texts = {r.doc_id: r.text for r in docs.collect()}

    kept = stages["quality_rules"](spark, docs, tiny).cache()
    assert kept.columns == columns
    mask = quality_rules.POLICIES[quality_rules.CURRENT]
    ledger = {r.doc_id: r.failed_bits for r in quality_rules.ledger(docs).collect()}
    wanted = {i for i in texts if ledger[i] & mask == 0}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == wanted and 0 < len(wanted) < len(texts)

    single = stages["near_duplicates"](spark, kept, tiny).cache()
    least = groups({i: texts[i] for i in wanted}, 5, 80)
    assert {r.doc_id for r in single.select("doc_id").collect()} == {i for i in wanted if least[i] == i}
    assert single.columns == columns

    clean = stages["secrets"](spark, single, tiny).cache()
    assert clean.columns == columns and clean.count() == single.count()
    for r in clean.collect():
        assert r.n_chars == len(r.text)
        assert not re.search(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}", r.text)
        if "[REDACTED]" not in r.text:
            assert r.text == texts[r.doc_id]

    mixed = stages["mix"](spark, clean, tiny).cache()
    assert mixed.columns == columns
    times = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert 0 < max(times.values()) <= 3 and set(times) < {r.doc_id for r in clean.select("doc_id").collect()}

    final = stages["segmentations"](spark, mixed, tiny)
    per_document = Counter(r.doc_id for r in final.where("round_trip").select("doc_id").collect())
    assert all(per_document[i] == 2 * n for i, n in times.items())
    whole = corpus_pipeline.run(spark, tiny)
    assert sorted(map(str, whole.collect())) == sorted(map(str, final.collect()))
    spark.catalog.clearCache()


def test_pipeline_gets_over_odd_documents(spark, tiny):
    docs = cases.documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tiny)
        assert docs.columns == cases.documents(spark).columns, name
    final = corpus_pipeline.STAGES[-1][1](spark, docs, tiny)
    assert final.where("round_trip").count() == final.count() > 0
    none = cases.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, tiny)
    assert none.count() == 0


def test_pipeline_ends_with_the_ids_of_its_texts(spark, tiny):
    model = segment_sampling.lattice_of(tokenizer_path("piece_bpe_32k.model")).model
    docs = spark.read.parquet(f"{tiny}/documents.parquet").where("doc_id < 20")
    texts = {r.doc_id: r.text for r in docs.collect()}
    final = corpus_pipeline.STAGES[-1][1](spark, docs, tiny).collect()
    assert {r.doc_id for r in final} == set(texts)
    assert all(model.decode(list(r.ids)) == texts[r.doc_id] and len(r.ids) == r.n_pieces for r in final)


def test_near_duplicate_stage_keeps_one_document_of_each_group(spark, tiny):
    kept = corpus_pipeline.deduplicated(spark, cases.documents(spark), tiny)
    texts = Counter(r.text for r in kept.select("text").collect())
    assert texts[cases.PLAIN] == 1 and texts[cases.PLAIN.upper()] == 0 and texts[cases.PLAIN + " one more"] == 0
    assert kept.where(F.col("doc_id") == 3).count() == kept.where(F.col("doc_id") == 4).count() == 1
