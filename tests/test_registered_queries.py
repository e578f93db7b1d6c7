"""Every registered query against its SQL twin, and the golden numbers."""

from __future__ import annotations

import pytest
from compare import differences, duck
from pyspark.sql import functions as F

import __spark_entry__ as registered
from quitanda.workload.oracle import all_oracles
from quitanda.workload.queries import all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con(tiny):
    return duck(tiny)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, con, tiny):
    assert differences(QUERIES[name](spark, tiny), con, ORACLES[name]) is None


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_golden_totals(spark, small):
    totals = QUERIES["gold_vendas_totais"](spark, small).first()
    assert (totals.total_vendas, totals.receita_total) == (45832, 61852500910.63)
    assert (totals.vendas_produto_nao_cadastrado, totals.vendas_antes_do_cadastro) == (489, 9006)
    assert QUERIES["gold_preco_competitivo_resumo"](spark, small).first().precos_suspeitos == 3180
    hours = QUERIES["gold_vendas_temporais"](spark, small).agg(F.count("*"), F.sum("total_vendas")).first()
    assert tuple(hours) == (164, 514)


@pytest.mark.parametrize("name", ["check_segments", "check_prices", "check_honorifics"])
def test_golden_checks_pass(name, spark, small):
    report = QUERIES[name](spark, small).collect()
    assert report and all(r.aprovada for r in report), report


@pytest.mark.parametrize("name", ["check_segments", "check_prices", "check_detail", "check_documentation"])
def test_checks_pass_at_another_scale(name, spark, tiny):
    report = QUERIES[name](spark, tiny).collect()
    assert report and all(r.aprovada for r in report if r.verificacao != "vendas_sem_segmento_ou_regiao"), report


def test_golden_counts(spark, small):
    seen = {r.verificacao: int(r.observado) for n in ("check_segments", "check_prices") for r in QUERIES[n](spark, small).collect()}
    assert (seen["clientes_VIP"], seen["clientes_TOP_TIER"], seen["clientes_REGULAR"]) == (103, 42, 1355)
    assert (seen["produtos_na_visao_de_precos"], seen["mais_caros_que_todos"]) == (2000, 330)


def test_regions_come_by_number_of_customers(spark, small):
    rows = QUERIES["gold_clientes_por_regiao"](spark, small).collect()
    counts = [r.total_clientes for r in rows]
    assert len(rows) == 5 and counts == sorted(counts, reverse=True)


def test_profile_distinct_is_close(spark, tiny):
    from quitanda.operators.profile import profile
    from quitanda.sources import benchmark_tables as raw

    near = {r.coluna: r for r in profile(raw.vendas(spark, tiny)).collect()}
    for r in QUERIES["profile_vendas_distinct"](spark, tiny).collect():
        assert abs(near[r.coluna].distintos_aprox - r.distintos) <= 0.15 * r.distintos
