"""Cleaned tables, marts and metrics on hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from quitanda.plans import gold, kpi, silver
from quitanda.settings import Period, SegmentLimits

DAY = dt.date(2026, 1, 5)
PERIOD = Period.of("2026-01-01", "2026-01-31")


def at(day: int, hour: int = 12, month: int = 1) -> dt.datetime:
    return dt.datetime(2026, month, day, hour)


@pytest.fixture(scope="module")
def raw(spark):
    return {
        "produtos": spark.createDataFrame(
            [
                (1, "  big BALL ", "Toys", "Acme", "1500.00", at(4), "x1"),
                (1, "zz copy", "Toys", "Acme", "1.00", at(4), "x2"),
                (2, "kite", None, None, "600", at(1), "x3"),
                (3, "rope", "Garden", "Knot", "cheap", at(1), "x4"),
                (None, "lost", "Toys", "Acme", "5", at(1), "x5"),
                (None, "lost", "Toys", "Acme", "5", at(1), "x5"),
            ],
            "id_produto bigint, nome_produto string, categoria string, marca string, preco_atual string, "
            "data_criacao timestamp_ntz, extra string",
        ),
        "clientes": spark.createDataFrame(
            [
                (10, "Sr. João silva", " sp"),
                (10, "Zé", "RJ"),
                (11, "DRA. ANA", "mg"),
                (12, "Drauzio", "xx"),
                (None, "ninguém", "SP"),
            ],
            "id_cliente bigint, nome_cliente string, estado string",
        ),
        "vendas": spark.createDataFrame(
            [
                (100, at(5, 9), 10, 1, 2, "1000.00", "ecommerce"),
                (100, at(6, 9), 10, 1, 3, "1000.00", "ecommerce"),
                (101, at(3, 23), 10, 1, 1, "10.00", "loja_fisica"),
                (102, at(5, 9), 11, 99, 1, "50.005", "ecommerce"),
                (103, at(5, 9), 11, None, 1, "1.00", "ecommerce"),
                (104, at(20, 0, 2), 11, 2, 4, "2.50", "telefone"),
                (None, at(5, 9), 77, 2, 1, "7.00", "loja_fisica"),
                (None, at(5, 9), 77, 2, 1, "7.00", "loja_fisica"),
            ],
            "id_venda bigint, data_venda timestamp_ntz, id_cliente bigint, id_produto bigint, quantidade int, "
            "preco_unitario string, canal_venda string",
        ),
        "precos": spark.createDataFrame(
            [
                (1, "A", "2026-01-01 10:00:00", "899.99"),
                (1, "A", "2026-01-02 10:00:00", "1.00"),
                (1, "B", "someday", "1600.00"),
                (2, "A", "2026-01-01", "0.00"),
                (2, "B", "2026-01-01", "0.01"),
                (3, "A", "2026-01-01", "10"),
                (88, "A", "2026-01-01", "0.50"),
                (None, "A", "2026-01-01", "1"),
                (None, "A", "2026-01-01", "1"),
            ],
            "id_produto bigint, nome_concorrente string, data_coleta string, preco_concorrente string",
        ),
    }


@pytest.fixture(scope="module")
def clean(raw):
    produtos = silver.silver_produtos(raw["produtos"])
    return {
        "produtos": produtos,
        "clientes": silver.silver_clientes(raw["clientes"]),
        "vendas": silver.silver_vendas(raw["vendas"], produtos),
        "precos": silver.silver_preco_competidores(raw["precos"], produtos, ["data_coleta"]),
    }


def by(df, key):
    return {r[key]: r for r in df.where(F.col(key).isNotNull()).collect()}


def test_silver_produtos(clean):
    found = by(clean["produtos"], "id_produto")
    assert (found[1].nome_produto, found[1].preco_atual, found[1].faixa_preco) == ("big BALL", D("1500.00"), "PREMIUM")
    assert found[1].extra == "x1"
    assert (found[2].faixa_preco, found[3].preco_atual, found[3].faixa_preco) == ("MEDIO", None, "BASICO")
    assert clean["produtos"].count() == 5


def test_silver_clientes(clean):
    found = by(clean["clientes"], "id_cliente")
    joao = found[10]
    assert (joao.nome_cliente, joao.nome_original, joao.estado) == ("João Silva", "Sr. João silva", "SP")
    assert (joao.nome_estado, joao.regiao) == ("São Paulo", "Sudeste")
    assert found[11].nome_cliente == "Ana"
    assert (found[12].nome_cliente, found[12].estado, found[12].regiao) == ("Drauzio", "XX", None)
    assert clean["clientes"].count() == 4


def test_silver_vendas(clean):
    vendas = clean["vendas"]
    found = by(vendas, "id_venda")
    assert vendas.count() == 7 and vendas.where("id_venda is null").count() == 2
    first = found[100]
    assert (first.quantidade, first.receita, first.data, first.hora) == (2, D("2000.00"), DAY, 9)
    assert (first.dia_semana_num, first.dia_semana) == (2, "Segunda")
    flags = {i: (r.produto_cadastrado, r.venda_antes_do_cadastro, r.venda_depois_do_cadastro) for i, r in found.items()}
    assert flags == {
        100: (True, False, True),
        101: (True, True, False),
        102: (False, False, True),
        103: (False, False, True),
        104: (True, False, True),
    }
    assert found[102].preco_unitario == D("50.01")


def test_silver_preco_competidores(clean):
    rows = clean["precos"].collect()
    assert len(rows) == 8 and sum(r.id_produto is None for r in rows) == 2
    found = {(r.id_produto, r.nome_concorrente): r for r in rows}
    assert (found[1, "A"].preco_concorrente, found[1, "A"].preco_suspeito) == (D("899.99"), True)
    assert found[1, "A"].data_coleta == dt.datetime(2026, 1, 1, 10)
    assert (found[1, "B"].data_coleta, found[1, "B"].preco_suspeito) == (None, False)
    assert (found[88, "A"].preco_atual, found[88, "A"].preco_suspeito) == (None, False)
    assert found[3, "A"].preco_suspeito is False


def test_clientes_segmentacao(clean):
    limits = SegmentLimits(D("2000"), D("51"))
    mart = gold.clientes_segmentacao(clean["clientes"], clean["vendas"], PERIOD, limits)
    found = by(mart, "id_cliente")
    assert (found[10].total_compras, found[10].receita, found[10].ticket_medio) == (2, D("2010.00"), D("1005.00"))
    assert (found[10].primeira_compra, found[10].ultima_compra) == (at(3, 23), at(5, 9))
    assert [found[i].segmento_cliente for i in (10, 11, 12)] == ["VIP", "TOP_TIER", "REGULAR"]
    assert (found[12].total_compras, found[12].receita, found[12].ticket_medio) == (0, D("0.00"), None)
    assert sorted(r.ranking_receita for r in mart.collect()) == [1, 2, 3, 4]
    assert mart.columns == [
        "id_cliente", "nome_cliente", "estado", "nome_estado", "regiao", "total_compras", "receita", "ticket_medio",
        "primeira_compra", "ultima_compra", "segmento_cliente", "ranking_receita",
    ]


def test_vendas_temporais(clean):
    rows = gold.vendas_temporais(clean["vendas"], PERIOD).collect()
    found = {(r.data, r.hora, r.canal_venda): r for r in rows}
    assert len(found) == len(rows) == 3
    busy = found[DAY, 9, "ecommerce"]
    assert (busy.total_vendas, busy.itens_vendidos, busy.receita, busy.clientes_unicos) == (3, 4, D("2051.01"), 2)
    assert found[DAY, 9, "loja_fisica"].total_vendas == 2
    assert gold.vendas_temporais(clean["vendas"], None).count() == 4


def test_vendas_produtos(clean):
    rows = gold.vendas_produtos(clean["vendas"], clean["produtos"]).collect()
    found = {r.id_produto: r for r in rows}
    assert len(rows) == 4
    assert (found[1].nome_produto, found[1].categoria, found[1].ranking_receita) == ("Big Ball", "Toys", 1)
    assert (found[2].categoria, found[2].marca, found[2].produto_cadastrado) == ("Não cadastrado", "Não cadastrado", True)
    for unknown in (99, None):
        r = found[unknown]
        assert (r.nome_produto, r.faixa_preco, r.produto_cadastrado) == ("Produto nao cadastrado", "Não cadastrado", False)
    inside = {r.id_produto: r.ranking_na_categoria for r in rows if r.categoria == "Não cadastrado"}
    assert inside == {99: 1, 2: 2, None: 3}


def test_vendas_detalhadas(clean):
    segments = gold.customer_segments(clean["clientes"], clean["vendas"], PERIOD)
    detail = gold.vendas_detalhadas(clean["vendas"], clean["produtos"], segments)
    assert detail.count() == clean["vendas"].count() and len(detail.columns) == 23
    found = by(detail, "id_venda")
    assert (found[101].nome_produto, found[101].venda_antes_do_cadastro, found[101].regiao) == ("Big Ball", True, "Sudeste")
    assert (found[103].nome_produto, found[103].nome_cliente) == ("Produto nao cadastrado", "Ana")
    stranger = detail.where("id_cliente = 77").first()
    assert (stranger.segmento_cliente, stranger.regiao) == (None, None)


def test_precos_competitividade(clean):
    mart = gold.precos_competitividade(clean["produtos"], clean["precos"], clean["vendas"], PERIOD)
    found = by(mart, "id_produto")
    ball = found[1]
    assert (ball.preco_medio_concorrentes, ball.total_concorrentes) == (D("1250.00"), 2)
    assert (ball.diferenca_pct_vs_media, ball.diferenca_pct_vs_minimo) == (D("20.00"), D("66.67"))
    assert (ball.classificacao_preco, ball.possui_preco_suspeito) == ("MAIS_CARO_QUE_MEDIA", True)
    assert (ball.receita, ball.itens_vendidos) == (D("2010.00"), 3)
    # The mean 0.005 rounds to 0.01, the lowest price is 0.
    assert (found[2].preco_medio_concorrentes, found[2].diferenca_pct_vs_minimo) == (D("0.01"), D("0.00"))
    assert found[2].classificacao_preco == "MAIS_CARO_QUE_TODOS"
    # Our price is unknown: it counts as 0, and no competitor is suspicious.
    assert (found[3].nosso_preco, found[3].classificacao_preco) == (D("0.00"), "MAIS_BARATO_QUE_TODOS")
    assert (found[3].possui_preco_suspeito, found[3].receita) == (False, D("0.00"))
    lost = mart.where("id_produto is null").collect()
    assert len(lost) == 2 and lost[0].possui_preco_suspeito is None and lost[0].total_concorrentes == 0
    only = gold.precos_competitividade(clean["produtos"], clean["precos"], clean["vendas"], PERIOD, True)
    assert set(by(only, "id_produto")) == {1, 2, 3} and only.count() == 3


def test_suspicion_from_the_lowest_price_equals_any_flag(clean):
    mart = by(gold.precos_competitividade(clean["produtos"], clean["precos"], clean["vendas"], PERIOD), "id_produto")
    flags = by(clean["precos"].groupBy("id_produto").agg(F.bool_or("preco_suspeito").alias("f")), "id_produto")
    assert {i: r.possui_preco_suspeito for i, r in mart.items()} == {i: flags[i].f for i in mart}


def test_summaries(clean):
    totals = gold.vendas_totais(clean["vendas"]).first()
    assert (totals.total_vendas, totals.receita_total) == (7, D("2085.01"))
    assert (totals.vendas_produto_nao_cadastrado, totals.vendas_antes_do_cadastro) == (2, 1)
    nothing = gold.vendas_totais(clean["vendas"].where("false")).first()
    assert (nothing.total_vendas, nothing.receita_total, nothing.vendas_antes_do_cadastro) == (0, None, None)
    regions = gold.clientes_por_regiao(clean["clientes"]).collect()
    assert [tuple(r) for r in regions] == [("Sudeste", 3, 2)]
    bands = gold.produtos_por_faixa_preco(clean["produtos"]).collect()
    assert [(r.faixa_preco, r.total_produtos) for r in bands] == [("PREMIUM", 1), ("MEDIO", 1), ("BASICO", 3)]
    prices = gold.preco_competitivo_resumo(clean["precos"]).first()
    assert (prices.total_precos_competidores, prices.precos_suspeitos, prices.min_preco_concorrente) == (8, 3, D("0.00"))


def test_lifetime_value(clean):
    found = by(kpi.lifetime_value(clean["vendas"]), "id_cliente")
    assert (found[11].ltv, found[11].meses_ativos, found[11].valor_mensal_medio) == (D("61.01"), 2, D("30.51"))
    assert (found[10].meses_ativos, found[10].valor_mensal_medio) == (1, D("2010.00"))


def test_acquisition_cost(spark):
    spend = spark.createDataFrame([(DAY, D("10.00")), (DAY, D("5.00")), (dt.date(2026, 1, 7), D("3.00"))], "data date, valor decimal(18,2)")
    bought = spark.createDataFrame(
        [(1, DAY), (1, dt.date(2026, 1, 6)), (2, DAY), (3, dt.date(2026, 1, 6))], "id_cliente bigint, data date"
    )
    rows = {r.periodo.day: tuple(r)[1:] for r in kpi.acquisition_cost(spend, bought).collect()}
    assert rows == {5: (D("15.00"), 2, D("7.50")), 6: (D("0.00"), 1, D("0.00")), 7: (D("3.00"), 0, None)}
    month = kpi.acquisition_cost(spend, bought, "MONTH").collect()
    assert [tuple(r) for r in month] == [(dt.date(2026, 1, 1), D("18.00"), 3, D("6.00"))]


def test_conversion_and_drop(spark):
    events = [(1, u, "view") for u in range(4)] + [(1, u, "purchase") for u in (0, 1, 9)]
    events += [(2, u, "view") for u in range(4)] + [(2, 0, "purchase"), (2, 0, "purchase"), (3, 0, "view")]
    df = spark.createDataFrame(
        [(dt.date(2026, 1, d), u, k) for d, u, k in events], "data date, id_cliente bigint, event_type string"
    )
    days = kpi.conversion_drops(kpi.conversion_by_day(df)).orderBy("data").collect()
    assert [(r.visitantes, r.compradores, r.taxa_conversao) for r in days] == [
        (4, 2, D("0.5000")), (4, 1, D("0.2500")), (1, 0, D("0.0000")),
    ]
    mild = kpi.conversion_drops(kpi.conversion_by_day(df), D("0.50")).orderBy("data").collect()
    assert [r.alerta for r in mild] == [False, False, True]
    assert [(r.queda_relativa, r.alerta) for r in days] == [(None, False), (D("0.5000"), True), (D("1.0000"), True)]


def test_a_small_drop_is_not_rounded_away(spark):
    days = spark.createDataFrame(
        [(dt.date(2026, 1, 1), 3, 1), (dt.date(2026, 1, 2), 4, 1)], "data date, visitantes bigint, compradores bigint"
    )
    last = kpi.conversion_drops(days).orderBy("data").collect()[1]
    assert (last.queda_relativa, last.alerta) == (D("0.2500"), True)


def test_churn(spark):
    before, now = Period.of("2026-01-01", "2026-01-03"), Period.of("2026-01-04", "2026-01-06")
    active = spark.createDataFrame(
        [(1, dt.date(2026, 1, 1)), (1, dt.date(2026, 1, 4)), (2, dt.date(2026, 1, 3)), (3, dt.date(2026, 1, 5)), (None, dt.date(2026, 1, 1))],
        "id_cliente bigint, data date",
    )
    assert tuple(kpi.churn(active, before, now).first()) == (2, 1, D("0.5000"))
    groups = spark.createDataFrame([(1, "A"), (2, "B"), (3, "B")], "id_cliente bigint, g string")
    rows = {r.g: (r.ativos_antes, r.perdidos) for r in kpi.churn(active, before, now, groups).collect()}
    assert rows == {"A": (1, 0), "B": (1, 1)}


def test_hourly_sketches_roll_up(spark):
    """Within four standard errors of 60,000 customers who come at many hours; none for sales without a customer."""
    sales = spark.range(240_000).selectExpr(
        "date'2026-01-01' + cast(id % 3 as int) as data", "cast(id % 24 as int) as hora", "if(id % 2 = 0, 'loja', 'site') as canal_venda",
        "1 as quantidade", "cast(1 as decimal(18,2)) as receita", "id % 60000 as id_cliente",
    )
    nobody = sales.limit(4).withColumns({"id_cliente": F.lit(None).cast("bigint"), "canal_venda": F.lit("anon")})
    hours = gold.hourly_customers(sales.unionByName(nobody), None)
    whole = gold.rolled_up(hours).first()
    assert whole.total_vendas == 240_004 and abs(whole.clientes_aprox - 60_000) <= 60_000 * 0.065
    channels = {r.canal_venda: (r.total_vendas, r.clientes_aprox) for r in gold.rolled_up(hours, "canal_venda").collect()}
    assert channels["anon"] == (4, 0)
    assert all(abs(channels[c][1] - 30_000) <= 30_000 * 0.065 for c in ("loja", "site"))
    assert gold.rolled_up(hours.limit(0), "data").count() == 0 and gold.rolled_up(hours.limit(0)).first().clientes_aprox == 0


def test_churn_of_many_pairs(spark):
    """Every pair equals ``churn``, over word borders, before 1970, for over 60 periods and without any customer."""
    start = dt.date(1969, 11, 20)
    rows = [(i % 9, start + dt.timedelta((i * i * 7 + i) % 140)) for i in range(60)]
    active = spark.createDataFrame([*rows, *rows[:5], (None, start), (3, None)], "id_cliente bigint, data date")
    days = kpi.active_days(active)

    def period(first, n):
        return Period(start + dt.timedelta(first), start + dt.timedelta(first + n - 1))

    pairs = [(period(a, n), period(a + n, n)) for n in (1, 7, 65) for a in range(0, 70, 3)]
    got = kpi.churn_pairs(days, pairs).collect()
    seen = {}
    for c, d in rows:
        seen.setdefault(c, set()).add(d)
    inside = lambda p: {c for c, ds in seen.items() if any(p.first <= d <= p.last for d in ds)}
    assert len({p for pair in pairs for p in pair}) > 60
    assert {(r.inicio_antes, r.fim_antes, r.inicio, r.fim): (r.ativos_antes, r.perdidos) for r in got} == {
        (b.first, b.last, n.first, n.last): (len(inside(b)), len(inside(b) - inside(n))) for b, n in pairs
    }
    one = kpi.churn_pairs(days, pairs[30:31]).drop("inicio_antes", "fim_antes", "inicio", "fim").collect()
    assert one == kpi.churn(active, *pairs[30]).collect()
    empty = kpi.churn_pairs(days.limit(0), pairs[:2]).collect()
    assert [(r.ativos_antes, r.perdidos, r.taxa_churn) for r in empty] == [(0, 0, None)] * 2
    groups = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(8)], "id_cliente bigint, g string")
    split = {(r.g, r.ativos_antes, r.perdidos, r.taxa_churn) for r in kpi.churn_pairs(days, pairs[30:31], groups).collect()}
    assert split == {tuple(r) for r in kpi.churn(active, *pairs[30], groups).collect()}


def test_revenue_cube_keeps_missing_and_subtotals_apart(spark):
    df = spark.createDataFrame([("a", None, D("1.00")), ("a", "x", D("2.00"))], "g string, h string, receita decimal(18,2)")
    rows = {(r.g, r.h, r.nivel): r.receita for r in kpi.revenue_cube(df, ["g", "h"]).collect()}
    assert rows == {
        ("a", None, 0): 1, ("a", "x", 0): 2, ("a", None, 1): 3, (None, None, 2): 1, (None, "x", 2): 2, (None, None, 3): 3,
    }


def test_abc_curve(spark):
    df = spark.createDataFrame([(1, D("80.00")), (2, D("15.00")), (3, D("4.00")), (4, D("1.00")), (5, None)], "id_produto bigint, receita decimal(18,2)")
    rows = {r.id_produto: (r.classe, r.posicao, r.receita_acumulada) for r in kpi.abc_curve(df).collect()}
    assert rows == {1: ("A", 1, 80), 2: ("B", 2, 95), 3: ("C", 3, 99), 4: ("C", 4, 100), 5: ("C", 5, 100)}


def test_top_sellers(clean):
    top = kpi.top_sellers(clean["vendas"], 2).collect()
    assert [(r.id_produto, r.itens_vendidos) for r in top] == [(2, 6), (1, 3)]
    recent = kpi.top_sellers(kpi.last_days(clean["vendas"], 7), 5).collect()
    assert [(r.id_produto, r.itens_vendidos) for r in recent] == [(2, 4)]
    per_category = kpi.top_per_group(gold.product_sales(clean["vendas"], clean["produtos"]), 1, "categoria").collect()
    assert {(r.categoria, r.id_produto) for r in per_category} == {("Toys", 1), ("Não cadastrado", 2)}


def test_favourite_channel(clean):
    segments = gold.customer_segments(clean["clientes"], clean["vendas"], PERIOD, SegmentLimits(D("2000"), D("51")))
    rows = {r.segmento_cliente: (r.canal_venda, r.total_vendas) for r in kpi.favourite_channel(clean["vendas"], segments).collect()}
    assert rows == {"VIP": ("ecommerce", 1), "TOP_TIER": ("ecommerce", 2)}


def placed(seen):
    from quitanda.sources.sinks import clustered

    def by_day(df):
        seen.append(set(df.columns))
        return clustered(df, F.col("data_venda").cast("date"), "id_venda")

    return by_day


MADE_IN_PLACE = {"receita", "data", "hora", "dia_semana_num", "dia_semana"}


def test_silver_sales_move_without_columns_that_follow_from_others(raw, clean):
    seen = []
    moved = silver.silver_vendas(raw["vendas"], clean["produtos"], place=placed(seen))
    assert seen and not seen[0] & MADE_IN_PLACE
    assert moved.schema.simpleString() == clean["vendas"].schema.simpleString()
    assert sorted(map(str, moved.collect())) == sorted(map(str, clean["vendas"].collect()))
    assert "range" in moved._jdf.queryExecution().toString()


def test_detail_moves_without_columns_that_follow_from_others(clean):
    segments, seen = gold.customer_segments(clean["clientes"], clean["vendas"], PERIOD), []
    plain = gold.vendas_detalhadas(clean["vendas"], clean["produtos"], segments)
    moved = gold.vendas_detalhadas(clean["vendas"], clean["produtos"], segments, place=placed(seen))
    assert seen and not seen[0] & (MADE_IN_PLACE | {"produto_cadastrado", "data_criacao"})
    assert moved.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, moved.collect())) == sorted(map(str, plain.collect()))


def test_refresh_finds_hot_customers_in_the_stored_sales(spark, raw, monkeypatch):
    from quitanda.plans import refresh as plan
    from quitanda.session import new_location
    from quitanda.sources.sinks import into_files

    seen, count = {}, plan.hot_keys
    monkeypatch.setattr(plan, "hot_keys", lambda df, key: seen.setdefault(key, df) and count(df, key))
    sales = raw["vendas"].where("id_venda IS NOT NULL AND id_produto IS NOT NULL")
    tables = {
        "produtos": raw["produtos"].where("id_produto < 3"),
        "clientes": raw["clientes"].where("id_cliente IS NOT NULL"),
        "vendas": sales,
        "preco_competidores": raw["precos"],
    }
    plan.refresh(tables, into_files(new_location(spark, "warehouse")))
    assert seen["id_produto"] is sales and seen["id_cliente"].inputFiles()
