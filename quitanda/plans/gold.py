"""Marts. Inputs are the cleaned tables, whose keys are unique (see ``operators.checks``).

Sales are aggregated before they meet a dimension wherever the mart allows it: the join is then
one row to one row, and neither a best seller nor the many unknown products form a hot key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.functions import calendar, money, text
from quitanda.operators.lookup import lookup
from quitanda.operators.ordered import ordered_totals
from quitanda.settings import DEFAULT_LIMITS, DEFAULT_PERIOD, Period, SegmentLimits


def _average(value: str) -> Column:
    return F.round(F.avg(value), 2)


def vendas_temporais(vendas: DataFrame, period: Period | None = DEFAULT_PERIOD, stored: bool = False) -> DataFrame:
    """Sales per day, hour and channel. The weekday follows from the day, so it is no grouping key.

    ``stored``: sales are cheap to read twice, so customers are counted apart, on rows without any sums.
    """
    hours = ["data", "hora", "canal_venda"]
    sold = vendas.where(calendar.within(F.col("data"), period))
    sums = [F.count("*").alias("total_vendas"), F.sum("quantidade").alias("itens_vendidos"), F.sum("receita").alias("receita")]
    if stored:
        people = sold.select(*hours, "id_cliente").distinct().groupBy(*[F.col(c).alias(f"_{c}") for c in hours])
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in hours])
        counted = sold.groupBy(*hours).agg(*sums).join(people.agg(F.count("id_cliente").alias("clientes_unicos")), same)
    else:
        counted = sold.groupBy(*hours).agg(*sums, F.count_distinct("id_cliente").alias("clientes_unicos"))
    return (
        counted.withColumn("dia_semana_num", calendar.weekday_number(F.col("data")))
        .withColumn("dia_semana", calendar.weekday_name(F.col("dia_semana_num")))
        .select(
            "data", "dia_semana_num", "dia_semana", "hora", "canal_venda",
            "total_vendas", "itens_vendidos", "receita", "clientes_unicos",
        )
    )


# Log2 of a sketch's buckets; the relative standard error of a count is 1.04 / sqrt(2**12), about 1.6%.
SKETCH_BITS = 12


def hourly_customers(vendas: DataFrame, period: Period | None = DEFAULT_PERIOD) -> DataFrame:
    """``vendas_temporais`` to be stored and rolled up: instead of a number of customers, which cannot be
    added, ``clientes`` is a sketch of them, of at most some KB whatever the number."""
    return (
        vendas.where(calendar.within(F.col("data"), period))
        .groupBy("data", "hora", "canal_venda")
        .agg(
            F.count("*").alias("total_vendas"),
            F.sum("quantidade").alias("itens_vendidos"),
            F.sum("receita").alias("receita"),
            F.hll_sketch_agg(F.col("id_cliente").cast("string"), SKETCH_BITS).alias("clientes"),
        )
    )


def rolled_up(hours: DataFrame, *keys: str) -> DataFrame:
    """Totals of ``hourly_customers`` by any of its keys, or overall; customers of several hours count once.

    ``clientes_aprox`` is an estimate with the sketch's error, 0 where no sale has a customer; sales
    are not read again.
    """
    return hours.groupBy(*keys).agg(
        F.sum("total_vendas").alias("total_vendas"),
        F.sum("itens_vendidos").alias("itens_vendidos"),
        F.sum("receita").alias("receita"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("clientes")), F.lit(0).cast("bigint")).alias("clientes_aprox"),
    )


def customer_segments(
    clientes: DataFrame,
    vendas: DataFrame,
    period: Period | None = DEFAULT_PERIOD,
    limits: SegmentLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Every customer, buyers or not, with purchases in the period and segment; not ranked.

    Sales ids are unique, so counting them needs no distinct.
    """
    bought = (
        vendas.where(calendar.within(F.col("data"), period))
        .groupBy("id_cliente")
        .agg(
            F.count("id_venda").alias("total_compras"),
            F.sum("receita").alias("receita"),
            _average("receita").alias("ticket_medio"),
            F.min("data_venda").alias("primeira_compra"),
            F.max("data_venda").alias("ultima_compra"),
        )
    )
    people = clientes.select("id_cliente", "nome_cliente", "estado", "nome_estado", "regiao")
    revenue = F.coalesce("receita", F.lit(0).cast(money.REVENUE))
    return (
        people.join(bought, "id_cliente", "left")
        .withColumns({"total_compras": F.coalesce("total_compras", F.lit(0).cast("bigint")), "receita": revenue})
        .withColumn("segmento_cliente", money.segment(F.col("receita"), limits))
    )


def clientes_segmentacao(
    clientes: DataFrame,
    vendas: DataFrame,
    period: Period | None = DEFAULT_PERIOD,
    limits: SegmentLimits = DEFAULT_LIMITS,
    folder: str | None = None,
) -> DataFrame:
    """``customer_segments`` ranked by revenue; equal revenue by id. ``folder``: see `ordered_totals`."""
    return ordered_totals(
        customer_segments(clientes, vendas, period, limits),
        [F.col("receita").desc(), F.col("id_cliente").asc(), F.col("nome_cliente").asc(), F.col("estado").asc()],
        ranks={"ranking_receita": []},
        folder=folder,
    )


def _described(key: str = "_produto") -> dict:
    """Product columns with their labels; ``key`` is NULL where the catalogue lacks the product."""
    found = F.col(key)
    return {
        "nome_produto": text.label_or(found, text.product_name(F.col("nome_produto")), text.UNREGISTERED_PRODUCT),
        **{
            c: F.coalesce(F.col(c), F.lit(text.UNREGISTERED))  # NULL as well where there is no match
            for c in ("categoria", "marca", "faixa_preco")
        },
        "produto_cadastrado": found.isNotNull(),
    }


def _catalogue(produtos: DataFrame, *extra: str) -> DataFrame:
    columns = ("nome_produto", "categoria", "marca", "faixa_preco", *extra)
    return produtos.select("id_produto", *columns, F.col("id_produto").alias("_produto"))


def described_products(sold: DataFrame, produtos: DataFrame) -> DataFrame:
    """Totals per product sold, with the product's labels."""
    return sold.join(_catalogue(produtos), "id_produto", "left").withColumns(_described()).drop("_produto")


def product_sales(vendas: DataFrame, produtos: DataFrame, period: Period | None = None) -> DataFrame:
    """Sales per product sold, with the product's labels; not ranked."""
    sold = (
        vendas.where(calendar.within(F.col("data"), period))
        .groupBy("id_produto")
        .agg(
            F.count("*").alias("total_vendas"),
            F.sum("quantidade").alias("itens_vendidos"),
            F.sum("receita").alias("receita"),
            _average("receita").alias("ticket_medio"),
        )
    )
    return described_products(sold, produtos)


def _ranked(described: DataFrame, folder: str | None) -> DataFrame:
    return ordered_totals(
        described,
        [F.col("receita").desc(), F.col("id_produto").asc()],
        ranks={"ranking_receita": [], "ranking_na_categoria": ["categoria"]},
        folder=folder,
    ).select(
        "id_produto", "nome_produto", "categoria", "marca", "faixa_preco", "produto_cadastrado", "total_vendas",
        "itens_vendidos", "receita", "ticket_medio", "ranking_receita", "ranking_na_categoria",
    )


def ranked_products(sold: DataFrame, produtos: DataFrame, folder: str | None = None) -> DataFrame:
    """`vendas_produtos` from totals per product, however they were added up."""
    return _ranked(described_products(sold, produtos), folder)


def vendas_produtos(
    vendas: DataFrame, produtos: DataFrame, period: Period | None = None, folder: str | None = None
) -> DataFrame:
    """``product_sales`` ranked by revenue, overall and inside the category; equal revenue by id.
    ``folder``: see `ordered_totals`.

    Unknown products keep the id they were sold under: one row each.
    """
    return _ranked(product_sales(vendas, produtos, period), folder)


def vendas_detalhadas(
    vendas: DataFrame,
    produtos: DataFrame,
    segmentos: DataFrame,
    period: Period | None = None,
    hot_products: DataFrame | None = None,
    hot_customers: DataFrame | None = None,
    place: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One wide row per sale: the sale, its product, its customer with segment and region.

    ``place`` lays out the rows, as `sinks.clustered` does. Sales must then have their revenue and
    calendar columns as `silver.with_sale_columns` makes them: these are not moved but made anew in place.
    """
    made = {
        "receita": money.line_revenue(F.col("quantidade"), F.col("preco_unitario")),
        **calendar.columns(F.col("data_venda")),
    }
    carried = ["id_venda", "data_venda", "canal_venda", "id_produto", "id_cliente", "quantidade", "preco_unitario"]
    sales = vendas.where(calendar.within(F.col("data"), period)).select(*carried, *([] if place else made))
    spread_by = ["id_venda", "id_produto", "id_cliente", "data_venda"]
    people = segmentos.select("id_cliente", "nome_cliente", "estado", "nome_estado", "regiao", "segmento_cliente")
    catalogue = _catalogue(produtos, "data_criacao").withColumn("_produto", F.lit(True))
    with_product = lookup(sales, catalogue, "id_produto", spread_by, hot_products)
    early = F.coalesce(F.col("data_venda") < F.col("data_criacao"), F.lit(False))
    with_product = with_product.withColumn("venda_antes_do_cadastro", early).drop("data_criacao")
    detail = lookup(with_product, people, "id_cliente", spread_by, hot_customers)
    if place:
        detail = place(detail).withColumns(made)
    return detail.withColumns(_described()).select(
        "id_venda", "data_venda", "data", "dia_semana_num", "dia_semana", "hora", "canal_venda", "id_produto",
        "nome_produto", "categoria", "marca", "faixa_preco", "id_cliente", "nome_cliente", "estado", "nome_estado",
        "regiao", "segmento_cliente", "quantidade", "preco_unitario", "receita", "produto_cadastrado",
        "venda_antes_do_cadastro",
    )


def precos_competitividade(
    produtos: DataFrame,
    precos: DataFrame,
    vendas: DataFrame,
    period: Period | None = DEFAULT_PERIOD,
    only_with_competitors: bool = False,
) -> DataFrame:
    """Per product, where its price stands among the competitors, and what it sold in the period.

    Competitor prices and sales shrink to one row per product before they are joined. A product has
    a suspicious competitor price exactly if its lowest one is suspicious, so ``precos`` needs no
    flags. A product without a price counts as priced 0.
    """
    offers = precos.groupBy("id_produto").agg(
        _average("preco_concorrente").alias("preco_medio_concorrentes"),
        F.min("preco_concorrente").alias("preco_minimo_concorrentes"),
        F.max("preco_concorrente").alias("preco_maximo_concorrentes"),
        F.count("nome_concorrente").alias("total_concorrentes"),
        F.count("*").alias("_ofertas"),
    )
    sold = (
        vendas.where(calendar.within(F.col("data"), period))
        .groupBy("id_produto")
        .agg(F.sum("receita").alias("receita"), F.sum("quantidade").alias("itens_vendidos"))
    )
    own, mean, low, high = (
        F.col(c)
        for c in ("nosso_preco", "preco_medio_concorrentes", "preco_minimo_concorrentes", "preco_maximo_concorrentes")
    )
    product = F.col("id_produto")
    priced = (
        produtos.select("id_produto", "nome_produto", "categoria", "marca", "preco_atual")
        .join(offers, "id_produto", "inner" if only_with_competitors else "left")
        .join(sold, "id_produto", "left")
        .withColumns(
            {
                "nosso_preco": F.coalesce("preco_atual", F.lit(0).cast(money.PRICE)),
                "total_concorrentes": F.coalesce("total_concorrentes", F.lit(0).cast("bigint")),
                "receita": F.coalesce("receita", F.lit(0).cast(money.REVENUE)),
                "itens_vendidos": F.coalesce("itens_vendidos", F.lit(0).cast("bigint")),
            }
        )
    )
    return priced.select(
        product,
        text.label_or(product, text.product_name(F.col("nome_produto")), text.UNREGISTERED_PRODUCT).alias(
            "nome_produto"
        ),
        *[text.label_or(product, F.col(c), text.UNREGISTERED, text.UNREGISTERED).alias(c) for c in ("categoria", "marca")],
        own,
        mean,
        low,
        high,
        "total_concorrentes",
        F.when(mean == 0, F.lit(0)).otherwise(money.gap_percent(own, mean)).alias("diferenca_pct_vs_media"),
        F.when(low == 0, F.lit(0)).otherwise(money.gap_percent(own, low)).alias("diferenca_pct_vs_minimo"),
        F.when(product.isNotNull(), money.price_position(own, low, high, mean, F.col("total_concorrentes"))).alias(
            "classificacao_preco"
        ),
        F.when(F.col("_ofertas") > 0, money.suspicious(low, F.col("preco_atual"))).alias("possui_preco_suspeito"),
        "receita",
        "itens_vendidos",
    )


def _count_if(condition) -> Column:
    """How many rows meet the condition; NULL, not 0, for a table without rows."""
    return F.sum(F.when(condition, 1).otherwise(0))


def vendas_totais(vendas: DataFrame, period: Period | None = None) -> DataFrame:
    return vendas.where(calendar.within(F.col("data"), period)).agg(
        F.count("*").alias("total_vendas"),
        F.sum("receita").alias("receita_total"),
        _count_if(~F.col("produto_cadastrado")).alias("vendas_produto_nao_cadastrado"),
        _count_if(F.col("venda_antes_do_cadastro")).alias("vendas_antes_do_cadastro"),
        F.avg("receita").alias("ticket_medio"),
    )


def clientes_por_regiao(clientes: DataFrame) -> DataFrame:
    return (
        clientes.where(F.col("regiao").isNotNull())
        .groupBy("regiao")
        .agg(F.count("*").alias("total_clientes"), F.count_distinct("estado").alias("ufs_presentes"))
        .orderBy(F.col("total_clientes").desc(), "regiao")
    )


def band_position(band) -> Column:
    """Bands from dear to cheap; an unknown band has no position and sorts first."""
    names = [name for _, name in money.PRICE_BANDS] + [money.LOWEST_BAND]
    return F.nullif(F.array_position(F.lit(names), band), F.lit(0))


def produtos_por_faixa_preco(produtos: DataFrame) -> DataFrame:
    return (
        produtos.groupBy("faixa_preco")
        .agg(
            F.count("*").alias("total_produtos"),
            F.avg("preco_atual").alias("preco_medio_faixa"),
            F.min("preco_atual").alias("min_preco_faixa"),
            F.max("preco_atual").alias("max_preco_faixa"),
        )
        .orderBy(band_position(F.col("faixa_preco")).asc_nulls_first())
    )


def preco_competitivo_resumo(precos: DataFrame) -> DataFrame:
    return precos.agg(
        F.count("*").alias("total_precos_competidores"),
        _count_if(F.col("preco_suspeito")).alias("precos_suspeitos"),
        F.avg("preco_concorrente").alias("preco_medio_concorrente"),
        F.min("preco_concorrente").alias("min_preco_concorrente"),
        F.max("preco_concorrente").alias("max_preco_concorrente"),
    )
