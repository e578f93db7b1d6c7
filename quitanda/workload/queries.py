"""Every operator, mart, metric and check as a query over the whole benchmark tables."""

from __future__ import annotations

import uuid
import datetime as dt
from collections.abc import Callable
from decimal import Decimal
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.functions import calendar, money, text
from quitanda.operators import checks, expectations
from quitanda.operators.dedupe import keep_first
from quitanda.operators.expectations import EXPECTATIONS
from quitanda.operators.expectations import DROP, Expectation
from quitanda.operators.lookup import hot_keys, lookup
from quitanda.operators.ordered import ordered_totals
from quitanda.functions.calendar import within
from quitanda.operators.profile import profile
from quitanda.operators.ledger import MONTH, difference
from quitanda.plans import gold, incremental, kpi, silver
from quitanda.plans.comments import GOLD_COMMENTS
from quitanda.plans.refresh import refresh
from quitanda.session import new_location, scratch, shuffles_removed
from quitanda.settings import Period, SegmentLimits
from quitanda.sources import benchmark_tables as raw
from quitanda.sources.raw import list_tables, read_table
from quitanda.sources.sinks import clustered, documented, into_files, read_published, write_files
from quitanda.streaming.hourly_sales import refresh_hourly_sales, sales_stream

Query = Callable[[SparkSession, str], DataFrame]

PERIOD = Period.of("1997-01-01", "1997-01-30")
PERIOD_BEFORE = Period.of("1996-12-02", "1996-12-31")
LIMITS = SegmentLimits(Decimal("3000000"), Decimal("1000000"))
EVENT_DAYS_BEFORE = Period.of("2024-01-01", "2024-01-03")
EVENT_DAYS = Period.of("2024-01-04", "2024-01-04")

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Registers ``fn`` under its name. Decimals leave as doubles, after all exact arithmetic."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        exact = [f.name for f in df.schema if f.dataType.typeName() == "decimal"]
        return df.withColumns({c: F.col(c).cast("double") for c in exact}) if exact else df

    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Cleaned tables


@query
def silver_produtos(spark, sf_dir):
    return silver.silver_produtos(raw.produtos(spark, sf_dir))


@query
def silver_clientes(spark, sf_dir):
    return silver.silver_clientes(raw.clientes(spark, sf_dir), raw.CLIENTES_ORDER)


def _sales(spark, sf_dir):
    return silver.typed_sales(raw.vendas(spark, sf_dir), raw.VENDAS_ORDER)


@query
def silver_vendas(spark, sf_dir):
    return silver.silver_vendas(raw.vendas(spark, sf_dir), silver_produtos(spark, sf_dir), raw.VENDAS_ORDER)


def _prices(spark, sf_dir):
    return silver.typed_competitor_prices(raw.preco_competidores(spark, sf_dir), raw.PRECOS_ORDER)


@query
def silver_preco_competidores(spark, sf_dir):
    return silver.silver_preco_competidores(
        raw.preco_competidores(spark, sf_dir), silver_produtos(spark, sf_dir), raw.PRECOS_ORDER
    )


# Marts


def _segments(spark, sf_dir):
    return gold.customer_segments(silver_clientes(spark, sf_dir), _sales(spark, sf_dir), PERIOD, LIMITS)


@query
def gold_vendas_temporais(spark, sf_dir):
    return gold.vendas_temporais(_sales(spark, sf_dir), PERIOD)


@query
def gold_clientes_segmentacao(spark, sf_dir):
    return gold.clientes_segmentacao(silver_clientes(spark, sf_dir), _sales(spark, sf_dir), PERIOD, LIMITS)


@query
def gold_vendas_produtos(spark, sf_dir):
    return gold.vendas_produtos(_sales(spark, sf_dir), silver_produtos(spark, sf_dir))


@query
def gold_vendas_detalhadas(spark, sf_dir):
    return gold.vendas_detalhadas(_sales(spark, sf_dir), silver_produtos(spark, sf_dir), _segments(spark, sf_dir))


@query
def gold_precos_competitividade(spark, sf_dir):
    return gold.precos_competitividade(
        silver_produtos(spark, sf_dir), _prices(spark, sf_dir), _sales(spark, sf_dir), PERIOD
    )


@query
def gold_precos_com_concorrentes(spark, sf_dir):
    return gold.precos_competitividade(
        silver_produtos(spark, sf_dir), _prices(spark, sf_dir), _sales(spark, sf_dir), PERIOD, True
    )


@query
def gold_vendas_totais(spark, sf_dir):
    return gold.vendas_totais(silver_vendas(spark, sf_dir))


@query
def gold_clientes_por_regiao(spark, sf_dir):
    return gold.clientes_por_regiao(silver_clientes(spark, sf_dir))


@query
def gold_produtos_por_faixa_preco(spark, sf_dir):
    return gold.produtos_por_faixa_preco(silver_produtos(spark, sf_dir))


@query
def gold_preco_competitivo_resumo(spark, sf_dir):
    return gold.preco_competitivo_resumo(silver_preco_competidores(spark, sf_dir))


# Metrics


@query
def kpi_ltv(spark, sf_dir):
    return kpi.lifetime_value(_sales(spark, sf_dir))


@query
def kpi_cac(spark, sf_dir):
    return kpi.acquisition_cost(raw.events(spark, sf_dir, ["click"]), raw.events(spark, sf_dir, ["purchase"]))


@query
def kpi_cac_monthly(spark, sf_dir):
    return kpi.acquisition_cost(raw.events(spark, sf_dir, ["click"]), raw.events(spark, sf_dir, ["purchase"]), "MONTH")


@query
def kpi_ticket_medio(spark, sf_dir):
    return kpi.average_ticket(_sales(spark, sf_dir), ["canal_venda", "dia_semana"])


@query
def kpi_conversion(spark, sf_dir):
    return kpi.conversion_by_day(raw.events(spark, sf_dir, ["view", "purchase"]))


@query
def kpi_conversion_drop(spark, sf_dir):
    return kpi.conversion_drops(kpi_conversion(spark, sf_dir))


@query
def kpi_churn(spark, sf_dir):
    return kpi.churn(raw.events(spark, sf_dir, ["purchase"]), EVENT_DAYS_BEFORE, EVENT_DAYS)


@query
def agg_distinct_rolled_up(spark, sf_dir):
    """Customers per day, per channel and overall from stored hourly sketches, held against exact counts:
    the estimates must lie within four standard errors, 6.5%, or one customer."""
    path = new_location(spark, "hours")
    sales = _sales(spark, sf_dir)
    gold.hourly_customers(sales, PERIOD).write.parquet(path)
    hours, wanted = spark.read.parquet(path), sales.where(within(F.col("data"), PERIOD))
    results = []
    for keys in (["data"], ["canal_venda"], []):
        exact = wanted.groupBy(*keys).agg(F.count_distinct("id_cliente").alias("clientes_unicos"))
        both = gold.rolled_up(hours, *keys).withColumn("_k", F.struct(F.lit(0), *keys)).join(
            exact.select(F.struct(F.lit(0), *keys).alias("_e"), "clientes_unicos"), F.col("_k").eqNullSafe(F.col("_e"))
        )
        off = F.abs(F.col("clientes_aprox") - F.col("clientes_unicos"))
        named = [(F.col(c) if c in keys else F.lit(None).cast(t)).alias(c) for c, t in (("data", "date"), ("canal_venda", "string"))]
        close = (off <= F.greatest(F.lit(1.0), F.col("clientes_unicos") * 0.065)).alias("dentro_do_erro")
        results.append(both.select(*named, "total_vendas", "itens_vendidos", "receita", "clientes_unicos", close))
    return results[0].unionByName(results[1]).unionByName(results[2])


# Neighbouring periods of one, two and three days.
CHURN_PAIRS = [
    tuple(Period(dt.date(2024, 1, a), dt.date(2024, 1, a + n - 1)) for a in (first, first + n))
    for n in (1, 2, 3)
    for first in range(1, 7)
]


@query
def kpi_churn_pairs(spark, sf_dir):
    """Churn of 18 period pairs from one stored table of active days."""
    path = new_location(spark, "active_days")
    kpi.active_days(raw.events(spark, sf_dir, ["purchase"])).write.parquet(path)
    return kpi.churn_pairs(spark.read.parquet(path), CHURN_PAIRS)


@query
def kpi_churn_by_segment(spark, sf_dir):
    sales = _sales(spark, sf_dir)
    segments = gold.customer_segments(silver_clientes(spark, sf_dir), sales, PERIOD_BEFORE, LIMITS)
    return kpi.churn(sales, PERIOD_BEFORE, PERIOD, segments.select("id_cliente", "segmento_cliente"))


@query
def kpi_revenue_cube(spark, sf_dir):
    return kpi.revenue_by_category_and_channel(_sales(spark, sf_dir), silver_produtos(spark, sf_dir))


@query
def kpi_revenue_by_region_and_category(spark, sf_dir):
    return kpi.revenue_cube(gold_vendas_detalhadas(spark, sf_dir), ["regiao", "categoria"])


@query
def kpi_abc(spark, sf_dir):
    return kpi.abc_curve(gold.product_sales(_sales(spark, sf_dir), silver_produtos(spark, sf_dir)))


@query
def kpi_top_products(spark, sf_dir):
    return kpi.top_sellers(_sales(spark, sf_dir), 10)


@query
def kpi_top_products_last_week(spark, sf_dir):
    return kpi.top_sellers(kpi.last_days(_sales(spark, sf_dir), 7), 10)


@query
def kpi_top_products_by_category(spark, sf_dir):
    products = gold.product_sales(_sales(spark, sf_dir), silver_produtos(spark, sf_dir))
    return kpi.top_per_group(products, 3, "categoria")


@query
def kpi_segment_channel(spark, sf_dir):
    return kpi.favourite_channel(_sales(spark, sf_dir), _segments(spark, sf_dir))


# Single operators


@query
def clean_dedupe_first(spark, sf_dir):
    return keep_first(raw.clientes(spark, sf_dir), ["id_cliente"], raw.CLIENTES_ORDER)


@query
def clean_dedupe_null_ids(spark, sf_dir):
    """Sales some of which have no id: those are all kept."""
    return keep_first(raw.vendas_sem_id(spark, sf_dir), ["id_venda"], raw.VENDAS_ORDER)


@query
def clean_dedupe_two_keys(spark, sf_dir):
    return keep_first(
        raw.preco_competidores(spark, sf_dir), ["id_produto", "nome_concorrente"], raw.PRECOS_ORDER
    )


@query
def clean_strip_honorific(spark, sf_dir):
    name = F.col("nome_cliente")
    return raw.clientes(spark, sf_dir).select(
        "id_cliente", name.alias("nome_original"), text.strip_honorific(name).alias("nome_cliente"),
        text.has_honorific(name).alias("tinha_tratamento"),
    )


@query
def clean_title_case(spark, sf_dir):
    return raw.clientes(spark, sf_dir).select("id_cliente", text.title_case(F.col("nome_cliente")).alias("nome_cliente"))


@query
def clean_product_name(spark, sf_dir):
    name = F.col("nome_produto")
    return raw.produtos(spark, sf_dir).select(
        "id_produto", F.trim(name).alias("nome_aparado"), text.product_name(name).alias("nome_produto")
    )


@query
def clean_upper_state(spark, sf_dir):
    return raw.clientes(spark, sf_dir).groupBy(F.upper(F.trim("estado")).alias("estado")).agg(
        F.count("*").alias("linhas")
    )


@query
def clean_price_cast(spark, sf_dir):
    """Prices as text, some of them no numbers."""
    return raw.load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id_produto"),
        money.price(F.expr("case when p_partkey % 13 = 0 then 'n/a' else cast(p_retailprice as string) end")).alias(
            "preco_atual"
        ),
    )


@query
def clean_line_revenue(spark, sf_dir):
    return raw.vendas(spark, sf_dir).select(
        "id_venda", money.line_revenue(F.col("quantidade"), money.price(F.col("preco_unitario"))).alias("receita")
    )


@query
def clean_price_band(spark, sf_dir):
    return raw.produtos(spark, sf_dir).select(
        "id_produto", "preco_atual", money.price_band(F.col("preco_atual")).alias("faixa_preco")
    )


@query
def label_defaults(spark, sf_dir):
    return gold.product_sales(_sales(spark, sf_dir), silver_produtos(spark, sf_dir), PERIOD)


@query
def calendar_columns(spark, sf_dir):
    moment = F.col("data_venda")
    number = calendar.weekday_number(moment)
    return raw.vendas(spark, sf_dir).select(
        "id_venda",
        calendar.day(moment).alias("data"),
        calendar.hour_of_day(moment).alias("hora"),
        number.alias("dia_semana_num"),
        calendar.weekday_name(number).alias("dia_semana"),
    )


@query
def calendar_parse_timestamp(spark, sf_dir):
    """Collection dates as text, some of them no dates."""
    written = F.expr("case when l_linenumber = 3 then 'ontem' else cast(l_shipdate as string) end")
    return raw.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", calendar.parse_timestamp(written).alias("data_coleta")
    )


@query
def filter_period(spark, sf_dir):
    return raw.vendas(spark, sf_dir).where(calendar.within(calendar.day(F.col("data_venda")), PERIOD))


@query
def filter_channel(spark, sf_dir):
    inside = F.col("canal_venda").isin("ecommerce")
    return raw.vendas(spark, sf_dir).where(~inside & F.col("id_cliente").isNotNull()).groupBy("id_cliente").agg(
        F.count("*").alias("linhas")
    )


@query
def filter_repeated_ids(spark, sf_dir):
    return checks.duplicated_keys(raw.vendas(spark, sf_dir), ["id_venda"])


@query
def join_state_lookup(spark, sf_dir):
    people = raw.clientes(spark, sf_dir).withColumn("estado", F.upper(F.trim("estado")))
    return silver.with_state(people)


@query
def join_hot_key_lookup(spark, sf_dir):
    """Sales with their product's brand, joined so that best sellers and missing keys are split."""
    brands = raw.produtos(spark, sf_dir).select("id_produto", "marca")
    sales = raw.vendas(spark, sf_dir).select("id_venda", "id_produto", "data_venda")
    hot = hot_keys(raw.sold_keys(spark, sf_dir), "id_produto")
    return lookup(sales, brands, "id_produto", ["id_venda", "data_venda"], hot)


@query
def flag_registered(spark, sf_dir):
    return silver_vendas(spark, sf_dir).select(
        "id_venda", "id_produto", "produto_cadastrado", "venda_antes_do_cadastro", "venda_depois_do_cadastro"
    )


@query
def flag_suspicious_price(spark, sf_dir):
    return silver_preco_competidores(spark, sf_dir).where("preco_suspeito").select(
        "id_produto", "nome_concorrente", "preco_concorrente", "preco_atual"
    )


@query
def agg_count_distinct(spark, sf_dir):
    return raw.vendas(spark, sf_dir).groupBy("canal_venda").agg(
        F.count_distinct("id_cliente").alias("clientes"), F.count_distinct("id_produto").alias("produtos")
    )


@query
def agg_basic(spark, sf_dir):
    """Count, sum, rounded mean, least and greatest price per brand."""
    return raw.produtos(spark, sf_dir).groupBy("marca").agg(
        F.count("*").alias("linhas"),
        F.sum("preco_atual").alias("soma"),
        F.round(F.avg("preco_atual"), 2).alias("media"),
        F.min("preco_atual").alias("minimo"),
        F.max("data_criacao").alias("ultima_criacao"),
    )


@query
def agg_conditional_sum(spark, sf_dir):
    return raw.vendas(spark, sf_dir).groupBy("id_cliente").agg(
        F.sum(F.when(F.col("canal_venda") == "ecommerce", 1).otherwise(0)).alias("compras_ecommerce"),
        F.sum(F.when(F.col("quantidade") > 40, 1).otherwise(0)).alias("compras_grandes"),
    )


@query
def agg_any_suspicious(spark, sf_dir):
    return silver_preco_competidores(spark, sf_dir).groupBy("id_produto").agg(
        F.bool_or("preco_suspeito").alias("possui_preco_suspeito")
    )


@query
def join_aggregate_coalesce(spark, sf_dir):
    """Every customer with the revenue of the period, 0 for those who bought nothing."""
    return _segments(spark, sf_dir).select("id_cliente", "total_compras", "receita", "segmento_cliente")


@query
def rank_global(spark, sf_dir):
    spent = _sales(spark, sf_dir).groupBy("id_cliente").agg(F.sum("receita").alias("receita"))
    return ordered_totals(spent, [F.col("receita").desc(), F.col("id_cliente").asc()], ranks={"ranking": []})


@query
def rank_in_group(spark, sf_dir):
    """Products by price, overall and inside their (possibly missing) category."""
    products = raw.produtos(spark, sf_dir).select("id_produto", "categoria", "preco_atual")
    order = [F.col("preco_atual").desc(), F.col("id_produto").asc()]
    return ordered_totals(products, order, ranks={"ranking": [], "ranking_na_categoria": ["categoria"]})


@query
def running_sum(spark, sf_dir):
    """Revenue accumulated over days, per channel and overall."""
    daily = _sales(spark, sf_dir).groupBy("data", "canal_venda").agg(F.sum("receita").alias("receita"))
    return ordered_totals(
        daily,
        [F.col("data").asc(), F.col("canal_venda").asc()],
        sums={"acumulado": ("receita", []), "acumulado_canal": ("receita", ["canal_venda"])},
    )


# Expectations and checks


@query
def expectations_produtos(spark, sf_dir):
    return expectations.report(silver_produtos(spark, sf_dir), EXPECTATIONS["produtos"])


@query
def expectations_clientes(spark, sf_dir):
    return expectations.report(silver_clientes(spark, sf_dir), EXPECTATIONS["clientes"])


@query
def expectations_vendas(spark, sf_dir):
    return expectations.report(silver_vendas(spark, sf_dir), EXPECTATIONS["vendas"])


@query
def expectations_vendas_strict(spark, sf_dir):
    return expectations.report(silver_vendas(spark, sf_dir), EXPECTATIONS["vendas"], strict=True)


@query
def expectations_preco_competidores(spark, sf_dir):
    return expectations.report(silver_preco_competidores(spark, sf_dir), EXPECTATIONS["preco_competidores"])


@query
def expectations_guarded_vendas(spark, sf_dir):
    """Sales that pass the guard: it fails the job on a violation, so all rows arrive."""
    return expectations.guard(silver_vendas(spark, sf_dir), EXPECTATIONS["vendas"]).select("id_venda", "receita")


@query
def quarantine_vendas(spark, sf_dir):
    return expectations.quarantine(silver_vendas(spark, sf_dir), EXPECTATIONS["vendas"]).select("id_venda", "violadas")


@query
def quarantine_clientes(spark, sf_dir):
    return expectations.quarantine(silver_clientes(spark, sf_dir), EXPECTATIONS["clientes"]).select(
        "id_cliente", "estado", "violadas"
    )


@query
def check_unique_keys(spark, sf_dir):
    return checks.all_of(
        [
            checks.unique_key("clientes", silver_clientes(spark, sf_dir), ["id_cliente"]),
            checks.unique_key("produtos", silver_produtos(spark, sf_dir), ["id_produto"]),
            checks.unique_key("vendas", _sales(spark, sf_dir), ["id_venda"]),
            checks.unique_key("preco_competidores", _prices(spark, sf_dir), ["id_produto", "nome_concorrente"]),
            checks.unique_key("vendas_bruta", raw.vendas(spark, sf_dir), ["id_venda"]),
        ]
    )


@query
def check_gold_unique_keys(spark, sf_dir):
    return checks.all_of(
        [
            checks.unique_key("clientes_segmentacao", _segments(spark, sf_dir), ["id_cliente"]),
            checks.unique_key("vendas_detalhadas", gold_vendas_detalhadas(spark, sf_dir), ["id_venda"]),
            checks.unique_key("precos_competitividade", gold_precos_competitividade(spark, sf_dir), ["id_produto"]),
        ]
    )


@query
def check_sales(spark, sf_dir):
    return checks.sales_checks(silver_vendas(spark, sf_dir))


@query
def check_honorifics(spark, sf_dir):
    titled = F.count_if(F.substring("nome_original", 1, 1).isin("S", "D"))
    return checks.customer_checks(silver_clientes(spark, sf_dir), titled)


@query
def check_segments(spark, sf_dir):
    """Segments against counts taken straight from the clean tables, at any scale."""
    wanted = checks.expected_segments(_sales(spark, sf_dir), silver_clientes(spark, sf_dir), PERIOD, LIMITS)
    return checks.segment_checks(_segments(spark, sf_dir), LIMITS, wanted)


@query
def check_detail(spark, sf_dir):
    return checks.detail_checks(gold_vendas_detalhadas(spark, sf_dir), vendas=_sales(spark, sf_dir))


@query
def check_prices(spark, sf_dir):
    wanted = checks.expected_prices(silver_produtos(spark, sf_dir), silver_preco_competidores(spark, sf_dir))
    return checks.price_checks(gold_precos_competitividade(spark, sf_dir), **wanted)


@query
def check_same_revenue(spark, sf_dir):
    """All sums from clean tables that are stored once."""
    home = new_location(spark, "clean")
    sales = write_files(_sales(spark, sf_dir), f"{home}/vendas")
    products = write_files(silver_produtos(spark, sf_dir), f"{home}/produtos")
    segments = gold.customer_segments(silver_clientes(spark, sf_dir), sales, PERIOD, LIMITS)
    segments = write_files(segments, f"{home}/segmentos")
    return checks.same_revenue(
        sales,
        {
            "vendas_temporais": gold.vendas_temporais(sales, None),
            "vendas_produtos": gold.product_sales(sales, products),
            "vendas_detalhadas": gold.vendas_detalhadas(sales, products, segments),
            "clientes_segmentacao": segments,
        },
    )


@query
def check_reconciliation(spark, sf_dir):
    return checks.revenue_outside_segments(_sales(spark, sf_dir), silver_clientes(spark, sf_dir), PERIOD)


@query
def check_row_counts(spark, sf_dir):
    return checks.row_counts(
        {
            "clientes": silver_clientes(spark, sf_dir),
            "produtos": silver_produtos(spark, sf_dir),
            "vendas": _sales(spark, sf_dir),
            "preco_competidores": _prices(spark, sf_dir),
        }
    )


# Profiles, sources, sinks, refresh, stream


@query
def profile_vendas(spark, sf_dir):
    return profile(raw.vendas(spark, sf_dir), distinct=None)


@query
def profile_produtos(spark, sf_dir):
    return profile(raw.produtos(spark, sf_dir), distinct=None)


@query
def profile_clientes(spark, sf_dir):
    return profile(raw.clientes(spark, sf_dir), distinct=None)


@query
def profile_preco_competidores(spark, sf_dir):
    return profile(raw.preco_competidores(spark, sf_dir), distinct=None)


@query
def profile_vendas_distinct(spark, sf_dir):
    """With exact distinct counts."""
    return profile(raw.vendas(spark, sf_dir), "exact")


@query
def source_catalog_tables(spark, sf_dir):
    """Rows of the tables a catalog lists, its internal ones left out, read by name."""
    tables = {
        "quitanda_clientes": silver_clientes(spark, sf_dir),
        "quitanda_produtos": silver_produtos(spark, sf_dir),
        "quitanda_vendas": _sales(spark, sf_dir),
        "quitanda_preco_competidores": _prices(spark, sf_dir),
        "__materialization_quitanda": _sales(spark, sf_dir),
    }
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    listed = [name for name in list_tables(spark) if name in tables]
    counts = checks.row_counts({name.removeprefix("quitanda_"): read_table(spark, name) for name in listed})
    for name in tables:  # the counts know their views by now
        spark.catalog.dropTempView(name)
    return counts


@query
def source_three_part_name(spark, sf_dir):
    """Sold quantity per line number, from a table read by catalog, schema and name."""
    name = f"quitanda_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE spark_catalog.default.{name} USING parquet LOCATION '{sf_dir}/lineitem.parquet'")
    lines = read_table(spark, name, "default", "spark_catalog")
    sold = lines.groupBy("l_linenumber").agg(F.count("*").alias("linhas"), F.sum(F.col("l_quantity").cast("bigint")).alias("itens"))
    spark.sql(f"DROP TABLE spark_catalog.default.{name}")  # only the entry: the files are not the catalog's
    return sold


@query
def sink_clustered_by_date(spark, sf_dir):
    """Stores the detail mart clustered by day, and sums up what a day filter reads back."""
    by_day = partial(clustered, by=calendar.day(F.col("data_venda")), then="id_venda")
    detail = gold.vendas_detalhadas(
        _sales(spark, sf_dir), silver_produtos(spark, sf_dir), _segments(spark, sf_dir), place=by_day
    )
    stored = write_files(detail, new_location(spark, "vendas_detalhadas"))
    return stored.where(calendar.within(F.col("data"), PERIOD)).groupBy("data").agg(
        F.count("*").alias("total_vendas"), F.sum("receita").alias("receita")
    )


@query
def documented_columns(spark, sf_dir):
    """The products mart with its comments, profiled column by column."""
    mart = documented(
        gold.product_sales(_sales(spark, sf_dir), silver_produtos(spark, sf_dir)), GOLD_COMMENTS["vendas_produtos"]
    )
    comment = {f.name: f.metadata.get("comment") for f in mart.schema}
    label = F.coalesce(*[F.when(F.col("coluna") == c, F.lit(t)) for c, t in comment.items()])
    return profile(mart, distinct=None).select("coluna", "linhas", "nulos", label.alias("comentario"))


def _refreshed(spark, sf_dir, home):
    tables = {
        "produtos": raw.produtos(spark, sf_dir),
        "clientes": raw.clientes(spark, sf_dir),
        "vendas": raw.vendas(spark, sf_dir),
        "preco_competidores": raw.preco_competidores(spark, sf_dir),
    }
    orders = {"clientes": raw.CLIENTES_ORDER, "vendas": raw.VENDAS_ORDER, "preco_competidores": raw.PRECOS_ORDER}
    return refresh(tables, into_files(home), PERIOD, LIMITS, orders)


@query
def refresh_row_counts(spark, sf_dir):
    """Stores all clean tables and marts, then counts their rows."""
    return checks.row_counts(_refreshed(spark, sf_dir, new_location(spark, "warehouse")).tables)


@query
def published_revenue(spark, sf_dir):
    """Sales and revenue by channel as a reader of the published tables sees them."""
    home = new_location(spark, "warehouse")
    _refreshed(spark, sf_dir, home)
    sales = read_published(spark, home)["silver.vendas"]
    return sales.groupBy("canal_venda").agg(F.count("*").alias("total_vendas"), F.sum("receita").alias("receita"))


@query
def check_documentation(spark, sf_dir):
    """Every column of every published mart has a comment."""
    tables = _refreshed(spark, sf_dir, new_location(spark, "warehouse")).tables
    return checks.documentation({n.removeprefix("gold."): df for n, df in tables.items() if n.startswith("gold.")})


@query
def expectations_dropped_prices(spark, sf_dir):
    """Competitor prices per competitor once those without a product or implausible are dropped."""
    rules = [
        Expectation("id_produto_nao_preenchido", "id_produto IS NOT NULL", DROP),
        Expectation("preco_plausivel", "NOT preco_suspeito", DROP),
    ]
    kept = expectations.guard(silver_preco_competidores(spark, sf_dir), rules)
    return kept.groupBy("nome_concorrente").agg(F.count("*").alias("precos"), F.sum("preco_concorrente").alias("soma"))


@query
def quarantine_stored_prices(spark, sf_dir):
    """Competitor prices stored once, those without a product or implausible in a partition of their own."""
    rules = [
        Expectation("id_produto_nao_preenchido", "id_produto IS NOT NULL", DROP),
        Expectation("preco_acima_de_mil", "preco_concorrente > 1000"),
        Expectation("preco_plausivel", "NOT preco_suspeito", DROP),
    ]
    split = expectations.store_split(silver_preco_competidores(spark, sf_dir), rules, new_location(spark, "prices"))
    kept, aside = (df.withColumn("situacao", F.lit(s)) for df, s in zip(split, (expectations.KEPT, expectations.SET_ASIDE)))
    totals = [F.count("*").alias("precos"), F.sum("preco_concorrente").alias("soma")]
    return kept.unionByName(aside).groupBy("situacao", "violadas").agg(*totals)


@query
def stream_hourly_sales(spark, sf_dir):
    """Purchases of the event stream per hour and kind of day."""
    events = sales_stream(spark, sf_dir, raw.load(spark, sf_dir, "events").schema, "events.parquet")
    return refresh_hourly_sales(_purchases(events), new_location(spark, "hourly"))


def _purchases(events):
    return events.where("event_type = 'purchase'").selectExpr(
        "event_id as id_venda",
        "cast(ts as timestamp) as data_venda",
        "user_id as id_cliente",
        "case when user_id % 2 = 0 then 'ecommerce' else 'loja_fisica' end as canal_venda",
        "1 as quantidade",
        "cast(value as decimal(18,2)) as receita",
    )


@query
def stream_hourly_sales_refreshes(spark, sf_dir):
    """The same hours from three refreshes. Every third purchase also comes with a later moment, before
    its own, in the same refresh, or after it: then it moves to an earlier day, or stays."""
    sales = _purchases(raw.load(spark, sf_dir, "events"))
    later = sales.where("id_venda % 3 = 0").withColumn("data_venda", F.expr("data_venda + interval 30 hours"))
    landing, home = new_location(spark, "arriving"), new_location(spark, "hourly")
    for part in range(3):
        arriving = sales.where(F.col("id_venda") % 4 % 3 == part).unionByName(later.where(F.col("id_venda") % 5 % 3 == part))
        arriving.write.mode("append").parquet(landing)
        table = refresh_hourly_sales(sales_stream(spark, landing, sales.schema), home)
    return table


def _daily(spark, sf_dir):
    """A warehouse brought up to date in three refreshes, and its catalogue.

    The first has no sale of January 1997, a tenth of all sales on a wrong day and with a wrong price,
    and a catalogue without every ninth product; the second brings January, the third the right rows
    for the wrong ones and the whole catalogue. The raw sales are a join; they are stored once, each
    refresh takes its part, and they go when all have.
    """
    columns = [*raw.VENDAS_ORDER, "id_venda"]
    january = F.col("data_venda").between(F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1997-01-31").cast("timestamp_ntz"))
    off = F.col("id_venda") % 10 == 3
    come = lambda df: df.withColumn("n", F.lit(1).cast("bigint"))
    produtos, home = silver_produtos(spark, sf_dir), new_location(spark, "daily")
    some = produtos.where("id_produto % 9 <> 0")
    with shuffles_removed(spark), scratch(spark) as folder:
        right = write_files(raw.vendas(spark, sf_dir).select(*columns), f"{folder}/raw")
        wrong = right.withColumns(
            {
                "data_venda": F.when(off, F.expr("data_venda + interval 40 hours")).otherwise(F.col("data_venda")),
                "preco_unitario": F.when(off, F.col("preco_unitario") + 7).otherwise(F.col("preco_unitario")),
            }
        )
        corrected = difference(wrong.where(off), right.where(off))
        steps = [(come(wrong.where(~january)), some, True), (come(wrong.where(january)), some, False), (corrected, produtos, False)]
        for changes, catalogue, stored in steps:
            incremental.refresh_sales(changes, catalogue, raw.VENDAS_ORDER, home, 16, MONTH, stored)
    return home, produtos


@query
def daily_refresh_temporais(spark, sf_dir):
    home, _ = _daily(spark, sf_dir)
    return incremental.vendas_temporais(spark, home, PERIOD)


@query
def daily_refresh_produtos(spark, sf_dir):
    home, produtos = _daily(spark, sf_dir)
    return incremental.vendas_produtos(spark, home, produtos)


@query
def daily_refresh_totais(spark, sf_dir):
    home, _ = _daily(spark, sf_dir)
    return incremental.vendas_totais(spark, home)
