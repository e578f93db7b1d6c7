"""Refresh of the whole warehouse: clean tables are stored once, every mart reads the stored ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.functions import calendar
from quitanda.operators import expectations
from quitanda.operators.expectations import EXPECTATIONS
from quitanda.operators.lookup import hot_keys
from quitanda.plans import gold, silver
from quitanda.plans.comments import GOLD_COMMENTS
from quitanda.settings import DEFAULT_LIMITS, DEFAULT_PERIOD, Period, SegmentLimits
from quitanda.session import scratch
from quitanda.sources.sinks import Store, clustered, documented, write_files


class Refreshed(NamedTuple):
    """The stored tables by name, ``silver.*`` and ``gold.*``, and per clean table its violations."""

    tables: dict[str, DataFrame]
    violations: dict[str, dict[str, int]]


def refresh(
    raw: Mapping[str, DataFrame],
    store: Store,
    period: Period | None = DEFAULT_PERIOD,
    limits: SegmentLimits = DEFAULT_LIMITS,
    orders: Mapping[str, Sequence[str]] | None = None,
    strict: bool = False,
) -> Refreshed:
    """Stores the four clean tables and the nine marts, and publishes them together at the end.

    Violations are counted in all rows, before any is left out, while the table is written; one of
    severity ``fail`` stops the refresh, and the tables published before stay as they were.
    ``orders`` decides which copy of a row is kept. Which products and customers are hot is counted
    once; that and the slices of ranked marts lie in a folder that is removed at the end.
    """
    with scratch(raw["vendas"].sparkSession) as folder:
        done = _stored(raw, store, period, limits, orders or {}, strict, folder)
    store.publish()
    return done


def _stored(
    raw: Mapping[str, DataFrame],
    store: Store,
    period: Period | None,
    limits: SegmentLimits,
    orders: Mapping[str, Sequence[str]],
    strict: bool,
    folder: str,
) -> Refreshed:
    done = Refreshed({}, {})

    def clean(name: str, df: DataFrame) -> DataFrame:
        exps = EXPECTATIONS[name]
        watched, watch = expectations.observe(df, exps)
        done.tables[f"silver.{name}"] = store("silver", name, expectations.guard(watched, exps, strict))
        done.violations[name] = expectations.observed(watch, exps)
        return done.tables[f"silver.{name}"]

    def mart(name: str, df: DataFrame) -> DataFrame:
        done.tables[f"gold.{name}"] = store("gold", name, documented(df, GOLD_COMMENTS[name]))
        return done.tables[f"gold.{name}"]

    def hot(sales: DataFrame, key: str) -> DataFrame:
        return write_files(hot_keys(sales, key), f"{folder}/hot_{key}")

    by_day = partial(clustered, by=calendar.day(F.col("data_venda")), then="id_venda")
    hot_products = hot(raw["vendas"], "id_produto")
    produtos = clean("produtos", silver.silver_produtos(raw["produtos"], orders.get("produtos")))
    clientes = clean("clientes", silver.silver_clientes(raw["clientes"], orders.get("clientes")))
    vendas = clean("vendas", silver.silver_vendas(raw["vendas"], produtos, orders.get("vendas"), hot_products, by_day))
    hot_customers = hot(vendas, "id_cliente")  # of the stored sales: the raw ones may be a join
    precos = silver.silver_preco_competidores(raw["preco_competidores"], produtos, orders.get("preco_competidores"))
    precos = clean("preco_competidores", precos)

    segmentos = mart("clientes_segmentacao", gold.clientes_segmentacao(clientes, vendas, period, limits, folder))
    mart("vendas_temporais", gold.vendas_temporais(vendas, period))
    mart("vendas_produtos", gold.vendas_produtos(vendas, produtos, folder=folder))
    mart("vendas_detalhadas", gold.vendas_detalhadas(vendas, produtos, segmentos, None, hot_products, hot_customers, by_day))
    mart("precos_competitividade", gold.precos_competitividade(produtos, precos, vendas, period))
    mart("vendas_totais", gold.vendas_totais(vendas))
    mart("clientes_por_regiao", gold.clientes_por_regiao(clientes))
    mart("produtos_por_faixa_preco", gold.produtos_por_faixa_preco(produtos))
    mart("preco_competitivo_resumo", gold.preco_competitivo_resumo(precos))
    return done
