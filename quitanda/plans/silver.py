"""Cleaned tables: one row per key, typed, with derived columns and flags. No row is dropped.

``typed_sales`` and ``typed_competitor_prices`` stop before the join with the catalogue; marts that
need none of its flags, or that join after aggregating, start from them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.functions import calendar, money, text
from quitanda.functions.states import state_table
from quitanda.operators.dedupe import keep_first
from quitanda.operators.lookup import lookup


def silver_produtos(produtos: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    return (
        keep_first(produtos, ["id_produto"], order)
        .withColumns({"nome_produto": F.trim("nome_produto"), "preco_atual": money.price(F.col("preco_atual"))})
        .withColumn("faixa_preco", money.price_band(F.col("preco_atual")))
    )


def with_state(df: DataFrame) -> DataFrame:
    """Adds ``nome_estado`` and ``regiao``; a state that does not exist gets NULL."""
    states = F.broadcast(state_table(df.sparkSession))  # 27 rows
    return df.join(states, F.col("estado") == F.col("uf"), "left").drop("uf")


def silver_clientes(clientes: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    named = keep_first(clientes, ["id_cliente"], order).withColumns(
        {
            "nome_original": F.col("nome_cliente"),
            "nome_cliente": text.person_name(F.col("nome_cliente")),
            "estado": F.upper(F.trim("estado")),
        }
    )
    return with_state(named)


def with_price(once: DataFrame) -> DataFrame:
    return once.withColumn("preco_unitario", money.price(F.col("preco_unitario")))


def with_sale_columns(once: DataFrame) -> DataFrame:
    """Types prices and adds revenue and calendar columns to sales that are unique by id."""
    return with_price(once).withColumns(
        {
            "receita": money.line_revenue(F.col("quantidade"), F.col("preco_unitario")),
            **calendar.columns(F.col("data_venda")),
        }
    )


def typed_sales(vendas: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Sales, one row per id, with revenue and calendar columns."""
    return with_sale_columns(keep_first(vendas, ["id_venda"], order))


def flag_sales(
    sales: DataFrame, produtos: DataFrame, hot: DataFrame | None = None, cut: tuple[str, Column, int] | None = None
) -> DataFrame:
    """Marks sales of products outside the catalogue and sales older than their product's entry.

    ``cut``: see `lookup`; sales without a product are then dealt out by that value as well.
    """
    known = produtos.select("id_produto", F.col("data_criacao").alias("_criado"), F.lit(True).alias("_existe"))
    spread_by = [cut[1]] if cut else ["id_venda", "id_cliente", "data_venda"]
    found = lookup(sales, known, "id_produto", spread_by, hot, cut=cut and (cut[0], cut[2]))
    early = F.coalesce(F.col("data_venda") < F.col("_criado"), F.lit(False))
    return found.withColumns(
        {
            "produto_cadastrado": F.col("_existe").isNotNull(),
            "venda_antes_do_cadastro": early,
            "venda_depois_do_cadastro": ~early,
        }
    ).drop("_criado", "_existe")


def silver_vendas(
    vendas: DataFrame,
    produtos: DataFrame,
    order: Sequence[str] | None = None,
    hot: DataFrame | None = None,
    place: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``hot``: hot products, see `lookup`. ``place`` lays out the rows, as `sinks.clustered` does.

    Revenue and calendar columns are added after all rows have moved, since they follow from the others.
    """
    once = with_price(keep_first(vendas, ["id_venda"], order))
    flagged = flag_sales(once, produtos, hot)
    placed = place(flagged) if place else flagged
    columns = dict.fromkeys([*with_sale_columns(once).columns, *flagged.columns])
    return with_sale_columns(placed).select(*columns)


def typed_competitor_prices(precos: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Competitor prices, one row per product and competitor."""
    return keep_first(precos, ["id_produto", "nome_concorrente"], order).withColumns(
        {
            "data_coleta": calendar.parse_timestamp(F.col("data_coleta")),
            "preco_concorrente": money.price(F.col("preco_concorrente")),
        }
    )


def flag_competitor_prices(precos: DataFrame, produtos: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Adds our own price and marks competitor prices far below it."""
    own = produtos.select("id_produto", "preco_atual")
    found = lookup(precos, own, "id_produto", ["nome_concorrente", "data_coleta", "preco_concorrente"], hot)
    return found.withColumn("preco_suspeito", money.suspicious(F.col("preco_concorrente"), F.col("preco_atual")))


def silver_preco_competidores(
    precos: DataFrame, produtos: DataFrame, order: Sequence[str] | None = None, hot: DataFrame | None = None
) -> DataFrame:
    """``hot``: products with very many prices, see `lookup`."""
    return flag_competitor_prices(typed_competitor_prices(precos, order), produtos, hot)
