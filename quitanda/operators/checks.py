"""Checks of whole tables. Every check returns rows (verificacao, aprovada, observado, esperado)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.functions import calendar, money, text
from quitanda.settings import DEFAULT_LIMITS, DEFAULT_PERIOD, Period, SegmentLimits

_COMPARE = {
    "=": lambda seen, wanted: seen.eqNullSafe(wanted),
    "<=": lambda seen, wanted: F.coalesce(seen <= wanted, F.lit(False)),
    "<": lambda seen, wanted: F.coalesce(seen < wanted, F.lit(False)),
}
_NUMBER = "decimal(38,4)"


@dataclass(frozen=True)
class Check:
    """An aggregate, and the value it must compare to (a number, or another aggregate)."""

    name: str
    observed: Column
    rule: str
    expected: object


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table from one aggregate over it."""
    values = []
    for i, c in enumerate(checks):
        expected = c.expected if isinstance(c.expected, Column) else F.lit(c.expected)
        values += [c.observed.cast(_NUMBER).alias(f"o{i}"), expected.cast(_NUMBER).alias(f"e{i}")]
    lines = [
        F.struct(
            F.lit(c.name).alias("verificacao"),
            _COMPARE[c.rule](F.col(f"o{i}"), F.col(f"e{i}")).alias("aprovada"),
            F.col(f"o{i}").alias("observado"),
            F.col(f"e{i}").alias("esperado"),
        )
        for i, c in enumerate(checks)
    ]
    return df.agg(*values).select(F.inline(F.array(*lines)))


def all_of(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def failed(report: DataFrame) -> DataFrame:
    return report.where(~F.col("aprovada"))


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("linhas")).where(F.col("linhas") > 1)


def unique_key(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a key are no duplicates of each other: expectations count those."""
    whole = df.dropna(subset=list(keys))
    return run_checks(duplicated_keys(whole, keys), [Check(f"chave_unica_{name}", F.count("*"), "=", 0)])


def sales_checks(vendas: DataFrame, unregistered_share: float = 0.01, early_limit: int = 5) -> DataFrame:
    """Revenue formula, share of sales outside the catalogue, sales older than their product."""
    revenue = money.line_revenue(F.col("quantidade"), F.col("preco_unitario"))
    return run_checks(
        vendas,
        [
            Check("receita_igual_quantidade_x_preco", F.count_if(F.col("receita") != revenue), "=", 0),
            Check(
                "vendas_de_produto_nao_cadastrado",
                F.count_if(~F.col("produto_cadastrado")),
                "<",
                F.count("*") * F.lit(unregistered_share).cast("decimal(9,4)"),
            ),
            Check("vendas_antes_do_cadastro", F.count_if("venda_antes_do_cadastro"), "<=", early_limit),
        ],
    )


def customer_checks(clientes: DataFrame, honorifics: int) -> DataFrame:
    """Honorifics: as many as expected in the original names, none left in the cleaned ones."""
    return run_checks(
        clientes,
        [
            Check("clientes_com_tratamento", F.count_if(text.has_honorific(F.col("nome_original"))), "=", honorifics),
            Check("tratamento_restante", F.count_if(text.has_honorific(F.col("nome_cliente"))), "=", 0),
        ],
    )


def segment_checks(
    segmentos: DataFrame, limits: SegmentLimits = DEFAULT_LIMITS, counts: Mapping[str, int | Column] | None = None
) -> DataFrame:
    """Known segments only, no VIP below the limit, and, if given, the expected size of each: numbers,
    or those that `expected_segments` finds in the clean tables."""
    name, revenue = F.col("segmento_cliente"), F.col("receita")
    checks = [
        Check("segmento_desconhecido", F.count_if(~F.coalesce(name.isin(*money.SEGMENTS), F.lit(False))), "=", 0),
        Check("vip_abaixo_do_limite", F.count_if((name == "VIP") & (revenue < F.lit(limits.vip))), "=", 0),
    ]
    if counts:
        checks.append(Check("total_de_clientes", F.count("*"), "=", sum(counts.values())))
        checks += [Check(f"clientes_{s}", F.count_if(name == s), "=", n) for s, n in counts.items()]
    return run_checks(segmentos, checks)


def expected_segments(
    vendas: DataFrame,
    clientes: DataFrame,
    period: Period | None = DEFAULT_PERIOD,
    limits: SegmentLimits = DEFAULT_LIMITS,
) -> dict[str, Column]:
    """Customers per segment, straight from the clean tables; the rest of them are regular."""
    spent = vendas.where(calendar.within(F.col("data"), period)).groupBy("id_cliente").agg(F.sum("receita").alias("gasto"))
    known = spent.join(clientes.where(F.col("id_cliente").isNotNull()), "id_cliente", "left_semi")
    vip = known.where(F.col("gasto") >= F.lit(limits.vip)).agg(F.count("*")).scalar()
    upper = known.where(F.col("gasto") >= F.lit(limits.top_tier)).agg(F.count("*")).scalar()
    return {"VIP": vip, "TOP_TIER": upper - vip, "REGULAR": clientes.agg(F.count("*")).scalar() - upper}


def expected_prices(produtos: DataFrame, precos: DataFrame) -> dict[str, Column]:
    """What `price_checks` should find, straight from the clean tables, prices with their flag."""
    dearest = precos.groupBy("id_produto").agg(F.max("preco_concorrente").alias("maximo"))
    dearer = produtos.join(dearest, "id_produto").where(F.col("preco_atual") > F.col("maximo"))
    flagged = precos.where("preco_suspeito").agg(F.count_distinct("id_produto"))
    return {
        "products": produtos.agg(F.count("*")).scalar(),
        "dearest": dearer.agg(F.count("*")).scalar(),
        "with_suspicious": flagged.scalar(),
    }


def detail_checks(
    detalhe: DataFrame, rows: int | Column | None = None, ecommerce: int | Column | None = None, vendas: DataFrame | None = None
) -> DataFrame:
    """Every sale has segment and region; optionally the expected row counts, as numbers or, with
    ``vendas``, those of the sales themselves."""
    if vendas is not None:
        rows = vendas.agg(F.count("*")).scalar()
        ecommerce = vendas.agg(F.count_if(F.col("canal_venda") == "ecommerce")).scalar()
    incomplete = F.col("segmento_cliente").isNull() | F.col("regiao").isNull()
    checks = [Check("vendas_sem_segmento_ou_regiao", F.count_if(incomplete), "=", 0)]
    if rows is not None:
        checks.append(Check("linhas_vendas_detalhadas", F.count("*"), "=", rows))
    if ecommerce is not None:
        checks.append(Check("vendas_ecommerce", F.count_if(F.col("canal_venda") == "ecommerce"), "=", ecommerce))
    return run_checks(detalhe, checks)


def price_checks(
    precos: DataFrame, products: int | Column, dearest: int | Column, with_suspicious: int | Column
) -> DataFrame:
    dearer = F.col("classificacao_preco") == "MAIS_CARO_QUE_TODOS"
    return run_checks(
        precos,
        [
            Check("produtos_na_visao_de_precos", F.count("*"), "=", products),
            Check("mais_caros_que_todos", F.count_if(dearer), "=", dearest),
            Check("produtos_com_preco_suspeito", F.count_if("possui_preco_suspeito"), "=", with_suspicious),
        ],
    )


def same_revenue(vendas: DataFrame, marts: Mapping[str, DataFrame]) -> DataFrame:
    """Revenue of each mart against that of the sales, exact to the cent."""
    total = vendas.agg(F.sum("receita").cast(_NUMBER).alias("esperado"))
    sums = [m.agg(F.lit(n).alias("mart"), F.sum("receita").cast(_NUMBER).alias("observado")) for n, m in marts.items()]
    joined = all_of(sums).withColumn("esperado", total.scalar())
    return joined.select(
        F.concat(F.lit("receita_"), "mart").alias("verificacao"),
        F.col("observado").eqNullSafe(F.col("esperado")).alias("aprovada"),
        "observado",
        "esperado",
    )


def revenue_outside_segments(
    vendas: DataFrame, clientes: DataFrame, period: Period | None = DEFAULT_PERIOD
) -> DataFrame:
    """Why the segments' revenue differs from the sales': what lies outside the period, and what
    was bought by customers the customer table lacks. One row per customer is joined, not per sale."""
    inside = F.when(calendar.within(F.col("data"), period), F.col("receita"))
    spent = vendas.groupBy("id_cliente").agg(F.sum("receita").alias("tudo"), F.sum(inside).alias("no_periodo"))
    known = clientes.where(F.col("id_cliente").isNotNull()).select("id_cliente", F.lit(True).alias("conhecido"))
    parts = spent.join(known, "id_cliente", "left")
    zero = F.lit(0).cast("decimal(28,2)")
    return parts.agg(
        F.sum("tudo").alias("receita_vendas"),
        F.coalesce(F.sum(F.when(F.col("conhecido"), F.col("no_periodo"))), zero).alias("receita_segmentos"),
        (F.sum("tudo") - F.coalesce(F.sum("no_periodo"), zero)).alias("fora_do_periodo"),
        F.coalesce(F.sum(F.when(F.col("conhecido").isNull(), F.col("no_periodo"))), zero).alias("cliente_desconhecido"),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return all_of([df.agg(F.lit(n).alias("tabela"), F.count("*").alias("linhas")) for n, df in tables.items()])


def documentation(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: columns without a comment, of which there should be none, and that it can be read."""
    return all_of(
        [
            run_checks(
                df,
                [
                    Check(f"colunas_sem_comentario_{name}", F.lit(len(undocumented_columns({name: df}))), "=", 0),
                    Check(f"tabela_com_linhas_{name}", F.least(F.count("*"), F.lit(1)), "=", 1),
                ],
            )
            for name, df in tables.items()
        ]
    )


def undocumented_columns(tables: Mapping[str, DataFrame]) -> list[tuple[str, str]]:
    """(table, column) of every column without a comment; reads schemas only."""
    return [(name, f.name) for name, df in tables.items() for f in df.schema if not f.metadata.get("comment")]
