"""Row expectations: named predicates that every row of a cleaned table should meet.

A predicate that is NULL for a row counts as violated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, FAIL, DROP = "warn", "fail", "drop"
KEPT, SET_ASIDE = "mantida", "quarentena"


@dataclass(frozen=True)
class Expectation:
    """``severity`` is what happens to violations; ``strict`` the stricter one that was promised."""

    name: str
    predicate: str
    severity: str = WARN
    strict: str = FAIL

    def met(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    def level(self, strict: bool) -> str:
        return self.strict if strict else self.severity


# The expectations of the cleaned tables.
EXPECTATIONS = {
    "clientes": [
        Expectation("id_cliente_nao_preenchido", "id_cliente IS NOT NULL"),
        Expectation("regiao_nao_preenchida", "regiao IS NOT NULL"),
    ],
    "produtos": [
        Expectation("id_produto_nao_preenchido", "id_produto IS NOT NULL"),
        Expectation("preco_nao_positivo", "preco_atual > 0"),
    ],
    "vendas": [
        Expectation("id_venda_nao_preenchido", "id_venda IS NOT NULL", FAIL),
        Expectation("data_venda_nao_preenchida", "data IS NOT NULL", FAIL),
        Expectation("id_cliente_nao_preenchido", "id_cliente IS NOT NULL", FAIL),
        Expectation("id_produto_nao_preenchido", "id_produto IS NOT NULL", FAIL),
        Expectation("quantidade_invalida", "quantidade IS NOT NULL AND quantidade > 0", FAIL),
        Expectation("preco_unitario_nao_positivo", "preco_unitario > 0", FAIL),
        Expectation("canal_venda_invalido", "canal_venda IN ('ecommerce', 'loja_fisica')"),
        Expectation("produto_nao_cadastrado", "produto_cadastrado = true", WARN, WARN),
        Expectation("venda_depois_do_cadastro", "venda_depois_do_cadastro", WARN, WARN),
        Expectation("receita_nao_calculada", "receita IS NOT NULL", WARN, WARN),
    ],
    "preco_competidores": [
        Expectation("id_produto_nao_preenchido", "id_produto IS NOT NULL"),
        Expectation("preco_concorrente_nao_positivo", "preco_concorrente > 0"),
        Expectation("preco_plausivel", "NOT preco_suspeito", WARN, WARN),
    ],
}


def _violations(exps: Sequence[Expectation]) -> list[Column]:
    return [F.count_if(~e.met()).alias(f"v{i}") for i, e in enumerate(exps)]


def report(df: DataFrame, exps: Sequence[Expectation], strict: bool = False) -> DataFrame:
    """One row per expectation: name, severity, rows, violations. One aggregate over ``df``."""
    counted = df.agg(F.count("*").alias("linhas"), *_violations(exps))
    lines = [
        F.struct(
            F.lit(e.name).alias("expectativa"),
            F.lit(e.level(strict)).alias("severidade"),
            F.col("linhas"),
            F.col(f"v{i}").alias("violacoes"),
        )
        for i, e in enumerate(exps)
    ]
    return counted.select(F.inline(F.array(*lines)))


def guard(df: DataFrame, exps: Sequence[Expectation], strict: bool = False) -> DataFrame:
    """``df`` as it may be stored: the job that reads it fails at the first violation of severity
    ``fail`` and leaves out rows violating one of severity ``drop``. No extra pass."""
    for e in exps:
        if e.level(strict) == FAIL:
            alarm = F.raise_error(F.lit(f"expectation {e.name} violated: {e.predicate}")).cast("boolean")
            df = df.where(F.when(e.met(), F.lit(True)).otherwise(alarm))
    kept = [e.met() for e in exps if e.level(strict) == DROP]
    return df.where(reduce(and_, kept)) if kept else df


def observe(df: DataFrame, exps: Sequence[Expectation]) -> tuple[DataFrame, Observation]:
    """Counts violations while ``df`` is written; read them with :func:`observed` afterwards."""
    watch = Observation()
    return df.observe(watch, F.count("*").alias("linhas"), *_violations(exps)), watch


def observed(watch: Observation, exps: Sequence[Expectation]) -> dict[str, int]:
    counts = watch.get
    return {e.name: counts[f"v{i}"] for i, e in enumerate(exps)}


def _violated(exps: Sequence[Expectation]) -> Column:
    """Names of the violated expectations, comma-joined; empty if there is none."""
    return F.concat_ws(",", *[F.when(~e.met(), F.lit(e.name)) for e in exps])


def quarantine(df: DataFrame, exps: Sequence[Expectation]) -> DataFrame:
    """The rows that violate any expectation, with the names of those they violate."""
    return df.withColumn("violadas", _violated(exps)).where(F.col("violadas") != "")


class Split(NamedTuple):
    """Rows that may be used and rows set aside, both with ``violadas``, and violations by name."""

    kept: DataFrame
    quarantined: DataFrame
    violations: dict[str, int]


def store_split(df: DataFrame, exps: Sequence[Expectation], path: str, strict: bool = False) -> Split:
    """Stores all rows of ``df`` below ``path`` in one job, which reads it once: rows that violate an
    expectation of severity ``drop`` in the partition ``situacao=quarentena``, all others in
    ``situacao=mantida``, each with the names of what it violates. So kept and quarantined rows together are
    the input. A violation of severity ``fail`` fails the job, and nothing can be read at ``path``. Where
    no rule is of severity ``drop``, all rows are kept.
    """
    watched, watch = observe(df, exps)
    checked = guard(watched, [e for e in exps if e.level(strict) == FAIL], strict)
    kept = reduce(and_, [e.met() for e in exps if e.level(strict) == DROP], F.lit(True))
    marked = checked.withColumns({"violadas": _violated(exps), "situacao": F.when(kept, KEPT).otherwise(SET_ASIDE)})
    marked.write.mode("error").partitionBy("situacao").parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    parts = [stored.where(F.col("situacao") == s).drop("situacao") for s in (KEPT, SET_ASIDE)]
    return Split(*parts, observed(watch, exps))
