"""Times the headline queries, each from the raw tables to its full result, and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from quitanda.plans import gold, kpi
from quitanda.plans.refresh import refresh
from quitanda.session import local_session, new_location
from quitanda.sources import benchmark_tables as raw
from quitanda.sources.sinks import into_files
from quitanda.workload.queries import LIMITS, PERIOD, all_queries

HEADLINE = [
    "silver_produtos", "silver_clientes", "silver_vendas", "silver_preco_competidores",
    "gold_vendas_temporais", "gold_clientes_segmentacao", "gold_vendas_produtos", "gold_vendas_detalhadas",
    "gold_precos_competitividade", "gold_vendas_totais", "gold_clientes_por_regiao",
    "gold_produtos_por_faixa_preco", "gold_preco_competitivo_resumo",
    "kpi_ltv", "kpi_cac", "kpi_ticket_medio", "kpi_conversion", "kpi_churn", "kpi_revenue_cube", "kpi_abc",
    "kpi_top_products", "kpi_segment_channel", "expectations_vendas", "check_reconciliation",
]


def stored_marts(spark, sf_dir: str) -> dict:
    """The marts as a refresh computes them: from clean tables that are stored once."""
    views = {v.__name__: v(spark, sf_dir) for v in (raw.produtos, raw.clientes, raw.vendas, raw.preco_competidores)}
    orders = {"clientes": raw.CLIENTES_ORDER, "vendas": raw.VENDAS_ORDER, "preco_competidores": raw.PRECOS_ORDER}
    tables = refresh(views, into_files(new_location(spark, "bench")), PERIOD, LIMITS, orders).tables
    sales, products, people, prices = (
        tables[f"silver.{n}"] for n in ("vendas", "produtos", "clientes", "preco_competidores")
    )
    segments = tables["gold.clientes_segmentacao"]
    return {
        "vendas_temporais": lambda *_: gold.vendas_temporais(sales, PERIOD),
        "clientes_segmentacao": lambda *_: gold.clientes_segmentacao(people, sales, PERIOD, LIMITS),
        "vendas_produtos": lambda *_: gold.vendas_produtos(sales, products),
        "vendas_detalhadas": lambda *_: gold.vendas_detalhadas(sales, products, segments),
        "precos_competitividade": lambda *_: gold.precos_competitividade(products, prices, sales, PERIOD),
        "kpi_ltv": lambda *_: kpi.lifetime_value(sales),
    }


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    queries = all_queries()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run(queries[name], spark, sf_dir)  # warm-up: code generation and class loading
        seconds[name] = round(min(run(queries[name], spark, sf_dir) for _ in range(2)), 3)
    stored = {}
    for name, query in {} if sys.argv[1:] else stored_marts(spark, sf_dir).items():
        run(query, spark, sf_dir)
        stored[name] = round(min(run(query, spark, sf_dir) for _ in range(2)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, best of two after a warm-up, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "from_stored_tables": stored,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
