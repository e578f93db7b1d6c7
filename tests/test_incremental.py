"""Marts brought up to date from changes equal the marts of all rows."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from quitanda.operators.ledger import difference
from quitanda.plans import gold, incremental, silver
from quitanda.session import new_location, path_exists, shuffles_removed
from quitanda.sources.sinks import write_files

RAW = (
    "id_venda bigint, data_venda timestamp_ntz, id_cliente bigint, id_produto bigint, quantidade int, "
    "preco_unitario double, canal_venda string"
)
RAW_NAMES = [c.split()[0] for c in RAW.split(", ")]
ORDER = ["data_venda", "id_cliente"]
PRODUCTS = "id_produto bigint, nome_produto string, categoria string, marca string, preco_atual double, data_criacao timestamp_ntz"


def sales(spark, seed, n=60):
    draw = random.Random(seed)
    rows = [
        (
            draw.choice([None, *range(20)]),
            None if draw.random() < 0.05 else dt.datetime(2026, draw.randint(1, 3), draw.randint(1, 3), draw.randint(8, 10)),
            draw.choice([None, 1, 2, 3]),
            draw.choice([None, 1, 2, 3, 4]),
            draw.choice([None, 1, 2]),
            draw.choice([None, 9.99, 5.0]),
            draw.choice(["ecommerce", "loja_fisica"]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, RAW)


def products(spark, *created):
    rows = [(i, f"p{i}", "c" if i % 2 else None, "m", 10.0 * i, at) for i, at in created]
    return silver.silver_produtos(spark.createDataFrame(rows, PRODUCTS))


def lines(df):
    return sorted(str(tuple(r)) for r in df.select(sorted(df.columns)).collect())


def assert_equal(spark, home, raw, produtos):
    clean = silver.silver_vendas(raw, produtos, ORDER)
    assert lines(incremental.vendas_temporais(spark, home, None)) == lines(gold.vendas_temporais(clean, None))
    assert lines(incremental.vendas_produtos(spark, home, produtos)) == lines(gold.vendas_produtos(clean, produtos))
    assert lines(incremental.vendas_totais(spark, home)) == lines(gold.vendas_totais(clean))


def test_inserts_corrections_removals_and_catalogue(spark):
    home = new_location(spark, "daily")
    early, late = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 2, 9)
    nothing = sales(spark, 0, 0)
    steps = [
        (sales(spark, 1), products(spark, (1, early), (2, early))),
        (sales(spark, 1).union(sales(spark, 2)), products(spark, (1, early), (2, late), (4, None))),  # rows come, labels change
        (sales(spark, 1).where("id_venda <> 3").union(sales(spark, 3)), products(spark, (1, late), (4, late))),
    ]
    before = nothing
    for raw, produtos in steps:
        touched = incremental.refresh_sales(difference(before, raw), produtos, ORDER, home, 4)
        before = raw
    assert touched.count() > 0
    assert_equal(spark, home, raw, produtos)
    same = incremental.refresh_sales(difference(raw, raw), produtos, ORDER, home, 4)
    assert same.count() == 0
    columns = raw.schema
    incremental.compact_sales(spark, columns, ORDER, home, 4)
    assert spark.read.parquet(f"{home}/notes").agg(F.max("base")).first()[0] == 4
    assert_equal(spark, home, raw, produtos)


def test_a_refresh_nets_the_touched_sales_once(spark, monkeypatch):
    """The three states read them stored, and nothing of that is left."""
    stored = []

    def write(df, path):
        stored.append((df.columns, path))
        return write_files(df, path)

    monkeypatch.setattr(incremental, "write_files", write, raising=False)
    home, raw = new_location(spark, "daily"), sales(spark, 5)
    incremental.refresh_sales(difference(raw.limit(0), raw), products(spark, (1, None)), ORDER, home, 4)
    assert [set(RAW_NAMES) | {"dia"}] == [set(columns) for columns, _ in stored]
    assert not path_exists(spark, stored[0][1])


def test_rows_of_a_batch_are_netted_where_they_are_written(spark):
    """One shuffle brings equal rows together and buckets to files; a bucket is cut into a few of them."""
    home, raw = new_location(spark, "daily"), sales(spark, 6, 400)
    ledger = incremental.sales_ledger(raw.schema, ORDER, home, 2)
    batch = difference(raw.limit(0), raw)
    ledger.take(batch.unionByName(batch).unionByName(batch.withColumn("n", -F.col("n"))).repartition(8), 0)
    stored = spark.read.parquet(f"{home}/ledger/versao=0")
    assert sorted(map(str, stored.select(*RAW_NAMES, "n").collect())) == sorted(map(str, batch.select(*RAW_NAMES, "n").collect()))
    where = F.coalesce(F.pmod(F.xxhash64("id_venda"), F.lit(2)).cast("int"), F.lit(-1))
    assert stored.where(F.col("balde") != where).isEmpty()


def test_totals_and_products_come_from_one_shuffle_of_sales(spark):
    """The states per product hold what the totals add up; no product's days are all one task's."""
    home, raw = new_location(spark, "daily"), sales(spark, 7, 200)
    produtos = products(spark, (1, dt.datetime(2026, 2, 2, 9)), (2, None))
    incremental.refresh_sales(difference(raw.limit(0), raw), produtos, ORDER, home, 4)
    assert_equal(spark, home, raw, produtos)
    states = spark.read.parquet(f"{home}/produtos")
    assert states.groupBy("data", "id_produto").count().where("count > 1").isEmpty()
    added = ["total_vendas", "receita", "com_receita", "nao_cadastradas", "antes_do_cadastro"]
    by_product, totals = (df.agg(*[F.sum(c).alias(c) for c in added]).first() for df in (states, spark.read.parquet(f"{home}/totais")))
    assert by_product == totals and totals.nao_cadastradas > 0 and totals.antes_do_cadastro > 0


def test_shuffle_files_go_with_the_query_that_made_them(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(setting, None), []
    with shuffles_removed(spark):
        seen.append(spark.conf.get(setting))
    assert seen == ["true"] and spark.conf.get(setting, None) == before
    home, raw = new_location(spark, "daily"), sales(spark, 8)
    incremental.refresh_sales(difference(raw.limit(0), raw), products(spark, (1, None)), ORDER, home, 4)
    assert spark.conf.get(setting, None) == before


def test_hours_of_stored_sales_count_customers_alike(spark):
    clean = silver.silver_vendas(sales(spark, 9, 150), products(spark, (1, None)), ORDER)
    assert lines(gold.vendas_temporais(clean, None, stored=True)) == lines(gold.vendas_temporais(clean, None))
