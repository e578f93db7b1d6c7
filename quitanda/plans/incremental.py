"""Sales marts that a refresh brings up to date from changed rows and days, not from all of history.

Every day has partial states: its hours, its sales per product, and its totals. A refresh finds the days
that changed rows or a changed catalogue touch, computes their states anew from their counting
sales, and stores them as a new version of these days; marts are sums over the states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quitanda.functions import calendar
from quitanda.operators.ledger import DAY, Ledger, by_order, day_of, difference, latest, read_touched, write_touched
from quitanda.operators.ledger import stored as stored_rows
from quitanda.operators.sieve import sieve, sifted
from quitanda.plans import gold, silver
from quitanda.session import scratch, shuffles_removed
from quitanda.settings import DEFAULT_PERIOD, Period
from quitanda.sources.sinks import write_files

# Columns of a sale that the states need, and its id.
SALE = ["id_venda", "data_venda", "id_cliente", "id_produto", "quantidade", "preco_unitario", "canal_venda"]
# What a refresh stores per touched day, by folder.
STATES = {
    "horas": (
        "data date, dia_semana_num int, dia_semana string, hora int, canal_venda string, total_vendas bigint, "
        "itens_vendidos bigint, receita decimal(28,2), clientes_unicos bigint"
    ),
    "produtos": (
        "data date, id_produto bigint, total_vendas bigint, itens_vendidos bigint, receita decimal(28,2), com_receita bigint, "
        "nao_cadastradas bigint, antes_do_cadastro bigint"
    ),
    "totais": (
        "data date, total_vendas bigint, receita decimal(28,2), com_receita bigint, nao_cadastradas bigint, antes_do_cadastro bigint"
    ),
}
CATALOGUE = "id_produto bigint, data_criacao timestamp_ntz"
# Parts the days of every product are dealt out to, so that a best seller is not one task's.
PARTS = 4


def sales_ledger(columns: StructType, order: list[str], home: str, buckets: int = 64, grain: int = DAY) -> Ledger:
    """The ledger of raw sales with the given columns, ``id_venda`` and ``data_venda`` among them."""
    return by_order(columns, "id_venda", "data_venda", order, home, buckets, grain)


def refresh_sales(
    changes: DataFrame,
    produtos: DataFrame,
    order: list[str],
    home: str,
    buckets: int = 64,
    grain: int = DAY,
    stored: bool = False,
) -> DataFrame:
    """Takes in changed raw sales; returns the days computed anew (one column, ``dia``).

    ``changes`` are raw sales with ``n``: 1 for a row that came, -1 for one that went (see
    `ledger.difference`); a corrected row is both. They are read several times: ``stored`` says that they are
    cheap to read. ``produtos`` is the clean catalogue as it is now: where a
    product came, went or got another creation date since the last refresh, the days it was sold on
    count as touched. ``order`` decides between copies of a sale, as in `silver.typed_sales`; it,
    ``buckets`` and ``grain`` (days, or months where days are small) must stay the same. Of the ledger the buckets of changed ids are read, of the sales
    the touched days. Nothing is seen before the note at the end; a refresh that failed is simply
    called again.
    """
    spark = changes.sparkSession
    columns = StructType([f for f in changes.schema if f.name != "n"])
    ledger = sales_ledger(columns, order, home, buckets, grain)
    with shuffles_removed(spark):
        last, _, base = ledger.state(spark)
        version = last + 1
        sold = ledger.take(changes, version, base, stored)

        now = produtos.select("id_produto", "data_criacao")
        now.write.mode("overwrite").parquet(f"{home}/catalogo/versao={version}")
        catalogue = stored_rows(spark, f"{home}/catalogo", f"{CATALOGUE}, versao bigint")
        before, after = (catalogue.where(F.col("versao") == v).drop("versao") for v in (last, version))
        changed = difference(before, after).select("id_produto").distinct()
        # Days touched anyway need no look at their products, and few others have one that may have changed.
        elsewhere = _states(spark, home, "produtos", last, base).join(F.broadcast(sold), "dia", "left_anti")
        maybe = sifted(elsewhere.select("id_produto", "dia"), "id_produto", sieve(changed, "id_produto")).where("_may")
        relabelled = maybe.join(changed, "id_produto", "left_semi").select("dia").distinct()
        touched = write_touched(sold.union(relabelled).distinct(), home, version)
        _compute(ledger, touched, after, version, base)
        ledger.note(spark, version, version, base)
    return touched


def compact_sales(
    spark: SparkSession, columns: StructType, order: list[str], home: str, buckets: int = 64, grain: int = DAY
) -> None:
    """Gathers all versions into one, without what cancels out; marts stay the same."""
    ledger = sales_ledger(columns, order, home, buckets, grain)
    version = ledger.compact(spark)
    if version is None:
        return
    catalogue = stored_rows(spark, f"{home}/catalogo", f"{CATALOGUE}, versao bigint")
    now = catalogue.where(F.col("versao") == version - 1).drop("versao")
    now.write.mode("overwrite").parquet(f"{home}/catalogo/versao={version}")
    days = ledger.days(spark).where(F.col("versao") == version).select("dia").distinct()
    now = stored_rows(spark, f"{home}/catalogo", f"{CATALOGUE}, versao bigint").where(F.col("versao") == version).drop("versao")
    _compute(ledger, write_touched(days, home, version), now, version, version)
    ledger.note(spark, version, version, version)


def _compute(ledger: Ledger, touched: DataFrame, catalogue: DataFrame, version: int, base: int) -> None:
    """The states of the touched days; a few files per state, since states are small.

    What of the days' sales must be netted is netted once and stored for the three states, below a folder
    that goes when they are; the rest is read from the days as it is.
    """
    with scratch(touched.sparkSession) as folder:
        sure, netted = ledger.current_parts(touched, version, base, folder, SALE)
        sales = sure.unionByName(write_files(netted, f"{folder}/sales"))
        _write_states(ledger, silver.with_sale_columns(sales), catalogue, version)


def _write_states(ledger: Ledger, sales: DataFrame, catalogue: DataFrame, version: int) -> None:
    def write(name: str, df: DataFrame) -> DataFrame:
        kinds = [c.split() for c in STATES[name].split(", ")]
        typed = df.select("dia", *[F.col(c).cast(t).alias(c) for c, t in kinds])
        laid = typed.sortWithinPartitions("data", "id_produto") if name == "produtos" else typed.hint("rebalance", F.col("dia"))
        laid.write.mode("overwrite").option("compression", "zstd").parquet(f"{ledger.home}/{name}/versao={version}")
        return sales.sparkSession.read.schema(f"dia string, {STATES[name]}").parquet(f"{ledger.home}/{name}/versao={version}")

    in_day = lambda df: df.withColumn("dia", day_of(F.col("data"), ledger.grain))
    write("horas", in_day(gold.vendas_temporais(sales, None, stored=True)))

    # One shuffle of narrow rows, by product, serves the catalogue, the states per product and, from these, the totals.
    narrow = sales.select("id_produto", "data_venda", "quantidade", "receita")
    flagged = silver.flag_sales(narrow, catalogue, cut=("_parte", calendar.day(F.col("data_venda")), PARTS))
    per_product = flagged.groupBy("_parte", "id_produto", calendar.day(F.col("data_venda")).alias("data")).agg(
        F.count("*").alias("total_vendas"),
        F.sum("quantidade").alias("itens_vendidos"),
        F.sum("receita").alias("receita"),
        F.count("receita").alias("com_receita"),
        F.count_if(~F.col("produto_cadastrado")).alias("nao_cadastradas"),
        F.count_if("venda_antes_do_cadastro").alias("antes_do_cadastro"),
    )
    per_product = write("produtos", in_day(per_product))
    added = ["total_vendas", "receita", "com_receita", "nao_cadastradas", "antes_do_cadastro"]
    write("totais", per_product.groupBy("dia", "data").agg(*[F.sum(c).alias(c) for c in added]))


def _states(spark: SparkSession, home: str, name: str, version: int, base: int) -> DataFrame:
    """The states of all days, each from the version that last touched it."""
    rows = stored_rows(spark, f"{home}/{name}", f"dia string, {STATES[name]}, versao bigint")
    return latest(rows.where(F.col("versao").between(base, version)), read_touched(spark, home, version, base))


def _valid(spark: SparkSession, home: str, name: str, period: Period | None) -> DataFrame:
    version, _, base = by_order(StructType(), "id_venda", "data_venda", [], home).state(spark)
    return _states(spark, home, name, version, base).where(calendar.within(F.col("data"), period))


def vendas_temporais(spark: SparkSession, home: str, period: Period | None = DEFAULT_PERIOD) -> DataFrame:
    """`gold.vendas_temporais` of all sales taken in, read from the states of the period's days."""
    return _valid(spark, home, "horas", period).drop("dia", "versao")


def _mean() -> Column:
    """The mean revenue of the sales that have one, from its sum and their number, as Spark's avg types it."""
    paid = F.nullif(F.sum("com_receita"), F.lit(0))
    return (F.sum("receita") / paid).cast("decimal(22,6)")


def vendas_produtos(
    spark: SparkSession, home: str, produtos: DataFrame, period: Period | None = None, folder: str | None = None
) -> DataFrame:
    """`gold.vendas_produtos` of all sales taken in, from the states per day and product."""
    per_product = _valid(spark, home, "produtos", period).groupBy("id_produto")
    sold = per_product.agg(
        F.sum("total_vendas").alias("total_vendas"),
        F.sum("itens_vendidos").alias("itens_vendidos"),
        F.round(_mean(), 2).alias("ticket_medio"),
        F.sum("receita").alias("receita"),
    )
    return gold.ranked_products(sold, produtos, folder)


def vendas_totais(spark: SparkSession, home: str, period: Period | None = None) -> DataFrame:
    """`gold.vendas_totais` of all sales taken in, from the totals per day."""
    return _valid(spark, home, "totais", period).agg(
        F.coalesce(F.sum("total_vendas"), F.lit(0)).alias("total_vendas"),
        _mean().alias("ticket_medio"),
        F.sum("receita").alias("receita_total"),
        F.sum("nao_cadastradas").alias("vendas_produto_nao_cadastrado"),
        F.sum("antes_do_cadastro").alias("vendas_antes_do_cadastro"),
    )
