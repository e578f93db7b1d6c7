"""Sales per hour and channel, kept up to date from a stream of new sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quitanda.operators.dedupe import keep_first
from quitanda.operators.ledger import Ledger, by_order, day_of, latest, read_touched, stored, write_touched

COLUMNS = ["id_venda", "data_venda", "id_cliente", "canal_venda", "quantidade", "receita"]
TABLE_SCHEMA = (
    "data date, hora int, canal_venda string, total_vendas bigint, itens_vendidos bigint, receita decimal(28,2), "
    "clientes_unicos bigint"
)


def sales_stream(
    spark: SparkSession, folder: str, schema: StructType, files: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    """New files of ``folder`` as a stream, a bounded number of them per batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _hours(once: DataFrame) -> DataFrame:
    return once.groupBy(F.to_date("data_venda").alias("data"), F.hour("data_venda").alias("hora"), "canal_venda").agg(
        F.count("*").alias("total_vendas"),
        F.sum("quantidade").cast("bigint").alias("itens_vendidos"),
        F.sum("receita").cast("decimal(28,2)").alias("receita"),
        F.count_distinct("id_cliente").alias("clientes_unicos"),
    )


def hourly_sales(sales: DataFrame) -> DataFrame:
    """Sales, items, revenue and distinct customers per hour and channel; each sale id counts once.

    ``sales`` has (id_venda, data_venda, id_cliente, canal_venda, quantidade, receita); of several
    rows with an id the first by moment counts, rows without an id count each.
    """
    return _hours(keep_first(sales.select(*COLUMNS), ["id_venda"], ["data_venda"]))


def _ledger(home: str, schema: StructType, buckets: int = 64) -> Ledger:
    return by_order(StructType([schema[c] for c in COLUMNS]), "id_venda", "data_venda", ["data_venda"], home, buckets)


def refresh_hourly_sales(sales: DataFrame, home: str, buckets: int = 64) -> DataFrame:
    """Takes in all files that arrived since the last call and returns the table of hours.

    ``sales`` streams the columns of `hourly_sales`; ``home`` is a folder all executors share. Every
    batch of the stream is landed as it is under its number, so a batch that is tried again replaces
    itself. What was landed since the last call then meets the ledger of sale ids: an id that comes
    again on an earlier day moves there, and both days count as touched. Touched days are computed
    anew from their counting rows and stored as a new version, which one small note makes valid: a
    reader sees the old or the new table. The result equals `hourly_sales` of all rows so far, however
    they were split over files, batches and calls, and no sale comes too late. Of the ledger a call
    reads the buckets of new ids, of the sales the touched days (``buckets`` must stay the same).
    """
    spark = sales.sparkSession
    ledger, landed = _ledger(home, sales.schema, buckets), f"{home}/landed"

    def land(batch: DataFrame, number: int) -> None:
        batch.select(*COLUMNS).write.mode("overwrite").parquet(f"{landed}/lote={number}")

    stream = sales.writeStream.option("checkpointLocation", f"{home}/state").trigger(availableNow=True).foreachBatch(land)
    stream.start().awaitTermination()

    version, upto, base = ledger.state(spark)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ledger.columns)
    new = stored(spark, landed, f"{ddl}, lote bigint").where(F.col("lote") > upto)
    newest = new.agg(F.max("lote")).first()[0]
    if newest is not None:
        version += 1
        days = ledger.take(new.select(*COLUMNS, F.lit(1).cast("bigint").alias("n")), version, base, stored=True)
        _compute(ledger, write_touched(days, home, version), version, base)
        ledger.note(spark, version, newest, base)
    return read_hourly_sales(spark, home)


def _compute(ledger: Ledger, touched: DataFrame, version: int, base: int) -> None:
    names = [f.split()[0] for f in TABLE_SCHEMA.split(", ")]
    hours = _hours(ledger.current(touched, version, base)).select(*names)
    hours.write.mode("overwrite").parquet(f"{ledger.home}/table/versao={version}")


def compact_hourly_sales(sales: DataFrame, home: str, buckets: int = 64) -> DataFrame:
    """Gathers all versions into one, without what cancels out; the table stays the same.

    ``sales`` gives the schema only. Folders of older versions may be removed afterwards by whoever owns
    ``home``, once no reader uses them.
    """
    spark, ledger = sales.sparkSession, _ledger(home, sales.schema, buckets)
    version = ledger.compact(spark)
    if version is not None:
        _, upto, _ = ledger.state(spark)
        days = ledger.days(spark).where(F.col("versao") == version).select("dia").distinct()
        _compute(ledger, write_touched(days, home, version), version, version)
        ledger.note(spark, version, upto, version)
    return read_hourly_sales(spark, home)


def read_hourly_sales(spark: SparkSession, home: str) -> DataFrame:
    """The table of hours: every day from the last valid version that touched it."""
    version, _, base = by_order(StructType(), "id_venda", "data_venda", [], home).state(spark)
    rows = stored(spark, f"{home}/table", f"{TABLE_SCHEMA}, versao bigint").where(F.col("versao").between(base, version))
    by_day = rows.withColumn("dia", day_of(F.col("data")))
    return latest(by_day, read_touched(spark, home, version, base)).drop("versao", "dia")
