"""A stored ledger of sales by id: what every change of the raw rows changes in the deduplicated ones, day by day."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quitanda.operators.dedupe import sortable
from quitanda.operators.lookup import hot_keys
from quitanda.operators.sieve import sieve, sifted
from quitanda.session import path_exists, scratch
from quitanda.sources.sinks import write_files

WITHOUT_DAY = "sem_data"
# Characters of the ISO date that name a partition: days, or months where days are small.
DAY, MONTH = 10, 7
NOTE = "version bigint, batch bigint, base bigint"


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What is stored at ``path``, nothing if nobody has stored anything yet."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows to add to ``before`` and to take away (negative ``n``) to get ``after``, repeats counted."""
    signed = before.withColumn("n", F.lit(-1)).unionByName(after.withColumn("n", F.lit(1)))
    return signed.groupBy(*before.columns).agg(F.sum("n").alias("n")).where("n <> 0")


def day_of(moment: Column, grain: int = DAY) -> Column:
    """The partition a moment lies in; never NULL, so that plain equality prunes partitions."""
    return F.coalesce(F.substring(moment.cast("date").cast("string"), 1, grain), F.lit(WITHOUT_DAY))


@dataclass(frozen=True)
class Ledger:
    """Signed rows below ``home``, in versions that a note makes valid.

    ``columns`` is the schema of the raw rows, ``key`` their id, ``moment`` the column that gives the
    day, ``order`` which of several rows with an id counts: the first, as in `keep_first`. Two folders
    grow by what changes, and nothing in them is ever rewritten:

    - ``ledger``, by bucket of the id: every raw row and how often it came (``n``, negative
      where it was taken away), and whether it began or ceased to count (``vale``, 1 and -1). Reading the
      buckets of a batch tells the row that counted for an id before and the one that counts now.
    - ``days``, by day (or month, see ``grain``): counting rows that came (1) and went (-1), rows without an id as they are.

    So any split of the same rows over versions, in any order, leaves the same counting rows on every
    day. A version is valid once its note is there; a refresh that fails before that is repeated under
    its number and replaces what it left. There is one writer at a time.
    """

    home: str
    columns: StructType
    key: str
    moment: str
    order: tuple[str, ...]
    buckets: int = 64
    grain: int = DAY

    def __post_init__(self) -> None:
        odd = [f.name for f in self.columns if not sortable(f.dataType)]
        if odd:
            raise ValueError(f"rows cannot be ordered by {', '.join(odd)}")

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.columns]

    def _read(self, spark: SparkSession, folder: str, partition: str) -> DataFrame:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.columns)
        return stored(spark, f"{self.home}/{folder}", f"{ddl}, n bigint, versao bigint, {partition}")

    def days(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "days", "dia string")

    def state(self, spark: SparkSession) -> tuple[int, int, int]:
        """(version, batch, base) of the last note; versions from ``base`` on hold everything."""
        notes = stored(spark, f"{self.home}/notes", NOTE)
        last = notes.orderBy(F.desc("version")).first()
        return (-1, -1, 0) if last is None else tuple(last)

    def note(self, spark: SparkSession, version: int, batch: int, base: int) -> None:
        spark.createDataFrame([(version, batch, base)], NOTE).coalesce(1).write.mode("append").parquet(f"{self.home}/notes")

    def valid(self, df: DataFrame, version: int, base: int) -> DataFrame:
        return df.where(F.col("versao").between(base, version))

    def _write(self, df: DataFrame, folder: str, partition: str, version: int) -> None:
        df.write.mode("overwrite").option("compression", "zstd").partitionBy(partition).parquet(
            f"{self.home}/{folder}/versao={version}"
        )

    def _write_days(self, df: DataFrame, version: int) -> None:
        """One file per day, more where it is large; months are few, so every task writes its own part of them."""
        self._write(df.hint("rebalance", F.col("dia")) if self.grain == DAY else df, "days", "dia", version)

    def take(self, rows: DataFrame, version: int, base: int = 0, stored: bool = False) -> DataFrame:
        """Takes in ``rows`` (the columns and ``n``) as the given version; returns the days that changed.

        Rows are read several times, so they are stored first unless they are already (``stored``). Earlier
        rows come along where a sieve of the batch's ids lets them pass. Only rows that may share their id with
        another one are then shuffled; a row alone counts as it is.
        """
        spark = rows.sparkSession
        known, may, none = F.col(self.key).isNotNull(), F.col("_may"), F.lit(0).cast("bigint")
        bucket = F.coalesce(F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"), F.lit(-1))
        with scratch(spark) as folder:
            rows = rows.select(*self.names, "n")
            if not stored:
                rows = write_files(rows, f"{folder}/batch")
            if version > base:
                of_batch = rows.where(known).select(bucket).distinct().collect()  # at most ``buckets`` rows
                ids = write_files(sieve(rows, self.key), f"{folder}/ids")
                old = self.valid(self._read(spark, "ledger", "balde int"), version - 1, base)
                old = sifted(old.where(F.col("balde").isin([b for b, in of_batch])), self.key, ids).where(may)
                old = old.select(*self.names, none.alias("n"), F.col("n").alias("_n0"))
                rows = rows.withColumn("_n0", none).unionByName(old)
            several = rows.where(known).groupBy(self.key).agg(F.count("*").alias("_rows")).where("_rows > 1")
            told = sifted(rows, self.key, write_files(sieve(several, self.key), f"{folder}/several"))
            marked = self._marked(told.where(~known | may).drop("_may"), known, bucket)
            vale = (F.col("n") > 0).cast("bigint").alias("vale")
            alone = told.where(known & ~may).select(*self.names, "n", vale, bucket.alias("balde"))
            self._write(marked.unionByName(alone).where("n <> 0 OR vale <> 0"), "ledger", "balde", version)

        changed = self._read(spark, "ledger", "vale bigint, balde int").where((F.col("versao") == version) & (F.col("vale") != 0))
        days = changed.select(*self.names, F.col("vale").alias("n"), day_of(F.col(self.moment), self.grain).alias("dia"))
        self._write_days(days, version)
        return self.days(spark).where(F.col("versao") == version).select("dia").distinct()

    def _marked(self, rows: DataFrame, known: Column, bucket: Column) -> DataFrame:
        """Every different row of ``rows`` once, with its bucket (balde), ``n`` summed, and ``vale``: 1 where it counts from now on,
        -1 where it no longer does, else 0; rows without an id as they are. ``_n0`` is how often a row came before.

        Rows go to parts of their buckets, a few per task, where all rows of an id meet; an id with very
        many rows is cut, and which of them count is known before.
        """
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot = [r[0] for r in hot_keys(rows, self.key).select(self.key).collect()]  # two per task at most
        cut = F.xxhash64(*self.names)
        by_id = known & ~F.col(self.key).isin(hot) if hot else known
        part = F.pmod(F.when(by_id, F.xxhash64(self.key, F.lit(1))).otherwise(cut), F.lit(4 * math.ceil(tasks / self.buckets)))
        before = F.sum("_n0") if "_n0" in rows.columns else F.lit(0)
        sums = [F.sum("n").cast("bigint").alias("n"), before.cast("bigint").alias("_n0")]

        rest = [*self.order, *[c for c in self.names if c != self.key and c not in self.order]]
        row = F.struct(*rest)
        first = [F.min(F.when(F.col(n) > 0, row)) for n in ("_n0", "_n1")]
        net = lambda df, *by: df.groupBy(*by, *self.names).agg(*sums).withColumn("_n1", F.col("_n0") + F.col("n"))
        # The place is an expression, so that the shuffle does not carry it.
        held = net(rows.repartition(bucket, part).withColumns({"balde": bucket, "_part": part}), "balde", "_part")
        alike = Window.partitionBy("balde", "_part", self.key)
        held = held.withColumns({name: agg.over(alike) for name, agg in zip(("_old", "_new"), first)})
        if hot:
            of_hot = net(rows.where(F.col(self.key).isin(hot))).groupBy(F.col(self.key).alias("_hot"))
            of_hot = F.broadcast(of_hot.agg(first[0].alias("_hot_old"), first[1].alias("_hot_new")))
            held = held.join(of_hot, F.col(self.key) == F.col("_hot"), "left")
            held = held.withColumns(
                {c: F.when(F.col("_hot").isNull(), F.col(c)).otherwise(F.col(f"_hot{c}")) for c in ("_old", "_new")}
            )
        is_old, is_new = ((F.col(n) > 0) & row.eqNullSafe(F.col(c)) for n, c in (("_n0", "_old"), ("_n1", "_new")))
        change = is_new.cast("bigint") - is_old.cast("bigint")
        return held.select(*self.names, "n", F.when(known, change).otherwise(F.col("n")).alias("vale"), "balde")

    def current(self, days: DataFrame, version: int, base: int = 0) -> DataFrame:
        """The counting rows of the given days (one column, ``dia``); only their partitions are read."""
        sure, netted = self.current_parts(days, version, base)
        return sure.unionByName(netted)

    def current_parts(
        self, days: DataFrame, version: int, base: int = 0, folder: str | None = None, needed: Sequence[str] | None = None
    ) -> tuple[DataFrame, DataFrame]:
        """`current` in two parts: rows that nothing takes away, read as they are, and the rest, which is netted.

        Read as they are: rows of ids of which these days take none away, as a sieve tells that is stored in
        ``folder`` where one is given, and what the last version brought. Both have ``needed`` columns and dia;
        the id and the moment must be among them.
        """
        needed = list(needed or self.names)
        rows = self.valid(self.days(days.sparkSession), version, base)
        # One row per day, so no more than a calendar holds.
        rows = rows.join(F.broadcast(days.select(F.col("dia").alias("_dia"))), F.col("dia") == F.col("_dia"), "left_semi")
        # A row goes in a later version than it came, and again in a later one if it came again.
        rows = rows.select(*self.names, "n", ((F.col("versao") == version) & (F.col("n") > 0)).alias("_last"))
        gone = sieve(rows.where("n < 0"), self.key)
        if folder is not None:
            gone = write_files(gone, f"{folder}/gone")
        known = F.col(self.key).isNotNull()
        sure = known & (F.col("_last") | ~F.col("_may"))
        told = sifted(rows, self.key, gone)
        day = day_of(F.col(self.moment), self.grain).alias("dia")
        # What came and went of an id leaves its counting rows whichever columns are looked at. A row without an id may
        # have gone before it came, so it is netted whole.
        whole = [c if c in needed else F.when(~known, F.col(c)).alias(c) for c in self.names]
        net = told.where(~sure).select(*whole, "n").groupBy(*self.names).agg(F.sum("n").cast("int").alias("n")).where("n > 0")
        copies = net.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("n"))))
        return told.where(sure).select(*needed, day), copies.select(*needed, day)

    def compact(self, spark: SparkSession) -> int | None:
        """Writes all that is valid as one new version without what cancels out; older ones may then go.

        Returns the new version, to be noted with itself as base once everything beside the ledger is
        in it too; None if there is nothing.
        """
        version, _, base = self.state(spark)
        if version < 0:
            return None
        for folder, partition in (("ledger", "balde int"), ("days", "dia string")):
            rows, name = self.valid(self._read(spark, folder, partition), version, base), partition.split()[0]
            net = rows.groupBy(*self.names, name).agg(F.sum("n").alias("n")).where("n <> 0")
            if folder == "days":
                self._write_days(net, version + 1)
            else:
                self._write(net.hint("rebalance", F.col(name)), folder, name, version + 1)
        return version + 1


def latest(table: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of ``table`` (with dia and versao) in the version that last touched their day."""
    last = touched.groupBy(F.col("dia").alias("_dia")).agg(F.max("versao").alias("_versao"))  # a row per day
    same = reduce(and_, [F.col("dia") == F.col("_dia"), F.col("versao") == F.col("_versao")])
    return table.join(F.broadcast(last), same, "left_semi")


def write_touched(days: DataFrame, home: str, version: int) -> DataFrame:
    """Stores the days that a version computes anew, and reads them back.

    They are read by the filter on the version: Spark prunes partitions by a join only where the other
    side is filtered.
    """
    days.select("dia").coalesce(1).write.mode("overwrite").parquet(f"{home}/touched/versao={version}")
    all_days = days.sparkSession.read.schema("dia string, versao bigint").parquet(f"{home}/touched")
    return all_days.where(F.col("versao") == version).select("dia")


def read_touched(spark: SparkSession, home: str, version: int, base: int) -> DataFrame:
    return stored(spark, f"{home}/touched", "dia string, versao bigint").where(F.col("versao").between(base, version))


def by_order(
    columns: StructType, key: str, moment: str, order: Sequence[str], home: str, buckets: int = 64, grain: int = DAY
) -> Ledger:
    return Ledger(home.rstrip("/"), columns, key, moment, tuple(order), buckets, grain)
