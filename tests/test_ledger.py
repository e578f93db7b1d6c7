"""The ledger of sales: any split of rows over refreshes, corrections, pruning, compaction, failures."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from quitanda.operators.dedupe import keep_first
from quitanda.operators.ledger import Ledger, by_order, difference, write_touched
from quitanda.session import new_location
from quitanda.streaming import hourly_sales as hourly
from quitanda.streaming.hourly_sales import compact_hourly_sales, hourly_sales, read_hourly_sales, refresh_hourly_sales, sales_stream

SALES = "id_venda bigint, data_venda timestamp, id_cliente bigint, canal_venda string, quantidade int, receita decimal(18,2)"


def sales_rows(seed, n=120):
    """Sales that come again on other days, with other values, without an id or a moment."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        moment = dt.datetime(2026, 1, draw.randint(1, 4), draw.randint(8, 10), draw.choice([0, 30]))
        rows.append(
            (
                draw.choice([None, *range(25)]),
                None if draw.random() < 0.05 else moment,
                draw.choice([None, 1, 2, 3]),
                draw.choice(["web", "shop"]),
                draw.choice([None, 1, 2]),
                D(draw.randint(1, 400)) / 100,
            )
        )
    return rows


def plain(df):
    return sorted(str(tuple(r)) for r in df.select([f.split()[0] for f in hourly.TABLE_SCHEMA.split(", ")]).collect())


def add(spark, rows, source):
    spark.createDataFrame(rows, SALES).coalesce(1).write.mode("append").parquet(source)


def stream(spark, source):
    return sales_stream(spark, source, spark.createDataFrame([], SALES).schema, files_per_batch=2)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_over_refreshes_gives_the_table_of_all_rows(spark, tmp_path, seed):
    source, home = str(tmp_path / "in"), str(tmp_path / "home")
    rows, draw = sales_rows(seed), random.Random(seed)
    while rows:
        for _ in range(draw.randint(1, 2)):
            size = draw.randint(1, 50)
            part, rows = rows[:size], rows[size:]
            if part:
                add(spark, part, source)
        table = refresh_hourly_sales(stream(spark, source), home, buckets=8)
    assert plain(table) == plain(hourly_sales(spark.read.schema(SALES).parquet(source)))


def test_a_sale_that_comes_again_on_an_earlier_day_moves_there(spark, tmp_path):
    source, home = str(tmp_path / "in"), str(tmp_path / "home")
    sale = lambda i, day: (i, dt.datetime(2026, 1, day, 9), 1, "web", 1, D("1.00"))
    add(spark, [sale(1, 2)], source)
    assert [r.data.day for r in refresh_hourly_sales(stream(spark, source), home).collect()] == [2]
    add(spark, [sale(1, 1)], source)
    # Its old day has no sale left, and so no hour.
    assert [(r.data.day, r.total_vendas) for r in refresh_hourly_sales(stream(spark, source), home).collect()] == [(1, 1)]
    add(spark, [sale(1, 3), sale(2, 3)], source)
    table = refresh_hourly_sales(stream(spark, source), home).collect()
    assert sorted((r.data.day, r.total_vendas) for r in table) == [(1, 1), (3, 1)]
    # The last call computed day 3 only.
    touched = spark.read.parquet(f"{home}/touched").where("versao = 2").collect()
    assert [r.dia for r in touched] == ["2026-01-03"]


def test_failed_and_repeated_refresh(spark, tmp_path, monkeypatch):
    source, home = str(tmp_path / "in"), str(tmp_path / "home")
    rows = sales_rows(3)
    add(spark, rows[:60], source)
    before = plain(refresh_hourly_sales(stream(spark, source), home))
    add(spark, rows[60:], source)
    right = hourly._compute
    monkeypatch.setattr(hourly, "_compute", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh_hourly_sales(stream(spark, source), home)
    assert plain(read_hourly_sales(spark, home)) == before
    monkeypatch.setattr(hourly, "_compute", right)
    table = refresh_hourly_sales(stream(spark, source), home)
    assert plain(table) == plain(hourly_sales(spark.createDataFrame(rows, SALES)))


def test_compaction_keeps_the_table_and_what_comes_later(spark, tmp_path):
    source, home = str(tmp_path / "in"), str(tmp_path / "home")
    rows = sales_rows(4)
    for at in (0, 40):
        add(spark, rows[at : at + 40], source)
        table = refresh_hourly_sales(stream(spark, source), home)
    before = plain(table)
    assert plain(compact_hourly_sales(spark.createDataFrame([], SALES), home)) == before
    notes = spark.read.parquet(f"{home}/notes").orderBy("version").collect()
    assert [(r.version, r.base) for r in notes] == [(0, 0), (1, 0), (2, 2)]
    add(spark, rows[80:], source)
    table = refresh_hourly_sales(stream(spark, source), home)
    assert plain(table) == plain(hourly_sales(spark.createDataFrame(rows, SALES)))
    assert compact_hourly_sales(spark.createDataFrame([], SALES), str(tmp_path / "nothing")).count() == 0


def _ledger(spark, home):
    schema = spark.createDataFrame([], SALES).schema
    return by_order(schema, "id_venda", "data_venda", ["data_venda"], home, 8)


def test_rows_taken_away_and_corrected(spark):
    home = new_location(spark, "ledger")
    ledger = _ledger(spark, home)
    versions = [sales_rows(seed, 80) for seed in (5, 6, 7)] + [[]]
    now = spark.createDataFrame([], SALES)
    for number, rows in enumerate(versions):
        after = spark.createDataFrame(rows, SALES)
        touched = write_touched(ledger.take(difference(now, after), number), home, number)
        now = after
        everywhere = ledger.days(spark).select("dia").distinct()
        seen = ledger.current(everywhere, number).drop("dia")
        wanted = keep_first(after, ["id_venda"], ["data_venda"])
        assert sorted(map(str, seen.collect())) == sorted(map(str, wanted.select(seen.columns).collect())), number
        ledger.note(spark, number, number, 0)
        assert touched.count() > 0
    assert seen.count() == 0


def test_only_touched_days_and_buckets_are_read(spark):
    home = new_location(spark, "ledger")
    ledger = _ledger(spark, home)
    rows = spark.createDataFrame(sales_rows(8), SALES).withColumn("n", F.lit(1).cast("bigint"))
    ledger.take(rows, 0)
    touched = write_touched(spark.createDataFrame([("2026-01-02",)], "dia string"), home, 0)
    plan = ledger.current(touched, 0)._jdf.queryExecution().toString()
    assert "dynamicpruning#" in plan
    # Buckets without an id of the batch are not opened: their files may be gone.
    one = rows.where("id_venda = 1").withColumn("data_venda", F.expr("data_venda - interval 1 year"))
    bucket = one.select(F.pmod(F.xxhash64("id_venda"), F.lit(8))).first()[0]
    for folder in Path(home, "ledger", "versao=0").glob("balde=*"):
        if folder.name != f"balde={bucket}":
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"not a table")
    assert ledger.take(one, 1).count() > 0
    assert {r.dia for r in ledger.current(touched, 0).collect()} == {"2026-01-02"}


def test_columns_that_cannot_be_ordered_are_refused():
    schema = StructType([StructField("id", StringType()), StructField("m", MapType(StringType(), StringType()))])
    with pytest.raises(ValueError, match="m"):
        by_order(schema, "id", "id", [], "/nowhere")


def test_difference_counts_repeats(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    b = spark.createDataFrame([(1, "x"), (3, "y")], "a int, b string")
    assert sorted(map(tuple, difference(a, b).collect()), key=str) == [(1, "x", -1), (2, None, -1), (3, "y", 1)]


def test_a_row_alone_with_its_id_is_not_shuffled(spark, monkeypatch):
    """What is marked in a shuffle are rows that may share their id, in the batch or with earlier ones."""
    shuffled = []
    right = Ledger._marked

    def marked(self, rows, *more):
        shuffled.append(sorted(str(r[0]) for r in rows.select("id_venda").collect()))
        return right(self, rows, *more)

    monkeypatch.setattr(Ledger, "_marked", marked)
    home = new_location(spark, "ledger")
    ledger = _ledger(spark, home)
    sale = lambda i, day: (i, dt.datetime(2026, 1, day, 9), 1, "web", 1, D("1.00"))
    batches = [[sale(i, 1) for i in range(50)] + [sale(7, 2), sale(None, 3)], [sale(i, 2) for i in range(60, 90)] + [sale(8, 1), sale(9, 2)]]
    for number, batch in enumerate(batches):
        ledger.take(spark.createDataFrame(batch, SALES).withColumn("n", F.lit(1).cast("bigint")), number)
    assert shuffled == [["7", "7", "None"], ["8", "8", "9", "9"]]
    seen = ledger.current(ledger.days(spark).select("dia").distinct(), 1).drop("dia")
    wanted = keep_first(spark.createDataFrame([r for b in batches for r in b], SALES), ["id_venda"], ["data_venda"])
    assert sorted(map(str, seen.collect())) == sorted(map(str, wanted.select(seen.columns).collect()))


def test_only_what_may_be_taken_away_is_netted(spark):
    home = new_location(spark, "ledger")
    ledger = _ledger(spark, home)
    sale = lambda i, day: (i, dt.datetime(2026, 1, day, 9), i, "web", 1, D("1.00"))
    versions = [[sale(i, 1) for i in range(40)], [sale(i, 1) for i in range(39)] + [sale(39, 2)], [sale(i, 1) for i in range(40)]]
    now = spark.createDataFrame([], SALES)
    for number, rows in enumerate(versions):
        after = spark.createDataFrame(rows, SALES)
        ledger.take(difference(now, after), number)
        now, everywhere = after, ledger.days(spark).select("dia").distinct()
        whole = sorted(map(str, ledger.current(everywhere, number).drop("dia").collect()))
        assert whole == sorted(map(str, after.collect()))
        for needed in (None, ["id_venda", "data_venda", "canal_venda"]):
            sure, netted = ledger.current_parts(everywhere, number, needed=needed)
            assert sure.columns == netted.columns == [*(needed or ledger.names), "dia"]
            assert netted.count() == 0 and sure.count() == 40  # what came last, 39 among it, is not netted


def test_an_id_with_very_many_rows_is_cut(spark):
    """Its rows lie in many parts, and the first of all of them counts, before and after a correction."""
    home = new_location(spark, "ledger")
    ledger = _ledger(spark, home)
    hot = [(1, dt.datetime(2026, 1, 1 + i % 28, i % 24, i % 60), i, "web", 1, D("1.00")) for i in range(300)]
    rows = hot + [(i % 40, dt.datetime(2026, 2, 1 + i % 28), 1, "shop", 1, D("2.00")) for i in range(100)]
    before = spark.createDataFrame([], SALES)
    for number, some in enumerate([rows, rows[3:], rows[2:300]]):
        after = spark.createDataFrame(some, SALES)
        ledger.take(difference(before, after), number)
        before = after
        seen = ledger.current(ledger.days(spark).select("dia").distinct(), number).drop("dia")
        wanted = keep_first(after, ["id_venda"], ["data_venda"])
        assert sorted(map(str, seen.collect())) == sorted(map(str, wanted.select(seen.columns).collect())), number
    marked = ledger._marked(spark.createDataFrame(rows, SALES).withColumn("n", F.lit(1)), F.col("id_venda").isNotNull(), F.lit(0))
    # Where no earlier row is known, only the first counts.
    assert [r.vale for r in marked.where("id_venda = 1 AND vale <> 0").collect()] == [1]
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert "_hot" in plan
