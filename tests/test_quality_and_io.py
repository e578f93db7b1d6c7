"""Expectations, checks, profiles, readers, sinks, refresh and stream."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quitanda.operators import checks, expectations
from quitanda.operators.expectations import DROP, EXPECTATIONS, FAIL, WARN, Expectation
from quitanda.operators.profile import profile
from quitanda.plans import silver
from quitanda.plans.comments import GOLD_COMMENTS
from quitanda.plans.refresh import refresh
from quitanda.session import new_location, shared_folder
from quitanda.settings import Period, SegmentLimits
from quitanda.sources import benchmark_tables as bench
from quitanda.sources import raw
from quitanda.sources.sinks import clustered, documented, into_catalog, into_files, read_published, write_files
from quitanda.streaming.hourly_sales import refresh_hourly_sales, sales_stream


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1, 5), (2, -1), (3, None), (None, 4)], "id int, n int")


RULES = [Expectation("id", "id IS NOT NULL", FAIL), Expectation("positive", "n > 0", WARN, DROP)]


def test_report_counts_null_as_violation(numbers):
    rows = [tuple(r) for r in expectations.report(numbers, RULES).collect()]
    assert rows == [("id", "fail", 4, 1), ("positive", "warn", 4, 2)]
    assert [r.severidade for r in expectations.report(numbers, RULES, strict=True).collect()] == ["fail", "drop"]


def test_guard(numbers):
    with pytest.raises(Exception, match="expectation id violated"):
        expectations.guard(numbers, RULES).collect()
    known = numbers.where("id is not null")
    assert expectations.guard(known, RULES).count() == 3
    assert [r.id for r in expectations.guard(known, RULES, strict=True).collect()] == [1]


def test_observe_counts_while_writing(spark, numbers):
    df, watch = expectations.observe(numbers, RULES)
    write_files(df, new_location(spark, "observed"))
    assert expectations.observed(watch, RULES) == {"id": 1, "positive": 2}


def test_quarantine(numbers):
    rows = {(r.id, r.n): r.violadas for r in expectations.quarantine(numbers, RULES).collect()}
    assert rows == {(2, -1): "positive", (3, None): "positive", (None, 4): "id"}


def test_split_is_stored_in_one_job_and_loses_no_row(spark, numbers):
    rules = [Expectation("id", "id IS NOT NULL"), Expectation("positive", "n > 0", DROP)]
    place = new_location(spark, "split")
    split = expectations.store_split(numbers, rules, place)
    assert {tuple(r) for r in split.kept.collect()} == {(1, 5, ""), (None, 4, "id")}
    assert {tuple(r) for r in split.quarantined.collect()} == {(2, -1, "positive"), (3, None, "positive")}
    assert split.violations == {"id": 1, "positive": 2}
    assert {p.name for p in Path(place).glob("situacao=*")} == {"situacao=mantida", "situacao=quarentena"}
    failing = new_location(spark, "split")
    with pytest.raises(Exception, match="expectation id violated"):
        expectations.store_split(numbers, RULES, failing)
    assert not list(Path(failing).glob("situacao=*"))
    everything = expectations.store_split(numbers.where("id > 1"), RULES[:1], new_location(spark, "split"))
    assert everything.kept.count() == 2 and everything.quarantined.count() == 0


def test_expectations_are_complete():
    sizes = {t: len(e) for t, e in EXPECTATIONS.items()}
    assert sizes == {"clientes": 2, "produtos": 2, "vendas": 10, "preco_competidores": 3}
    fail = {e.name for e in EXPECTATIONS["vendas"] if e.severity == FAIL}
    assert len(fail) == 6 and "canal_venda_invalido" not in fail
    assert all(e.strict == FAIL for t in ("clientes", "produtos") for e in EXPECTATIONS[t])


def test_unique_key_ignores_rows_without_key(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "k int")
    row = checks.unique_key("t", df, ["k"]).first()
    assert (row.verificacao, row.aprovada, row.observado) == ("chave_unica_t", False, 1)
    assert checks.unique_key("t", df.distinct(), ["k"]).first().aprovada


def test_checks_on_segments_details_and_prices(spark):
    segments = spark.createDataFrame(
        [("VIP", D("21000.00")), ("VIP", D("23000.00")), ("GOLD", D("1.00")), (None, D("1.00"))],
        "segmento_cliente string, receita decimal(18,2)",
    )
    seen = {r.verificacao: (r.aprovada, int(r.observado)) for r in checks.segment_checks(segments, counts={"VIP": 2}).collect()}
    assert seen == {
        "segmento_desconhecido": (False, 2), "vip_abaixo_do_limite": (False, 1),
        "total_de_clientes": (False, 4), "clientes_VIP": (True, 2),
    }
    detail = spark.createDataFrame(
        [("VIP", "Sul", "ecommerce"), ("VIP", None, "loja_fisica")], "segmento_cliente string, regiao string, canal_venda string"
    )
    assert [r.aprovada for r in checks.detail_checks(detail, 2, 1).collect()] == [False, True, True]
    prices = spark.createDataFrame(
        [("MAIS_CARO_QUE_TODOS", True), ("NA_MEDIA", None)], "classificacao_preco string, possui_preco_suspeito boolean"
    )
    assert checks.failed(checks.price_checks(prices, 2, 1, 1)).count() == 0


def test_sales_checks_find_wrong_revenue(spark):
    df = spark.createDataFrame(
        [(2, D("1.50"), D("3.00"), True, False), (2, D("1.50"), D("3.01"), False, True)],
        "quantidade int, preco_unitario decimal(10,2), receita decimal(18,2), produto_cadastrado boolean, "
        "venda_antes_do_cadastro boolean",
    )
    assert [(r.aprovada, float(r.observado)) for r in checks.sales_checks(df).collect()] == [(False, 1), (False, 1), (True, 1)]
    assert checks.sales_checks(df, 0.6, 0).collect()[1].aprovada


def test_same_revenue(spark):
    sales = spark.createDataFrame([(D("1.10"),), (D("2.20"),)], "receita decimal(18,2)")
    rows = checks.same_revenue(sales, {"a": sales, "b": sales.limit(1)}).collect()
    assert {r.verificacao: r.aprovada for r in rows} == {"receita_a": True, "receita_b": False}


def test_profile(spark, numbers):
    rows = {r.coluna: tuple(r)[1:] for r in profile(numbers).collect()}
    assert rows == {"id": (4, 1, 3, "1", "3"), "n": (4, 1, 3, "-1", "5")}


def test_read_raw_formats(spark, tmp_path):
    (tmp_path / "v.csv").write_text("1,2026-01-05 10:00:00,2,3,4,9.99,ecommerce\n2,2026-01-05 10:00:00,2,3,x,abc,ecommerce\n")
    text = raw.read_raw(spark, "vendas", str(tmp_path / "v.csv"), "csv")
    assert dict(text.dtypes)["preco_unitario"] == "string" and text.count() == 2
    wide = spark.createDataFrame([("7", "n", "c", "m", "bad", "2026-01-01", "kept")], "id_produto string, nome_produto string, categoria string, marca string, preco_atual string, data_criacao string, other string")
    path = str(tmp_path / "p")
    wide.write.parquet(path)
    row = raw.read_raw(spark, "produtos", path).first()
    assert (row.id_produto, row.preco_atual, row.other) == (7, None, "kept")
    with pytest.raises(ValueError, match="lacks"):
        raw.conform(wide.drop("marca"), "produtos")


def test_catalog_tables(spark, numbers):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    store = into_catalog(None, "shop", "shop", new_location(spark, "shop"))
    store("silver", "numbers", documented(numbers, {"id": "It's the \\ key"}))
    store("gold", "__materialization_1", numbers)
    assert raw.list_tables(spark, "shop") == []
    store.publish()
    assert raw.list_tables(spark, "shop") == ["numbers"]
    assert raw.read_table(spark, "numbers", "shop").count() == 4
    assert raw.read_table(spark, "numbers", "shop", "spark_catalog").count() == 4
    comments = {c.name: c.description for c in spark.catalog.listColumns("shop.numbers")}
    assert comments["id"] == "It's the \\ key"


def test_clustered_files_have_narrow_ranges_and_split_a_hot_day(spark):
    day = "date_add(date'2026-01-01', cast(if(id % 3 = 0, 0, id % 60) as int))"
    df = spark.range(20_000).selectExpr("id", f"{day} as data")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = write_files(clustered(df, "data", "id"), new_location(spark, "clustered"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = stored.groupBy(F.input_file_name().alias("f")).agg(F.min("data").alias("a"), F.max("data").alias("b"), F.count("*").alias("n"))
    found = sorted(files.collect(), key=lambda r: (r.a, r.b))
    assert len(found) == 4 and max(r.n for r in found) < 20_000 / 3
    assert all(x.b <= y.a for x, y in zip(found, found[1:]))


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named and new_location(spark, "t").startswith(named)


def test_a_cluster_must_name_its_shared_folder():
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *_: None),
        sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(cluster)


PERIOD, LIMITS = Period.of("1997-01-01", "1997-01-30"), SegmentLimits(D("3000000"), D("1000000"))
ORDERS = {"clientes": bench.CLIENTES_ORDER, "vendas": bench.VENDAS_ORDER, "preco_competidores": bench.PRECOS_ORDER}


@pytest.fixture(scope="module")
def raw_tables(spark, tiny):
    views = (bench.produtos, bench.clientes, bench.vendas, bench.preco_competidores)
    return {view.__name__: view(spark, tiny) for view in views}


@pytest.fixture(scope="module")
def warehouse(spark, raw_tables):
    return refresh(raw_tables, into_files(new_location(spark, "warehouse")), PERIOD, LIMITS, ORDERS)


def test_refresh_stores_every_table(warehouse):
    assert len(warehouse.tables) == 13
    assert all("parquet" in df.inputFiles()[0] for df in warehouse.tables.values())


def test_refresh_equals_the_lazy_marts(spark, tiny, warehouse):
    from quitanda.workload.queries import all_queries

    for name in ("vendas_temporais", "vendas_detalhadas", "precos_competitividade", "clientes_segmentacao"):
        lazy = all_queries()[f"gold_{name}"](spark, tiny)
        stored = warehouse.tables[f"gold.{name}"]
        stored = stored.select(*[F.col(c).cast(t) for c, t in lazy.dtypes])
        assert stored.exceptAll(lazy).count() == lazy.exceptAll(stored).count() == 0, name


def test_refresh_counts_violations_while_writing(warehouse):
    for name, counts in warehouse.violations.items():
        report = expectations.report(warehouse.tables[f"silver.{name}"], EXPECTATIONS[name]).collect()
        assert counts == {r.expectativa: r.violacoes for r in report}
    assert warehouse.violations["vendas"]["venda_depois_do_cadastro"] > 0
    assert warehouse.violations["preco_competidores"]["id_produto_nao_preenchido"] > 0


def test_every_mart_column_is_documented(warehouse):
    marts = {n.removeprefix("gold."): df for n, df in warehouse.tables.items() if n.startswith("gold.")}
    assert set(marts) == set(GOLD_COMMENTS)
    assert checks.undocumented_columns(marts) == []


def test_refresh_stops_at_a_failed_expectation(spark, raw_tables):
    broken = {**raw_tables, "vendas": raw_tables["vendas"].withColumn("quantidade", F.lit(0))}
    with pytest.raises(Exception, match="quantidade_invalida"):
        refresh(broken, into_files(new_location(spark, "broken")))


def test_strict_refresh_stops_at_promised_severities(spark, raw_tables):
    with pytest.raises(Exception, match="regiao_nao_preenchida"):
        refresh(raw_tables, into_files(new_location(spark, "strict")), strict=True)


def test_refresh_into_catalog_tables(spark, raw_tables, warehouse):
    for schema in ("clean", "marts"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    done = refresh(raw_tables, into_catalog("spark_catalog", "clean", "marts"), PERIOD, LIMITS, ORDERS)
    assert done.violations == warehouse.violations
    assert len(raw.list_tables(spark, "clean")) == 4 and len(raw.list_tables(spark, "marts")) == 9
    assert raw.read_table(spark, "vendas", "clean").count() == warehouse.tables["silver.vendas"].count()
    assert all(c.description for c in spark.catalog.listColumns("marts.vendas_detalhadas"))


SALES = "id_venda bigint, data_venda timestamp, id_cliente bigint, canal_venda string, quantidade int, receita decimal(18,2)"


def hours_of(spark, source, home, files_per_batch=1000):
    stream = sales_stream(spark, source, spark.createDataFrame([], SALES).schema, files_per_batch=files_per_batch)
    return refresh_hourly_sales(stream, home)


def test_stream_adds_new_files_and_counts_each_sale_once(spark, tmp_path):
    source, home = str(tmp_path / "in"), str(tmp_path / "home")

    def add(*rows):
        spark.createDataFrame(list(rows), SALES).coalesce(1).write.mode("append").parquet(source)

    def run():
        table = hours_of(spark, source, home).collect()
        return {(r.data.day, r.hora, r.canal_venda): (r.total_vendas, r.itens_vendidos, r.receita, r.clientes_unicos) for r in table}

    at = lambda h, m=0, day=5: dt.datetime(2026, 1, day, h, m)
    add((1, at(9), 1, "web", 2, D("5.00")), (2, at(9, 59), 1, "web", 1, D("1.00")), (1, at(9), 1, "web", 2, D("5.00")))
    assert run() == {(5, 9, "web"): (2, 3, D("6.00"), 1)}
    add((2, at(9, 59), 1, "web", 1, D("1.00")), (3, at(10), 2, "shop", 1, D("9.00")))
    assert run() == {(5, 9, "web"): (2, 3, D("6.00"), 1), (5, 10, "shop"): (1, 1, D("9.00"), 1)}
    assert len(run()) == 2
    add((4, at(8, day=9), 3, "web", 1, D("2.00")))  # another day leaves the first one's version alone
    add((5, at(9, 1), 4, "web", 1, D("3.00")))  # late
    assert run()[5, 9, "web"] == (3, 4, D("9.00"), 2) and run()[9, 8, "web"] == (1, 1, D("2.00"), 1)


@pytest.mark.parametrize("files_per_batch", [1, 2, 1000])
def test_stream_does_not_depend_on_batches_or_order(spark, tmp_path, files_per_batch):
    """Files out of order over a year, each sale twice in different files."""
    moment = "timestampadd(HOUR, cast(pmod(id * 7919, 8760) as int), timestamp'2025-01-01 00:00:00')"
    sales = spark.range(600).selectExpr(
        "id as id_venda", f"{moment} as data_venda", "id % 7 as id_cliente", "'web' as canal_venda", "1 as quantidade",
        "cast(id as decimal(18,2)) as receita",
    )
    for month in (6, 1, 12, 3):
        sales.where(F.month("data_venda") % 3 == month % 3).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = hours_of(spark, str(tmp_path / "in"), str(tmp_path / "home"), files_per_batch)
    wanted = sales.groupBy(F.to_date("data_venda").alias("d"), F.hour("data_venda").alias("h")).agg(F.count("*"), F.sum("receita"))
    found = table.select("data", "hora", "total_vendas", F.col("receita").cast("decimal(28,2)"))
    present = wanted.join(found.select(F.col("data").alias("d"), F.col("hora").alias("h")), ["d", "h"], "left_semi")
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, map(tuple, present.collect())))
    assert table.agg(F.sum("total_vendas")).first()[0] == sales.where("month(data_venda) % 3 = 0 or month(data_venda) % 3 = 1").count()


def test_stream_of_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert hours_of(spark, str(tmp_path / "in"), str(tmp_path / "home")).count() == 0


def test_a_failed_refresh_leaves_the_published_tables(spark, raw_tables):
    home = new_location(spark, "lake")
    refresh(raw_tables, into_files(home), PERIOD, LIMITS, ORDERS)
    before = {n: sorted(map(str, df.collect())) for n, df in read_published(spark, home).items()}
    broken = {**raw_tables, "vendas": raw_tables["vendas"].withColumn("quantidade", F.lit(0))}
    with pytest.raises(Exception, match="quantidade_invalida"):
        refresh(broken, into_files(home), PERIOD, LIMITS, ORDERS)
    after = {n: sorted(map(str, df.collect())) for n, df in read_published(spark, home).items()}
    assert len(before) == 13 and before == after
    half = {**raw_tables, "vendas": raw_tables["vendas"].where("id_cliente % 2 = 0")}
    refresh(half, into_files(home), PERIOD, LIMITS, ORDERS)
    assert read_published(spark, home)["silver.vendas"].count() < len(before["silver.vendas"])
    assert read_published(spark, new_location(spark, "nowhere")) == {}


def test_a_failed_refresh_leaves_the_catalog_tables(spark, raw_tables):
    for schema in ("kept_clean", "kept_marts"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    store = lambda: into_catalog("spark_catalog", "kept_clean", "kept_marts", new_location(spark, "tables"))
    read = lambda: {
        f"{s}.{t}": sorted(map(str, spark.table(f"{s}.{t}").collect()))
        for s in ("kept_clean", "kept_marts")
        for t in raw.list_tables(spark, s)
    }
    refresh(raw_tables, store(), PERIOD, LIMITS, ORDERS)
    before = read()
    broken = {**raw_tables, "vendas": raw_tables["vendas"].withColumn("quantidade", F.lit(0))}
    with pytest.raises(Exception, match="quantidade_invalida"):
        refresh(broken, store(), PERIOD, LIMITS, ORDERS)
    assert len(before) == 13 and read() == before
    half = {**raw_tables, "vendas": raw_tables["vendas"].where("id_cliente % 2 = 0")}
    refresh(half, store(), PERIOD, LIMITS, ORDERS)
    assert len(read()["kept_clean.vendas"]) < len(before["kept_clean.vendas"])


def test_dropped_rows_are_counted(spark, raw_tables, monkeypatch):
    rules = [expectations.Expectation("id_produto_nao_preenchido", "id_produto IS NOT NULL", expectations.DROP)]
    monkeypatch.setitem(EXPECTATIONS, "preco_competidores", rules)
    done = refresh(raw_tables, into_files(new_location(spark, "dropping")), PERIOD, LIMITS, ORDERS)
    stored = done.tables["silver.preco_competidores"]
    dropped = done.violations["preco_competidores"]["id_produto_nao_preenchido"]
    assert stored.where("id_produto IS NULL").count() == 0 and dropped > 0
    lazy = silver.typed_competitor_prices(raw_tables["preco_competidores"], ORDERS["preco_competidores"])
    assert stored.count() + dropped == lazy.count()


def test_a_refresh_leaves_nothing_behind(spark, raw_tables):
    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = {p.name for p in shared.iterdir()}
    refresh(raw_tables, into_files(str(shared / "only-this")), PERIOD, LIMITS, ORDERS)
    assert {p.name for p in shared.iterdir()} - before == {"only-this"}


def test_an_absurd_sale_does_not_stop_the_others(spark):
    rows = [(1, dt.datetime(2026, 1, 1), 1, 1, 2147483647, "99999999.99", "web"), (2, dt.datetime(2026, 1, 1), 1, 1, 2, "1.50", "web")]
    sales = spark.createDataFrame(rows, "id_venda bigint, data_venda timestamp_ntz, id_cliente bigint, id_produto bigint, quantidade int, preco_unitario string, canal_venda string")
    found = {r.id_venda: r.receita for r in silver.typed_sales(sales).collect()}
    assert found == {1: None, 2: D("3.00")}


def test_exact_profile_counts_values_in_narrow_rows(spark):
    """Distinct values are those Spark tells apart: one zero, one NaN, NULL none; no row is padded per column."""
    kinds = (
        "i int, s string, f double, g float, d decimal(9,2), t timestamp, n timestamp_ntz, b boolean, y binary, "
        "a array<int>, r struct<x: int, y: double>, l date"
    )
    at = dt.datetime(2026, 10, 25, 1, 30)
    rows = [
        (1, "", 0.0, 0.0, D("1.00"), at, at, True, b"\xff", [1], (1, 0.0), dt.date(2026, 1, 1)),
        (1, " ", -0.0, -0.0, D("1.0"), at, at, True, b"\xfe", [1], (1, 0.5), dt.date(2026, 1, 1)),
        (None, None, float("nan"), float("nan"), None, at + dt.timedelta(hours=1), None, False, b"", [], None, None),
        (2, "", float("nan"), 1.5, D("2.00"), None, at + dt.timedelta(microseconds=1), None, None, None, (1, 0.5), None),
    ]
    df = spark.createDataFrame(rows, kinds)
    wanted = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    result = profile(df, "exact")
    assert {r.coluna: r.distintos for r in result.collect()} == wanted
    assert {r.distintos for r in profile(df.limit(0), "exact").collect()} == {0}
    narrow = profile(df.select("i", "s", "f"), "exact")
    assert "Expand" not in narrow._jdf.queryExecution().optimizedPlan().toString()
