"""Column functions on hand-made rows with NULL and boundary values."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from quitanda.functions import calendar, money, text
from quitanda.functions.states import STATES, state_table
from quitanda.plans.gold import band_position
from quitanda.settings import Period, SegmentLimits


def apply(spark, schema: str, values, fn):
    """``fn`` over the columns of one-row inputs."""
    df = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)], f"i int, {schema}")
    columns = [F.col(c) for c in df.columns[1:]]
    return [r.x for r in df.select("i", fn(*columns).alias("x")).orderBy("i").collect()]


def test_person_name(spark):
    names = {
        "Sr. João silva": "João Silva",
        "sra.MARIA lima": "Maria Lima",
        "Srta. Ana": "Ana",
        "Dr . Paulo": "Paulo",
        "Dra Rita": "Rita",
        "  dr. Zé ": "Zé",
        "Drauzio Melo": "Drauzio Melo",
        "Sraa B": "Sraa B",
        "Dr.": "",
        None: None,
    }
    assert apply(spark, "n string", names, text.person_name) == list(names.values())


def test_has_honorific(spark):
    values = ["Sr. A", "SRA B", "Srta.C", "Drauzio", "A Dr. B", None]
    assert apply(spark, "n string", values, text.has_honorific) == [True, True, True, False, False, None]


def test_product_name(spark):
    assert apply(spark, "n string", ["  BIG red Ball ", None], text.product_name) == ["Big Red Ball", None]


def test_label_or(spark):
    found = apply(
        spark, "k int, v string", [(None, "a"), (1, None), (1, "a")], lambda k, v: text.label_or(k, v, "no key", "no value")
    )
    assert found == ["no key", "no value", "a"]


def test_calendar(spark):
    moment = dt.datetime(2026, 1, 11, 23, 59)  # a Sunday
    fields = lambda m: F.struct(
        calendar.day(m), calendar.hour_of_day(m), calendar.weekday_number(m), calendar.weekday_name(calendar.weekday_number(m))
    )
    known, unknown = apply(spark, "m timestamp_ntz", [moment, None], fields)
    assert tuple(known) == (dt.date(2026, 1, 11), 23, 1, "Domingo")
    assert tuple(unknown) == (None, None, None, "Desconhecido")


def test_weekday_names(spark):
    names = apply(spark, "n int", [1, 3, 7, 0, 8, None], calendar.weekday_name)
    assert names == ["Domingo", "Terça", "Sábado", "Desconhecido", "Desconhecido", "Desconhecido"]


def test_day_does_not_move_with_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        row = spark.sql("select timestamp_ntz'2026-01-11 23:30:00' m").select(
            calendar.day(F.col("m")).alias("d"), calendar.hour_of_day(F.col("m")).alias("h")
        ).first()
        assert (row.d, row.h) == (dt.date(2026, 1, 11), 23)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_parse_timestamp(spark):
    found = apply(spark, "t string", ["2026-01-02 03:04:05", "2026-01-02", "soon", None], calendar.parse_timestamp)
    assert found == [dt.datetime(2026, 1, 2, 3, 4, 5), dt.datetime(2026, 1, 2), None, None]


def test_period_is_closed(spark):
    period = Period.of("2025-12-13", "2026-01-11")
    days = [dt.date(2025, 12, 12), dt.date(2025, 12, 13), dt.date(2026, 1, 11), dt.date(2026, 1, 12), None]
    assert apply(spark, "d date", days, lambda d: calendar.within(d, period)) == [False, True, True, False, None]
    assert apply(spark, "d date", days[:1], lambda d: calendar.within(d, None)) == [True]


def test_price(spark):
    values = ["12.345", "1e3", "abc", "99999999999", None]
    assert apply(spark, "v string", values, money.price) == [D("12.35"), D("1000.00"), None, None, None]


def test_line_revenue(spark):
    values = [(3, D("19.99")), (None, D("1.00")), (2, None)]
    assert apply(spark, "q int, p decimal(10,2)", values, money.line_revenue) == [D("59.97"), None, None]


def test_price_band_limits(spark):
    values = [D("1000.01"), D("1000.00"), D("500.01"), D("500.00"), None]
    assert apply(spark, "p decimal(10,2)", values, money.price_band) == ["PREMIUM", "MEDIO", "MEDIO", "BASICO", "BASICO"]


def test_segment_limits(spark):
    values = [D("22000.00"), D("21999.99"), D("17000.00"), D("16999.99"), D("0")]
    found = apply(spark, "r decimal(18,2)", values, lambda r: money.segment(r, SegmentLimits()))
    assert found == ["VIP", "TOP_TIER", "TOP_TIER", "REGULAR", "REGULAR"]


def test_suspicious_is_exact_and_strict(spark):
    values = [(D("59.99"), D("99.99")), (D("60.00"), D("100.00")), (D("59.99"), D("100.00")), (None, D("1")), (D("1"), None)]
    found = apply(spark, "c decimal(10,2), o decimal(10,2)", values, money.suspicious)
    assert found == [True, False, True, False, False]


def test_gap_percent(spark):
    values = [(D("110.00"), D("100.00")), (D("1.00"), D("3.00")), (D("5.00"), D("0.00")), (D("5.00"), None)]
    found = apply(spark, "o decimal(10,2), m decimal(10,2)", values, money.gap_percent)
    assert found == [D("10.00"), D("-66.67"), None, None]


@pytest.mark.parametrize(
    ("own", "low", "high", "mean", "n", "label"),
    [
        (10, None, None, None, 0, "NA_MEDIA"),
        (31, 10, 30, 20, 2, "MAIS_CARO_QUE_TODOS"),
        (9, 10, 30, 20, 2, "MAIS_BARATO_QUE_TODOS"),
        (20.5, 10, 30, 20, 2, "NA_MEDIA"),
        (21, 10, 30, 20, 2, "MAIS_CARO_QUE_MEDIA"),
        (19, 10, 30, 20, 2, "MAIS_BARATO_QUE_MEDIA"),
        (10.1, 10, 10, 10, 1, "MAIS_CARO_QUE_TODOS"),
        (0, 0, 0, 0, 1, "MAIS_BARATO_QUE_MEDIA"),
    ],
)
def test_price_position(spark, own, low, high, mean, n, label):
    price = "decimal(10,2)"
    schema = f"o {price}, l {price}, h {price}, m {price}, n bigint"
    number = lambda x: None if x is None else D(str(x))
    row = (number(own), number(low), number(high), number(mean), n)
    assert apply(spark, schema, [row], money.price_position) == [label]


def test_ratio(spark):
    values = [(1, 3), (2, 3), (1, 0), (0, 5)]
    assert apply(spark, "a bigint, b bigint", values, money.ratio) == [D("0.3333"), D("0.6667"), None, D("0.0000")]


def test_states(spark):
    assert len(STATES) == 27 and len({s[0] for s in STATES}) == 27
    regions = {r.regiao: r["count"] for r in state_table(spark).groupBy("regiao").count().collect()}
    assert regions == {"Norte": 7, "Nordeste": 9, "Centro-Oeste": 4, "Sudeste": 4, "Sul": 3}


def test_band_position(spark):
    assert apply(spark, "b string", ["PREMIUM", "MEDIO", "BASICO", "LUXO", None], band_position) == [1, 2, 3, None, None]
