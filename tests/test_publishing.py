"""Catalog tables change all together: a fault at any step leaves all old or all new."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quitanda.session import new_location
from quitanda.sources import sinks
from quitanda.sources.sinks import documented, into_catalog

TABLES = [("silver", "a"), ("silver", "b"), ("gold", "c"), ("gold", "d")]


@pytest.fixture
def schemas(spark):
    names = ("pub_clean", "pub_marts")
    for schema in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    yield names
    for schema in names:
        spark.sql(f"DROP DATABASE {schema} CASCADE")


def store(spark, schemas, value, location, extra=False, pointer=None):
    made = into_catalog("spark_catalog", *schemas, location, pointer=pointer)
    for layer, name in TABLES:
        df = spark.range(3).select(F.lit(value).alias("v"), "id")
        df = df.withColumn("more", F.lit("x")) if extra else df
        made(layer, name, documented(df, {"v": "It's the \\ value"}))
    return made


def seen(spark, schemas):
    layers = dict(zip(("silver", "gold"), schemas))
    return {r.v for layer, name in TABLES for r in spark.table(f"{layers[layer]}.{name}").collect()}


@pytest.mark.parametrize("moved, extra", [(False, False), (True, True)])
def test_a_fault_at_any_step_leaves_one_version(spark, schemas, monkeypatch, moved, extra):
    pointer, place = new_location(spark, "pointer"), new_location(spark, "tables")
    store(spark, schemas, 1, place, pointer=pointer).publish()
    assert seen(spark, schemas) == {1}
    show, append = sinks._show, sinks._append_row
    for fault in range(len(TABLES) + 1):
        calls = []

        def failing(do):
            def step(*args):
                calls.append(0)
                if len(calls) > fault:
                    raise RuntimeError("lost")
                return do(*args)

            return step

        monkeypatch.setattr(sinks, "_show", failing(show))
        monkeypatch.setattr(sinks, "_append_row", failing(append))
        new = store(spark, schemas, 2, new_location(spark, "tables") if moved else place, extra, pointer)
        with pytest.raises(RuntimeError):
            new.publish()
        assert len(calls) == fault + 1 and seen(spark, schemas) == {1}, fault
    monkeypatch.setattr(sinks, "_show", show)
    monkeypatch.setattr(sinks, "_append_row", append)
    store(spark, schemas, 3, place, extra, pointer).publish()
    assert seen(spark, schemas) == {3}
    assert ("more" in spark.table(f"{schemas[1]}.c").columns) == extra


def test_views_read_one_version_and_keep_comments(spark, schemas):
    place = new_location(spark, "tables")
    for value in (1, 2):
        store(spark, schemas, value, place, pointer=f"{place}/pointer").publish()
    plan = spark.table(f"{schemas[0]}.a")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(versao" in plan and "Subquery" in plan
    column = next(c for c in spark.catalog.listColumns(f"{schemas[1]}.d") if c.name == "v")
    assert column.description == "It's the \\ value"


def test_a_table_of_the_name_gives_way(spark, schemas):
    spark.range(1).write.saveAsTable(f"{schemas[0]}.a")
    place = new_location(spark, "tables")
    store(spark, schemas, 5, place, pointer=f"{place}/pointer").publish()
    assert seen(spark, schemas) == {5}
