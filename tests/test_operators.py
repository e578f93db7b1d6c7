"""Deduplication, lookups, ranks and running sums on small and on skewed tables."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quitanda.operators.dedupe import keep_first
from quitanda.operators.lookup import hot_keys, lookup
from quitanda.operators.ordered import ordered_totals
from quitanda.operators.sieve import sieve, sifted


def rows(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def test_keep_first_orders_and_keeps_columns(spark):
    df = spark.createDataFrame(
        [(1, "b", 5), (1, "a", 9), (2, None, 1), (2, "x", 0), (3, "z", 7), (3, "z", 7)], "k int, name string, n int"
    )
    assert rows(keep_first(df, ["k"])) == rows_of([(1, "a", 9), (2, None, 1), (3, "z", 7)])
    assert rows(keep_first(df, ["k"], ["n"])) == rows_of([(1, "b", 5), (2, "x", 0), (3, "z", 7)])
    assert keep_first(df, ["k"], ["n"]).columns == ["k", "name", "n"]


def rows_of(values) -> Counter:
    return Counter(values)


def test_keep_first_keeps_every_row_without_a_key(spark):
    df = spark.createDataFrame(
        [(None, "a"), (None, "a"), (None, "b"), (1, "c"), (1, "d")], "k int, v string"
    )
    assert rows(keep_first(df, ["k"])) == rows_of([(None, "a"), (None, "a"), (None, "b"), (1, "c")])


def test_keep_first_with_two_keys_and_nothing_else(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "a")], "k int, v string")
    assert rows(keep_first(df, ["k", "v"])) == rows_of([(1, "a"), (1, None), (1, None), (2, "a")])


def test_keep_first_is_idempotent(spark, tiny):
    from quitanda.sources import benchmark_tables as raw

    once = keep_first(raw.vendas(spark, tiny), ["id_venda"], raw.VENDAS_ORDER)
    assert rows(keep_first(once, ["id_venda"], raw.VENDAS_ORDER)) == rows(once)


def test_keep_first_combines_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a third have none."""
    return spark.range(30_000).selectExpr(
        "id", "case id % 3 when 0 then 7 when 1 then null else id % 5000 end as k", "id % 11 as other"
    )


def test_hot_keys_are_found_and_few(spark, skewed):
    assert [r.k for r in hot_keys(skewed, "k").collect()] == [7]
    even = spark.range(50_000).selectExpr("id % 25000 as k")
    assert hot_keys(even, "k").count() == 0


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_keys_of_nothing(spark, skewed, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        assert hot_keys(skewed.where("id < 0"), "k").count() == 0
        assert hot_keys(skewed.where("k is null"), "k").count() == 0
        assert [r.k for r in hot_keys(skewed, "k").collect()] == [7]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_hot_keys_of_text(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'best', 'k' || id) as k")
    assert "best" in {r.k for r in hot_keys(df, "k").collect()}


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_lookup_equals_a_plain_left_join(spark, skewed, threshold):
    table = spark.range(4000).selectExpr("id as k", "'v' || id as v").union(
        spark.createDataFrame([(None, "never")], "k bigint, v string")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        wanted = rows(skewed.join(table, "k", "left").select("id", "k", "other", "v"))
        for hot in (None, hot_keys(skewed, "k")):
            joined = lookup(skewed, table, "k", ["id"], hot)
            assert joined.columns == ["id", "k", "other", "v"]
            assert rows(joined) == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookup_splits_the_hot_key(spark, skewed):
    """No task of the join gets most of the rows, although one key and NULL hold two thirds."""
    table = spark.range(4000).selectExpr("id as k", "'v' || id as v")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    for name, value in zip(names, ("-1", "false", "16")):
        spark.conf.set(name, value)
    try:
        hot = hot_keys(skewed, "k")
        sizes = lookup(skewed, table, "k", ["id"], hot).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 30_000 / 6
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_a_wrong_hint_changes_nothing(spark, skewed):
    table = spark.range(4000).selectExpr("id as k", "'v' || id as v")
    misleading = spark.createDataFrame([(1, 9), (3, 1), (999_999, 5)], "k bigint, parts int")
    assert rows(lookup(skewed, table, "k", ["id"], misleading)) == rows(lookup(skewed, table, "k", ["id"]))


def test_a_small_table_is_broadcast_and_nothing_is_counted(spark, skewed):
    table = spark.range(100).selectExpr("id as k", "'v' || id as v")
    plan = lookup(skewed, table, "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Join") == 1 and "Aggregate" not in plan


def test_shared_column_names_get_a_suffix(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    table = spark.createDataFrame([(1, "x", 5)], "k int, v string, n int")
    joined = lookup(facts, table, "k", ["v"])
    assert joined.columns == ["k", "v", "v_tabela", "n"]
    assert rows(joined) == rows_of([(1, "a", "x", 5), (2, "b", None, None)])
    with pytest.raises(ValueError, match="v_tabela"):
        lookup(facts.withColumn("v_tabela", F.lit(1)), table, "k", ["v"])


def test_hot_keys_follow_the_number_of_tasks(spark):
    """A key with 0.04% of the rows is eight average tasks' rows on 20,000 tasks, and little on four."""
    df = spark.range(100_000).selectExpr("if(id % 2500 = 0, -1, id) as k")
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    assert hot_keys(df, "k").count() == 0
    spark.conf.set(name, "20000")
    try:
        assert [(r.k, r.parts) for r in hot_keys(df, "k").collect()] == [(-1, 32)]
    finally:
        spark.conf.set(name, before)


def test_keep_first_reads_its_input_once(spark, tmp_path):
    spark.range(10).selectExpr("nullif(id % 4, 0) as k", "id as v").write.parquet(str(tmp_path / "t"))
    df = keep_first(spark.read.parquet(str(tmp_path / "t")), ["k"])
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert df.count() == 3 + 3


def test_keep_first_with_maps(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, map('a', 2)), (1, map('a', 1)), (2, map('b', 1)), (null, map('c', 1)), (null, map('c', 1)) AS t(k, m)"
    )
    found = sorted((r.k or 0, sorted(r.m.items())) for r in keep_first(df, ["k"]).collect())
    assert found == [(0, [("c", 1)]), (0, [("c", 1)]), (1, [("a", 1)]), (2, [("b", 1)])]


def test_slices_go_with_their_folder(spark):
    from quitanda.session import path_exists, scratch

    df = spark.range(100).selectExpr("id", "id % 7 as v")
    with scratch(spark) as folder:
        found = ordered_totals(df, [F.col("v").asc(), F.col("id").asc()], ranks={"r": []}, folder=folder)
        assert found.count() == 100 and path_exists(spark, folder)
    assert not path_exists(spark, folder) and not path_exists(spark, folder.rpartition("/")[0])


@pytest.fixture
def many_slices(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_ordered_totals_equal_plain_windows(spark, many_slices):
    """Heavy ties, a group with a third of the rows, and a group that is NULL."""
    df = spark.range(5000).selectExpr(
        "id",
        "case when id % 3 = 0 then 'big' when id % 7 = 0 then null else 'g' || id % 40 end as g",
        "cast(if(id % 2 = 0, 0, id % 50) as decimal(18,2)) as v",
    )
    order = [F.col("v").desc(), F.col("id").asc()]
    found = ordered_totals(
        df,
        order,
        ranks={"r": [], "rg": ["g"]},
        sums={"s": ("v", []), "sg": ("v", ["g"])},
        totals={"t": "v"},
    )
    whole, group = Window.orderBy(*order), Window.partitionBy("g").orderBy(*order)
    upto = (Window.unboundedPreceding, Window.currentRow)
    plain = df.select(
        "*",
        F.row_number().over(whole).alias("r"),
        F.row_number().over(group).alias("rg"),
        F.sum("v").over(whole.rowsBetween(*upto)).alias("s"),
        F.sum("v").over(group.rowsBetween(*upto)).alias("sg"),
        F.sum("v").over(Window.partitionBy()).alias("t"),
    )
    assert rows(found.select(*plain.columns)) == rows(plain)


def test_ranks_are_a_permutation(spark, many_slices):
    df = spark.range(1000).selectExpr("id", "0 as v")
    found = ordered_totals(df, [F.col("v").desc(), F.col("id").asc()], ranks={"r": []})
    assert sorted(r.r for r in found.collect()) == list(range(1, 1001))


def test_ordered_totals_of_nothing(spark):
    df = spark.range(0).selectExpr("id", "cast(1 as decimal(18,2)) as v")
    assert ordered_totals(df, [F.col("id").asc()], ranks={"r": []}, totals={"t": "v"}).count() == 0


def test_slices_hold_similar_numbers_of_tied_rows(spark, many_slices):
    """All values are equal; the id in the order still spreads them."""
    from quitanda.operators.ordered import SLICE

    df = spark.range(10_000).selectExpr("id", "0 as v")
    sizes = (
        df.repartitionByRange(F.col("v").desc(), F.col("id").asc())
        .groupBy(F.spark_partition_id().alias(SLICE))
        .count()
        .collect()
    )
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 5000


def test_a_sieve_never_misses_a_key(spark):
    keys = spark.range(0, 3000, 3).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    rows = spark.range(3000).select(F.when(F.col("id") != 1, F.col("id")).alias("k"), F.lit("x").alias("v"))
    told = sifted(rows, "k", sieve(keys, "k"))
    assert told.columns == ["k", "v", "_may"] and told.count() == 3000
    passed = {r.k for r in told.where("_may").collect()}
    assert passed >= set(range(3, 3000, 3)) and len(passed) < 1100 and None not in passed
    assert told.where("_may IS NULL").isEmpty()
    assert sifted(rows, "k", sieve(keys.limit(0), "k")).where("_may").isEmpty()
    held = sieve(keys, "k").select(F.size("_words").alias("words")).distinct().collect()
    assert [r.words for r in held] == [64]


def test_lookup_cuts_every_key(spark):
    facts = spark.createDataFrame([(k, d) for k in (1, 2, 9, None) for d in range(40)], "k bigint, d int")
    table = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k bigint, t string")
    joined = lookup(facts, table, "k", ["d"], cut=("part", 4))
    assert joined.columns == ["k", "d", "t", "part"] and joined.count() == 160
    plain = lookup(facts, table, "k", ["d"])
    assert sorted(map(str, joined.drop("part").collect())) == sorted(map(str, plain.collect()))
    assert joined.where("k = 1").select("part").distinct().count() == 4
    assert joined.select("k", "d", "part").distinct().count() == 160
    with pytest.raises(ValueError):
        lookup(facts, table, "k", ["d"], hot_keys(facts, "k"), cut=("part", 4))
