"""Left joins from many rows to a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows looked at per task when hot keys are sought: a key at the limit shows about half as often.
SEEN_PER_TASK = 200
# Parts per average task a hot key is cut into: small ones spread evenly.
PARTS_PER_TASK = 4


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, parts) for every key of ``df`` that holds more than half of an average task's rows.

    A routing hint for `lookup`, counted on a drawn share of one column: a fixed number of rows per
    shuffle task, so it grows with the cluster and not with the table. There are at most two hot
    keys per task. Costs a count and a scan of the column: store the result where several joins use it.
    """
    tasks, known = _tasks(df.sparkSession), df.where(F.col(key).isNotNull()).select(key)
    total = max(known.count(), 1)
    share = min(1.0, SEEN_PER_TASK * tasks / total)
    seen = known if share == 1 else known.sample(share, seed=1)
    held = F.col("_rows") / F.lit(share * total)
    return (
        seen.groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .where((held > 1 / (2 * tasks)) & (F.col("_rows") > 1))
        .select(key, F.ceil(held * PARTS_PER_TASK * tasks).cast("int").alias("parts"))
    )


def lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: Sequence[str | Column],
    hot: DataFrame | None = None,
    suffix: str = "_tabela",
    cut: tuple[str, int] | None = None,
) -> DataFrame:
    """``facts`` left join ``table`` on ``key``; ``table`` has one row per key.

    Facts without a key match nothing and are dealt out over all tasks by ``spread_by`` (columns
    that differ between rows). Otherwise this is Spark's left join: a small table is broadcast where
    its size check allows it, else AQE may split large partitions. ``hot``, from `hot_keys`, also
    splits the hot keys by plan: their facts carry a part number, and only their few table rows are
    repeated once per part. Which keys are hot is only a routing hint; the result does not depend
    on it. Columns of ``table`` that ``facts`` has as well get ``suffix``.

    ``cut`` is (column, parts): instead of hot keys, every key is cut into so many parts by ``spread_by``, and
    the table is repeated as often. The column keeps the part number, so that rows grouped by the key, that column
    and what decides on it need no further shuffle.
    """
    if cut and hot is not None:
        raise ValueError("keys are cut either all or by hot")
    renamed = {c: c + suffix if c in facts.columns else c for c in table.columns if c != key}
    clash = sorted(set(renamed.values()) & set(facts.columns))
    if clash:
        raise ValueError(f"both sides have {', '.join(clash)}")
    table = table.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_t_{i}") for i, c in enumerate(renamed)]
    )
    found = [F.col(f"_t_{i}").alias(new) for i, new in enumerate(renamed.values())]
    drawn = F.xxhash64(*spread_by)
    anywhere = F.pmod(drawn, F.lit(PARTS_PER_TASK * _tasks(facts.sparkSession)))
    if cut:
        # An expression, so that the shuffle does not carry it.
        part = F.when(F.col(key).isNull(), anywhere).otherwise(F.pmod(drawn, F.lit(cut[1]))).cast("int")
        parts = table.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(cut[1] - 1))))
        joined = facts.join(parts, (F.col(key) == F.col("_key")) & (part == F.col("_at")), "left")
        return joined.select(*facts.columns, *found, part.alias(cut[0]))
    if hot is None:
        spread = facts.withColumn("_part", F.when(F.col(key).isNull(), anywhere).otherwise(0).cast("int"))
        parts = table.withColumn("_at", F.lit(0))
    else:
        hot = F.broadcast(hot.select(F.col(key).alias("_hot"), F.col("parts").alias("_parts")))  # two per task at most
        part = F.when(F.col(key).isNull(), anywhere).otherwise(F.coalesce(F.pmod(drawn, F.col("_parts")), F.lit(0)))
        spread = facts.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_part", part.cast("int"))
        copies = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
        parts = table.join(hot, F.col("_key") == F.col("_hot"), "left").withColumn("_at", F.explode(copies))
        parts = parts.drop("_hot", "_parts")
    joined = spread.join(parts, (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_at")), "left")
    return joined.select(*facts.columns, *found)
