"""Profile of a raw table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Types whose text tells equal values from different ones.
PLAIN = {"string", "byte", "short", "integer", "long", "decimal", "boolean", "date", "timestamp_ntz", "binary"}


def _text(name: str, kind: DataType) -> Column | None:
    """Text that is equal for equal values and different for others; None if the type has none."""
    value = F.col(name)
    if kind.typeName() in ("float", "double"):
        return (value + F.lit(0).cast(kind)).cast("string")  # one zero
    if kind.typeName() == "timestamp":
        return F.unix_micros(value).cast("string")  # local times repeat when clocks go back
    return value.cast("string") if kind.simpleString() == "string" or kind.typeName() in PLAIN - {"string"} else None


def _distinct(df: DataFrame) -> DataFrame:
    """One row: per column the exact number of distinct values.

    Rows are cut into (number of the column, value as text), so that a task holds two narrow columns per
    distinct value, by hash, and not a whole row padded with NULLs.
    """
    texts = {i: _text(f.name, f.dataType) for i, f in enumerate(df.schema)}
    told = [F.struct(F.lit(i).alias("i"), t.alias("v")) for i, t in texts.items() if t is not None]
    counts = []
    if told:
        values = df.select(F.inline(F.array(*told))).where("v IS NOT NULL").distinct()
        counts.append(values.agg(*[F.count_if(F.col("i") == i).alias(f"d{i}") for i, t in texts.items() if t is not None]))
    if other := [F.count_distinct(df.columns[i]).alias(f"d{i}") for i, t in texts.items() if t is None]:
        counts.append(df.agg(*other))
    return counts[0] if len(counts) == 1 else counts[0].crossJoin(counts[1])


def profile(df: DataFrame, distinct: str | None = "approximate") -> DataFrame:
    """Per column: rows, NULLs, distinct values, least and greatest value as text.

    ``distinct`` is "approximate" (5% standard error), "exact" or None. All but "exact" is one aggregate
    with constant-size state per column; "exact" reads the rows once more, cuts them into values and
    shuffles what is distinct in each map task, see `_distinct`.
    """
    values = [F.count("*").alias("linhas")]
    for i, c in enumerate(df.columns):
        values += [
            F.count_if(F.col(c).isNull()).alias(f"n{i}"),
            F.min(c).cast("string").alias(f"a{i}"),
            F.max(c).cast("string").alias(f"z{i}"),
        ]
        if distinct and distinct != "exact":
            values.append(F.approx_count_distinct(c).alias(f"d{i}"))
    lines = [
        F.struct(
            F.lit(c).alias("coluna"),
            F.col("linhas"),
            F.col(f"n{i}").alias("nulos"),
            *([F.col(f"d{i}").alias("distintos" if distinct == "exact" else "distintos_aprox")] if distinct else []),
            F.col(f"a{i}").alias("minimo"),
            F.col(f"z{i}").alias("maximo"),
        )
        for i, c in enumerate(df.columns)
    ]
    totals = df.agg(*values)
    if distinct == "exact":
        totals = totals.crossJoin(_distinct(df))  # one row each
    return totals.select(F.inline(F.array(*lines)))
