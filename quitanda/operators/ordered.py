"""Ranks and running sums over a whole table, without a single-task window."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quitanda.session import new_location
from quitanda.sources.sinks import write_files

SLICE = "_slice"


def ordered_totals(
    df: DataFrame,
    order: Sequence[Column],
    ranks: Mapping[str, Sequence[str]] | None = None,
    sums: Mapping[str, tuple[str, Sequence[str]]] | None = None,
    totals: Mapping[str, str] | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Adds row numbers, running sums and grand totals along ``order``, which must be total.

    ``ranks`` maps a new column to its partition columns, ``sums`` to (value column, partition
    columns); no partition columns means the whole table. ``totals`` maps to a value column.

    The rows are range-partitioned by ``order`` into slices of equal size. Ties and groups of any
    size are cut like everything else, since the order is total. Inside a slice an ordinary window
    counts; what lies in earlier slices is added from one small row per group and slice. Slices
    are written to the shared folder first: Spark draws range bounds from a sample, and both passes
    must see the same ones, also after an executor is lost. So this call runs a job. The slices lie
    in ``folder``, which its owner may remove when the result is stored (see `session.scratch`), by
    default in a new one.
    """
    sliced = df.repartitionByRange(*order).withColumn(SLICE, F.spark_partition_id())
    place = new_location(df.sparkSession, "slices") if folder is None else f"{folder}/slices-{uuid.uuid4().hex}"
    sliced = write_files(sliced, place)

    wanted: dict[tuple[str, ...], list[tuple[str, Column | None]]] = defaultdict(list)
    for name, by in (ranks or {}).items():
        wanted[tuple(by)].append((name, None))
    for name, (value, by) in (sums or {}).items():
        wanted[tuple(by)].append((name, F.coalesce(F.col(value), F.lit(0))))

    result = sliced
    if totals:
        wanted.setdefault((), [])
    for by in sorted(wanted, key=len):
        inside = Window.partitionBy(SLICE, *by).orderBy(*order)
        running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for name, value in wanted[by]:
            here = F.row_number().over(inside) if value is None else F.sum(value).over(running)
            result = result.withColumn(name, here)
        whole = {} if by else dict(totals or {})
        result = _add_earlier(result, _earlier(sliced, by, wanted[by], whole), by, [n for n, _ in wanted[by]], whole)
    return result.drop(SLICE)


def _earlier(sliced: DataFrame, by: tuple[str, ...], wanted: list, whole: Mapping[str, str]) -> DataFrame:
    """Per group and slice, the totals of the group's earlier slices, and those of all slices."""
    totals = [F.sum(value).alias(name) for name, value in whole.items()]
    totals += [(F.count("*") if value is None else F.sum(value)).alias(f"_{name}") for name, value in wanted]
    before = Window.partitionBy(*[F.col(f"_by_{c}") for c in by]).orderBy("_at")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by], F.col(SLICE).alias("_at"))
        .agg(*totals)
        .select(
            "_at",
            *[f"_by_{c}" for c in by],
            *[F.coalesce(F.sum(f"_{name}").over(before), F.lit(0)).alias(f"_{name}") for name, _ in wanted],
            *[F.sum(name).over(Window.partitionBy()).alias(name) for name in whole],
        )
    )


def _add_earlier(
    df: DataFrame, earlier: DataFrame, by: tuple[str, ...], names: Sequence[str], whole: Mapping[str, str]
) -> DataFrame:
    if not by:
        earlier = F.broadcast(earlier)  # one row per slice, at most spark.sql.shuffle.partitions
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by], F.col(SLICE) == F.col("_at"))
    joined = df.join(earlier, same, "left")
    added = {name: F.col(name) + F.col(f"_{name}") for name in names}
    return joined.select(*[added.get(c, F.col(c)).alias(c) for c in df.columns], *whole)
