"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def sortable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(sortable(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return sortable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def _rank(df: DataFrame, name: str) -> Column:
    """The column itself where Spark can order it; a map by its sorted entries, else its text."""
    kind = df.schema[name].dataType
    if sortable(kind):
        return F.col(name)
    if isinstance(kind, MapType) and sortable(kind.valueType):
        return F.array_sort(F.map_entries(name)).alias(name)
    return F.to_json(F.struct(name)).alias(name)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The first row of every key, by ``order`` and then by all other columns, ascending, NULL first.

    The smallest row is an aggregate, so each map task sends at most one row per key and a key
    that holds a third of the table stays cheap. Rows are variable in size, so Spark sorts on both
    sides of that shuffle. Rows with a NULL in the key cannot be told to be copies of each other:
    each is grouped under a number of its own, so all are kept, dealt out evenly, in the same pass.
    """
    lead = list(order or [])
    rest = lead + [c for c in df.columns if c not in keys and c not in lead]
    by = [F.col(k) for k in keys]
    if any(df.schema[k].nullable for k in keys):
        keyless = reduce(or_, [F.col(k).isNull() for k in keys])
        by.append(F.when(keyless, F.monotonically_increasing_id()).alias("_own"))
    grouped = df.groupBy(*by)
    if not rest:
        return grouped.agg(F.lit(1).alias("_row")).select(*df.columns)
    whole = F.struct(*rest)
    if all(sortable(df.schema[c].dataType) for c in rest):
        first = F.min(whole)
    else:
        first = F.min_by(whole, F.struct(*[_rank(df, c) for c in rest]))
    return grouped.agg(first.alias("_row")).select(*keys, "_row.*").select(*df.columns)
