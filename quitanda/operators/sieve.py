"""Rows whose key may be one of many, told before they are shuffled.

A sieve is a bitmap of the keys' hashes, at most 32 MB whatever the number of keys, that every task holds. It never misses a
key it was built from; others pass by chance, the more often the more keys it holds, so what passes is
then looked at exactly. It only saves shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Log2 of the bits, of those in a row of the sieve, and of those in one of its words.
BITS, ROW, WORD = 28, 12, 6


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << BITS))


def _low(place: Column, bits: int) -> Column:
    return place.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def sieve(keys: DataFrame, key: str) -> DataFrame:
    """(_row, _words) of all keys but NULL; store it where it is used more than once."""
    place = F.col("_place")
    bit = F.expr(f"shiftleft(1L, cast(_place & {(1 << WORD) - 1} as int))")
    words = (
        keys.where(F.col(key).isNotNull())
        .select(_place(key).alias("_place"))
        .groupBy(F.shiftright(place, WORD).alias("_place"))
        .agg(F.bit_or(bit).alias("_bits"))
    )
    among = _low(place, ROW - WORD)
    held = F.map_from_entries(F.collect_list(F.struct(among, "_bits")))
    rows = words.groupBy(F.shiftright(place, ROW - WORD).alias("_row")).agg(held.alias("_held"))
    all_words = F.sequence(F.lit(0), F.lit((1 << ROW - WORD) - 1))
    return rows.select("_row", F.transform(all_words, lambda i: F.coalesce(F.try_element_at("_held", i), F.lit(0))).alias("_words"))


def sifted(df: DataFrame, key: str, of: DataFrame, name: str = "_may") -> DataFrame:
    """``df`` and whether its key may be in the sieve ``of``: true for every key in it, never for NULL."""
    place = _place(key)
    word = F.get("_words", _low(F.shiftright(place, WORD), ROW - WORD))
    found = F.col(key).isNotNull() & (F.getbit(word, _low(place, WORD)) == 1)
    joined = df.join(F.broadcast(of), F.shiftright(place, ROW) == F.col("_row"), "left")  # 32 MB at most
    return joined.select(*df.columns, F.coalesce(found, F.lit(False)).alias(name))
