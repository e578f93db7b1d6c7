"""Sharding by a permutation-filled lookup table: constant-time placement that moves little when shards change."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Slots of the table, a prime well above a hundred times the shards.
SLOTS = 65_537


def _preference(shard: str, slots: int) -> tuple[int, int]:
    """First slot and step of the shard's walk; as ``slots`` is prime, the walk meets every slot."""
    digest = hashlib.sha256(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], slots: int = SLOTS, weights: Mapping[str, int] | None = None) -> list[int]:
    """The shard (its position in ``shards``) of every slot.

    Shards take turns; in its turn a shard claims the next free slot of its own permutation of
    all slots, ``weights`` of them if given (1 by default). The table's size is a parameter and
    does not depend on any data, so it is filled where the job is planned.
    """
    if not is_prime(slots):
        raise ValueError(f"{slots} slots: the number must be prime")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be named, distinct and no more than slots")
    weights = weights or {}
    if any(weights.get(s, 1) < 1 for s in shards):
        raise ValueError("weights start at 1")
    table, free = [-1] * slots, slots
    walk = [_preference(s, slots) for s in shards]
    at = [start for start, _ in walk]
    while True:
        for i, shard in enumerate(shards):
            for _ in range(weights.get(shard, 1)):
                while table[at[i]] >= 0:
                    at[i] = (at[i] + walk[i][1]) % slots
                table[at[i]] = i
                free -= 1
                if not free:
                    return table


def slot_of(key: Column, instead: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; rows without a key are spread by ``instead``."""
    hashed = F.when(key.isNotNull(), F.xxhash64(key.cast("string"))).otherwise(F.xxhash64(instead))
    return F.pmod(hashed, F.lit(slots)).cast("int")


def place(
    df: DataFrame,
    key: str,
    tables: Mapping[str, Sequence[int]],
    spread: str | None = None,
) -> DataFrame:
    """Adds ``slot`` and, per table of ``tables``, the shard its rows belong to.

    Placement is one hash and one probe of a broadcast table of fixed size; nothing is shuffled
    and no row depends on another. Equal keys share a shard. A NULL key is placed by the hash of
    ``spread`` (of NULL: slot of the NULL hash), so that keyless rows do not pile up in one shard.
    Columns of ``df`` named like the new ones are replaced; an empty table stays empty.
    """
    names = list(tables)
    rows = list(zip(*tables.values(), strict=True))
    lookup = df.sparkSession.createDataFrame(
        [(slot, *shards) for slot, shards in enumerate(rows)], ", ".join(["_slot int", *[f"`{n}` int" for n in names]])
    )
    rest = [c for c in df.columns if c not in {"slot", *names}]
    slot = slot_of(F.col(key), F.col(spread) if spread else F.lit(None).cast("string"), len(rows))
    keyed = df.select(*rest, slot.alias("slot"))
    # As many rows as the table has slots, whatever the data.
    return keyed.join(F.broadcast(lookup), F.col("slot") == F.col("_slot"), "left").select(*rest, "slot", *names)
