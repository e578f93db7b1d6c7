"""Mixing sources to target weights with hash thresholds found from nested histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quitanda.llm.tables import WORD, stored, with_key_values
from quitanda.operators.ordered import ordered_totals

# A document's place is 60 bits of its hash: five levels of buckets of 12 bits.
BITS, LEVELS = 12, 5
PLACES = 1 << (BITS * LEVELS)


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: Sequence[float], most: float, total: float | None = None) -> DataFrame:
    """``sources`` (source_key, source_size) plus ``target``.

    Sources in code-point order, NULL last, weigh ``weights``, repeating. They share ``total``
    (all sizes by default); a target stops at ``most`` times its source's size and the excess goes
    to the others by weight, until none is above. Rounds of two sums each: only numbers reach the
    driver. A source of size 0 gets 0. If everything is capped, the rest of ``total`` stays unused.
    """
    ranked = ordered_totals(sources, [F.col("source_key").asc()], ranks={"_rank": []})
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    weighed = ranked.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    whole = weighed.agg(F.sum("source_size")).first()[0] or 0 if total is None else total
    level, capped = 0.0, -1
    while True:
        is_capped = F.col("_cap") < F.lit(level) * F.col("_weight") if capped >= 0 else F.lit(False)
        held, free, n = weighed.agg(
            F.sum(F.when(is_capped, F.col("_cap")).otherwise(0.0)),
            F.sum(F.when(is_capped, F.lit(0.0)).otherwise(F.col("_weight"))),
            F.count(F.when(is_capped, 1)),
        ).first()
        if n == capped or not free:
            break
        level, capped = (whole - held) / free, n
    share = F.least("_cap", F.lit(float(level)) * F.col("_weight"))
    return weighed.withColumn("target", F.when(F.lit(bool(free)), share).otherwise(F.col("_cap"))).drop(
        "_rank", "_weight", "_cap"
    )


def thresholds(placed: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per row of ``budgets`` (source_key, budget) the place below which sizes add up to the budget.

    ``placed`` has (source_key, place, size). Sizes are summed by source and bucket, the bucket in
    which the running sum crosses the budget is found, and only that bucket is refined on the next
    level, so a pass sums at most 4,096 numbers per budget and no document is sorted. It ends when
    no boundary bucket holds more than one document, or documents of one and the same place: such
    a bucket is taken if that brings the sum nearer to the budget. All budgets of a source cut the
    same order of places, so their sets are nested.
    """
    zero = F.lit(0).cast("bigint")
    found = budgets.select(
        "source_key", "budget", zero.alias("threshold"), zero.alias("_below"), F.lit(True).alias("_open")
    )
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        wider = F.shiftright("place", shift + BITS)
        edge = found.where("_open").select(
            F.col("source_key").alias("_s"), F.shiftright("threshold", shift + BITS).alias("_edge")
        )
        near = placed.where("size > 0").withColumn("_wider", wider)
        if level > 1:
            near = near.join(edge, (F.col("source_key") == F.col("_s")) & (F.col("_wider") == F.col("_edge")), "left_semi")
        histogram = near.groupBy(F.col("source_key").alias("_s"), "_wider", F.shiftright("place", shift).alias("_bucket")).agg(
            F.sum("size").alias("_size"), F.count("*").alias("_rows")
        )
        same = (F.col("source_key") == F.col("_s")) & (F.shiftright("threshold", shift + BITS) == F.col("_wider"))
        up_to = Window.partitionBy("source_key", "budget").orderBy("_bucket")
        crossed = (
            found.where("_open")
            .join(histogram, same)
            .withColumn("_until", F.col("_below") + F.sum("_size").over(up_to))
            .where(F.col("_until") > F.col("budget"))
            .groupBy("source_key", "budget")
            .agg(F.min(F.struct("_bucket", "_until", "_size", "_rows")).alias("_b"))
        )
        before = F.col("_b._until") - F.col("_b._size")
        begin = F.shiftleft("_b._bucket", shift)
        done = (F.col("_b._rows") == 1) | F.lit(level == LEVELS)
        nearer = F.col("_b._until") - F.col("budget") < F.col("budget") - before
        cut = F.when(done & nearer, begin + F.lit(1 << shift)).otherwise(begin)
        # Without a crossing on the first level the budget exceeds all sizes: everything is below.
        found = (
            found.join(crossed, ["source_key", "budget"], "left")
            .withColumn("threshold", F.when(~F.col("_open"), F.col("threshold")).otherwise(F.coalesce(cut, F.lit(PLACES))))
            .withColumn("_below", F.when(F.col("_b").isNull(), F.col("_below")).otherwise(before))
            .withColumn("_open", F.col("_open") & F.col("_b").isNotNull() & ~F.coalesce(done, F.lit(True)))
            .drop("_b")
        )
        found = stored(found, f"thresholds_{level}")
        if not found.where("_open").take(1):
            break
    return found.select("source_key", "budget", "threshold")


def placed_column(key: str, text: str) -> Column:
    """60 bits of the hash of the key, of the text where there is none."""
    hashed = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.col(text), F.lit("")))
    return hashed.bitwiseAND(F.lit(PLACES - 1))


def source_key(source: str) -> Column:
    """Orders as the source does, NULL last, and is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("~")).alias("source_key")


def placed_sizes(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source_key, place, size) of every row: what mixing needs to know, without the texts."""
    return df.select(
        F.col(key), source_key(source), placed_column(key, text).alias("place"), word_count(text).alias("size")
    )


def plan(
    placed: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = 3, total: float | None = None
) -> DataFrame:
    """Per source: source_size, source_rows, target, whole copies, and the threshold below which a
    document is taken once more. ``placed`` is read several times and should be stored."""
    sources = stored(
        placed.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows")),
        "sources",
    )
    goals = targets(sources, weights, most, total)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = goals.withColumn("copies", F.least(whole, F.lit(most)).cast("bigint")).withColumn(
        "budget", F.greatest(F.col("target") - F.col("copies") * F.col("source_size"), F.lit(0.0))
    )
    goals = stored(goals, "goals")
    cuts = thresholds(placed, goals.select("source_key", "budget"))
    return stored(goals.join(cuts.drop("budget"), "source_key"), "mix")


def mix(
    df: DataFrame,
    placed: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    most: int = 3,
    total: float | None = None,
) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``taken_copies`` to ``df``, which has source_key and place;
    ``placed`` has (source_key, place, size) of the same rows and should be stored.

    Sources in code-point order, NULL last, weigh ``weights``, repeating, and share ``total`` words
    (by default all); see `targets`. A source's documents are taken floor(target / size) times, and
    those whose hash lies below the source's threshold once more, so that taken words come as near
    to the target as whole documents allow; none is taken more than ``most`` times. Every decision
    is a comparison of a document's own hash: rows with equal keys (keyless ones: equal texts) are
    taken together, and reruns agree. A NULL text has size 0 and counts for nothing; it is taken
    like others. An empty table gives an empty result.
    """
    per_source = plan(placed, weights, most, total)
    values = ["source_size", "target", "copies", "threshold"]
    joined = with_key_values(df, per_source, "source_key", "source_rows", values)
    extra = (F.col("place") < F.col("threshold")).cast("bigint")
    taken = F.least(F.col("copies") + extra, F.lit(most).cast("bigint"))
    return joined.withColumn("taken_copies", taken).drop("copies", "threshold")


def mixed_rows(
    df: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    most: int = 3,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The rows of ``df`` as often as `mix` takes them, with all their columns and no others."""
    placed = stored(placed_sizes(df, key, text, source).drop(key), "placed")
    whole = df.select(F.struct("*").alias("_row"), placed_column(key, text).alias("place"), source_key(source))
    taken = mix(whole, placed, weights, most).where("taken_copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("taken_copies").cast("int")))).select("_row.*")
