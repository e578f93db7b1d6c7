"""Document fingerprints that are sums: independent of paragraph order, and easily added to or taken from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quitanda.llm.tables import tasks

# A fingerprint is an array of 60-bit longs. The first SUMS hold two lanes of 28 bits each, summed
# from SHA-256 digests of paragraphs: 560 bits for equality. Then SIGNS longs of two 29-bit lanes,
# summed from one bit per sentence and lane, and one long with the number of sentences: together a
# sign sketch for likeness. Two guard bits, or one, above each lane take the carry of an addition and are cleared, so
# every lane is a sum modulo a power of two, whatever the number of paragraphs. Spark holds fewer than 2**28
# sentence hashes in a row, so no text reaches half a sign lane and no likeness turns its sign.
SUMS, SIGNS = 10, 60
WIDE = (1 << 28) - 1
SUM_MASK = WIDE | WIDE << 30
BIT_MASK = 1 | 1 << 30
LANE = (1 << 29) - 1
SIGN_MASK = LANE | LANE << 30
PER_HASH = 30
# Sentences end at . ! ? or ; followed by a blank; paragraphs at a line feed.
SENTENCE_END = r"\n|(?<=[.!?;])\x20"
SLICES_PER_TASK = 8


def _masked_sum(hashes: Column, part, mask: int) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("bigint"), lambda acc, h: (acc + part(h)).bitwiseAND(F.lit(mask)))


def _sign_sums(hashes: Column, bits) -> Column:
    """PER_HASH longs; as one expression over their numbers, which keeps the plan and its code small."""

    def one(i: Column) -> Column:
        return _masked_sum(hashes, lambda h: F.call_function("shiftright", bits(h), i).bitwiseAND(F.lit(BIT_MASK)), SIGN_MASK)

    return F.transform(F.sequence(F.lit(0), F.lit(PER_HASH - 1)), one)


def _parts(text: Column) -> tuple[Column, Column]:
    paragraphs = F.filter(F.split(text, "\n"), lambda p: p != "")
    digests = F.transform(paragraphs, lambda p: F.sha2(p, 256))
    sentences = F.filter(F.split(text, SENTENCE_END), lambda s: s != "")
    return digests, F.transform(sentences, lambda s: F.xxhash64(s))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``, the fingerprint of ``text`` as an array of longs.

    A paragraph is a non-empty line, a text the multiset of its paragraphs: equal multisets have
    equal fingerprints, and different ones differ but for a chance of about 2**-500 with SHA-256. An
    empty or NULL text has no paragraph and the fingerprint zero.
    """
    digests, sentences = _parts(F.coalesce(F.col(text), F.lit("")))
    staged = df.withColumns({"_digests": digests, "_sentences": sentences})
    sums = [
        _masked_sum(F.col("_digests"), lambda d, i=i: F.xxhash64(d, F.lit(i)).bitwiseAND(F.lit(SUM_MASK)), SUM_MASK)
        for i in range(SUMS)
    ]
    signs = [_sign_sums(F.col("_sentences"), bits) for bits in (lambda h: h, F.xxhash64)]
    number = F.size("_sentences").cast("bigint").bitwiseAND(F.lit(LANE))
    whole = F.concat(F.array(*sums), *signs, F.array(number))
    return staged.withColumn(name, whole).drop("_digests", "_sentences")


def _mask(i: int) -> int:
    return SUM_MASK if i < SUMS else SIGN_MASK if i < SUMS + SIGNS else LANE


def combined(a: Column, b: Column) -> Column:
    """The fingerprint of both texts' paragraphs together: insertion of ``b`` into ``a``."""
    return F.array(*[(a[i] + b[i]).bitwiseAND(F.lit(_mask(i))) for i in range(SUMS + SIGNS + 1)])


def without(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` after the paragraphs of ``b``, which are among its own, are deleted.

    Each lane borrows from its own guard bit, so neighbours are untouched.
    """
    guards = [
        (1 << 28 | 1 << 58) if i < SUMS else (1 << 29 | 1 << 59) if i < SUMS + SIGNS else 1 << 29
        for i in range(SUMS + SIGNS + 1)
    ]
    return F.array(
        *[(a[i] + F.lit(guards[i]) - b[i]).bitwiseAND(F.lit(_mask(i))) for i in range(SUMS + SIGNS + 1)]
    )


def as_text(fingerprint: Column) -> Column:
    """15 hex digits per long."""
    return F.array_join(F.transform(fingerprint, lambda v: F.lpad(F.lower(F.hex(v)), 15, "0")), "")


def with_lanes(df: DataFrame, fingerprint: str, name: str) -> DataFrame:
    """Adds ``name``: the sign lanes as numbers, twice the ones less all sentences, around zero."""
    fp, half = F.col(fingerprint), LANE // 2 + 1

    def lane(ones: Column) -> Column:
        return (2 * ones.bitwiseAND(F.lit(LANE)) - fp[SUMS + SIGNS] + half).bitwiseAND(F.lit(LANE)) - half

    pairs = F.transform(F.slice(fp, SUMS + 1, SIGNS), lambda v: F.array(lane(v), lane(F.shiftright(v, 30))))
    return df.withColumn(name, F.flatten(pairs))


def likeness(a: Column, b: Column, same: Column) -> Column:
    """Estimated cosine of the sentence multisets, 0 to 1, with an error of about 0.09; exactly 1
    where the fingerprints are the ``same``, 0 where only one of them has sentences."""
    zero = F.lit(0.0)

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: (p * q).cast("double")), zero, lambda acc, v: acc + v)

    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    cosine = F.when(norms > 0, dot(a, b) / norms).otherwise(zero)
    return F.when(same, F.lit(1.0)).otherwise(F.least(F.greatest(cosine, zero), F.lit(1.0)))


def _slices(df: DataFrame, order: str, slices: int) -> list[int]:
    """At most ``slices`` lower bounds of ``order``, all of them values of ``df``."""
    at = [i / slices for i in range(slices)]
    found = df.agg(F.percentile_approx(order, at, max(10_000, 10 * slices))).first()[0]
    return sorted({0 if not found else found[0], *(found or [])}) if found else []


def with_next(df: DataFrame, key: str, text: str, carried: list[str]) -> DataFrame:
    """Adds ``next_<c>`` for every column of ``carried``, from the row with the next greater ``key``.

    Rows are cut into slices of nearby keys by approximate percentiles (a bounded list of numbers),
    each slice is a small window, and the first row of a slice is copied to the end of the slice
    before it; the very first follows the last. So texts move once, and no task gets more than a
    few slices. NULL keys come last; rows with equal keys follow each other by the text's hash,
    identical rows in any order. A single row is its own successor; an empty table stays empty.
    """
    ordered = df.withColumns(
        {
            "_o": F.coalesce(F.col(key).cast("bigint"), F.lit((1 << 63) - 1)),
            "_tie": F.xxhash64(text),
        }
    )
    bounds = _slices(ordered, "_o", SLICES_PER_TASK * tasks(df.sparkSession)) or [0]
    step = max(1, round(len(bounds) ** 0.5))
    every = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    coarse = F.array(*[F.lit(b).cast("bigint") for b in bounds[::step]])
    reached = (F.size(F.filter(coarse, lambda b: b <= F.col("_o"))) - 1) * step
    inside = F.size(F.filter(F.slice(every, reached + 1, step), lambda b: b <= F.col("_o")))
    sliced = ordered.withColumn("_slice", reached + inside - 1)
    before = F.pmod(F.col("_slice") - 1, F.lit(len(bounds)))
    own, copy = F.struct(F.col("_slice"), F.lit(0).alias("copy")), F.struct(before.alias("_slice"), F.lit(1).alias("copy"))
    is_first = F.col("_o") == every[F.col("_slice")]
    placed = sliced.withColumn("_p", F.explode(F.when(is_first, F.array(own, copy)).otherwise(F.array(own))))
    window = Window.partitionBy(F.col("_p._slice")).orderBy(F.col("_p.copy"), "_o", "_tie")
    following = {f"next_{c}": F.lead(c).over(window) for c in carried}
    return placed.withColumns(following).where("_p.copy = 0").drop("_o", "_tie", "_slice", "_p")


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_chars, the edited text's digest, both fingerprints, and likenesses.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document, see `with_next`. NULL texts are empty; repeated rows are documents
    of their own; extra columns are left out.
    """
    docs = df.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    docs = with_next(with_fingerprint(docs, "_text", "_fp"), "_key", "_text", ["_text", "_fp"])
    n = F.char_length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("_text", F.lit(1), n - half), F.substring("next__text", F.lit(1), half))
    docs = docs.withColumns({"_edited": edited, "_n": n.cast("bigint")}).drop("_text", "next__text")
    docs = with_fingerprint(docs.withColumn("_sha", F.sha2("_edited", 256)), "_edited", "_efp")
    for fp, name in (("_fp", "_a"), ("_efp", "_b"), ("next__fp", "_c")):
        docs = with_lanes(docs, fp, name)
    return docs.select(
        F.col("_key").alias(key),
        F.col("_n").alias("n_chars"),
        F.col("_sha").alias("edited_sha256"),
        as_text(F.col("_fp")).alias("fingerprint"),
        as_text(F.col("_efp")).alias("edited_fingerprint"),
        likeness(F.col("_a"), F.col("_b"), F.col("_fp") == F.col("_efp")).alias("near_edited"),
        likeness(F.col("_a"), F.col("_c"), F.col("_fp") == F.col("next__fp")).alias("near_next"),
    )
