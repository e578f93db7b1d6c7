"""Quality rules as a ledger of bits: every rule is evaluated once, policies are masks over the bits."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.llm.tables import small_batches

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouted"]


@dataclass(frozen=True)
class Rule:
    """One bit of the ledger; ``failed`` is SQL over the measurements and never NULL."""

    bit: int
    name: str
    failed: str


# Rules keep their bit for ever; a changed rule is a new one.
RULES = [
    Rule(0, "too_few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "n_words > 0 AND 100 * n_symbols > 30 * n_words"),
    Rule(3, "duplicate_lines", "n_lines > 0 AND 100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "long_words", "n_words > 0 AND word_chars > 20 * n_words"),
    Rule(5, "short_words", "n_words > 0 AND word_chars < 2 * n_words"),
    Rule(6, "shouting", "n_words > 0 AND 100 * n_shouted > 60 * n_words"),
]
BIT = {r.name: 1 << r.bit for r in RULES}
# A policy is a set of rules, named and never changed.
POLICIES = {
    "base": BIT["too_few_words"] | BIT["repeated_words"],
    "v1": BIT["too_few_words"] | BIT["repeated_words"] | BIT["symbols"] | BIT["duplicate_lines"],
    "v2": sum(BIT.values()),
}
CURRENT = "v2"


def measure(text: bytes) -> tuple[int, ...]:
    """The MEASURES of one text in UTF-8. Lines are cut at \\n, and only those with a word count."""
    words = text.split()
    n = len(words)
    code_points = len(text.decode())
    blanks = len(text) - len(text.translate(None, SPACES))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = 0
    windows = Counter(zip(words, words[1:], words[2:]))
    if len(windows) < n - 2:
        often = np.fromiter((windows[w] > 1 for w in zip(words, words[1:], words[2:])), bool, n - 2)
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift : shift + n - 2] |= often
        repeated = int(covered.sum())
    # Upper-cased bytes that differ from lower-cased ones: at least two ASCII letters, none of them small.
    shouted = sum(1 for w in words if len(w) > 1 and w.isupper())
    return n, code_points - blanks, symbols, len(lines) - len(set(lines)), repeated, len(lines), shouted


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).cast(pa.large_binary())
        rows = [measure(t.as_py() or b"") for t in texts]
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * len(MEASURES)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *MEASURES])


def ledger(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``df``: the ``keep`` columns, all measurements, and ``failed_bits``.

    Whole texts are measured where they are read; nothing is shuffled. A NULL text is empty: it
    has no words and fails ``too_few_words`` alone. Repeated rows are measured each; extra columns
    of ``df`` are ignored, so their names cannot clash.
    """
    keep = ["doc_id"] if keep is None else keep
    kept = df.select(*[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    schema = ", ".join([f"_keep{i} {kept.schema[i].dataType.simpleString()}" for i in range(len(keep))])
    measured = small_batches(kept).mapInArrow(
        _measure_batches, ", ".join(filter(None, [schema, *[f"{m} bigint" for m in MEASURES]]))
    )
    bits = sum((F.when(F.expr(r.failed), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES), F.lit(0))
    names = [F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)]
    return measured.select(*names, *MEASURES, bits.cast("bigint").alias("failed_bits"))


def passes(policy: str = CURRENT, bits: str = "failed_bits") -> Column:
    """Whether a ledger row passes a policy."""
    return F.col(bits).bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablations(rows: DataFrame, policies: Mapping[str, int] = POLICIES) -> DataFrame:
    """Per policy and rule in it: rows and words the rule fails, those only it fails, and what the
    policy keeps with and without it.

    The ledger is first counted per distinct ``failed_bits``, of which there are at most two to
    the number of rules; everything after works on those few rows and bit masks. Nothing is
    evaluated again. An empty ledger gives no rows.
    """
    patterns = rows.groupBy("failed_bits").agg(F.count("*").alias("_n"), F.sum("n_words").alias("_w"))
    masks = [(p, mask, r.name, 1 << r.bit) for p, mask in sorted(policies.items()) for r in RULES if mask >> r.bit & 1]
    each = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip("pmrb", m)]) for m in masks])
    hit = F.col("failed_bits").bitwiseAND(F.col("_m.m"))
    without = F.col("failed_bits").bitwiseAND(F.col("_m.m").bitwiseAND(F.bitwise_not(F.col("_m.b"))))

    def total(where: Column, of: str) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(of))), F.lit(0))

    fails = F.col("failed_bits").bitwiseAND(F.col("_m.b")) != 0
    return (
        patterns.select("*", F.explode(each).alias("_m"))
        .groupBy(F.col("_m.p").alias("policy"), F.col("_m.r").alias("rule"))
        .agg(
            total(fails, "_n").alias("failed"),
            total(fails & (without == 0), "_n").alias("failed_alone"),
            total(fails & (without == 0), "_w").alias("words_failed_alone"),
            total(hit == 0, "_n").alias("kept"),
            total(without == 0, "_n").alias("kept_without"),
        )
    )
