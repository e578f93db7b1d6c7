"""Secret scans over a ledger of blobs: every distinct content meets every rule version once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quitanda.llm.tables import stored, with_key_values

MARK = "[REDACTED]"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


# The patterns of the three base kinds. A run of upper-case letters and digits or of hex
# digits is always matched whole, so its least length can stand in the pattern.
BASE_RULES = [
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]
MORE_RULES = [
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
RULES = BASE_RULES + MORE_RULES


class Ledger(NamedTuple):
    """paths: the versions' keys and ``blob``. scanned: blob, rule, version. findings: these and start, end."""

    paths: DataFrame
    scanned: DataFrame
    findings: DataFrame


def blob_of(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _among(rules: Sequence[Rule], value) -> Column:
    """``value(rule)`` of the row's rule, whose position is in _rule; patterns stay literals."""
    case = F.when(F.col("_rule") == 0, value(rules[0]))
    for i, rule in enumerate(rules[1:], 1):
        case = case.when(F.col("_rule") == i, value(rule))
    return case


def _pair(rule: Rule) -> str:
    return f"{rule.name}@{rule.version}"


def scan(
    versions: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    known: Ledger | None = None,
) -> Ledger:
    """Extends the ledger by ``versions``: one row per path and historical version of a text.

    A text is addressed by its SHA-256. Texts are brought together by address, one copy per map
    task at most; of each, only the rules are run whose version has not met that address before.
    Positions count code points, ends are exclusive; they follow from the lengths of the matches
    and of the pieces between them. Only matches are shuffled after that.

    A NULL text is empty. Repeated versions, and equal texts under any number of paths, are scanned
    once and all listed in ``paths``, NULL keys included. Extra columns are ignored. An empty table
    extends the ledger by nothing.
    """
    paths = stored(versions.select(*keys, blob_of(text).alias("blob")), "paths")
    blobs = (
        versions.select(F.coalesce(F.col(text), F.lit("")).alias("_text"), blob_of(text).alias("blob"))
        .groupBy("blob")
        .agg(F.first("_text").alias("_text"))
    )
    every = F.array(*[F.lit(_pair(r)) for r in rules])
    if known is None:
        due = blobs.withColumn("_due", every)
    else:
        pair = F.concat_ws("@", "rule", F.col("version").cast("string"))
        seen = known.scanned.groupBy("blob").agg(F.collect_set(pair).alias("_seen"))
        due = blobs.join(seen, "blob", "left").withColumn(
            "_due", F.array_except(every, F.coalesce("_seen", F.array().cast("array<string>")))
        )
    found = [
        F.struct(
            F.lit(i).alias("rule"),
            F.when(
                F.array_contains("_due", _pair(rule)),
                F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(0)),
            ).alias("matches"),
        )
        for i, rule in enumerate(rules)
    ]
    hits = (
        due.select("blob", "_text", F.explode(F.filter(F.array(*found), lambda x: F.size(x.matches) > 0)).alias("_hit"))
        .select("blob", "_text", F.col("_hit.rule").alias("_rule"), F.col("_hit.matches").alias("_match"))
        .select(
            "blob",
            "_rule",
            F.posexplode(
                F.arrays_zip(
                    F.transform("_match", F.char_length).alias("whole"),
                    F.transform(
                        _among(rules, lambda r: F.regexp_extract_all("_text", F.lit(r.pattern), F.lit(r.group))),
                        F.char_length,
                    ).alias("value"),
                    F.transform(_among(rules, lambda r: F.split("_text", r.pattern, -1)), F.char_length).alias("gap"),
                )
            ).alias("_at", "_m"),
        )
        .where(F.col("_m.whole").isNotNull())
    )
    order = Window.partitionBy("blob", "_rule").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("_m.gap") + F.col("_m.whole")).over(order)
    new = (
        hits.select("blob", "_rule", "_m", end.alias("end"))
        .where(F.col("_m.value") >= _among(rules, lambda r: F.lit(r.least)))
        .select(
            "blob",
            _among(rules, lambda r: F.lit(r.name)).alias("rule"),
            _among(rules, lambda r: F.lit(r.version)).alias("version"),
            (F.col("end") - F.col("_m.whole")).alias("start"),
            "end",
        )
    )
    findings = stored(new, "findings")
    pairs = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules]))
    scanned = paths.select("blob").distinct().select("blob", pairs.alias("_p")).select("blob", "_p.*")
    if known is not None:
        paths = known.paths.unionByName(paths)
        findings = known.findings.unionByName(findings)
        scanned = known.scanned.unionByName(scanned).distinct()
    return Ledger(paths, scanned, findings)


def current(findings: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Findings of the given rule versions, with the rule's position as ``kind``."""
    names = [r.name for r in rules]
    versions = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.version)])
    kind = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("rule")) - 1
    return findings.where(F.col("rule").isin(names)).where(F.col("version") == versions[F.col("rule")]).withColumn(
        "kind", kind
    )


def per_blob(ledger: Ledger, rules: Sequence[Rule] = RULES, base: int = len(BASE_RULES)) -> DataFrame:
    """Per blob with findings: the number of its paths, counts of the first ``base`` kinds, their
    spans' digest, all spans as text (by start, then kind), and ``cuts``, the pieces of text to keep.

    Spans of a kind never overlap, those of two kinds may; the pieces lie between their union.
    """
    rows = current(ledger.findings, rules)
    before = Window.partitionBy("blob").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_from", F.coalesce(F.max("end").over(before), F.lit(0)))
    span = F.concat_ws(":", "rule", F.col("start").cast("string"), F.col("end").cast("string"))
    piece = F.concat_ws(":", F.col("_from").cast("string"), F.col("start").cast("string"))

    def listed(text: Column, where: Column) -> Column:
        sortable = F.when(where, F.struct("start", "kind", text.alias("text")))
        return F.array_join(F.transform(F.array_sort(F.collect_list(sortable)), lambda x: x.text), ",")

    counts = [F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{r.name}") for i, r in enumerate(rules[:base])]
    per = rows.groupBy("blob").agg(
        *counts,
        F.sha2(listed(span, F.col("kind") < base), 256).alias("base_sha256"),
        listed(span, F.lit(True)).alias("spans"),
        listed(piece, F.col("_from") <= F.col("start")).alias("cuts"),
        F.max("end").cast("string").alias("tail"),
    )
    copies = ledger.paths.groupBy("blob").agg(F.count("*").alias("paths"))
    return stored(copies.join(per, "blob"), "blob_findings")


def report(ledger: Ledger, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per path: its keys, counts of the base kinds, base_sha256 and spans.

    Findings return to all paths of their blob; a blob under a third of all paths does not gather
    them in one task. Paths without findings have zeros, the digest of an empty text, and no spans.
    """
    values = [f"n_{r.name}" for r in BASE_RULES] + ["base_sha256", "spans"]
    joined = with_key_values(ledger.paths, per_blob(ledger, rules), "blob", "paths", values)
    zero = [F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias(v) for v in values[:-2]]
    none = F.sha2(F.lit(""), 256)
    keys = [c for c in ledger.paths.columns if c != "blob"]
    return joined.select(
        *keys, *zero, F.coalesce("base_sha256", none).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans")
    )


def redacted(df: DataFrame, ledger: Ledger, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``df`` with every found span of ``text`` replaced by MARK; other columns and rows stay.

    Overlapping spans become one mark. Texts without findings, NULL ones included, are unchanged.
    """
    whole = df.select(F.struct("*").alias("_row"), F.col(text).alias("_text"), blob_of(text).alias("blob"))
    joined = with_key_values(whole, per_blob(ledger, rules), "blob", "paths", ["cuts", "tail"])

    def piece(cut: Column) -> Column:
        ends = F.split(cut, ":")
        begin = ends[0].cast("int")
        return F.substring("_text", begin + 1, ends[1].cast("int") - begin)

    kept = F.array_join(F.transform(F.split("cuts", ","), piece), MARK)
    rest = F.substring("_text", F.col("tail").cast("int") + 1, F.char_length("_text"))
    clean = F.when(F.col("cuts").isNotNull(), F.concat(kept, F.lit(MARK), rest)).otherwise(F.col("_text"))
    return joined.select(*[clean.alias(c) if c == text else F.col(f"_row.`{c}`") for c in df.columns])
