"""Damaged conversations repaired by the cheapest edits, with an audit of these."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.llm.audit_paths import AFTER, CLOSING, NEXT, ROLES, STATES, Audits, Step, row_step, states_along
from quitanda.llm.tables import small_batches, stored

WHITE = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
# Rows and characters of a block, the unit in which a long conversation is worked on.
BLOCK_ROWS, BLOCK_CHARS = 2_000, 4_000_000
# Characters of role and text by which rows of one turn are ordered, before a hash of both.
TIE = 64
COUNTS = ("blank", "duplicate", "truncated", "illegal")
TOTALS = ("gaps", *COUNTS, "cost")
LINES = "array<struct<role: string, text: string>>"
_BLOCKS = (
    "conv string, slice int, block int, whole boolean, roles array<string>, texts array<string>, turns array<bigint>, "
    f"digests array<binary>, repeats array<boolean>, {', '.join(f'{c} bigint' for c in TOTALS)}, audit string, lines {LINES}"
)
_ARROW = pa.schema(
    [
        ("conv", pa.string()),
        ("slice", pa.int32()),
        ("block", pa.int32()),
        ("whole", pa.bool_()),
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
        ("turns", pa.list_(pa.int64())),
        ("digests", pa.list_(pa.binary())),
        ("repeats", pa.list_(pa.bool_())),
        *[(c, pa.int64()) for c in TOTALS],
        ("audit", pa.string()),
        ("lines", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
    ]
)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations with faults put in by a checksum of their keys, as the contract of op11 says.

    Adds ``copy`` (0, or 1 for the second of two equal rows) and ``ghost`` (a dropped row). NULLs read
    as one space, in the checksum as well as in roles and texts.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", space("role").alias("_role"), space("text").alias("_text"), fault.alias("_fault"))
    text = (
        F.when(F.col("_fault").isin(0, 1), "").when(F.col("_fault") == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text"))
    )
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.select(
        "conv_id",
        "turn",
        F.when(F.col("_fault") == 4, "user").otherwise(F.col("_role")).alias("role"),
        text.alias("text"),
        F.struct(
            F.substring("_role", 1, TIE).alias("role"), F.substring("_text", 1, TIE).alias("text"), F.xxhash64("_role", "_text").alias("hash")
        ).alias("tie"),
        F.explode(copies).alias("copy"),
        (F.col("_fault") == 0).alias("ghost"),
    )


def _initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else ""


def _digest(role: str, text: str) -> bytes:
    name = role.encode()
    return blake2b(b"%d:%b%b" % (len(name), name, text.encode()), digest_size=16).digest()


class _Run:
    """Rows of one block with what is known of them."""

    def __init__(self, roles: list[str], texts: list[str], turns: list[int | None], repeats: list[bool]):
        self.roles, self.texts, self.turns = roles, texts, [t for t in turns if t is not None]
        self.initials = [_initial(r) for r in roles]
        self.steps: list[Step] = []
        self.counts = dict.fromkeys(COUNTS, 0)
        for initial, text, repeat in zip(self.initials, texts, repeats, strict=True):
            rest = text.rstrip(WHITE)
            cut = bool(rest) and not repeat and rest[-1] not in ".!?"
            if not rest:
                self.counts["blank"] += 1
            elif repeat:
                self.counts["duplicate"] += 1
            self.counts["truncated"] += cut
            self.steps.append(row_step(initial, not rest or repeat, cut))
        self.counts["illegal"] = sum(a + b not in LEGAL for a, b in zip(self.initials, self.initials[1:]))

    def gaps(self) -> int:
        return self.turns[-1] - self.turns[0] + 1 - len(set(self.turns)) if self.turns else 0

    def lines(self, letters: list[str], state: int, closing: str = "") -> list[dict[str, str]]:
        """The rows that the edits leave."""
        found = []
        for i, step in enumerate([*letters, closing]):
            for letter in step:
                if letter == "D":
                    continue
                role = ROLES[NEXT[state]]
                if letter == "I":
                    found.append({"role": role, "text": ""})
                else:
                    found.append({"role": self.roles[i] if letter == "K" else role, "text": self.texts[i]})
                state = AFTER[state, self.initials[i] if letter == "K" else NEXT[state]]
        return found


def _solved(run: _Run) -> dict:
    """Totals, audit and lines of a conversation that is one block."""
    audits = Audits()
    cost, end, node = audits.closed(run.steps)
    letters = audits.symbols(node)
    lines = run.lines(letters, 0, CLOSING[end])
    return {"gaps": run.gaps(), **run.counts, "cost": cost, "audit": "".join(letters) + CLOSING[end], "lines": lines}


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered rows of a partition, in blocks. A conversation that lies inside the partition and fits in
    one block is solved; others may go on in the next partition or block."""
    out: list[dict] = []
    held = 0
    conv, slice_, block, chars, first = None, 0, 0, 0, True
    roles, texts, turns, digests, repeats, seen = [], [], [], [], [], set()

    def finished(last: bool) -> dict:
        row = {"conv": conv, "slice": slice_, "block": block, "whole": last and block == 0 and not first}
        if row["whole"]:
            return row | _solved(_Run(roles, texts, turns, repeats))
        return row | {"roles": roles, "texts": texts, "turns": turns, "digests": digests, "repeats": repeats}

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("_conv", "slice", "role", "text", "turn", "ghost")]
        for c, s, role, text, turn, ghost in zip(*columns, strict=True):
            full = len(roles) >= BLOCK_ROWS or chars + len(text) > BLOCK_CHARS
            if conv is not None and (c != conv or (full and roles)):
                out.append(finished(c != conv))
                held += chars
                roles, texts, turns, digests, repeats, chars, block = [], [], [], [], [], 0, block + 1
                if c != conv:
                    first, block, seen = False, 0, set()
                if held > BLOCK_CHARS:
                    yield pa.RecordBatch.from_pylist(out, _ARROW)
                    out, held = [], 0
            conv, slice_ = c, s
            if not ghost:
                digest = _digest(role, text)
                roles.append(role)
                texts.append(text)
                turns.append(turn)
                digests.append(digest)
                repeats.append(digest in seen)
                seen.add(digest)
                chars += len(text)
    if conv is not None:
        first = True  # the last conversation may go on
        out.append(finished(True))
    if out:
        yield pa.RecordBatch.from_pylist(out, _ARROW)


# Summaries of blocks


_SUMMARY = (
    f"costs array<bigint>, ranks array<bigint>, {', '.join(f'{c} bigint' for c in COUNTS)}, first_initial string, "
    "last_initial string, first_turn bigint, last_turn bigint, distinct_turns bigint"
)
_PATH = "start int, stop int, closing string"


def _summary(steps: list[Step], counts: dict, initials: tuple, turns: tuple) -> dict:
    whole = Audits().block(steps)
    ends = [(p, q) for p in STATES for q in STATES]
    return {
        "costs": [whole[e][0] if e in whole else None for e in ends],
        "ranks": [whole[e][1] if e in whole else None for e in ends],
        **counts,
        **dict(zip(("first_initial", "last_initial"), initials)),
        **dict(zip(("first_turn", "last_turn", "distinct_turns"), turns)),
    }


def _step(costs, ranks) -> Step:
    ends = [(p, q) for p in STATES for q in STATES]
    return {e: (int(c), int(r)) for e, c, r in zip(ends, costs, ranks) if c is not None and not pd.isna(c)}


def _run_of(row: dict) -> _Run:
    late = set(row["late"] or ())
    repeats = [r or i in late for i, r in enumerate(row["repeats"])]
    return _Run(row["roles"], row["texts"], row["turns"], repeats)


def _leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("conv", pa.string()),
            ("slice", pa.int32()),
            ("block", pa.int32()),
            ("costs", pa.list_(pa.int64())),
            ("ranks", pa.list_(pa.int64())),
            *[(c, pa.int64()) for c in COUNTS],
            ("first_initial", pa.string()),
            ("last_initial", pa.string()),
            *[(c, pa.int64()) for c in ("first_turn", "last_turn", "distinct_turns")],
        ]
    )
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            run = _run_of(row)
            initials = (run.initials[0], run.initials[-1]) if run.initials else (None, None)
            turns = (run.turns[0], run.turns[-1], len(set(run.turns))) if run.turns else (None, None, 0)
            out.append({c: row[c] for c in ("conv", "slice", "block")} | _summary(run.steps, run.counts, initials, turns))
        yield pa.RecordBatch.from_pylist(out, schema)


def _merged(rows: list[dict]) -> tuple[list[Step], dict, tuple, tuple]:
    """Steps of the parts in order, and their counts, ends and turns taken together."""
    steps = [_step(r["costs"], r["ranks"]) for r in rows]
    counts = {c: int(sum(r[c] for r in rows)) for c in COUNTS}
    full = [r for r in rows if r["first_initial"] is not None]
    counts["illegal"] += sum(a["last_initial"] + b["first_initial"] not in LEGAL for a, b in zip(full, full[1:]))
    timed = [r for r in rows if not pd.isna(r["first_turn"])]
    distinct = sum(r["distinct_turns"] for r in timed) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(timed, timed[1:]))
    initials = (full[0]["first_initial"], full[-1]["last_initial"]) if full else (None, None)
    turns = (int(timed[0]["first_turn"]), int(timed[-1]["last_turn"]), int(distinct)) if timed else (None, None, 0)
    return steps, counts, initials, turns


def _ordered(group: pd.DataFrame, by: str) -> list[dict]:
    return group.sort_values(by).astype(object).to_dict("records")


def _of_slice(group: pd.DataFrame) -> pd.DataFrame:
    """One summary of a conversation's blocks in one slice."""
    rows = _ordered(group, "block")
    steps, counts, initials, turns = _merged(rows)
    return pd.DataFrame([{"conv": rows[0]["conv"], "slice": rows[0]["slice"]} | _summary(steps, counts, initials, turns)])


def _of_conversation(group: pd.DataFrame) -> pd.DataFrame:
    """Totals of a conversation, and the states between which its best audit crosses every slice."""
    rows = _ordered(group, "slice")
    steps, counts, _, turns = _merged(rows)
    cost, end, _ = Audits().closed(steps)
    gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
    ends = [""] * (len(rows) - 1) + [CLOSING[end]]
    found = [
        {"conv": r["conv"], "slice": r["slice"], "gaps": gaps, **counts, "cost": cost, "start": p, "stop": q, "closing": c}
        for r, (p, q), c in zip(rows, states_along(steps, 0, end), ends, strict=True)
    ]
    return pd.DataFrame(found)


def _to_blocks(group: pd.DataFrame) -> pd.DataFrame:
    """The states between which the best audit crosses every block of a slice."""
    rows = _ordered(group, "block")
    steps = [_step(r["costs"], r["ranks"]) for r in rows]
    kept = ("conv", "slice", "block", *(f"_{c}" for c in TOTALS))
    path = states_along(steps, int(rows[0]["start"]), int(rows[0]["stop"]))
    ends = [""] * (len(rows) - 1) + [rows[0]["closing"]]
    return pd.DataFrame(
        [{c: r[c] for c in kept} | {"start": p, "stop": q, "closing": c} for r, (p, q), c in zip(rows, path, ends, strict=True)]
    )


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([_ARROW.field(c) for c in ("conv", "slice", "block", *TOTALS, "audit", "lines")])
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            run, audits = _run_of(row), Audits()
            letters = audits.symbols(audits.best(run.steps, row["start"])[row["stop"]][1])
            lines = run.lines(letters, row["start"], row["closing"])
            totals = {c: row[f"_{c}"] for c in TOTALS}
            audit = "".join(letters) + row["closing"]
            out.append({c: row[c] for c in ("conv", "slice", "block")} | totals | {"audit": audit, "lines": lines})
        yield pa.RecordBatch.from_pylist(out, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """(conv, slice, block, whole, gaps, blank, duplicate, truncated, illegal, cost, audit, lines) of conversations.

    ``rows`` are as `damaged` gives them: (conv_id, turn, role, text, tie, copy, ghost). A conversation
    comes in one or more blocks, in the order of (slice, block); counts and cost are those of the
    whole, audit and lines (role, text) those of the block. ``conv`` is conv_id as text, empty for NULL:
    rows without an id are one conversation. Rows are ordered by turn, NULL first, then by the first 64
    characters of the original role and text, and a hash of both; equal rows cannot be told apart. A conversation with ghosts only has
    one empty block.

    Rows are range-partitioned by their order, so a conversation of any size is cut over tasks like
    everything else, and stored. A conversation inside one partition and block is solved on the spot.
    Of the others (two per partition, and those of more than 2,000 rows) every block sends the cost and
    the rank of its best audit between every two states: audits of a block are compared once, and ranks
    stand for them further up, where slices and then the conversation choose among them. No group holds
    more than the blocks of one slice or one row per slice. Texts seen in an earlier slice are found by
    the digests of such blocks.
    """
    place = F.monotonically_increasing_id()
    numbered = rows.withColumn("_conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(""))).withColumn("_uid", place)
    order = ["_conv", "turn", "tie", "_uid"]
    ordered = numbered.repartitionByRange(*order).sortWithinPartitions(*order, "copy")
    ordered = ordered.withColumn("slice", F.spark_partition_id()).select("_conv", "slice", "role", "text", "turn", "ghost")
    blocks = stored(small_batches(ordered).mapInArrow(_cut, _BLOCKS), "blocks")

    parts = blocks.where(~F.col("whole")).select("conv", "slice", "block", "roles", "texts", "turns", "digests", "repeats")
    new = parts.select("conv", "slice", "block", "repeats", F.posexplode("digests").alias("n", "digest"))
    new = new.where(~F.element_at("repeats", F.col("n") + 1)).select("conv", "digest", "slice", "block", "n")
    seen = new.groupBy("conv", "digest").agg(F.min("slice").alias("_first"), F.max("slice").alias("_last"))
    seen = seen.where("_first < _last").select(F.col("conv").alias("_c"), F.col("digest").alias("_d"), "_first")
    again = new.join(seen, (F.col("conv") == F.col("_c")) & (F.col("digest") == F.col("_d"))).where("slice > _first")
    late = again.groupBy(F.col("conv").alias("_c"), F.col("slice").alias("_s"), F.col("block").alias("_b")).agg(
        F.collect_list("n").alias("late")
    )
    same = (F.col("conv") == F.col("_c")) & (F.col("slice") == F.col("_s")) & (F.col("block") == F.col("_b"))
    known = parts.join(late, same, "left").drop("_c", "_s", "_b")
    leaves = stored(small_batches(known).mapInArrow(_leaf, f"conv string, slice int, block int, {_SUMMARY}"), "summaries")

    slices = leaves.groupBy("conv", "slice").applyInPandas(_of_slice, f"conv string, slice int, {_SUMMARY}")
    totals = ", ".join(f"{c} bigint" for c in TOTALS)
    paths = slices.groupBy("conv").applyInPandas(_of_conversation, f"conv string, slice int, {totals}, {_PATH}")
    paths = paths.select("conv", "slice", *[F.col(c).alias(f"_{c}") for c in TOTALS], "start", "stop", "closing")
    wanted = leaves.select("conv", "slice", "block", "costs", "ranks").join(paths, ["conv", "slice"])
    under = ", ".join(f"_{c} bigint" for c in TOTALS)
    crossed = wanted.groupBy("conv", "slice").applyInPandas(_to_blocks, f"conv string, slice int, block int, {under}, {_PATH}")
    rendered = small_batches(known.drop("digests").join(crossed, ["conv", "slice", "block"])).mapInArrow(
        _render, f"conv string, slice int, block int, {totals}, audit string, lines {LINES}"
    )
    columns = ["conv", "slice", "block", *TOTALS, "audit", "lines"]
    whole = blocks.where("whole").select(*columns, F.lit(True).alias("whole"))
    return whole.unionByName(rendered.withColumn("whole", F.lit(False)))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and SHA-256 of conversations whose blocks come in order, one after the other."""
    conv, audit, sums, begun, totals = None, [], sha256(), False, {}

    def result() -> dict:
        return {"conv": conv, **totals, "audit": "".join(audit), "repaired_sha256": sums.hexdigest()}

    fields = [_ARROW.field(c) for c in ("conv", *TOTALS, "audit")]
    schema = pa.schema([*fields, ("repaired_sha256", pa.string())])
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["conv"] != conv:
                if conv is not None:
                    out.append(result())
                conv, audit, sums, begun, totals = row["conv"], [], sha256(), False, {c: row[c] for c in TOTALS}
            audit.append(row["audit"])
            if row["some"]:
                sums.update(b"\n" * begun + row["text"].encode())
                begun = True
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if conv is not None:
        yield pa.RecordBatch.from_pylist([result()], schema)


def _text(lines: str) -> Column:
    return F.array_join(F.transform(lines, lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")


def report(pieces: DataFrame, conv_id: str = "bigint") -> DataFrame:
    """One row per conversation: conv_id, the counts and cost, the whole audit, SHA-256 of the repaired lines.

    Conversations of several blocks are shuffled by id and hashed in a stream of blocks: a SHA-256 goes
    through a text from end to end, so one task reads the lines of one conversation, a block at a
    time.
    """
    key = F.nullif(F.col("conv"), F.lit("")).cast(conv_id).alias("conv_id")
    wanted = [key, *TOTALS, "audit"]
    whole = pieces.where("whole").select(*wanted, F.sha2(_text("lines").cast("binary"), 256).alias("repaired_sha256"))
    parts = pieces.where(~F.col("whole")).select(
        "conv", "slice", "block", *TOTALS, "audit", (F.size("lines") > 0).alias("some"), _text("lines").alias("text")
    )
    in_order = parts.repartition("conv").sortWithinPartitions("conv", "slice", "block")
    totals = ", ".join(f"{c} bigint" for c in TOTALS)
    streamed = small_batches(in_order).mapInArrow(_joined, f"conv string, {totals}, audit string, repaired_sha256 string")
    return whole.unionByName(streamed.select(*wanted, "repaired_sha256"))
