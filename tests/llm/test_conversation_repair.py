"""Audited repair against a plain dynamic program over strings, in one block and in many."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from quitanda.llm import audit_paths, conversation_repair

GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, slice int, audit string, _uid int"


def damaged(rows):
    """Rows per conversation after damage, in order."""
    result = defaultdict(list)
    for conv, turn, role, text in rows:
        result[conv] += []
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        new = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = ((turn is not None, turn or 0), role, text, turn, "user" if fault == 4 else role, new)
        result[conv] += [row] * (2 if fault == 3 else 1)
    return {conv: [r[3:] for r in sorted(found, key=lambda r: r[:3])] for conv, found in result.items()}


def plain(rows):
    """Counts, cheapest audit and repaired lines by trying all edits, rows put in anywhere."""
    seen, kinds = set(), []
    for _, role, text in rows:
        rest = text.strip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated")
        seen.add((role, text))
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(now):
        for _ in range(2):
            for state, (cost, audit, lines) in list(now.items()):
                for initial, name in names.items():
                    if (state, initial) in after:
                        way = (cost + 2, audit + "I", [*lines, f"{name}:"])
                        end = after[state, initial]
                        now[end] = min(now.get(end, way), way)
        return now

    now = with_inserts({0: (0, "", [])})
    for (_, role, text), kind in zip(rows, kinds):
        then = {}

        def offer(state, way):
            then[state] = min(then.get(state, way), way)

        for state, (cost, audit, lines) in now.items():
            offer(state, (cost + 3, audit + "D", lines))
            if kind in ("blank", "duplicate"):
                continue
            more = kind == "truncated"
            if (state, role[:1]) in after:
                offer(after[state, role[:1]], (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
            for initial, name in names.items():
                if (state, initial) in after:
                    offer(after[state, initial], (cost + 2 + more, audit + "R", [*lines, f"{name}:{text}"]))
        now = with_inserts(then)
    cost, audit, lines = min(now[s] for s in (0, 3) if s in now)
    assert GRAMMAR.fullmatch("".join(line[0] for line in lines))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest()


def conversations(seed, convs, longest):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "why?", "cut off", " \t", "", "one. two", "ok.\n", None, "x" * 300 + "."]
    roles = ["user", "assistant", "system", "User", "", None, "uncle", "tool"]
    rows = []
    for conv in range(convs):
        for turn in range(draw.randint(1, longest)):
            role = draw.choice(roles[:3]) if draw.random() < 0.8 else draw.choice(roles)
            text = draw.choice(texts) if draw.random() < 0.5 else f"text {draw.randint(0, 10**6)}" + draw.choice([".", "!", "", " ?"])
            rows.append((conv if conv else None, None if draw.random() < 0.05 else turn * draw.choice([1, 1, 1, 2]), role, text))
    return rows


def checked(spark, rows):
    extra = [(*r, 1, "x", 2) for r in rows]
    seen = conversation_repair.report(
        conversation_repair.repaired(conversation_repair.damaged(spark.createDataFrame(extra, SCHEMA).repartition(3)))
    ).collect()
    assert seen and {r.conv_id: tuple(r)[1:] for r in seen} == {c: plain(found) for c, found in damaged(rows).items()}
    assert len(seen) == len({r[0] for r in rows})


def test_short_conversations(spark):
    checked(spark, conversations(1, 150, 9))


def test_long_conversations_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "BLOCK_ROWS", 7)
    checked(spark, conversations(2, 6, 90) + [(900, t, "user" if t % 3 else "assistant", f"line {t % 40}.") for t in range(400)])


def test_repeated_rows_and_one_conversation(spark):
    checked(spark, [(5, 1, "user", "same.")] * 40 + [(5, None, None, None)] * 3 + [(6, 2, "assistant", "a.")])


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversation_repair.report(conversation_repair.repaired(conversation_repair.damaged(none))).count() == 0


def test_blocks_compose_to_the_whole():
    """Ranks of blocks stand for their audits: any cut gives the same states."""
    draw = random.Random(4)
    for _ in range(60):
        rows = [(draw.choice("sua?"), draw.random() < 0.2, draw.random() < 0.3) for _ in range(draw.randint(1, 40))]
        steps = [audit_paths.row_step(i if i != "?" else "", dead, cut) for i, dead, cut in rows]
        audits = audit_paths.Audits()
        cost, end, node = audits.closed(steps)
        letters = audits.symbols(node)
        cuts = sorted({0, len(steps), *(draw.randrange(len(steps)) for _ in range(5))})
        parts = [steps[a:b] for a, b in zip(cuts, cuts[1:])]
        blocks = [audit_paths.Audits().block(p) for p in parts]
        assert audit_paths.Audits().closed(blocks)[:2] == (cost, end)
        found = []
        for part, (p, q) in zip(parts, audit_paths.states_along(blocks, 0, end)):
            inner = audit_paths.Audits()
            found += inner.symbols(inner.best(part, p)[q][1])
        assert found == letters


def test_least_audit_of_equal_cost_and_collisions():
    """Comparisons by hash agree with plain ones, also where hashes collide all the time."""
    for prime in (audit_paths.PRIME, 3):
        draw, audits = random.Random(7), audit_paths.Audits(prime)
        nodes = [0]
        for _ in range(400):
            nodes.append(audits.extended(draw.choice(nodes[-6:]), draw.choice(["D", "K", "IK", "R"])))
        by_length = defaultdict(list)
        for node in nodes:
            by_length[len(audits.symbols(node))].append(node)
        for same in by_length.values():
            for a in same:
                for b in same:
                    x, y = audits.symbols(a), audits.symbols(b)
                    assert audits.compare(a, b) == (x > y) - (x < y)
        assert (audits.collisions > 0) == (prime == 3)


@pytest.mark.parametrize("initial", ["s", "u", "a", ""])
def test_symbols_of_a_step_begin_no_other(initial):
    for dead in (False, True):
        letters = {s for _, s in audit_paths.row_step(initial, dead, False).values()}
        assert all(x == y or not y.startswith(x) for x in letters for y in letters)
