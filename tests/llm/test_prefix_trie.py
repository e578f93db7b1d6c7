"""The trie of conversations against a plain one of dictionaries, also where it is very deep."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

from quitanda.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, id string, depth int, conv int, pos int"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(found)] for c, found in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - conv % 5
        seq = tuple(turns if base == conv else own.get(base, [])[:h] + turns[h:])
        # A path is named by hashes of its turns, so that deep ones stay cheap.
        path = ()
        members[path].append((conv, ""))
        for d, (role, text) in enumerate(seq):
            path = (d, sha256(repr((path, role, text)).encode()).digest())
            members[path].append((conv, text))
        ends[path].append(conv)
    parents = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - conv % 5
        path = ()
        for d, (role, text) in enumerate(turns if base == conv else own.get(base, [])[:h] + turns[h:]):
            below = (d, sha256(repr((path, role, text)).encode()).digest())
            parents[below], path = path, below
    children = defaultdict(int)
    for path in parents:
        children[parents[path]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in sorted(members, key=lambda p: -p[0] if p else 1):
        leaves[path] += not children[path]
        saved[path] += (len(members[path]) - 1) * len(members[path][0][1].encode()) if path else 0
        if path:
            leaves[parents[path]] += leaves[path]
            saved[parents[path]] += saved[path]
    least = {p: min(c for c, _ in found) for p, found in members.items()}
    return sorted(
        (
            least[p],
            p[0] + 1 if p else 0,
            least[parents[p]] if p else -1,
            len(members[p]),
            children[p],
            leaves[p],
            saved[p],
            sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p in members
    )


def checked(spark, rows):
    given = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    seen = [tuple(-1 if v is None else v for v in r) for r in prefix_trie.trie(given).collect()]
    assert sorted(seen) == plain(rows) and len(seen) > 0


def test_shared_beginnings(spark):
    draw, rows = random.Random(1), []
    for conv in [*range(-12, 60), 101, 102, 997]:
        for turn in range(draw.randint(1, 12)):
            text = draw.choice(["Hi.", "é", "", None]) if turn < 3 else f"{draw.randint(0, 3)}"
            rows.append((conv, None if draw.random() < 0.03 else turn, draw.choice(["user", "assistant", None]), text))
    rows += [(None, 1, "user", "no id"), (7, 3, "user", "tie b"), (7, 3, "user", "tie a"), (7, 3, "user", "tie a")]
    checked(spark, rows)


def test_deep_conversations_and_many_equal_ones(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 7)
    line = [(t, "user" if t % 2 else "assistant", f"turn {t % 11}") for t in range(300)]
    rows = [(5, *t) for t in line] + [(6, *t) for t in line] + [(10, *t) for t in line[:200]]
    rows += [(15, *t) for t in line[:290]] + [(15, 290, "user", "another end")]
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1400) for t in range(2)]
    checked(spark, rows)


def test_only_turnless_conversations_and_no_rows(spark):
    # Conversations that have fewer turns than they would borrow, from a first one that is absent.
    turnless = [c for c in range(1, 40) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1]
    checked(spark, [(c, 0, "user", "own") for c in turnless])
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "user", "x", "", 1, 1, 1)], SCHEMA)).count() == 0
