"""Cheapest audits of edits over four role states, as linked nodes that share their beginnings.

A conversation's roles are read by four states: nothing yet (0), after a system row (1), after a user
row (2), after an assistant row (3). A step maps every state to every other at some cost and with
some symbol: the letters of the edits up to and including one row, or the rank of a block's audit among
those of the block. Of equally cheap paths that with the least sequence of symbols is wanted. Letters
of a step end with their only letter other than I, so no step's symbol is the beginning of another's,
and comparing symbol by symbol is comparing the whole audits.
"""

from __future__ import annotations

from functools import cache, cmp_to_key

STATES = range(4)
PRIME, BASE = (1 << 61) - 1, 1_000_003
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # fixed costs
# What a row does to a state: its first letter or a new role takes the state on.
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLES = {"u": "user", "a": "assistant"}
# What an empty row put in takes each state to.
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
# Letters that end a conversation from each state.
CLOSING = {0: "", 1: "II", 2: "I", 3: ""}

Step = dict[tuple[int, int], tuple[int, object]]


@cache
def row_step(initial: str, dead: bool, truncated: bool) -> Step:
    """Cost and letters of the best edits of one row between every two states.

    Rows put in stand before the row. Before a deleted row none are: behind it they cost the same and
    read D before I, which is less.
    """
    ways: dict[tuple[int, int], list[tuple[int, str]]] = {}
    for start in STATES:
        ways.setdefault((start, start), []).append((DELETE, "D"))
        if dead:
            continue
        state = start
        for inserted in range(3):
            letters, cost = "I" * inserted, INSERT * inserted + TRUNCATED * truncated
            if (state, initial) in AFTER:
                ways.setdefault((start, AFTER[state, initial]), []).append((cost + KEEP, letters + "K"))
            ways.setdefault((start, AFTER[state, NEXT[state]]), []).append((cost + REROLE, letters + "R"))
            state = AFTER[state, NEXT[state]]
    return {ends: min(found) for ends, found in ways.items()}


class Audits:
    """Nodes of audits: each has a parent, a symbol, a rolling hash, and ancestors 1, 2, 4, ... steps up."""

    def __init__(self, prime: int = PRIME):
        self.prime = prime
        self.symbol: list[object] = [None]
        self.hash: list[int] = [0]
        self.up: list[tuple[int, ...]] = [()]
        self.collisions = 0

    def extended(self, parent: int, symbol) -> int:
        ancestors, up = [parent], self.up
        k = 0
        while k < len(up[ancestors[k]]):
            ancestors.append(up[ancestors[k]][k])
            k += 1
        value = hash(symbol) if isinstance(symbol, int) else int.from_bytes(symbol.encode())
        self.symbol.append(symbol)
        self.hash.append((self.hash[parent] * BASE + value + 1) % self.prime)
        up.append(tuple(ancestors))
        return len(up) - 1

    def symbols(self, node: int) -> list:
        found = []
        while node:
            found.append(self.symbol[node])
            node = self.up[node][0]
        return found[::-1]

    def _same(self, a: int, b: int) -> bool:
        """Whether two audits of equal length are equal, symbol by symbol back to a shared node."""
        while a != b:
            if self.symbol[a] != self.symbol[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def compare(self, a: int, b: int) -> int:
        """-1, 0 or 1 for two audits of equal length: their longest common beginning is searched for in
        the ancestors by hash, then verified; hashes that collide lead to comparing all symbols."""
        if a == b:
            return 0
        first, second, up = a, b, self.up
        if self.hash[a] == self.hash[b]:
            if self._same(a, b):
                return 0
            self.collisions += 1
            return self._plain(first, second)
        for k in range(len(up[a]) - 1, -1, -1):
            if k < len(up[a]) and self.hash[up[a][k]] != self.hash[up[b][k]]:
                a, b = up[a][k], up[b][k]
        if not self._same(up[a][0], up[b][0]) or self.symbol[a] == self.symbol[b]:
            self.collisions += 1
            return self._plain(first, second)
        return -1 if self.symbol[a] < self.symbol[b] else 1

    def _plain(self, a: int, b: int) -> int:
        x, y = self.symbols(a), self.symbols(b)
        return (x > y) - (x < y)

    def best(self, steps: list[Step], start: int) -> dict[int, tuple[int, int]]:
        """Per state that can be reached from ``start``: (cost, node) of the best audit."""
        now = {start: (0, 0)}
        for step in steps:
            then: dict[int, tuple[int, int]] = {}
            chosen: dict[int, tuple[int, object]] = {}
            for (state, end), (more, symbol) in step.items():
                if state not in now:
                    continue
                cost, node = now[state]
                cost += more
                held = then.get(end)
                if held is None or cost < held[0]:
                    then[end], chosen[end] = (cost, node), (node, symbol)
                elif cost == held[0]:
                    other, letter = chosen[end]
                    order = self.compare(node, other)
                    if order < 0 or (order == 0 and symbol < letter):
                        then[end], chosen[end] = (cost, node), (node, symbol)
            now = {end: (cost, self.extended(*chosen[end])) for end, (cost, _) in then.items()}
        return now

    def block(self, steps: list[Step]) -> Step:
        """The step that all steps together are: cost, and rank of the best audit among all of these."""
        found = {(p, q): way for p in STATES for q, way in self.best(steps, p).items()}
        order = cmp_to_key(self.compare)
        nodes = sorted({node for _, node in found.values()}, key=order)
        ranks: dict[int, int] = {}
        for last, node in zip([None, *nodes], nodes):
            ranks[node] = 0 if last is None else ranks[last] + (self.compare(last, node) != 0)
        return {ends: (cost, ranks[node]) for ends, (cost, node) in found.items()}

    def closed(self, steps: list[Step]) -> tuple[int, int, int]:
        """(cost with that of closing rows, last state, node) of the best audit of a whole conversation."""
        ends = [(cost + INSERT * len(CLOSING[q]), node, q) for q, (cost, node) in self.best(steps, 0).items()]
        least = min(cost for cost, _, _ in ends)
        order = cmp_to_key(lambda x, y: self.compare(x[1], y[1]))
        _, node, end = min((e for e in ends if e[0] == least), key=order)
        return least, end, node


def states_along(steps: list[Step], start: int, end: int) -> list[tuple[int, int]]:
    """The two states of every step on the best audit from ``start`` to ``end``."""
    audits = Audits()
    symbols = audits.symbols(audits.best(steps, start)[end][1])
    states, state = [], start
    for step, symbol in zip(steps, symbols, strict=True):
        # From one state a symbol leads to one state only.
        then = next(q for (p, q), (_, s) in step.items() if p == state and s == symbol)
        states.append((state, then))
        state = then
    return states
