"""Run-length grammars of number sequences by recompression, and longest common extensions on them.

Rounds take turns: a block round replaces every run of one symbol by one symbol, a pair round splits the alphabet into
left and right symbols and replaces every left symbol and the right symbol after it. What replaces them depends on
nothing but the symbols themselves, so equal stretches are compressed alike but for their ends. After a number of
rounds that is logarithmic in its length each sequence is one symbol: the start of its grammar.

The levels are kept as arrays, a boundary between two symbols being the number of symbols before it. An extension of
two places climbs while both are boundaries a level up, taking at most one step a level, and comes down again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from brindle.llm.words import mixed


@dataclass
class Grammar:
    """`names[k]`: the symbols of level k, level 0 being the input. `up[k]`: the symbol a level up that holds each.
    `down[k]`: the boundary one level below of each boundary of level k + 1. `ends[k]`: boundaries of the sequences.
    `blocks[k]`: whether level k + 1 was made by a block round.
    `rules`: for each round the first name it gave, whether it was a block round, and for each name the replaced
    symbol with its exponent, or the replaced pair."""

    names: list[np.ndarray]
    ends: list[np.ndarray]
    up: list[np.ndarray] = field(default_factory=list)
    down: list[np.ndarray] = field(default_factory=list)
    blocks: list[bool] = field(default_factory=list)
    rules: list[tuple[int, bool, np.ndarray, np.ndarray]] = field(default_factory=list)
    next_name: int = 0

    def _push(self, head: np.ndarray, is_block: bool) -> None:
        """A level whose symbols begin at `head`; those of several symbols get the name of their rule."""
        names, start = self.names[-1], np.flatnonzero(head)
        down = np.append(start, len(names))
        size = np.diff(down)
        many = np.flatnonzero(size > 1)
        left = names[start[many]]
        right = size[many] if is_block else names[start[many] + 1]
        rules, which = np.unique(left << 32 | right, return_inverse=True)
        above = names[start]
        above[many] = self.next_name + which
        self.rules.append((self.next_name, is_block, rules >> 32, rules & 0xFFFFFFFF))
        self.next_name += len(rules)
        up = np.cumsum(head) - 1
        ends = np.searchsorted(start, self.ends[-1])
        self.names.append(above)
        self.ends.append(ends)
        self.up.append(up.astype(np.int32))
        self.down.append(down.astype(np.int32))
        self.blocks.append(is_block)

    def starts(self) -> list[int]:
        """The start symbol of each sequence, -1 if it is empty."""
        top, ends = self.names[-1], self.ends[-1]
        return [int(top[a]) if b > a else -1 for a, b in zip(ends[:-1], ends[1:])]

    def expand(self, name: int) -> list[int]:
        """The input symbols that a symbol stands for."""
        out, todo = [], [name]
        while todo:
            name = todo.pop()
            rule = next((r for r in reversed(self.rules) if r[0] <= name), None)
            if rule is None or name - rule[0] >= len(rule[2]):
                out.append(name)
            elif rule[1]:
                todo += [int(rule[2][name - rule[0]])] * int(rule[3][name - rule[0]])
            else:
                todo += [int(rule[3][name - rule[0]]), int(rule[2][name - rule[0]])]
        return out

    def extend(self, i: np.ndarray, j: np.ndarray, owner: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols match from the boundaries i < j on, or up to them, inside the sequence `owner`."""
        a, b = i.astype(np.int64), j.astype(np.int64)
        turned: list[np.ndarray] = []
        at = np.arange(len(a))
        for level in range(len(self.names)):
            same = self._same(level, a, b, owner, at, forward)
            if level == len(self.up):
                turned.append(at)
                break
            here = at[same]
            inner = here[~self._both_edges(level, a, b, here)]
            self._step(level, a, b, inner, forward)
            climbs = self._both_edges(level, a, b, here)
            turned.append(np.concatenate([at[~same], here[~climbs]]))
            at = here[climbs]
            if not len(at):
                break
            for x in (a, b):
                x[at] = self._above(level, x[at])
        at = turned.pop()
        for level in range(len(turned), -1, -1):
            moving = at
            while len(moving := moving[self._same(level, a, b, owner, moving, forward)]):
                self._step(level, a, b, moving, forward)
            if level:
                for x in (a, b):
                    x[at] = self.down[level - 1][x[at]]
                at = np.concatenate([at, turned.pop()])
        return a - i if forward else i - a

    def _above(self, level: int, p: np.ndarray) -> np.ndarray:
        """The boundary a level up of boundaries that are one there."""
        up = self.up[level]
        out = np.full(len(p), len(self.names[level + 1]), np.int64)
        inside = p < len(up)
        out[inside] = up[p[inside]]
        return out

    def _both_edges(self, level: int, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        down = self.down[level]
        x, y = a[at], b[at]
        return (down[self._above(level, x)] == x) & (down[self._above(level, y)] == y)

    def _same(self, level: int, a: np.ndarray, b: np.ndarray, owner: np.ndarray, at: np.ndarray, forward: bool) -> np.ndarray:
        """Whether both boundaries have a symbol of their sequence beside them, and the same one."""
        names, ends, x, y = self.names[level], self.ends[level], a[at], b[at]
        if forward:
            inside = y < ends[owner[at] + 1]
        else:
            inside = x > ends[owner[at]]
            x, y = x - 1, y - 1
        last = len(names) - 1
        return inside & (names[np.clip(x, 0, last)] == names[np.clip(y, 0, last)])

    def _step(self, level: int, a: np.ndarray, b: np.ndarray, at: np.ndarray, forward: bool) -> None:
        """Over one matching symbol, or over what both have left of a run of it."""
        size = 1
        if level < len(self.blocks) and self.blocks[level]:
            up, down, x, y = self.up[level], self.down[level], a[at], b[at]
            if forward:
                size = np.minimum(down[up[x] + 1] - x, down[up[y] + 1] - y)
            else:
                size = np.minimum(x - down[up[x - 1]], y - down[up[y - 1]])
        move = size if forward else -size
        a[at] += move
        b[at] += move


def build(ids: np.ndarray, first: np.ndarray) -> Grammar:
    """Grammars of the sequences `ids[first[t]:first[t + 1]]` with common names. Numbers from 0 to below 2**31."""
    g = Grammar([ids.astype(np.int64)], [np.asarray(first, np.int64)], next_name=int(ids.max(initial=-1)) + 1)
    salt = 0
    while len(g.names[-1]) > np.count_nonzero(np.diff(g.ends[-1])):
        names, ends = g.names[-1], g.ends[-1]
        opens = np.zeros(len(names) + 1, bool)
        opens[ends] = True
        opens = opens[:-1]
        head = opens.copy()
        head[1:] |= names[1:] != names[:-1]
        if not head.all():
            g._push(head, True)
            continue
        salt += 1
        side = (mixed(names.astype(np.uint64) + np.uint64(salt << 40)) & np.uint64(1)).astype(bool)
        meets = ~opens[1:]
        first_left, first_right = side[:-1] & ~side[1:] & meets, ~side[:-1] & side[1:] & meets
        second = first_left if np.count_nonzero(first_left) >= np.count_nonzero(first_right) else first_right
        if second.any():
            head = np.ones(len(names), bool)
            head[1:] = ~second
            g._push(head, False)
    return g
