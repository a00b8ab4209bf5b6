"""How many pieces of each length share a sequence: a plan from the counts of lengths alone.

Linear grouping: lengths above a part of the capacity are dealt in falling
order to groups of equal numbers of pieces, and each group counts as its
longest. For these few sizes a linear program over configurations (column
generation, a knapsack finds the next one) says how often to use which; whole
parts of its solution are kept. Real lengths then take the groups' places,
longest first, which leaves room where they are shorter, and all that is left,
small ones last, goes best fit: into the fullest sequence that has room.

Sequences with the same content are one ``Class``, so that the work depends on
the number of different lengths and not on the number of pieces.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np

#: Groups of the large lengths, and the part of the capacity above which a length is large.
GROUPS, LARGE = 48, 1 / 4
STEPS = 2_000


@dataclass
class Class:
    """``number`` sequences of equal content: (length, pieces of it) in order, and what is free."""

    number: int
    items: list[tuple[int, int]]
    room: int


@dataclass(frozen=True)
class Slot:
    """Pieces of ``length`` numbered ``first`` to ``last`` (not included) go, ``each`` at a time, to the
    sequences from ``sequence`` on, at ``offset``."""

    length: int
    first: int
    last: int
    each: int
    sequence: int
    offset: int


def grouped(counts: dict[int, int], groups: int = GROUPS) -> dict[int, list[tuple[int, int]]]:
    """Rounded size -> (length, pieces) of its group, falling; groups have equal numbers of pieces.

    Pieces of one length stay together, so that a group is larger or smaller by
    as much, and a length with a group's share or more is one of its own.
    """
    each = max(1, -(-sum(counts.values()) // groups))
    out: list[list[tuple[int, int]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        n = counts[length]
        if room <= 0 or n >= each:
            out.append([])
            room = each
        out[-1].append((length, n))
        room -= n
    return {members[0][0]: members for members in out}


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable configuration, sizes repeated at will."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    least = int(sizes.min())
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if c >= least:
            with_item = np.where(sizes <= c, best[np.maximum(c - sizes, 0)] + values, -1)
            i = int(with_item.argmax())
            if with_item[i] > best[c] + 1e-12:
                best[c], taken[c] = with_item[i], i
    out, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if taken[c] < 0:
            c -= 1
        else:
            out[taken[c]] += 1
            c -= int(sizes[taken[c]])
    return float(best[capacity]), out


def configurations(demand: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, size -> pieces): whole parts of an optimum of the linear program."""
    if not demand:
        return []
    sizes = np.array(list(demand))
    wanted = np.array(list(demand.values()), float)
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(STEPS):
        worth = np.linalg.solve(basis.T, np.ones(len(sizes)))
        value, column = _knapsack(sizes, np.maximum(worth, 0), capacity)
        if value <= 1 + 1e-9:
            break
        column = np.where(worth > 0, column, 0)
        used, change = np.linalg.solve(basis, wanted), np.linalg.solve(basis, column.astype(float))
        ratio = np.where(change > 1e-9, np.maximum(used, 0) / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    used = np.linalg.solve(basis, wanted)
    out, left = [], {s: n for s, n in demand.items()}
    for times, column in sorted(zip(used.tolist(), basis.T.tolist(), strict=True), key=lambda x: -x[0]):
        pieces = {int(s): int(n) for s, n in zip(sizes, column, strict=True) if n}
        whole = min([int(times + 1e-6), *(left[s] // n for s, n in pieces.items())])
        if whole > 0:
            out.append((whole, pieces))
            for s, n in pieces.items():
                left[s] -= whole * n
    return out


def _take(queue: list[tuple[int, int]], number: int) -> list[tuple[int, int]]:
    """The next ``number`` pieces of a group as (length, pieces)."""
    out = []
    while number:
        length, n = queue[0]
        part = min(n, number)
        out.append((length, part))
        number -= part
        if part == n:
            queue.pop(0)
        else:
            queue[0] = length, n - part
    return out


def substituted(groups: dict[int, list[tuple[int, int]]], plan: list[tuple[int, dict[int, int]]], capacity: int) -> tuple[list[Class], Counter]:
    """(the configurations with real lengths in the places of the groups' sizes, what was given back).

    The pieces are taken from ``groups``.
    """
    out, back = [], Counter()
    for times, pieces in plan:
        places = [_take(groups[s], times) for s, n in pieces.items() for _ in range(n)]
        ends = [np.cumsum([n for _, n in p]) for p in places]
        cuts = np.unique(np.concatenate([[0], *ends]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            content = Counter(p[int(np.searchsorted(e, a, "right"))][0] for p, e in zip(places, ends, strict=True))
            room = capacity - sum(x * n for x, n in content.items())
            if room and content.total() > 1:
                last = min(content)
                content -= Counter([last])
                room += last
                back[last] += b - a
            out.append(Class(b - a, sorted(content.items(), reverse=True), room))
    return out, back


def best_fit(classes: list[Class], counts: dict[int, int], capacity: int) -> list[Class]:
    """``classes`` with all pieces of ``counts`` added, longest first, each where the least room is left."""
    rooms: list[list[Class]] = [[] for _ in range(capacity + 1)]
    for c in classes:
        rooms[c.room].append(c)

    def add(c: Class, number: int, length: int, each: int) -> None:
        if number:
            new = Class(number, [*c.items, (length, each)] if each else c.items, c.room - length * each)
            rooms[new.room].append(new)

    for length in sorted(counts, reverse=True):
        left, room = counts[length], length
        while left:
            while room <= capacity and not rooms[room]:
                room += 1
            if room > capacity:
                c, each = Class(-(-left // (capacity // length)), [], capacity), capacity // length
            else:
                c, each = rooms[room].pop(), room // length
            full = min(c.number, left // each)
            add(c, full, length, each)
            left -= full * each
            if full < c.number:
                add(c, int(left > 0), length, left)
                add(c, c.number - full - (left > 0), length, 0)
                left = 0
    return [c for at in rooms for c in at]


def plan(counts: dict[int, int], capacity: int) -> list[Slot]:
    """Where the pieces of each length go. Lengths are from 1 to ``capacity``."""
    counts = {length: n for length, n in counts.items() if n}
    full = counts.pop(capacity, 0)
    groups = grouped({length: n for length, n in counts.items() if length > capacity * LARGE})
    demand = {size: sum(n for _, n in members) for size, members in groups.items()}
    classes, rest = substituted(groups, configurations(demand, capacity), capacity)
    rest.update({length: n for length, n in counts.items() if length <= capacity * LARGE})
    for members in groups.values():
        for length, n in members:
            rest[length] += n
    classes = [Class(full, [(capacity, 1)], 0)] * bool(full) + best_fit(classes, rest, capacity)
    slots, sequence, numbered = [], 0, Counter()
    for c in classes:
        offset = 0
        for length, each in c.items:
            first = numbered[length]
            numbered[length] += c.number * each
            slots.append(Slot(length, first, numbered[length], each, sequence, offset))
            offset += length * each
        sequence += c.number
    return slots
