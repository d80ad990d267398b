"""Suffix order by grouping Lyndon prefixes, in two linear sweeps.

Sweep 1 takes the groups of suffixes in descending order.  For each suffix of
the group it follows previous-smaller pointers to the nearest earlier suffix
of a lower group; those predecessors, by how many of the group point to them,
leave their groups for new ones just behind.  In the end every group holds
the suffixes with one Lyndon prefix, in the right order of groups.  Sweep 2
goes through the order upwards and emits, for each suffix, the suffixes whose
chain of pointers ends there into the next free place of their groups.  No
names are assigned anew and nothing recurses.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a sequence of integers whose last symbol is
    the smallest and occurs nowhere else."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    by_symbol = np.argsort(text, kind="stable")
    ordered = text[by_symbol]
    new = np.flatnonzero(np.diff(ordered, prepend=ordered[0] - 1))
    sizes = np.diff(np.append(new, n))
    starts = np.empty(n, np.int64)
    starts[by_symbol] = np.repeat(new, sizes)
    places = np.empty(n, np.int64)
    places[by_symbol] = np.arange(n)
    size_of = np.zeros(n, np.int64)
    size_of[new] = sizes
    order, place, group = by_symbol.tolist(), places.tolist(), starts.tolist()
    before = _group_lyndon_prefixes(order, place, group, size_of.tolist())
    return np.array(_emit(group, before, order[0]), np.int64)


def _group_lyndon_prefixes(order: list, place: list, group: list, size: list) -> list:
    """Sweep 1: regroups in place; returns the previous-smaller pointers."""
    before = [-1] * len(order)
    top = len(order) - 1
    while top > 0:
        start = group[order[top]]
        if start == top:  # a group of one, by far the most frequent
            s = order[top]
            p = s - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[s] = p
            if p >= 0:
                g = group[p]
                left = size[g] - 1
                if left:
                    _swap(order, place, p, g + left)
                    size[g] = left
                    group[p] = g + left
                    size[g + left] = 1
        else:
            _regroup(sorted(order[start:top + 1]), start, order, place, group, size, before)
        top = start - 1
    return before


def _swap(order: list, place: list, s: int, to: int) -> None:
    at, other = place[s], order[to]
    order[at], order[to] = other, s
    place[other], place[s] = at, to


def _regroup(members: list, start: int, order: list, place: list, group: list, size: list,
             before: list) -> None:
    by_count: dict[int, list] = {}
    last, count = -1, 0
    for s in members:  # in text order: their predecessors ascend
        p = s - 1
        while p >= 0 and group[p] >= start:
            p = before[p]
        before[s] = p
        if p == last:
            count += 1
        else:
            if last >= 0:
                by_count.setdefault(count, []).append(last)
            last, count = p, 1
    if last >= 0:
        by_count.setdefault(count, []).append(last)
    for count in sorted(by_count, reverse=True):
        leaving = by_count[count]
        for p in leaving:
            g = group[p]
            size[g] -= 1
            _swap(order, place, p, g + size[g])
        behind: dict[int, int] = {}
        for p in leaving:
            g = group[p]
            if g not in behind:
                behind[g] = g + size[g]
            g = behind[g]
            group[p] = g
            size[g] += 1


def _emit(group: list, before: list, first: int) -> list:
    """Sweep 2: the suffix order from the groups and pointers."""
    out = [-1] * len(group)
    free = list(range(len(group)))  # next free place of the group starting here
    done = [False] * len(group)
    out[0] = first
    done[first] = True
    free[0] = 1
    for i in range(len(out)):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            done[s] = True
            s = before[s]
    return out
