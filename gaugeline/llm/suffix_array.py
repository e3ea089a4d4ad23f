"""Suffix arrays by grouping, in linear time.

First the suffixes are grouped by their longest Lyndon prefix. Groups start with one
symbol and are taken in descending order. For every suffix of the group the nearest
earlier suffix of a smaller group is found along the pointers set so far; suffixes
that are pointed at grow their prefix by the group's, as often as they are pointed
at, and so move to new groups right above their old one. Then one pass over the
result, from the smallest suffix on, sends each suffix that ends where an ordered one
starts to the front of its group's free places. Nothing is renamed or solved anew.
"""

from __future__ import annotations

_OPEN = -2


def suffix_array(codes: list[int]) -> list[int]:
    """Starts of the suffixes in order. The last symbol must be smaller than all others."""
    size = len(codes)
    if not size:
        return []
    groups, ranked, before = _groups(codes)
    return _ordered(groups, ranked, before)


def _groups(codes: list[int]) -> tuple[list[int], list[tuple[int, int]], list[int]]:
    """The group of each suffix, (group, size) in descending order, and the pointers."""
    size = len(codes)
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(codes):
        by_symbol.setdefault(c, []).append(i)
    lists = [by_symbol[c] for c in sorted(by_symbol)]
    group = [0] * size
    for g, members in enumerate(lists):
        for i in members:
            group[i] = g
    below = list(range(-1, len(lists) - 1))
    above = [*range(1, len(lists)), -1]
    before = [_OPEN] * size
    ranked = []
    g = len(lists) - 1
    while g >= 0:
        members = [i for i in lists[g] if group[i] == g]
        if members:
            ranked.append((g, len(members)))
            # Members ascend, and so do the suffixes they point at.
            moved: dict[tuple[int, int], list[int]] = {}
            last, times = -1, 0
            for s in members:
                j = s - 1
                while j >= 0 and before[j] != _OPEN:
                    j = before[j]
                before[s] = j
                if j != last:
                    if times:
                        moved.setdefault((-times, group[last]), []).append(last)
                    last, times = j, 0
                if j >= 0:
                    times += 1
            if times:
                moved.setdefault((-times, group[last]), []).append(last)
            # The most often pointed at are placed first, so they end up highest.
            for key in sorted(moved) if len(moved) > 1 else moved:
                old, new = key[1], len(lists)
                lists.append(moved[key])
                for i in moved[key]:
                    group[i] = new
                up = above[old]
                below.append(old)
                above.append(up)
                above[old] = new
                if up >= 0:
                    below[up] = new
        lists[g] = []
        g = below[g]
    return group, ranked, before


def _ordered(group: list[int], ranked: list[tuple[int, int]], before: list[int]) -> list[int]:
    size = len(group)
    free: dict[int, int] = {}
    at = 0
    for g, count in reversed(ranked):
        free[g] = at
        at += count
    result = [0] * size
    placed = [False] * size
    result[0] = size - 1
    placed[size - 1] = True
    for i in range(size):
        s = result[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            k = free[g]
            result[k] = s
            free[g] = k + 1
            placed[s] = True
            s = before[s]
    return result
