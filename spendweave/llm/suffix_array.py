"""Suffix array by linear grouping, without recursive renaming.

First phase: suffixes are grouped by their first symbol, and the groups are taken in
descending order. Each suffix of a group points to the nearest suffix before it that lies in
a smaller group (its previous smaller one); suffixes pointed to equally often are moved out
of their group into a new one right behind it. In the end a group holds the suffixes that
share their longest Lyndon prefix. Second phase: going through the array in ascending order,
each suffix puts those that it follows at the front of their groups, along the pointers.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``symbols`` in lexicographic order. The last symbol
    must be smaller than every other one."""
    n = len(symbols)
    if n < 2:
        return np.arange(n)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    sizes = np.diff(np.append(starts, n))
    group_of = np.empty(n, "int64")
    group_of[order] = np.repeat(starts, sizes)
    place_of = np.empty(n, "int64")
    place_of[order] = np.arange(n)
    end_of = np.zeros(n, "int64")
    end_of[starts] = starts + sizes
    at, place, group, end = order.tolist(), place_of.tolist(), group_of.tolist(), end_of.tolist()
    smaller = [-1] * n

    def move(chosen: list[int]) -> None:
        """Suffixes of one group into a new group right behind what remains of it."""
        old = group[chosen[0]]
        stop = end[old]
        new = stop - len(chosen)
        if new == old:
            return
        to = stop
        for s in chosen:
            to -= 1
            here, other = place[s], at[to]
            at[here], place[other] = other, here
            at[to], place[s] = s, to
            group[s] = new
        end[old], end[new] = new, stop

    stop = n
    while stop > 0:
        begin = group[at[stop - 1]]
        if stop - begin == 1:                      # one suffix
            p = at[begin]
            s = p
            p -= 1
            while p >= 0 and group[p] >= begin:
                p = smaller[p]
            smaller[s] = p
            if p >= 0 and end[group[p]] - group[p] > 1:
                move([p])
        else:
            pointed: dict[int, int] = {}
            for s in sorted(at[begin:stop]):
                p = s - 1
                while p >= 0 and group[p] >= begin:
                    p = smaller[p]
                smaller[s] = p
                if p >= 0:
                    pointed[p] = pointed.get(p, 0) + 1
            levels: dict[int, dict[int, list[int]]] = {}
            for p, times in pointed.items():
                levels.setdefault(times, {}).setdefault(group[p], []).append(p)
            for times in sorted(levels, reverse=True):
                for chosen in levels[times].values():
                    move(chosen)
        stop = begin

    free, placed = list(range(n)), bytearray(n)    # by group: its first open place
    result = [0] * n
    result[0] = n - 1
    placed[n - 1] = 1
    for k in range(n):
        s = result[k] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            result[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = smaller[s]
    return np.array(result)
