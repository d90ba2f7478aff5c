"""Suffix arrays by linear grouping, without recursion or renaming.

A suffix's group is its Lyndon prefix: the longest prefix that is smaller than all its own
proper suffixes. All suffixes start in a group per symbol. Groups are processed in
descending order. Each run of members that follow each other looks left, over pointers to
previous smaller suffixes, for the nearest suffix whose group is still to come: that one's
prefix ends where the run begins and takes it in, so it moves to a new group right above its
old one, the higher the longer the run. When a group has been processed, its prefixes are
final and end at the next smaller suffix.

The second phase emits suffixes in ascending order: behind a suffix that has its place, the
suffixes whose prefix ends there, found by the same pointers, are next in their groups.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of all suffixes, in ascending order."""
    n = len(symbols)
    at: dict[int, list[int]] = {}
    for i in range(n - 1, -1, -1):
        at.setdefault(symbols[i], []).append(i)
    order = sorted(at)
    number = {c: g for g, c in enumerate(order)}
    group = [number[c] for c in symbols]
    members = [at[c] for c in order]  # positions descending; some have moved on
    length = [1] * len(order)
    below = list(range(-1, len(order) - 1))
    above = [*range(1, len(order)), -1]
    lowest = 0

    prev = [-1] * n
    done = bytearray(n)
    g = len(order) - 1
    while g >= 0:
        own = members[g] = [i for i in members[g] if group[i] == g]
        size = length[g]
        runs: dict[int, int] = {}
        moves: dict[int, dict[int, list[int]]] = {}
        for i in own:
            times = runs.get(i, 0) + 1
            j = i - 1
            while j >= 0 and done[j]:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                old = group[j]
                if old == g:
                    runs[j] = times
                else:
                    by_times = moves.get(old)
                    if by_times is None:
                        moves[old] = {times: [j]}
                    elif times in by_times:
                        by_times[times].append(j)
                    else:
                        by_times[times] = [j]
        if runs:
            for i in reversed(own):
                j = prev[i]
                if j >= 0 and group[j] == g:
                    prev[i] = prev[j]
        for i in own:
            done[i] = 1
        for old, by_times in moves.items():
            for times in sorted(by_times, reverse=True) if len(by_times) > 1 else by_times:
                new = len(members)
                moved = by_times[times]
                for j in moved:
                    group[j] = new
                members.append(moved)
                length.append(length[old] + times * size)
                up = above[old]
                below.append(old)
                above.append(up)
                above[old] = new
                if up >= 0:
                    below[up] = new
        g = below[g]

    heads, g, total = [0] * len(members), lowest, 0
    while g >= 0 and n:
        heads[g] = total
        total += len(members[g])
        g = above[g]
    ends = [i + length[k] for i, k in enumerate(group)]
    out = [0] * n
    t, i = n, -1
    while i < n:
        if i >= 0:
            t = out[i]
        s = t - 1
        while s >= 0 and ends[s] == t:
            k = group[s]
            out[heads[k]] = s
            heads[k] += 1
            s = prev[s]
        i += 1
    return out
