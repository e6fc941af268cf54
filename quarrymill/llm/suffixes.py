"""Suffix arrays of integer sequences in numpy, for the texts of one shard."""

from __future__ import annotations

import numpy as np


def refine(first: np.ndarray, ends: np.ndarray, keep: bool = False, length: int = 1) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Larsson-Sadakane refinement: (suffix array, ranks, ranks by length if keep).

    first: integers whose order sorts the suffixes by their first `length` symbols; ends: where the sequence
    of each position ends; stops are symbols below all others, and each its own. Ranks are group
    numbers: the place in the suffix array of the group's first member. Each round sorts, within
    the groups that still have several members, by the rank `length` further on, so lengths double
    and finished suffixes are not touched again.
    """
    n = len(first)
    sa = np.argsort(first, kind="stable")
    ranks = np.zeros(n + 1, np.int64)
    live, group = _regroup(sa, first[sa], np.zeros(n, np.int64), ranks, np.arange(n))
    kept = []
    while True:
        if keep:
            kept.append((length, ranks.copy()))
        if not len(live):
            return sa, ranks[:n], kept
        at = sa[live] + length
        inside = at < ends[sa[live]]
        key = group * np.int64(2 * n + 2) + np.where(inside, n + 1 + ranks[np.where(inside, at, 0)], ends[sa[live]])
        order = np.argsort(key, kind="stable")
        sa[live] = sa[live[order]]
        live, group = _regroup(sa, key[order], group, ranks, live)
        length *= 2


def _regroup(sa: np.ndarray, keys: np.ndarray, group: np.ndarray, ranks: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number the groups of equal keys at the places `live`; give back the places of groups that go on."""
    n = len(live)
    if not n:
        return live, group
    new = np.ones(n, bool)
    new[1:] = keys[1:] != keys[:-1]
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, n))
    number = np.repeat(live[heads], sizes)
    ranks[sa[live]] = number
    more = np.repeat(sizes > 1, sizes)
    return live[more], number[more]


def common_by_ranks(kept: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, from the ranks of each doubled length."""
    common = np.zeros(len(a), np.int64)
    for length, ranks in reversed(kept):
        x, y = a + common, b + common
        inside = (x + length <= ends[a]) & (y + length <= ends[b])
        common[inside] += np.where(ranks[x[inside]] == ranks[y[inside]], length, 0)
    return common


def kasai(symbols: np.ndarray, sa: np.ndarray, ranks: np.ndarray, ends: np.ndarray, most: int, lane: int = 64) -> np.ndarray:
    """Kasai's common prefixes: of each place of the suffix array with the place before it, up to `most`.

    In text order the common prefix shrinks by one at most from one suffix to the next, so what is
    known is not compared again. Lanes of `lane` positions walk side by side.
    """
    n = len(symbols)
    place = np.empty(n, np.int64)
    place[sa] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    starts = np.arange(0, n, lane)
    h = np.zeros(len(starts), np.int64)
    for t in range(lane):
        i = starts + t
        if i[-1] >= n:
            i = i[:-1]
            h = h[: len(i)]
            if not len(i):
                break
            starts = starts[: len(i)]
        p = place[i]
        j = sa[np.maximum(p - 1, 0)]
        has = p > 0
        room = np.where(has, np.minimum(np.minimum(ends[i] - i, ends[j] - j), most), 0)
        h = np.minimum(np.maximum(h - 1, 0), room)
        active = np.flatnonzero(h < room)
        while len(active):
            same = symbols[i[active] + h[active]] == symbols[j[active] + h[active]]
            active = active[same]
            h[active] += 1
            active = active[h[active] < room[active]]
        lcp[p] = h
    return lcp
