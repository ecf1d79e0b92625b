"""Suffix arrays over many word sequences at once, by prefix doubling in numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(words: np.ndarray, group: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of all suffixes, and their ranks by the first 1, 2, 4, ... words.

    `words` holds sequences end to end; `end[i]` is where the sequence of
    position i ends.  Suffixes sort by `group` first.  Equal suffixes of two
    sequences keep the order of their positions.  Only suffixes that are not yet
    told apart are sorted again.
    """
    n = len(words)
    if n == 0:
        return np.empty(0, np.int64), []
    key = group.astype(np.int64) * (int(words.max()) + 1) + words
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.ones(n, bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    slots = np.arange(n)
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, slots, 0))
    levels = [rank]
    longest = int((end - np.arange(n)).max())
    slots = slots[shared(new)]
    step = 1
    while len(slots) and step < longest:
        at = order[slots]
        then = at + step
        second = np.where(then < end[at], rank[np.minimum(then, n - 1)], -1)
        first = rank[at]
        sort = np.argsort(first.astype(np.int64) * (n + 1) + second + 1, kind="stable")  # runs of equal `first`
        at, first, second = at[sort], first[sort], second[sort]
        order[slots] = at
        new = np.ones(len(at), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        rank = rank.copy()
        rank[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        levels.append(rank)
        slots = slots[shared(new)]
        step *= 2
    at = order[slots]  # equal to their ends
    order[slots] = at[np.argsort(rank[at].astype(np.int64) * n + at)]
    return order, levels


def shared(new: np.ndarray) -> np.ndarray:
    """Where a run has more than one member; `new` marks the beginnings of runs."""
    last = np.append(new[1:], True)
    return ~(new & last)


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of suffixes a and b, whose groups are equal."""
    length, limit = np.zeros(len(a), np.int64), len(end) - 1
    for k in reversed(range(len(levels))):
        x, y = a + length, b + length
        inside = (x < end[a]) & (y < end[b])
        same = inside & (levels[k][np.minimum(x, limit)] == levels[k][np.minimum(y, limit)])
        length += same.astype(np.int64) << k
    return length


def repeat_lengths(words: np.ndarray, group: np.ndarray, end: np.ndarray, least: int) -> np.ndarray:
    """Longest match of each suffix with another one of its group; 0 if below `least`.

    Runs of neighbours whose common prefix stays at or above a length are the
    LCP intervals; a suffix's longest repeat is the deeper of its two neighbours.
    """
    found = np.zeros(len(words), np.int64)
    order, levels = suffix_array(words, group, end)
    k = least.bit_length() - 1
    if len(levels) <= k:
        return found
    a, b = order[:-1], order[1:]
    near = levels[k][a] == levels[k][b]
    a, b = a[near], b[near]
    lcp = common_prefix(levels, a, b, end)
    a, b, lcp = a[lcp >= least], b[lcp >= least], lcp[lcp >= least]
    found[b] = lcp
    np.maximum.at(found, a, lcp)
    return found
