"""Suffix order of several short texts by prefix doubling."""

from __future__ import annotations

import numpy as np


def suffix_ranks(units: np.ndarray, off: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix order, and (width, rank) levels: equal ranks at a width mean equal prefixes of that width.

    Suffixes end with their text; order holds to at least ``depth`` units, then ties by position.  No level is
    wider than the one at which all ranks differ."""
    n = len(units)
    place = np.arange(n)
    left = np.repeat(off[1:], np.diff(off)) - place
    if units.dtype == np.uint8:
        width = 7  # seven bytes, nine bits each, zero past the end
        key = np.zeros(n, np.int64)
        for j in range(width):
            unit = np.zeros(n, np.int64)
            unit[:max(n - j, 0)] = units[j:].astype(np.int64) + 1
            unit[left <= j] = 0
            key = (key << 9) | unit
        levels = [(w, key >> 9 * (width - w)) for w in (1, 2, 4)]
    else:
        width = 1
        key = np.unique(units, return_inverse=True)[1].astype(np.int64) + 1
        levels = []
    order = np.argsort(key)
    ordered = key[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    levels.append((width, rank.astype(np.int32)))
    slots = _shared(new, place)
    while width < depth and len(slots):
        # Only suffixes that share their rank are put in order again, inside the places that they hold together.
        at = order[slots]
        follow = np.zeros(len(at), np.int64)
        more = left[at] > width
        follow[more] = rank[at[more] + width] + 1
        key = (rank[at] << 32) | follow
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[slots] = at
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        rank[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        width *= 2
        levels.append((width, rank.astype(np.int32)))
        slots = slots[_shared(new, np.arange(len(at)))]
    if len(slots):
        at = order[slots]
        order[slots] = at[np.argsort((rank[at] << 32) | at)]
    return order, levels


def _shared(new: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of sorted items, ``new`` where a class begins, the places of those that are not alone in their class."""
    return place[~(new & np.append(new[1:], True))]


def common_prefixes(a: np.ndarray, b: np.ndarray, off: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, from wide levels to narrow ones.

    Where both texts end with it the figure may pass their ends."""
    end = np.repeat(off[1:], np.diff(off))
    a_end, b_end, a, b = end[a], end[b], a.copy(), b.copy()
    lcp = np.zeros(len(a), np.int64)
    todo = list(levels)
    while todo:
        width, rank = todo[-1]
        top = len(rank) - 1
        same = (a < a_end) & (b < b_end) & (rank[np.minimum(a, top)] == rank[np.minimum(b, top)])
        step = np.where(same, width, 0)
        lcp += step
        a += step
        b += step
        if len(todo) < len(levels) or not same.any():  # the widest level steps as often as it can
            todo.pop()
    return lcp
