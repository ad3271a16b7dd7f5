"""Suffix arrays of many short texts at once, by linear grouping.

Suffixes are grouped by their Lyndon prefix.  Groups are worked through from the
highest to the lowest: every suffix of a group points to the previous suffix in a lower
group, and what is pointed to moves into a group just above its own, the more often the
higher.  Afterwards each group's order is emitted from left to right along the same
pointers; nothing is renamed and nothing recurses.  All problems of a batch take their
steps side by side, as numpy operations over the groups that are on top in each.
"""

from __future__ import annotations

import numpy as np


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``start .. start + size`` of every range, one after the other."""
    first = np.cumsum(sizes) - sizes
    return np.repeat(starts - first, sizes) + np.arange(sizes.sum())


def _grouped(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions by group, every position's group, and its previous-smaller pointer.

    A group is named by where it starts in the first array.  Separators, symbol 0, are
    groups of their own, the lowest, in order of position.
    """
    n = len(symbols)
    problem = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = problem * 257 + symbols
    order = np.argsort(key, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    ordered = key[order]
    fresh = np.ones(n, bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]) | (symbols[order[1:]] == 0)
    starts = np.nonzero(fresh)[0]
    stop = np.zeros(n + 1, np.int64)
    stop[starts] = np.append(starts[1:], n)
    group = np.empty(n, np.int64)
    group[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    lowest = bounds[:-1] + np.bincount(problem[symbols == 0], minlength=len(bounds) - 1)
    previous = np.arange(n) - 1
    moving = np.zeros(n, bool)
    top, active = bounds[1:].copy(), np.nonzero(bounds[1:] > lowest)[0]
    while len(active):
        end = top[active]
        start = group[order[end - 1]]
        members = order[_ragged(start, end - start)]
        floor = np.repeat(start, end - start)
        pointed = previous[members]
        high = np.nonzero(group[pointed] >= floor)[0]
        while len(high):
            pointed[high] = previous[pointed[high]]
            previous[members[high]] = pointed[high]
            high = high[group[pointed[high]] >= floor[high]]
        previous[members] = pointed
        top[active] = start
        active = active[start > lowest[active]]
        pointed = pointed[symbols[pointed] != 0]
        if not len(pointed):
            continue
        moved, times = np.unique(pointed, return_counts=True)
        rank = np.lexsort((times, group[moved]))
        moved, times = moved[rank], times[rank]
        home = group[moved]
        new = np.ones(len(moved), bool)
        new[1:] = home[1:] != home[:-1]
        first = np.nonzero(new)[0]
        count = np.diff(np.append(first, len(moved)))
        tail = np.repeat(stop[home[first]] - count, count)
        target = tail + np.arange(len(moved)) - np.repeat(first, count)
        # What stands in the tail of a group and stays changes places with what moves.
        moving[moved] = True
        there = order[target]
        staying = there[~moving[there]]
        holes = place[moved]
        holes = holes[holes < tail]
        order[holes], place[staying] = staying, holes
        order[target], place[moved] = moved, target
        moving[moved] = False
        stop[home[first]] = tail[first]
        new[1:] |= times[1:] != times[:-1]
        first = np.nonzero(new)[0]
        count = np.diff(np.append(first, len(moved)))
        group[moved] = np.repeat(target[first], count)
        stop[target[first]] = target[first] + count
    return order, group, previous


def suffix_arrays(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The positions of every problem in the order of their suffixes.

    ``symbols`` are the problems one after the other, cut by ``bounds``; symbol 0
    separates texts and stands first and last in every problem.  Separators compare by
    position.  The problems' parts of the result lie where the problems do.
    """
    order, group, previous = _grouped(symbols, bounds)
    separator = symbols == 0
    done = separator.copy()
    free = np.arange(len(symbols))
    result = np.where(separator[order], order, -1)
    begin, size = bounds[:-1], np.diff(bounds)
    active = np.argsort(-size, kind="stable")
    begin, size = begin[active], size[active]
    for step in range(int(size[0]) if len(size) else 0):
        running = int(np.searchsorted(-size, -step, side="left"))
        at = result[begin[:running] + step] - 1
        at = at[at >= begin[:running]]
        at = at[~done[at]]
        while len(at):
            slot = free[group[at]]
            result[slot] = at
            free[group[at]] = slot + 1
            done[at] = True
            at = previous[at]
            at = at[~done[at]]
    return result
