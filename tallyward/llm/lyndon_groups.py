"""Suffix arrays by linear grouping.

Every suffix belongs to a group of suffixes that start with one string. At first that string is the first symbol; in the
end it is the suffix's longest Lyndon prefix. Groups are taken from the highest to the lowest. All that lies between a
suffix and the nearest lower suffix before it (its previous smaller one) has been taken already, so the string of that
lower suffix ends where the taken one begins, and grows by it: among the lower suffixes of one group those followed by
longer runs of the taken group are higher and leave their group upwards. A group's name is the place where it starts,
which never changes for what stays in it, so nothing is renamed round by round.

The second pass walks the finished order from the empty suffix up: the suffixes whose Lyndon prefix ends where the walked
suffix starts are found along the pointers to previous smaller ones, and each takes the next free place of its group.

Both passes are linear in time and memory. An empty text has an empty suffix array. A suffix that is a prefix of another
comes first.
"""

from __future__ import annotations

import numpy as np


def lyndon_groups(text: np.ndarray) -> tuple[list[int], list[int]]:
    """Per suffix the first place of its group in suffix order, and its previous smaller suffix (-1 without one)."""
    n = len(text)
    by_symbol = np.argsort(text, kind="stable")
    first = np.searchsorted(text[by_symbol], text)
    counts = np.bincount(first, minlength=n + 1)
    order, group, size = by_symbol.tolist(), [*first.tolist(), -1, -1], counts.tolist()
    place = np.empty(n, np.int64)
    place[by_symbol] = np.arange(n)
    place = place.tolist()
    # Suffixes not taken yet, linked in text order. Index n ends the list; n + 1, also reached as -1, begins it.
    left, right = [n + 1, *range(n), n], [*range(1, n + 1), n, 0]
    smaller = [-1] * n
    end = n
    while end:
        taken = group[order[end - 1]]
        longer: dict[int, list[int]] = {}
        for head in order[taken:end]:
            low = left[head]
            if group[low] == taken:
                continue  # inside a run, which is taken at its head
            run, at = 0, head
            while group[at] == taken:
                smaller[at] = low
                run += 1
                at = right[at]
            right[low], left[at] = at, low
            if low <= n:
                longer.setdefault(run, []).append(low)
        for run in sorted(longer, reverse=True):
            risen: dict[int, int] = {}
            for low in longer[run]:
                old = group[low]
                last = old + size[old] - 1
                size[old] -= 1
                at, other = place[low], order[last]
                order[at], place[other] = other, at
                order[last], place[low] = low, last
                risen[old] = risen.get(old, 0) + 1
            for old, many in risen.items():
                new = old + size[old]
                size[new] = many
                if new != old:
                    for k in range(new, new + many):
                        group[order[k]] = new
        end = taken
    return group[:n], [-1 if low > n else low for low in smaller]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text`` (an array of symbols) in ascending order."""
    n = len(text)
    group, smaller = lyndon_groups(np.asarray(text))
    free, order, placed = list(range(n)), [-1] * n, bytearray(n)
    walked = n
    for k in range(-1, n):
        if k >= 0:
            walked = order[k]
        at = walked - 1
        while at >= 0 and not placed[at]:
            start = group[at]
            order[free[start]] = at
            free[start] += 1
            placed[at] = 1
            at = smaller[at]
    return np.array(order, np.int64)
