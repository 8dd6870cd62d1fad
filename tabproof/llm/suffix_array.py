"""Suffix arrays by linear grouping.

Suffixes are grouped by their Lyndon prefix: the longest prefix that is smaller than all
its own suffixes. Groups start as the suffixes of one first symbol and are processed from
the highest down. Each suffix of the group at hand points to the nearest suffix on its left
in a lower group, and suffixes pointed at by that group move, by the number of pointers, to
new groups right above their old ones. After that, one pass over the emerging array places
every suffix: whoever is in place puts its left neighbour, and that one's pointer chain,
at the front of their groups. No substring is renamed and nothing is solved recursively.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of a sequence of integers, in ascending order.

    A suffix that is a prefix of another one comes first. An empty sequence has none.
    """
    if not len(symbols):
        return np.empty(0, np.int64)
    # The end mark is a symbol below all others.
    _, text = np.unique(symbols, return_inverse=True)
    text = np.concatenate([text + 1, [0]])
    group, previous = _lyndon_groups(text)
    return np.array(_emit(group, previous)[1:], np.int64)


def _lyndon_groups(text: np.ndarray) -> tuple[list[int], list[int]]:
    """Group of each suffix, named by its first place in the array, and its pointer."""
    size = len(text)
    by_symbol = np.argsort(text, kind="stable")
    starts = np.searchsorted(text[by_symbol], text)
    order: list[int] = by_symbol.tolist()
    place = np.empty(size, np.int64)
    place[by_symbol] = np.arange(size)
    where: list[int] = place.tolist()
    group: list[int] = starts.tolist()
    counts = np.bincount(starts, minlength=size)
    end: list[int] = (np.arange(size) + counts).tolist()
    previous = [-1] * size

    def lift(moved: list[int]) -> None:
        """Move suffixes to new groups right above the ones they are in."""
        tops: dict[int, int] = {}
        for j in moved:
            g = group[j]
            if g not in tops:
                tops[g] = end[g]
            last = end[g] - 1
            other, at = order[last], where[j]
            order[at], order[last] = other, j
            where[other], where[j] = at, last
            end[g] = last
        for g, top in tops.items():
            new = end[g]
            if new != g:
                for at in range(new, top):
                    group[order[at]] = new
            end[new] = top

    high = size
    while high > 0:
        start = group[order[high - 1]]
        if high - start == 1:
            i = order[start]
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                g = group[j]
                last = end[g] - 1
                if last != g:
                    other, at = order[last], where[j]
                    order[at], order[last] = other, j
                    where[other], where[j] = at, last
                    end[g] = group[j] = last
                    end[last] = last + 1
            high = start
            continue
        pointers: dict[int, int] = {}
        for i in sorted(order[start:high]):
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                pointers[j] = pointers.get(j, 0) + 1
        most = max(pointers.values(), default=0)
        if most == 1:
            lift([*pointers])
        else:
            by_number: dict[int, list[int]] = {}
            for j, n in pointers.items():
                by_number.setdefault(n, []).append(j)
            for n in sorted(by_number, reverse=True):
                lift(by_number[n])
        high = start
    return group, previous


def _emit(group: list[int], previous: list[int]) -> list[int]:
    """The suffix array from the groups and pointers."""
    size = len(group)
    array = [-1] * size
    free = list(range(size))
    placed = bytearray(size)
    array[0] = size - 1
    placed[size - 1] = 1
    for i in range(size):
        j = array[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            at = free[g]
            array[at] = j
            free[g] = at + 1
            placed[j] = 1
            j = previous[j]
    return array


def sorted_rows(rows: np.ndarray) -> np.ndarray:
    """Order of the rows of a matrix of bytes (width a multiple of 8), by a suffix array.

    Rows are laid end to end as words of eight bytes with a mark below all words after
    each; the suffixes that start at rows stand in the wanted order.
    """
    count, width = rows.shape
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    text = np.zeros((count, width // 8 + 1), np.int64)
    _, ranks = np.unique(words, return_inverse=True)
    text[:, :-1] = ranks.reshape(words.shape) + 1
    array = suffix_array(text.reshape(-1))
    starts = array[array % (width // 8 + 1) == 0]
    return starts // (width // 8 + 1)
