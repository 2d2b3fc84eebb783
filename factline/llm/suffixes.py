"""Suffix arrays by induced sorting, and their permuted common prefixes.

Suffixes are classified as S (less than the next one) or L. The leftmost S suffixes (LMS) are
sorted by inducing the order of their substrings, naming these and sorting the names
recursively; from their order that of all suffixes is induced in one pass up (L) and one down
(S). A pass works on stretches: the entries from where it stands up to the first one still
missing are known to be complete, and all they induce is placed at once.
"""

from __future__ import annotations

import numpy as np


def _s_types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are less than the next one; the last symbol is the only least one."""
    n = len(text)
    rises = np.ones(n, np.int8)
    rises[:-1] = (text[1:] > text[:-1]).view(np.int8) - (text[1:] < text[:-1]).view(np.int8)
    place = np.where(rises != 0, np.arange(n, dtype=np.int32), np.int32(n - 1))
    return rises[np.minimum.accumulate(place[::-1])[::-1]] > 0


def _dealt(symbols: np.ndarray, pointer: np.ndarray, step: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by symbol, and the places in it from each bucket's pointer on, which moves along by `step`."""
    order = symbols.argsort(kind="stable")
    ranked = symbols[order]
    changes = (ranked[1:] != ranked[:-1]).nonzero()[0]
    begins = np.zeros(len(changes) + 1, np.int64)
    begins[1:] = changes + 1
    counts = np.empty(len(begins), np.int64)
    counts[:-1] = begins[1:] - begins[:-1]
    counts[-1] = len(order) - begins[-1]
    heads = ranked[begins]
    own = pointer[heads]
    pointer[heads] = own + step * counts
    return order, (own - step * begins).repeat(counts) + step * numbers[:len(order)]


def _induce(text, is_s, starts, ends, low_ends, lms) -> np.ndarray:
    """All suffixes from ordered LMS ones. low_ends: where the L part of each bucket ends."""
    n = len(text)
    is_l = ~is_s
    numbers = np.arange(n, dtype=np.int32)
    array = np.full(n, -1, np.int32)
    symbols = text[lms]
    order, places = _dealt(symbols, ends - np.bincount(symbols, minlength=len(ends)), 1, numbers)
    array[places] = lms[order]

    low = np.zeros(n + 1, np.int32)
    np.add.at(low, starts, 1)
    np.add.at(low, low_ends, -1)
    is_low = np.cumsum(low[:n]) > 0
    missing = is_low.copy()
    pointer = starts.copy()
    at, reach = 0, 256
    while at < n:
        stop = min(n, at + reach)
        gap = missing[at:stop]
        first = int(gap.argmax())
        if gap[first]:
            stop, reach = at + first, max(256, 2 * first)
        else:
            reach *= 2
        before = array[at:stop]
        before = before[before > 0] - 1
        before = before[is_l[before]]
        if len(before):
            order, places = _dealt(text[before], pointer, 1, numbers)
            array[places] = before[order]
            missing[places] = False
        at = stop

    array[~is_low] = -1
    array[0] = n - 1
    missing = ~is_low
    missing[0] = False
    pointer = ends - 1
    at, reach = n - 1, 256
    while at >= 0:
        stop = max(-1, at - reach)
        gap = missing[stop + 1:at + 1][::-1]
        first = int(gap.argmax())
        if gap[first]:
            stop, reach = at - first, max(256, 2 * first)
        else:
            reach *= 2
        before = array[stop + 1:at + 1][::-1]
        before = before[before > 0] - 1
        before = before[is_s[before]]
        if len(before):
            order, places = _dealt(text[before], pointer, -1, numbers)
            array[places] = before[order]
            missing[places] = False
        at = stop
    return array


def _names(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the LMS substrings, given in their order; equal ones share a rank."""
    n = len(text)
    following = np.zeros(n + 1, np.int32)
    following[lms[:-1]] = lms[1:]
    following[lms[-1]] = n - 1
    size = following[ordered] - ordered + 1
    differs = np.ones(len(ordered), bool)
    active = np.flatnonzero(size[1:] == size[:-1]) + 1
    differs[active] = False
    offset = 0
    while len(active):
        active = active[size[active] > offset]
        unequal = text[ordered[active] + offset] != text[ordered[active - 1] + offset]
        differs[active[unequal]] = True
        active = active[~unequal]
        offset += 1
    return np.cumsum(differs) - 1


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array of fewer than 2**31 integers whose last one is 0 and occurs once."""
    n = len(text)
    if n <= 2:
        return np.arange(n - 1, -1, -1, dtype=np.int32)
    text = text.astype(np.int32)
    is_s = _s_types(text)
    sizes = np.bincount(text)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    low_ends = starts + np.bincount(text[~is_s], minlength=len(sizes))
    first = is_s.copy()
    first[0] = False
    first[1:] &= ~is_s[:-1]
    lms = np.flatnonzero(first).astype(np.int32)
    if len(sizes) <= 1 << 16:
        text = text.astype(np.uint16)  # sorted by counting
    array = _induce(text, is_s, starts, ends, low_ends, lms)
    ordered = array[first[array]]
    ranks = _names(text, lms, ordered)
    if ranks[-1] + 1 < len(lms):
        name = np.zeros(n, np.int32)
        name[ordered] = ranks
        ordered = lms[suffix_array(name[lms])]
    return _induce(text, is_s, starts, ends, low_ends, ordered)


def common_prefixes(eights: np.ndarray, array: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
    """For each of the places in text order, the bytes its suffix shares with the one before it in the array, up to `most`.

    `eights` holds eight bytes at each byte, zeros after the end.
    """
    before = np.full(len(array), -1, np.int32)
    before[array[1:]] = array[:-1]
    shared = np.zeros(len(places), np.int32)
    active = np.flatnonzero(before[places] >= 0)
    offset = 0
    while len(active) and offset < most:
        here, there = places[active] + offset, before[places[active]] + offset
        inside = np.maximum(here, there) < len(eights)
        active, here, there = active[inside], here[inside], there[inside]
        unlike = eights[here] ^ eights[there]
        ends = unlike != 0
        lowest = unlike[ends] & (~unlike[ends] + np.uint64(1))
        shared[active[ends]] = offset + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) // 8
        active = active[~ends]
        offset += 8
        shared[active] = offset
    return np.minimum(shared, most)
