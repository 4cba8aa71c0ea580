"""Suffix order of a shard by induced sorting, and its permuted common prefixes.

Suffixes are classified as falling (L) or rising (S). The leftmost rising ones
(LMS) are sorted by the substrings between them, recursively where substrings
repeat; from them the order of all others is induced in two linear scans. A
scan takes the suffixes of one first letter at a time, as arrays.
"""

from __future__ import annotations

import numpy as np

#: A reduced text with more letters than this is ordered by doubling ranks, as a scan per letter would not pay.
LETTERS = 1024


def rising(text: np.ndarray) -> np.ndarray:
    """Per position, whether its suffix is smaller than the next one; the last is not."""
    differs = np.r_[text[1:] != text[:-1], True]
    up = np.r_[text[:-1] < text[1:], False]
    # Within a run of one letter the type is that of the run's end.
    ends = np.flatnonzero(differs)
    return np.repeat(up[ends], np.diff(np.r_[-1, ends]))


def _induce(text: np.ndarray, up: np.ndarray, lms: np.ndarray, letters: int) -> np.ndarray:
    """The suffix order that follows from the LMS suffixes in the order given."""
    n = len(text)
    size = np.bincount(text, minlength=letters)
    end = np.cumsum(size)
    start = end - size
    order = np.full(n, -1, np.int64)
    placed = text[lms]
    by_letter = np.argsort(placed, kind="stable")
    lms = lms[by_letter]
    lms_count = np.bincount(placed, minlength=letters)
    lms_end = np.cumsum(lms_count)

    def put(found: np.ndarray, pointer: np.ndarray, step: int) -> None:
        """Append in scan order to the letters' lists, which grow upwards or downwards."""
        letter = text[found]
        sort = np.argsort(letter, kind="stable")
        found, letter = found[sort], letter[sort]
        count = np.bincount(letter, minlength=letters)
        inside = np.arange(len(found)) - np.repeat(np.cumsum(count) - count, count)
        order[pointer[letter] + step * inside] = found
        pointer += step * count

    # Falling suffixes, from the smallest letter up: a letter's list grows while it is read.
    head = start.copy()
    last = np.array([n - 1])
    put(last[~up[last]], head, 1)
    for c in np.flatnonzero(size):
        read = start[c]
        while read < head[c]:
            part, read = order[read : head[c]], head[c]
            before = part[part > 0] - 1
            before = before[~up[before]]
            if len(before):
                put(before, head, 1)
        part = lms[lms_end[c] - lms_count[c] : lms_end[c]]
        before = part[part > 0] - 1
        if len(before):
            put(before, head, 1)
    # Rising suffixes, from the largest letter down.
    tail = end - 1
    for c in np.flatnonzero(size)[::-1]:
        read = end[c] - 1
        while read > tail[c]:
            part, read = order[tail[c] + 1 : read + 1][::-1], tail[c]
            before = part[part > 0] - 1
            before = before[up[before]]
            if len(before):
                put(before, tail, -1)
        part = order[start[c] : head[c]][::-1]
        before = part[part > 0] - 1
        before = before[up[before]]
        if len(before):
            put(before, tail, -1)
    return order


def _by_doubling(text: np.ndarray) -> np.ndarray:
    """Suffix order from ranks of prefixes of doubled length; only suffixes still tied are sorted again."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    # A rank is the first place of its group.
    first = np.flatnonzero(np.r_[True, np.diff(rank[order]) != 0])
    rank[order] = np.repeat(first, np.diff(np.r_[first, n]))
    length = 1
    while True:
        group = rank[order]
        tied = np.flatnonzero(np.r_[group[1:] == group[:-1], False] | np.r_[False, group[1:] == group[:-1]])
        if not len(tied):
            return order
        suffix = order[tied]
        after = suffix + length
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        # Both in one number; what is equal in both stays tied, in any order.
        sort = np.argsort(group[tied] * (n + 1) + second + 1)
        order[tied] = suffix[sort]
        a, b = group[tied], second[sort]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        # tied places of a group are consecutive, so a place counts from its group's first.
        rank[order[tied]] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        length *= 2


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of whole numbers from 0, from the smallest; an end is smaller than any letter."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    letters = int(text.max()) + 1
    if letters > LETTERS:
        return _by_doubling(text)
    # Narrow letters are sorted by counting.
    text = text.astype(np.int16)
    up = rising(text)
    lms = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    order = _induce(text, up, lms, letters)
    if len(lms) < 2:
        return order
    # The LMS substrings are in order now: number them, equal ones alike.
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sorted_lms = order[is_lms[order]]
    length = np.zeros(n, np.int64)
    length[lms] = np.diff(np.r_[lms, n - 1]) + 1
    a, b = sorted_lms[:-1], sorted_lms[1:]
    same = length[a] == length[b]
    # The last substring runs into the text's end and equals no other.
    same &= (a != lms[-1]) & (b != lms[-1])
    pairs = np.flatnonzero(same)
    offset = 0
    while len(pairs):
        pairs = pairs[offset < length[a[pairs]]]
        equal = text[a[pairs] + offset] == text[b[pairs] + offset]
        same[pairs[~equal]] = False
        pairs = pairs[equal]
        offset += 1
    name = np.zeros(n, np.int64)
    name[sorted_lms] = np.cumsum(np.r_[0, ~same])
    reduced = name[lms]
    if reduced.max() + 1 < len(lms):
        lms = lms[suffix_order(reduced)]
    else:
        lms = sorted_lms
    return _induce(text, up, lms, letters)


def packed(text: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Per position the letters from it on in one number, the first one highest; how many, and the bits of each.

    Past the end stand zeros.
    """
    bits = max(1, int(text.max()).bit_length())
    each = 63 // bits
    padded = np.r_[text.astype(np.int64), np.zeros(each, np.int64)]
    words = np.zeros(len(text), np.int64)
    for i in range(each):
        words <<= bits
        words |= padded[i : i + len(text)]
    return words, each, bits


def permuted_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Per position, how many letters (up to ``most``) its suffix shares with the one before it in order.

    Taken in text order, a value is at most one less than the one before. So
    every sixteenth value is compared from the start, and the others in
    between go on from what is known, several letters at a time.
    """
    n = len(text)
    shared = np.zeros(n, np.int64)
    if not n:
        return shared
    words, each, bits = packed(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    stride = max(1, min(most, 16))
    for lane in range(stride):
        at = np.arange(lane, n, stride)
        known = np.maximum(shared[at - 1] - 1, 0) if lane else np.zeros(len(at), np.int64)
        other = before[at]
        # Nothing is shared past an end, or with nothing.
        limit = np.where(other < 0, 0, np.minimum(n - np.maximum(at, other), most))
        live = np.flatnonzero(known < limit)
        while len(live):
            differ = words[at[live] + known[live]] ^ words[other[live] + known[live]]
            same = differ == 0
            known[live[same]] += each
            ended, differ = live[~same], differ[~same]
            for i in range(1, each):
                known[ended] += differ >> bits * i == 0
            live = live[same]
            live = live[known[live] < limit[live]]
        shared[at] = np.minimum(known, limit)
    return shared
