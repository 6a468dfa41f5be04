"""Suffix arrays by induced sorting in array operations, and their permuted common prefixes."""

from __future__ import annotations

import numpy as np

#: Ranks looked at together when an order is induced; the step adapts between these.
LEAST, MOST = 256, 1 << 18


def classified(text: np.ndarray) -> np.ndarray:
    """True for suffixes that are smaller than the next one. The last character is the only one of its kind and the least."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    smaller = np.zeros(n, bool)
    smaller[-1] = True
    if n > 1:
        next_ = differs[np.searchsorted(differs, np.arange(n - 1))]
        smaller[:-1] = text[next_] < text[next_ + 1]
    return smaller


def _ranked(chars: np.ndarray) -> np.ndarray:
    """For each entry, how many before it are equal to it."""
    order = np.argsort(chars, kind="stable")
    sorted_ = chars[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    rank = np.empty(len(chars), np.int64)
    rank[order] = np.arange(len(chars)) - np.repeat(first, np.diff(np.concatenate([first, [len(chars)]])))
    return rank


def _induce(order: np.ndarray, text: np.ndarray, smaller: np.ndarray, edge: np.ndarray, up: bool) -> None:
    """Puts the suffix before each placed one at the next free place of its bucket, along the array (up) or against it.

    Ranks are taken in blocks. A block ends before the first place that it
    fills itself, so every entry in it is final when it is read.
    """
    n, step, at = len(order), MOST, 0 if up else len(order) - 1
    edge = edge.copy()
    sign = 1 if up else -1
    while 0 <= at < n:
        span = order[at : at + step] if up else order[max(0, at - step + 1) : at + 1][::-1]
        place = np.flatnonzero(span > 0)
        before = span[place] - 1
        fits = smaller[before] != up
        place, before = place[fits], before[fits]
        done = len(span)
        if len(before):
            chars = text[before]
            target = edge[chars] + sign * _ranked(chars)
            reach = int((sign * (target - at)).min())
            if reach < done:
                done = reach
                few = np.searchsorted(place, done)
                before, chars, target = before[:few], chars[:few], target[:few]
            order[target] = before
            np.add.at(edge, chars, sign)
        step = min(MOST, max(LEAST, 2 * done)) if done < len(span) else min(MOST, 2 * step)
        at += sign * done


def _sorted(text: np.ndarray, smaller: np.ndarray, given: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Order of all suffixes, induced from the order of the leftmost-smaller ones."""
    ends = np.cumsum(sizes)
    order = np.full(len(text), -1, np.int32 if len(text) < 1 << 31 else np.int64)
    back = given[::-1]
    order[ends[text[back]] - 1 - _ranked(text[back])] = back
    _induce(order, text, smaller, ends - sizes, True)
    placed = order >= 0
    order[placed & smaller[order]] = -1
    order[0] = len(text) - 1
    _induce(order, text, smaller, ends - 1, False)
    return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order. text holds numbers from 0; its last is 0 and the only 0.

    Suffixes are classified; the substrings between leftmost-smaller ones are
    put in order by inducing, named by rank and, unless all names differ, sorted
    by the order of the string of names, which is found in the same way. From
    the order of the leftmost-smaller suffixes that of all is induced.
    """
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    most = int(text.max())
    text = text.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.int32)
    smaller = classified(text)
    left = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    sizes = np.bincount(text)
    order = _sorted(text, smaller, left, sizes)
    mark = np.zeros(n, bool)
    mark[left] = True
    found = order[mark[order]]
    stop = np.full(n, n - 1, np.int64)
    stop[left[:-1]] = left[1:]
    length = stop[found] - found
    same = np.zeros(len(found), bool)
    open_ = np.flatnonzero(length[1:] == length[:-1]) + 1
    open_ = open_[length[open_] > 0]
    k = 0
    while len(open_):
        open_ = open_[text[found[open_] + k] == text[found[open_ - 1] + k]]
        done = length[open_] == k
        same[open_[done]] = True
        open_, k = open_[~done], k + 1
    names = np.cumsum(~same) - 1
    if names[-1] + 1 < len(found):
        by_place = np.empty(n, np.int64)
        by_place[found] = names
        found = left[suffix_array(by_place[left])]
    return _sorted(text, smaller, found, sizes)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: np.ndarray) -> np.ndarray:
    """For every position, in the order of the text, how many characters its suffix shares with the one ranked before it.

    most says for each position how many characters count. Eight characters are
    compared at a time; pairs that differ drop out.
    """
    n = len(text)
    before = np.empty(n, np.int64)
    before[order[1:]], before[order[0]] = order[:-1], -1
    limit = np.where(before >= 0, np.minimum(most, most[before]), 0)
    shared = np.zeros(n, np.int64)
    open_ = np.flatnonzero(limit > 0)
    padded = np.concatenate([text, np.zeros(8, text.dtype)]).astype(np.uint8 if text.max(initial=0) < 256 else np.uint16)
    words = np.zeros(n, np.uint64)
    per = 8 // padded.dtype.itemsize
    for i in range(per):
        words |= padded[i : i + n].astype(np.uint64) << np.uint64(8 * padded.dtype.itemsize * i)
    k = 0
    while len(open_):
        a, b = open_ + k, before[open_] + k
        inside = (a < n) & (b < n)
        equal = inside & (words[np.minimum(a, n - 1)] == words[np.minimum(b, n - 1)])
        rest = open_[~equal]
        step, alive = np.zeros(len(rest), np.int64), np.ones(len(rest), bool)
        for i in range(per - 1):
            x, y = np.minimum(rest + k + i, n), np.minimum(before[rest] + k + i, n)
            alive &= padded[x] == padded[y]
            step += alive
        shared[rest] = k + step
        open_, k = open_[equal], k + per
        full = limit[open_] <= k
        shared[open_[full]] = k
        open_ = open_[~full]
    return np.minimum(shared, limit)
