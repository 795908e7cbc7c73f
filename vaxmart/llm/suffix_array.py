"""A suffix array by induced sorting and its permuted common prefixes, with whole-array steps for each symbol."""

from __future__ import annotations

import numpy as np


def _types(x: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the last suffix counts as smaller."""
    step = np.sign(np.diff(x.astype(np.int32)))
    step = np.append(step, 1)
    at = np.where(step != 0, np.arange(len(x)), len(x))
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def _induce(x: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Sorts all suffixes from the leftmost-smaller ones, given in order: larger ones from the left, symbol by symbol,
    then smaller ones from the right.  All entries of a symbol that are known move at once."""
    n = len(x)
    count = np.bincount(x)
    end = np.cumsum(count)
    start = end - count
    sa = np.full(n, -1, dtype=np.int32)
    head, tail = start.copy(), end.copy()
    symbols = np.flatnonzero(count)
    bounds = np.searchsorted(x[lms], np.arange(len(count) + 1))

    def place(entries: np.ndarray, kind: bool, ends: np.ndarray, way: int) -> None:
        before = entries[entries > 0] - 1
        before = before[smaller[before] == kind]
        if len(before):
            symbol = x[before]
            order = np.argsort(symbol, kind="stable")
            before, symbol = before[order], symbol[order]
            each = np.bincount(symbol, minlength=len(count))
            nth = np.arange(len(before)) - (np.cumsum(each) - each)[symbol]
            sa[ends[symbol] + nth if way > 0 else ends[symbol] - 1 - nth] = before
            ends += way * each

    for c in symbols:
        done = start[c]
        while done < head[c]:
            known, done = sa[done:head[c]], head[c]
            place(known, False, head, 1)
        place(lms[bounds[c]:bounds[c + 1]], False, head, 1)
    sa[0] = n - 1
    tail[x[n - 1]] -= 1
    for c in symbols[::-1]:
        done = end[c]
        while done > tail[c]:
            known, done = sa[tail[c]:done][::-1], tail[c]
            place(known, True, tail, -1)
        place(sa[start[c]:head[c]][::-1], True, tail, -1)
    return sa


def _names(x: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sorted_lms: np.ndarray) -> np.ndarray:
    """For each leftmost-smaller substring in text order, its rank among the distinct ones."""
    symbol = x.astype(np.uint64) * np.uint64(2) + smaller + np.uint64(1)
    symbol *= np.uint64(0x9E3779B97F4A7C15)
    symbol ^= symbol >> np.uint64(29)
    power = np.cumprod(np.full(len(x), 0xD6E8FEB86659FD93, dtype=np.uint64))
    total = np.append(np.uint64(0), np.cumsum(symbol * power))
    stop = np.append(lms[1:], len(x) - 1) + 1
    # A substring's hash is its part of the sum; both sides are brought to one power before they are compared.
    part = total[stop] - total[lms]
    where = np.empty(len(x), dtype=np.int64)
    where[lms] = np.arange(len(lms))
    order = where[sorted_lms]
    a, b = order[:-1], order[1:]
    same = (stop[a] - lms[a] == stop[b] - lms[b]) & (part[a] * power[lms[b]] == part[b] * power[lms[a]])
    names = np.empty(len(lms), dtype=np.int64)
    names[order] = np.append(0, np.cumsum(~same))
    return names


def _rank(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the reduced text: each recursion names pairs of neighbours, doubling what a name spans,
    until all names differ."""
    n = len(names)

    def again(ranks: np.ndarray, span: int) -> np.ndarray:
        if ranks.max(initial=0) == n - 1:
            return np.argsort(ranks, kind="stable")
        following = np.append(ranks[span:], np.full(min(span, n), -1)) + 1
        key = ranks * (n + 1) + following
        order = np.argsort(key, kind="stable")
        named = np.empty(n, dtype=np.int64)
        named[order] = np.append(0, np.cumsum(np.diff(key[order]) != 0))
        return again(named, 2 * span)

    return again(names, 1)


def suffix_array(x: np.ndarray) -> np.ndarray:
    """Of symbols from 1 up that end with a single 0."""
    if len(x) < 2:
        return np.zeros(len(x), dtype=np.int32)
    smaller = _types(x)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    mark = np.zeros(len(x), dtype=bool)
    mark[lms] = True
    by_symbol = lms[np.argsort(x[lms], kind="stable")]
    sa = _induce(x, smaller, by_symbol)
    names = _names(x, smaller, lms, sa[mark[sa]])
    return _induce(x, smaller, lms[_rank(names)])


def permuted_lcp(x: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By text position: the position of the suffix before it in the array, and the length they share.

    Only where the symbols before the two suffixes differ is the length compared; elsewhere it is one less than at the
    position before."""
    n = len(x)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    own = np.ones(n, dtype=bool)
    both = np.flatnonzero((before > 0) & (np.arange(n) > 0))
    own[both] = x[both - 1] != x[before[both] - 1]
    # Four symbols a word, from every position.
    wide = np.append(x.astype(np.uint64), np.zeros(4, dtype=np.uint64))
    word = wide[:n] | wide[1:n + 1] << np.uint64(16) | wide[2:n + 2] << np.uint64(32) | wide[3:n + 3] << np.uint64(48)
    length = np.zeros(n, dtype=np.int64)
    at = np.flatnonzero(own & (before >= 0))
    shared = 0
    while len(at):
        differ = word[at + shared] ^ word[before[at] + shared]
        for k in range(4):
            length[at] += (differ & np.uint64((1 << 16 * (k + 1)) - 1)) == 0
        at = at[differ == 0]
        shared += 4
    last = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    lcp = length[last] - (np.arange(n) - last)
    lcp[before < 0] = 0
    return before, lcp


def repeated(pieces: list[bytes], least: int) -> list[np.ndarray]:
    """For each piece, whether the ``least`` bytes from each start occur anywhere else in the pieces."""
    joined = np.full(sum(len(p) + 1 for p in pieces) + 1, 1, dtype=np.uint16)
    starts, at = [], 0
    for p in pieces:
        joined[at:at + len(p)] = np.frombuffer(p, dtype=np.uint8)
        joined[at:at + len(p)] += 2
        starts.append(at)
        at += len(p) + 1
    joined[-1] = 0
    sa = suffix_array(joined)
    before, lcp = permuted_lcp(joined, sa)
    hit = lcp >= least
    hit[before[hit]] = True
    return [hit[s:s + max(0, len(p) - least + 1)] for s, p in zip(starts, pieces)]
