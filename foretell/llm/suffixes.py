"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

A suffix is S if it is smaller than the next one, else L; an S whose predecessor is L is a
leftmost S.  The substrings between leftmost S positions are sorted by one round of
inducing and named; if names repeat, the string of names is sorted the same way, recursively; the
order of the leftmost S suffixes then induces that of all others in two scans over the buckets.
A scan handles a whole bucket at a time; strings of names with many small buckets are scanned
element by element instead, which gives the same order.
"""

from __future__ import annotations

import numpy as np

SMALL_BUCKETS = 12  # elements a bucket below which a string is scanned element by element


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is S; the last one, the end mark, is."""
    n = len(s)
    rising = np.empty(n, np.int8)
    rising[:-1] = np.sign(s[1:] - s[:-1])
    rising[-1] = 1
    at = np.where(rising != 0, np.arange(n), n)
    after = np.minimum.accumulate(at[::-1])[::-1]  # the next place where the symbols differ
    return rising[after] > 0


def _put(sa, ends, s, items, step):
    """Puts ``items`` at the open ends of their buckets, in their order."""
    m = len(items)
    if m < 2:
        for i in items.tolist():
            sa[ends[s[i]]] = i
            ends[s[i]] += step
        return
    symbols = s[items]
    order = symbols.argsort(kind="stable")
    symbols = symbols[order]
    change = np.empty(m, bool)
    change[0] = True
    np.not_equal(symbols[1:], symbols[:-1], out=change[1:])
    within = np.arange(m)
    within -= change.nonzero()[0][change.cumsum() - 1]
    at = ends[symbols]
    at += within if step > 0 else -within
    sa[at] = items[order]
    ends[symbols] = at + step  # of equal symbols the last one counts


def _induced_by_buckets(s, is_s, ordered, counts) -> np.ndarray:
    stop = np.cumsum(counts)
    start = stop - counts
    sa = np.full(len(s), -1, np.int64)
    heads = start.copy()
    own = s[ordered]
    low, high = np.searchsorted(own, np.arange(len(counts))), np.searchsorted(own, np.arange(len(counts)), side="right")
    present = np.flatnonzero(counts)
    for c in present:
        done = start[c]
        while heads[c] > done:
            now = sa[done : heads[c]]
            done = heads[c]
            before = now[now > 0] - 1
            _put(sa, heads, s, before[~is_s[before]], 1)
        if high[c] > low[c]:
            before = ordered[low[c] : high[c]]
            before = before[before > 0] - 1
            _put(sa, heads, s, before[~is_s[before]], 1)
    tails = stop - 1
    for c in present[::-1]:
        done = stop[c] - 1
        while tails[c] < done:
            now = sa[tails[c] + 1 : done + 1][::-1]
            done = tails[c]
            before = now[now > 0] - 1
            _put(sa, tails, s, before[is_s[before]], -1)
        now = sa[start[c] : heads[c]][::-1]
        before = now[now > 0] - 1
        _put(sa, tails, s, before[is_s[before]], -1)
    sa[0] = len(s) - 1
    return sa


def _induced_one_by_one(s, is_s, ordered, counts) -> np.ndarray:
    stop = np.cumsum(counts)
    start = stop - counts
    text, kinds = s.tolist(), is_s.tolist()
    sa = [-1] * len(text)
    tails = stop.tolist()
    for i in ordered[::-1].tolist():
        c = text[i]
        tails[c] -= 1
        sa[tails[c]] = i
    heads = start.tolist()
    for at in range(len(sa)):
        i = sa[at] - 1
        if i >= 0 and not kinds[i]:
            c = text[i]
            sa[heads[c]] = i
            heads[c] += 1
    tails = stop.tolist()
    for at in range(len(sa) - 1, -1, -1):
        i = sa[at] - 1
        if i >= 0 and kinds[i]:
            c = text[i]
            tails[c] -= 1
            sa[tails[c]] = i
    sa[0] = len(text) - 1
    return np.array(sa, np.int64)


def _names(s, found, lengths) -> np.ndarray:
    """Ranks of sorted substrings that start at ``found``; equal ones share theirs."""
    a, b = found[:-1], found[1:]
    equal = lengths[:-1] == lengths[1:]
    live = np.flatnonzero(equal)
    k = 0
    while len(live):
        same = s[a[live] + k] == s[b[live] + k]
        equal[live[~same]] = False
        k += 1
        live = live[same]
        live = live[lengths[live] > k]
    return np.concatenate([[0], np.cumsum(~equal)])


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order.  The last symbol must be 0 and occur only there."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    counts = np.bincount(s)
    induced = _induced_by_buckets if n >= SMALL_BUCKETS * np.count_nonzero(counts) else _induced_one_by_one
    is_s = _types(s)
    leftmost = np.zeros(n, bool)
    leftmost[1:] = is_s[1:] & ~is_s[:-1]
    at = np.flatnonzero(leftmost)
    sa = induced(s, is_s, at[np.argsort(s[at], kind="stable")], counts)
    found = sa[leftmost[sa]]
    place = np.zeros(n, np.int64)
    place[at] = np.arange(len(at))
    lengths = np.append(np.diff(at) + 1, 1)
    names = _names(s, found, lengths[place[found]])
    if names[-1] + 1 < len(at):
        reduced = np.zeros(len(at), np.int64)
        reduced[place[found]] = names
        found = at[suffix_array(reduced)]
    return induced(s, is_s, found, counts)


def common_prefixes(s: np.ndarray, sa: np.ndarray) -> tuple:
    """``(plcp, before)``: of every position, how much it shares with the suffix that sorts before it, and that suffix.

    Only where the symbols to the left differ is anything compared; elsewhere it is one less
    than at the position before.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    left = np.concatenate([[-1], s[:-1]])
    at = np.arange(n)
    start = (before >= 0) & ((at == 0) | (before == 0) | (left != left[before]))
    live = np.flatnonzero(start)
    shared = np.zeros(n, np.int64)
    wide = np.concatenate([s, np.full(64, -1, s.dtype)])
    offset, width = 0, 8
    while len(live):
        columns = np.arange(offset, offset + width)
        mine, other = live[:, None] + columns, before[live][:, None] + columns
        differs = (mine >= n) | (other >= n) | (wide[np.minimum(mine, n)] != wide[np.minimum(other, n)])
        any_ = differs.any(axis=1)
        shared[live] += np.where(any_, differs.argmax(axis=1), width)
        live = live[~any_]
        offset, width = offset + width, 64
    reach = np.maximum.accumulate(np.where(start, shared + at, 0))
    return np.where(before >= 0, np.maximum(reach - at, 0), 0), before


def repeated_starts(bodies: list, length: int) -> list:
    """``(body, first, last)``: runs of starts of strings of ``length`` bytes that also start elsewhere in the bodies."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    s = np.ones(int(sizes.sum()) + len(bodies) + 1, np.int64)  # 1 between bodies, 0 at the end
    s[-1] = 0
    begins = np.cumsum(sizes + 1) - sizes - 1
    inside = np.zeros(len(s), bool)
    data = np.frombuffer(b"".join(bodies), np.uint8)
    spot = np.arange(len(data)) + np.repeat(np.arange(len(bodies)), sizes)
    s[spot] = data.astype(np.int64) + 2
    room = np.maximum(sizes - length + 1, 0)
    inside[np.repeat(begins, room) + np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)] = True
    plcp, before = common_prefixes(s, suffix_array(s))
    hit = np.flatnonzero(plcp >= length)
    found = np.zeros(len(s), bool)
    found[hit] = True
    found[before[hit]] = True
    found &= inside
    edge = np.diff(np.concatenate([[0], found.astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    body = np.searchsorted(begins, first, side="right") - 1
    return list(zip(body.tolist(), (first - begins[body]).tolist(), (last - begins[body]).tolist()))
