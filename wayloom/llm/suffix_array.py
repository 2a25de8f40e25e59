"""Suffix arrays of shards by induced sorting, vectorised over buckets.

A shard is a set of distinct byte segments, each followed by a separator. Suffixes
are classified as smaller (S) or larger (L) than their right neighbour. The substrings
from one leftmost S position to the next are sorted by words of several symbols (one
that is a longer one's beginning is the larger, as it ends on an S) and named; where
names repeat, the shorter string of names is sorted in the same way, or, once its
alphabet is large, by doubling the compared length of what is still tied. Two
induction passes then place every other suffix. Where the textbook loop moves one suffix
at a time, here all suffixes of a bucket move together: a bucket only feeds itself (a run
of one byte, in waves) and buckets not yet visited, so their order is the same.

Common prefixes are computed in text order (the permuted array), each starting
from its left neighbour's less one, for all segments in step.
"""

from __future__ import annotations

import numpy as np

from .textkit import U64, eights, ranges

SMALL_ALPHABET = 512


def classify(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its right neighbour; the last, a unique least symbol, is."""
    n = len(s)
    out = np.ones(n, bool)
    if n > 1:
        at = np.flatnonzero(s[1:] != s[:-1])  # ends of runs of one symbol
        out[:-1] = np.repeat(s[at] < s[at + 1], np.diff(np.append(-1, at)))
    return out


def _deal(ch: np.ndarray, j: np.ndarray, pending: list[list[np.ndarray]]) -> None:
    """Append positions to the buckets of their symbols, keeping their order."""
    if not len(j):
        return
    order = np.argsort(ch, kind="stable")
    ch, j = ch[order], j[order]
    cut = [0, *(np.flatnonzero(ch[1:] != ch[:-1]) + 1).tolist(), len(j)]
    for a, b, c in zip(cut, cut[1:], ch[cut[:-1]].tolist(), strict=False):
        pending[c].append(j[a:b])


def _waves(c: int, first: list[np.ndarray], s: np.ndarray, wanted: np.ndarray, pending: list[list[np.ndarray]]) -> np.ndarray:
    """Everything that enters bucket c, in order, when its entries induce their left neighbours of the wanted type."""
    wave = np.concatenate(first) if first else np.zeros(0, np.int64)
    parts = [wave]
    while len(wave):
        j = wave[wave > 0] - 1
        j = j[wanted[j]]
        ch = s[j]
        own = ch == c
        if own.any():
            _deal(ch[~own], j[~own], pending)
            wave = j[own]
            parts.append(wave)
        else:
            _deal(ch, j, pending)
            break
    return np.concatenate(parts) if len(parts) > 1 else wave


def induce(s: np.ndarray, is_s: np.ndarray, seeds: list[np.ndarray], sigma: int) -> np.ndarray:
    """Suffix array from the leftmost S positions of each bucket, in order."""
    is_l = ~is_s
    left: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    larger: list[np.ndarray] = []
    for c in range(sigma):
        larger.append(_waves(c, left[c], s, is_l, left))
        left[c] = []
        j = seeds[c][seeds[c] > 0] - 1
        _deal(s[j], j, left)
    right: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    smaller: list[np.ndarray] = [np.zeros(0, np.int64)] * sigma
    for c in range(sigma - 1, -1, -1):
        smaller[c] = _waves(c, right[c], s, is_s, right)[::-1]
        right[c] = []
        j = larger[c][::-1]
        j = j[j > 0] - 1
        j = j[is_s[j]]
        _deal(s[j], j, right)
    smaller[0] = np.array([len(s) - 1])
    return np.concatenate([x for c in range(sigma) for x in (larger[c], smaller[c])])


def _starts(new: np.ndarray) -> np.ndarray:
    """The first place of the group of each place."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _tied(new: np.ndarray) -> np.ndarray:
    """Places of groups of more than one."""
    return np.flatnonzero(~(new & np.append(new[1:], True)))


def _part(order: np.ndarray, new: np.ndarray, places: np.ndarray, key: np.ndarray) -> None:
    """Sort whole groups, of which `places` are all, by a key of their members, and split them where it changes."""
    group = np.cumsum(new[places])
    by = np.lexsort((key, group))
    order[places] = order[places][by]
    key = key[by]
    new[places[1:]] |= key[1:] != key[:-1]


def sorted_substrings(s: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): numbers of the leftmost S substrings in order, and where a new one begins among equal ones.

    The filler behind the end of a substring is larger than every symbol.
    """
    size = np.append(lms[1:] + 1, len(s)) - lms
    bits = 8 * s.itemsize
    each, last = 64 // bits, len(s) - 1
    eight = eights(s).byteswap() if bits == 8 else None
    filler = ~U64(0) >> (np.arange(each + 1).astype(U64) * U64(bits) % U64(64))  # behind so many symbols
    filler[each] = 0

    def word(who: np.ndarray | slice, j: int) -> np.ndarray:
        at = lms[who] + j * each
        behind = filler[np.clip(size[who] - j * each, 0, each)]
        if eight is not None:
            return eight[np.minimum(at, last)] | behind
        out = np.zeros(len(at), U64)
        for k in range(each):
            out = (out << U64(bits)) | s[np.minimum(at + k, last)].astype(U64)
        return out | behind

    first = word(slice(None), 0)
    order = np.argsort(first)  # equal ones in any order: they are told apart below, or have one name
    new = np.ones(len(lms), bool)
    new[1:] = first[order[1:]] != first[order[:-1]]
    for j in range(1, -(-int(size.max()) // each)):
        places = _tied(new)
        places = places[np.flatnonzero(np.isin(_starts(new)[places], _starts(new)[places][size[order[places]] > j * each]))]
        if not len(places):
            break
        _part(order, new, places, word(order[places], j))
    return order, new


def _double(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, by doubling the compared length of those that are still tied."""
    n, k = len(order), 1
    rank = np.empty(n, np.int64)
    rank[order] = _starts(new)
    places = _tied(new)
    while len(places):
        who = order[places]
        group = rank[who]
        follow = np.where(who + k < n, rank[np.minimum(who + k, n - 1)] + 1, 0)
        key = group * (n + 1) + follow
        by = np.argsort(key)
        order[places] = who[by]
        key = key[by]
        begins = np.ones(len(key), bool)
        begins[1:] = key[1:] != key[:-1]
        rank[who[by]] = places[_starts(begins)]
        places = places[_tied(begins)]
        k *= 2
    return order


def suffix_array(s: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of s, whose last symbol 0 occurs nowhere else and whose symbols are below sigma."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    s = s.astype(np.uint8 if sigma < 1 << 8 else np.uint16 if sigma < 1 << 16 else np.uint32, copy=False)
    is_s = classify(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    order, new = sorted_substrings(s, lms)
    if not new.all():
        # The last substring is the sentinel's: its name is 0 and unique.
        many = int(new.sum())
        if many > SMALL_ALPHABET:
            order = _double(order, new)
        else:
            name = np.empty(len(lms), np.int64)
            name[order] = np.cumsum(new) - 1
            order = suffix_array(name, many)
    seeds = lms[order]
    bounds = np.searchsorted(s[seeds], np.arange(sigma + 1))
    return induce(s, is_s, [seeds[bounds[c] : bounds[c + 1]] for c in range(sigma)], sigma)


def permuted_prefixes(s: np.ndarray, sa: np.ndarray, start: np.ndarray, size: np.ndarray, width: int = 1) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the array, within their segments, in text order.

    start, size: the segments of bytes, distinct and each followed by a separator. Suffixes
    with fewer than `width` bytes to the end of their segment are left at 0.
    """
    before = np.empty(len(s), np.int64)
    before[sa[0]] = len(s) - 1
    before[sa[1:]] = sa[:-1]
    left = np.zeros(len(s), np.int64)  # bytes up to the end of the segment
    inside = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    left[inside] = np.repeat(start + size, size) - inside
    eight = eights(s)
    out = np.zeros(len(s), np.int64)
    order = np.argsort(-size, kind="stable")
    start, steps = start[order], size[order] - width + 1
    have = np.zeros(len(start), np.int64)
    for t in range(int(steps.max(initial=0))):
        m = int(np.searchsorted(-steps, -t, "left"))
        i = start[:m] + t
        q = before[i]
        most = np.minimum(left[i], left[q])
        n = np.minimum(np.maximum(have[:m] - 1, 0), most)
        grow = np.flatnonzero(n < most)
        while len(grow):
            differ = eight[i[grow] + n[grow]] ^ eight[q[grow] + n[grow]]
            same = differ == 0
            lowest = differ & (~differ + U64(1))
            # The exponent of a power of two as a float is its logarithm.
            n[grow] += np.where(same, 8, ((lowest.astype(np.float64).view(np.int64) >> 52) - 1023) >> 3)
            np.minimum(n, most, out=n)
            grow = grow[same]
            grow = grow[n[grow] < most[grow]]
        have[:m] = n
        out[i] = n
    return out


def earliest_windows(segments: list[bytes], owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of `width` bytes of each distinct segment, the least owner of a segment holding it: (flat, windows of each segment)."""
    size = np.array([len(x) for x in segments], np.int64)
    if not len(size):
        return np.zeros(0, np.int64), size
    start = np.cumsum(size + 1) - (size + 1)
    whole = np.frombuffer(b"\0".join(segments) + b"\0\0", np.uint8)
    count = np.bincount(whole, minlength=256)
    count[0] -= len(size) + 1
    # Bytes from 2 on in their order, separators 1, the sentinel 0; shards with all of the 254 lowest symbols take two bytes each.
    symbol = np.cumsum(count > 0) + 1
    sigma = int(symbol[-1]) + 1
    s = symbol.astype(np.uint8 if sigma < 1 << 8 else np.uint16)[whole]
    s[start + size] = 1
    s[-1] = 0
    sa = suffix_array(s, sigma)
    prefix = permuted_prefixes(whole, sa, start, size, width)
    most = np.iinfo(np.int64).max
    own = np.append(np.repeat(owner, size + 1), most)
    own[start + size] = most
    new = prefix[sa] < width
    new[0] = True
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(own[sa], first)
    out = np.empty(len(s), np.int64)
    out[sa] = np.repeat(least, np.diff(np.append(first, len(sa))))
    many = np.maximum(size - width + 1, 0)
    return out[ranges(start, many)], many


def earliest(segments: list[bytes], owner: np.ndarray, width: int) -> list[np.ndarray]:
    """As `earliest_windows`, an array for each segment."""
    flat, many = earliest_windows(segments, owner, width)
    return np.split(flat, np.cumsum(many)[:-1]) if len(many) else []
