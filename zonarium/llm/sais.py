"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified as smaller (S) or larger (L) than their successor; the
leftmost S of each run (LMS) cut the text into substrings.  These are sorted by
induction and named, the string of names is sorted recursively, and the order of
all suffixes is induced from that of the LMS suffixes.  Induction scans the
buckets once; here it takes as many buckets at a time as do not feed each other,
so the work is linear and done in array operations.

Where only some suffixes are asked for, and only as far as a given depth,
``ranks_to`` sorts them by prefix doubling, in a few sorts of whole arrays.
"""

import numpy as np


def _ranges(starts, lengths):
    """Indices start, start + 1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths - starts, lengths)


def _induced(text, buckets, seeds, wanted, first=None):
    """Positions with ``wanted`` in the order that the sorted ``seeds`` induce.

    Buckets are scanned upwards; in each, what has been induced comes before the
    seeds.  Every position scanned adds its predecessor, if wanted, to the end of
    the predecessor's bucket.
    """
    counts = np.bincount(text[wanted], minlength=buckets)
    of_seeds = np.bincount(text[seeds], minlength=buckets)
    total = int(counts.sum())
    # One array: room for what is induced, then the seeds; two parts of it for every bucket.
    whole = np.empty(total + len(seeds), np.int64)
    whole[total:] = seeds
    starts, lengths = np.empty(2 * buckets, np.int64), np.zeros(2 * buckets, np.int64)
    starts[::2] = np.cumsum(counts) - counts
    starts[1::2] = np.cumsum(of_seeds) - of_seeds + total
    lengths[1::2] = of_seeds
    base, filled = starts[::2].copy(), lengths[::2]
    before_of = np.arange(-1, len(text) - 1)
    before_of[1:][~wanted[:-1]] = -1
    if first is not None:
        whole[base[text[first]]] = first
        filled[text[first]] = 1
    narrow = np.uint16 if buckets <= 1 << 16 else np.int64  # stable sorting of two bytes is linear

    def add(before, to):
        if len(to) > 1:
            order = to.astype(narrow).argsort(kind="stable")
            to, before = to[order], before[order]
            edge = (to[1:] != to[:-1]).nonzero()[0] + 1
            if len(edge) + 1 < len(to):
                starts_at = np.zeros(len(edge) + 1, np.int64)
                starts_at[1:] = edge
                sizes = np.empty_like(starts_at)
                sizes[:-1] = edge
                sizes[-1] = len(to)
                sizes[1:] -= edge
                names = to[starts_at]
                shift = base[names] + filled[names] - starts_at
                whole[np.arange(len(to)) + shift.repeat(sizes)] = before
                filled[names] += sizes
                return
        whole[base[to] + filled[to]] = before
        filled[to] += 1

    at, step = 0, 1
    while at < buckets:
        end = min(at + step, buckets)
        part = lengths[2 * at : 2 * end]
        ends = part.cumsum()
        size = int(ends[-1])
        if not size:
            at, step = end, step * 2
            continue
        scanned = whole[np.arange(size) + (starts[2 * at : 2 * end] - ends + part).repeat(part)]
        before = before_of[scanned]
        kept = before >= 0
        before = before[kept]
        to = text[before]
        lowest = int(to.min()) if len(to) else buckets
        if lowest >= end:  # none of these buckets feeds another of them
            add(before, to)
            at, step = end, step + (step >> 1) + 1
            continue
        if lowest > at:
            own = int(np.count_nonzero(kept[: ends[2 * (lowest - at) - 1]]))
            add(before[:own], to[:own])
            step = max(1, (step + lowest - at) >> 1)
            at = lowest
            continue
        # Bucket ``at`` feeds itself: scan what is new until nothing is, then its seeds.
        done = 0
        while done < filled[at]:
            now = int(filled[at])
            before = before_of[whole[base[at] + done : base[at] + now]]
            before = before[before >= 0]
            add(before, text[before])
            done = now
        before = before_of[whole[starts[2 * at + 1] : starts[2 * at + 1] + lengths[2 * at + 1]]]
        before = before[before >= 0]
        add(before, text[before])
        at, step = at + 1, max(1, step >> 2)
    return whole[:total]


def _types(text):
    """True where a suffix is smaller than the next one (the empty suffix is the least)."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    smaller = text[differs] < text[differs + 1]
    # An equal pair has the type of the next differing one; the last run is larger.
    out = np.zeros(n, bool)
    if len(differs):
        spans = np.diff(np.concatenate([[-1], differs]))
        out[: differs[-1] + 1] = np.repeat(smaller, spans)
    return out


def _sorted_suffixes(text, buckets, lms, small):
    """Suffix array induced from LMS suffixes given in order."""
    larger = _induced(text, buckets, lms, ~small, first=len(text) - 1)
    mirrored = buckets - 1 - text
    smaller = _induced(mirrored, buckets, larger[::-1], small)[::-1]
    counts_l = np.bincount(text[larger], minlength=buckets)
    counts_s = np.bincount(text[smaller], minlength=buckets)
    base = np.concatenate([[0], np.cumsum(counts_l + counts_s)])[:-1]
    out = np.empty(len(text), np.int64)
    out[_ranges(base, counts_l)] = larger
    out[_ranges(base + counts_l, counts_s)] = smaller
    return out


def suffix_array(text, buckets=None):
    """Suffix array of an array of whole numbers from 0 to ``buckets`` - 1."""
    text = np.asarray(text, np.int64)
    n = len(text)
    if n < 2:
        return np.arange(n)
    buckets = int(text.max()) + 1 if buckets is None else buckets
    small = _types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(lms):
        return _sorted_suffixes(text, buckets, lms, small)
    # Sort the LMS substrings: induce from the LMS positions in order of their first symbol.
    rough = _sorted_suffixes(text, buckets, lms[np.argsort(text[lms], kind="stable")], small)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    rough = rough[is_lms[rough]]
    rank = np.empty(n, np.int64)
    rank[lms] = np.arange(len(lms))
    # Name them: equal neighbours, compared symbol by symbol, get the same name.
    lengths = np.diff(np.append(lms, n)) + 1
    lengths[-1] = n + 1  # it ends with the end of the text, like no other
    a, b = rough[:-1], rough[1:]
    same = lengths[rank[a]] == lengths[rank[b]]
    pairs = np.flatnonzero(same)
    if len(pairs):
        sizes = lengths[rank[a[pairs]]]
        left, right = _ranges(a[pairs], sizes), _ranges(b[pairs], sizes)
        same[pairs] = np.logical_and.reduceat(text[left] == text[right], np.cumsum(sizes) - sizes)
    names = np.concatenate([[0], np.cumsum(~same)])
    if names[-1] + 1 < len(lms):
        reduced = np.empty(len(lms), np.int64)
        reduced[rank[rough]] = names
        ordered = lms[suffix_array(reduced, int(names[-1]) + 1)]
    else:
        ordered = rough
    return _sorted_suffixes(text, buckets, ordered, small)


def permuted_lcp(data, order, symbols=None):
    """For each position, the common prefix with the suffix before it in the suffix array.

    Computed where it cannot be inferred (the symbols before the two suffixes
    differ), eight bytes at a time; elsewhere it is one less than at the position
    before.  ``data``: bytes as uint8; ``symbols``: what was sorted, if not the bytes.
    """
    n = len(data)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.zeros(n + 1, np.uint64)
    for k in range(8):
        words[:n] |= padded[k : n + k].astype(np.uint64) << np.uint64(8 * k)
    kept = np.ones(n, bool)
    inner = np.flatnonzero(before[1:] > 0) + 1
    # Prefixes are inferred in the order of the symbols: a byte may be equal where its symbol is not.
    symbols = data if symbols is None else symbols
    kept[inner] = symbols[inner - 1] != symbols[before[inner] - 1]
    at = np.flatnonzero(kept & (before >= 0))
    other = before[at]
    length = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    while len(live):
        i, j = at[live] + length[live], other[live] + length[live]
        inside = np.maximum(i, j) < n
        live, i, j = live[inside], i[inside], j[inside]
        x = words[i] ^ words[j]
        equal = x == 0
        part = x[~equal]
        low = part & (~part + np.uint64(1))
        length[live[~equal]] += (np.log2(low.astype(np.float64)).astype(np.int64)) >> 3
        length[live[equal]] += 8
        live = live[equal]
    length = np.minimum(length, n - np.maximum(at, other))
    # A position that is not computed has the last computed one's value, less the distance.
    source = np.full(n, -1, np.int64)
    source[at] = np.arange(len(at))
    starts = np.flatnonzero(kept)
    last = starts[np.searchsorted(starts, np.arange(n), side="right") - 1]
    known = source[last] >= 0
    out[known] = length[source[last[known]]] - (np.arange(n)[known] - last[known])
    return np.maximum(out, 0)


def _ranked(keys):
    """For each key, the number of different smaller ones."""
    order = keys.argsort()
    ordered = keys[order]
    out = np.zeros(len(keys), np.int64)
    out[order[1:]] = np.cumsum(ordered[1:] != ordered[:-1])
    return out


def ranks_to(symbols, starts, length):
    """Ranks of the suffixes at ``starts`` by their first ``length`` symbols; equal strings rank equal.

    By prefix doubling: ranks by h symbols give those by 2 h.  The last steps are
    taken for the starts only.  ``symbols``: unsigned; each start has ``length`` of them.
    """
    if not len(starts):
        return np.zeros(0, np.int64)
    size, keys = 1, symbols
    if symbols.dtype == np.uint8 and length >= 8:  # eight bytes are a number
        size, keys = 8, np.zeros(len(symbols) - 7, np.uint64)
        for k in range(8):
            keys |= symbols[k : k + len(keys)].astype(np.uint64) << np.uint64(56 - 8 * k)
    ranks = _ranked(keys)
    while 8 * size <= length:
        ranks = _ranked(ranks[:-size] * len(ranks) + ranks[size:])
        size *= 2
    out = ranks[starts]
    for at in range(size, length, size):
        out = _ranked(out * len(ranks) + ranks[starts + min(at, length - size)])
    return _ranked(out)
