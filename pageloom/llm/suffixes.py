"""Suffix arrays of byte strings in numpy, and their common prefixes."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes or more, by Larsson-Sadakane refinement.

    A suffix's rank is the first slot of its group of suffixes equal so far.  A round sorts the groups that
    are not yet single by the rank of the suffix as many bytes on as are already sorted, which doubles
    that depth.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    bits = int(n).bit_length()
    low = np.uint64((1 << bits) - 1)
    # The first bytes in nine bits each, 0 beyond the end: as many as share a key with the place.
    done = min((64 - bits) // 9, 5)
    codes = np.zeros(n, np.uint64)
    for k in range(done):
        codes <<= np.uint64(9)
        codes[: max(n - k, 0)] |= text[k:].astype(np.uint64) + np.uint64(1)
    keys = (codes << np.uint64(bits)) | np.arange(n, dtype=np.uint64)
    keys.sort()
    sa = (keys & low).astype(np.int64)
    rank = np.empty(n, np.int64)
    slots = np.arange(n)
    head = keys >> np.uint64(bits)
    while True:
        first = np.concatenate([[True], head[1:] != head[:-1]])
        start = slots[np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))]
        moved = sa[slots]
        rank[moved] = start
        open_group = ~(first & np.concatenate([first[1:], [True]]))
        slots = slots[open_group]
        if done >= depth or not len(slots):
            return sa
        i = sa[slots]
        ahead = i + done
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        if 3 * bits <= 64:
            keys = (rank[i].astype(np.uint64) << np.uint64(2 * bits)) | (second.astype(np.uint64) << np.uint64(bits)) | i.astype(np.uint64)
            keys.sort()
            sa[slots] = (keys & low).astype(np.int64)
            head = keys >> np.uint64(bits)
        else:
            head = (rank[i].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
            order = np.argsort(head, kind="stable")
            sa[slots], head = i[order], head[order]
        done *= 2


def common_prefixes(text: np.ndarray, sa: np.ndarray, cap: int, lanes: int = 4096) -> np.ndarray:
    """For each slot of ``sa``, the bytes (``cap`` at most) that its suffix shares with the slot before.

    Kasai's rule: in text order, the length falls by one byte a step at most, so each step starts there.  It
    holds for a fully sorted ``sa`` only: where ties are left open, the slot before may share nothing.
    The text is cut into lanes that take their steps together; a lane's first step starts from nothing.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([text, np.zeros(cap + 16, np.uint8)]).astype(np.uint64)
    words = np.zeros(n + cap + 8, np.uint64)
    for k in range(8):
        words |= padded[k : k + len(words)] << np.uint64(8 * k)
    shared = np.zeros(n, np.int64)
    step = -(-n // lanes)
    lane = np.arange(0, n, step)
    length = np.zeros(len(lane), np.int64)
    for t in range(step):
        i = lane + t
        live = np.flatnonzero(i < n)
        j = before[np.minimum(i, n - 1)]
        length = np.maximum(length - 1, 0)
        length[j < 0] = 0
        live = live[j[live] >= 0]
        while len(live):
            x = words[i[live] + length[live]] ^ words[j[live] + length[live]]
            same = x == 0
            lowest = np.where(same, np.uint64(1), x & (~x + np.uint64(1)))
            length[live] += np.where(same, 8, (np.log2(lowest.astype(np.float64)) / 8).astype(np.int64))
            live = live[same & (length[live] < cap)]
        length = np.minimum(length, cap)
        length = np.minimum(length, n - np.maximum(np.minimum(i, n), j))
        length = np.maximum(length, 0)
        inside = i < n
        shared[i[inside]] = length[inside]
    return shared[sa]
