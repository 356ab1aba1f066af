"""Suffix arrays of byte segments in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np

#: Empty bytes after every segment; each is a symbol of its own, smaller than any text byte.
PAD = 8


def joined(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes plus one (a text byte is never 0xFF) with pads of 0 between segments; starts of the segments."""
    starts = np.cumsum([0] + [len(s) + PAD for s in segments])
    raw = np.frombuffer((bytes(PAD)).join(segments) + bytes(PAD), dtype=np.uint8)
    data = raw + np.uint8(1)
    ends = starts[1:] - PAD
    data[(ends[:, None] + np.arange(PAD)).ravel()] = 0
    return data, starts[:-1]


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one big-endian number (zeros beyond the end)."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.empty(len(data) + 8, dtype=np.uint64)
    for k in range(8):
        part = padded[k:k + (len(padded) - k) // 8 * 8].view(">u8")
        target = out[k::8]
        target[:] = part[:len(target)]
    return out[:len(data)]


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank) of ``data`` from :func:`joined`. Suffixes are sorted by
    eight symbols at first; then only groups still equal are sorted again, by the
    rank of the suffix as far on as they are known to agree, which doubles each time."""
    n = len(data)
    keys = words_at(data)
    pads = np.flatnonzero(data == 0)
    keys[pads] = np.arange(len(pads), dtype=np.uint64)  # all below 2^56: no text byte is 0 here
    sa = np.argsort(keys, kind="stable")
    ordered = keys[sa]
    fresh = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    head = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = head
    tied = ~(fresh & np.concatenate((fresh[1:], [True])))
    slots = np.flatnonzero(tied)
    h = 8
    while len(slots):
        pos = sa[slots]
        first, second = rank[pos], rank[pos + h]
        order = np.lexsort((second, first)) if n > 1 << 31 else np.argsort(first * n + second, kind="stable")
        pos, first, second = pos[order], first[order], second[order]
        sa[slots] = pos
        fresh = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        rank[pos] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        slots = slots[~(fresh & np.concatenate((fresh[1:], [True])))]
        h *= 2
    return sa, rank


def common_prefixes(data: np.ndarray, starts: np.ndarray, sa: np.ndarray, rank: np.ndarray, cap: int) -> np.ndarray:
    """For each position, the length (at most ``cap``) that its suffix shares with its
    predecessor in the suffix array, by Kasai's rule: one step to the right loses one
    symbol at most. All segments go side by side, each from its first position."""
    n = len(data)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    long = words_at(data)
    shared = np.zeros(n, dtype=np.int64)
    lens = np.diff(np.append(starts, n)) - PAD
    order = np.argsort(-lens, kind="stable")
    starts, lens = starts[order], lens[order]
    h = np.zeros(len(starts), dtype=np.int64)
    for step in range(int(lens[0]) if len(lens) else 0):
        k = int(np.searchsorted(-lens, -step, side="left"))  # segments longer than step
        at = starts[:k] + step
        h = np.maximum(h[:k] - 1, 0)
        prev = before[at]
        h[prev < 0] = 0
        live = np.flatnonzero((prev >= 0) & (h < cap))
        while len(live):
            i, j = at[live] + h[live], prev[live] + h[live]
            same = long[np.minimum(i, n - 1)] ^ long[np.minimum(j, n - 1)]
            whole = same == 0
            # pads differ from one another: nothing is shared from the first of them on
            more = np.where(whole, 8, 0)
            part = np.flatnonzero(~whole)
            if len(part):
                top = same[part]
                zeros = np.zeros(len(part), dtype=np.int64)
                for bits in (32, 16, 8):
                    low = top < (np.uint64(1) << np.uint64(64 - bits))
                    zeros += np.where(low, bits // 8, 0)
                    top = np.where(low, top << np.uint64(bits), top)
                more[part] = zeros
            more = np.minimum(more, _run_left(data, i, n))
            h[live] += more
            live = live[(more == 8) & (h[live] < cap)]
        h = np.minimum(h, cap)
        shared[at] = h
    return shared


def _run_left(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Symbols from ``at`` to the next pad, 8 at most."""
    window = data[np.minimum(at[:, None] + np.arange(8), n - 1)] == 0
    first = window.argmax(axis=1)
    return np.where(window.any(axis=1), first, 8)
