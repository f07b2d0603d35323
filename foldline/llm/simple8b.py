"""Simple-8b word-aligned coding of integer arrays, vectorised with numpy.

A 64-bit word has a 4-bit selector and 60 bits of payload: ``COUNT[s]`` values of ``WIDTH[s]`` bits,
least significant first. Selector 0 is the escape: the payload is the index of one value of 60 bits
or more in the list of exceptions. Values are cut into blocks of BLOCK; every block starts a new
word, and the first word of each block is listed, so that all blocks are coded and decoded together.
The last word of a block may have fewer values than its selector says; the rest is zero.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
# Values in a word, and their bits, by selector (0 is the escape).
COUNT = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTH = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)


PART = 256 * BLOCK  # values coded together; small enough for the processor's cache
_SMALL = np.array([v.bit_length() for v in range(1 << 16)], np.int8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    if not len(values) or values.max() < len(_SMALL):
        return _SMALL[values.astype(np.int64)]
    bits = np.zeros(len(values), np.int8)
    for shift in (32, 16, 8, 4, 2, 1):
        large = (values >> np.uint64(shift)) > 0
        bits[large] += shift
        values = np.where(large, values >> np.uint64(shift), values)
    return bits + (values > 0)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block and their total, exceptions) of uint64 values."""
    values = np.ascontiguousarray(values, np.uint64)
    words, firsts, exceptions, count, known = [], [], [], 0, 0
    for at in range(0, len(values), PART):
        part, first, odd = _encode_part(values[at: at + PART], known)
        words.append(part)
        firsts.append(first + count)
        exceptions.append(odd)
        count, known = count + len(part), known + len(odd)
    empty = np.zeros(0, np.uint64)
    first = np.concatenate([*firsts, np.array([count])]).astype(np.int64)
    return np.concatenate([empty, *words]), first, np.concatenate([empty, *exceptions])


def _encode_part(values: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    total = len(values)
    blocks = -(-total // BLOCK)
    bits = _bit_lengths(values)
    escaped = bits > 60
    exceptions = values[escaped]
    if len(exceptions):
        values = values.copy()
        values[escaped] = np.arange(known, known + len(exceptions), dtype=np.uint64)
    # widest packing from each position: enough values before the next that is too wide
    place = np.arange(total, dtype=np.int32)
    end = np.minimum((place // BLOCK + 1) * BLOCK, total).astype(np.int32)
    left = end - place
    choice = np.zeros(total, np.int8)
    for s in range(len(COUNT) - 1, 0, -1):
        wide = bits > WIDTH[s]
        if COUNT[s] > 5:  # no run of so many narrow values: other selectors serve, also at a block's end
            at = np.flatnonzero(wide)
            if len(at) and np.diff(at, prepend=-1, append=total).max() <= COUNT[s]:
                continue
        if wide.any():
            after = np.minimum.accumulate(np.where(wide, place, np.int32(total))[::-1])[::-1]
            room = np.minimum(after, end) - place
            choice[(room >= COUNT[s]) | ((room == left) & (room > 0))] = s
        else:
            choice[:] = s
    choice[escaped] = 0
    # all blocks step from word to word together
    at = np.arange(blocks, dtype=np.int64) * BLOCK
    last = np.minimum(at + BLOCK, total)
    starts = []
    while len(at):
        starts.append(at)
        at = at + COUNT[choice[at]]
        live = at < last
        at, last = at[live], last[live]
    start = np.sort(np.concatenate(starts))
    selector = choice[start].astype(np.int64)
    words = selector.astype(np.uint64) << np.uint64(60)
    limit = np.minimum((start // BLOCK + 1) * BLOCK, total)
    padded = np.concatenate([values, np.zeros(1, np.uint64)])
    for s in np.unique(selector):
        rows = np.flatnonzero(selector == s)
        source = start[rows, None] + np.arange(COUNT[s])
        taken = padded[np.where(source < limit[rows, None], source, total)]
        words[rows] |= np.bitwise_or.reduce(taken << (np.arange(COUNT[s], dtype=np.uint64) * np.uint64(WIDTH[s])), axis=1)
    return words, np.searchsorted(start, np.arange(blocks) * BLOCK), exceptions


def decode(words: np.ndarray, first: np.ndarray, exceptions: np.ndarray, total: int) -> np.ndarray:
    """The ``total`` values of ``encode``'s result."""
    out = np.zeros(total, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    payload = words & np.uint64((1 << 60) - 1)
    counts = COUNT[selector]
    sums = np.concatenate([[0], np.cumsum(counts)])
    block = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start = block * BLOCK + sums[:-1] - sums[first[:-1]][block]
    limit = np.minimum((block + 1) * BLOCK, total)
    for s in range(len(COUNT)):
        rows = np.flatnonzero(selector == s)
        mask = np.uint64((1 << int(WIDTH[s])) - 1)
        for j in range(COUNT[s] if len(rows) else 0):
            target = start[rows] + j
            inside = target < limit[rows]
            value = (payload[rows] >> np.uint64(j * WIDTH[s])) & mask
            out[target[inside]] = exceptions[value[inside].astype(np.int64)] if s == 0 else value[inside]
    return out
