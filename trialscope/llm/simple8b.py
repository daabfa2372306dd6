"""Simple-8b word-aligned coding of token ids, vectorised with numpy.

Ids are coded in blocks of ``BLOCK``. A 64-bit word holds a 4-bit selector and
as many ids as fit at one width; the selector is taken greedily, largest count
first, and a block starts a new word, so blocks decode independently. An id
that needs more than 20 bits is written as the escape code (20 ones) and kept
in full in the block's escape list.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4096
# Fixed values of the format. Selector -> (ids in a word, bits of an id);
# selectors 0 and 1 are runs of zero ids without payload.
SELECTORS = ((240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5),
             (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20))
ESCAPE = (1 << 20) - 1
WIDEST = 20


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits each id needs, at most WIDEST."""
    w = np.zeros(ids.shape, np.uint8)
    for b in range(WIDEST):
        top = ids >= np.uint64(1 << b)
        if not top.any():
            break
        w += top
    return w


def _selectors(width: np.ndarray) -> np.ndarray:
    """Best selector at every position of rows padded with zero widths."""
    span = {1: width}

    def widest(n: int) -> np.ndarray:
        """Largest width among the n ids from each position on."""
        if n not in span:
            a = max(k for k in span if k < n)
            b = n - a if n - a in span else a  # two windows that cover n, overlapping or not
            left, right = span[a], span[b]
            out = left.copy()
            np.maximum(left[:, :width.shape[1] - (n - b)], right[:, n - b:],
                       out=out[:, :width.shape[1] - (n - b)])
            span[n] = out
        return span[n]

    for n in (2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 120, 240):
        widest(n)
    best = np.full(width.shape, len(SELECTORS) - 1, np.uint8)
    for s in range(len(SELECTORS) - 2, -1, -1):
        n, bits = SELECTORS[s]
        best[span[n] <= bits] = s
    return best


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, words_at, escapes, escapes_at): block b's words are
    ``words[words_at[b]:words_at[b + 1]]``, likewise its escapes."""
    ids = np.ascontiguousarray(ids, np.uint64)
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        zero = np.zeros(1, np.int64)
        return np.zeros(0, np.uint64), zero, np.zeros(0, np.uint64), zero
    pad = SELECTORS[0][0]
    rows = np.zeros((blocks, BLOCK + pad), np.uint64)
    rows[:, :BLOCK].flat[:len(ids)] = ids
    size = np.full(blocks, BLOCK, np.int64)
    size[-1] = len(ids) - (blocks - 1) * BLOCK
    wide = rows >= ESCAPE
    escapes = rows[wide]
    escapes_at = np.concatenate([[0], np.cumsum(wide.sum(axis=1))]).astype(np.int64)
    rows[wide] = ESCAPE
    best = _selectors(_widths(rows))
    # all blocks step from word to word together
    count = np.array([n for n, _ in SELECTORS], np.int64)
    live, at = np.arange(blocks), np.zeros(blocks, np.int64)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    while len(live):
        steps.append((live, at))
        at = at + count[best[live, at]]
        more = at < size[live]
        live, at = live[more], at[more]
    block = np.concatenate([b for b, _ in steps])
    start = np.concatenate([a for _, a in steps])
    order = np.argsort(block, kind="stable")
    block, start = block[order], start[order]
    words_at = np.concatenate([[0], np.cumsum(np.bincount(block, minlength=blocks))]).astype(np.int64)
    flat, at = rows.reshape(-1), block * (BLOCK + pad) + start
    chosen = best[block, start]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s, (n, bits) in enumerate(SELECTORS):
        if bits and (rows_of := np.flatnonzero(chosen == s)).size:
            word = words[rows_of]
            for k in range(n):
                word |= flat[at[rows_of] + k] << np.uint64(k * bits)
            words[rows_of] = word
    return words, words_at, escapes, escapes_at


def decode(words: np.ndarray, words_at: np.ndarray, escapes: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of consecutive blocks, of which the last may be short."""
    if not n_ids:
        return np.zeros(0, np.uint64)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    n = np.array([c for c, _ in SELECTORS], np.int64)[chosen]
    before = np.cumsum(n) - n
    first = words_at[:-1]
    # a word's place: its place in its block, plus the block's place
    block = np.repeat(np.arange(len(first)), np.diff(words_at))
    place = before - before[first][block] + block * BLOCK
    out = np.zeros(len(first) * BLOCK + SELECTORS[0][0], np.uint64)
    for s, (count, bits) in enumerate(SELECTORS):
        if bits and (rows_of := np.flatnonzero(chosen == s)).size:
            word, at, mask = words[rows_of], place[rows_of], np.uint64((1 << bits) - 1)
            end = (block[rows_of] + 1) * BLOCK
            for k in range(count):
                inside = at + k < end  # what lies beyond the block is padding
                out[at[inside] + k] = (word[inside] >> np.uint64(k * bits)) & mask
    out = out[:n_ids]
    if len(escapes):
        out[out == ESCAPE] = escapes
    return out
