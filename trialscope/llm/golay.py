"""Nearby codewords of the perfect binary Golay code (23, 12, 7).

Every 23-bit word has one codeword within 3 bits. Its keys are the indices of
all codewords within 4 bits: one key, or six if the nearest codeword differs
in 3 bits. Two words that differ in at most 2 bits share a key.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np

GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
BITS, INFO, CHECK = 23, 12, 11


def _rest(words: np.ndarray) -> np.ndarray:
    """Remainder of polynomials of degree below 23 modulo the generator."""
    out = words.copy()
    for b in range(BITS - 1, CHECK - 1, -1):
        out = np.where(out >> b & 1, out ^ (GENERATOR << (b - CHECK)), out)
    return out


@functools.lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(remainders of the low 12 bits, of the high 11 bits, number of keys of a
    remainder, what to add to a word for each key)."""
    low, high = _rest(np.arange(1 << INFO)), _rest(np.arange(1 << CHECK) << INFO)
    info = np.arange(1 << INFO) << CHECK
    code = info | _rest(info)
    sevens = code[np.bitwise_count(code) == 7]
    number, add = np.ones(1 << CHECK, np.int64), np.zeros((1 << CHECK, 6), np.int64)
    for weight in range(4):
        for bits in combinations(range(BITS), weight):
            error = sum(1 << b for b in bits)
            s = int(_rest(np.array([error]))[0])
            add[s, 0] = error
            if weight == 3:  # the five codewords of weight 7 that hold these bits
                near = sevens[(sevens & error) == error]
                number[s], add[s, 1:] = 1 + len(near), error ^ near
    return low, high, number, add


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the 12-bit keys of each 23-bit word."""
    low, high, number, add = tables()
    s = low[words & ((1 << INFO) - 1)] ^ high[words >> INFO]
    n = number[s]
    row = np.repeat(np.arange(len(words)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return row, (words[row] ^ add[s[row], k]) >> CHECK
