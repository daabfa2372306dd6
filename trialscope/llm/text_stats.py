"""Counts over whole texts and lines that the quality operators use.

Words are ``[^\\x20\\x09-\\x0D]+``; a text is handled as its UTF-8 bytes, whose
white space is exactly that class."""

from __future__ import annotations

from operator import eq

import numpy as np

SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(0x41, 0x5B))
DIGITS = b"0123456789"
STOPS = b".!?"
LATER_BYTES = bytes(range(0x80, 0xC0))  # bytes of a code point after its first
WINDOW = 8


def count(raw: bytes, of: bytes) -> int:
    return len(raw) - len(raw.translate(None, of))


def code_points(raw: bytes) -> int:
    return len(raw.translate(None, LATER_BYTES))


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that stand twice or more in the text, the first
    one included. Equal windows are found exactly: runs of 1, 2, 4, ... words
    are numbered by their value."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    code = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    width = 1
    while width < window:
        step = min(width, window - width)
        code = code[:len(code) - step] * (int(code.max()) + 1) + code[step:]
        _, code, times = np.unique(code, return_inverse=True, return_counts=True)
        if len(times) == len(code):
            return 0
        width += step
    begin = np.flatnonzero(times[code] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def dup_lines(lines: list[bytes]) -> int:
    """Lines with a word that equal an earlier line."""
    filled = [x for x in lines if x.strip(SPACE)]
    return len(filled) - len(set(filled))


def base(raw: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words = raw.split()
    return (len(words), code_points(raw.translate(None, SPACE)), count(raw, SYMBOLS),
            dup_lines(raw.split(b"\n")), repeat_words(words))


FEATURES = ("log_words", "word_length", "symbols", "exclamations", "adjacent_equal", "distinct", "upper",
            "digits", "dup_lines", "line_words", "repeat_words", "stopped_lines", "short_words", "non_ascii",
            "punctuation", "longest_line")


def features(raw: bytes) -> tuple[float, ...]:
    """A text's numbers for the quality classifier, in the order of FEATURES."""
    words = raw.split()
    n = max(1, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    k = max(1, len(lines))
    dense = raw.translate(None, SPACE)
    chars = max(1, code_points(dense))
    return (np.log2(1 + len(words)), chars / n, count(dense, SYMBOLS) / n, dense.count(b"!") / n,
            sum(map(eq, words, words[1:])) / n, len(set(words)) / n, count(dense, UPPER) / chars,
            count(dense, DIGITS) / chars, (len(lines) - len(set(lines))) / k, len(words) / k,
            repeat_words(words) / n, sum(x.rstrip(SPACE)[-1:] in (b".", b"!", b"?") for x in lines) / k,
            sum(len(w) <= 3 for w in words) / n, count(dense, LATER_BYTES) / chars,
            count(dense, b".,;:?'\"()-") / n, max(map(len, lines), default=0) / max(1, len(raw)))
