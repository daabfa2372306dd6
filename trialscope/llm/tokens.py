"""Whole texts to token ids with a public byte-level BPE of ``tokenizers``.

A text is cut before every space that follows a non-space character. The
pre-tokenizer always has a boundary there and looks ahead only, so the ids of
a text are the ids of its chunks in order. Equal chunks are found in Arrow and
encoded once per worker (a bounded memo); the ids of all texts are then
gathered with numpy. Texts for which the cut is not safe (white space before a
space, the marker character, an added token where it counts as one) are
encoded whole by the library.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

START = "\x02"          # marks the first chunk of a text, which has no leading space
MEMO_CHUNKS = 1_000_000  # chunks a worker remembers before it starts afresh
MEMO_PIECES = 500_000
UNSAFE = -1


def _byte_alphabet() -> dict[int, str]:
    """Byte -> visible character, the rule of byte-level BPE: printable Latin-1
    characters stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


# A chunk of plain words: word, stops, and perhaps a line break, word, stops.
# The letters are those below U+0250, where Unicode versions agree.
_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
PLAIN = (f"^(?P<a>{START}?[{_LETTERS}]+)(?P<b>[.,;:!?]*)"
         f"(?:(?P<c>\n)(?P<d>[{_LETTERS}]+)(?P<e>[.,;:!?]*))?$")


class _Memo:
    """Strings already encoded, and their ids end to end."""

    def __init__(self):
        self.keys = pa.array([], pa.string())
        self.at = self.n = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def add(self, keys: pa.Array, n: np.ndarray, ids: np.ndarray) -> None:
        real = np.maximum(n, 0)
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(real) - real])
        self.n = np.concatenate([self.n, n])
        self.ids = np.concatenate([self.ids, ids])
        self.keys = pa.concat_arrays([self.keys, keys])

    def gather(self, row: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The ids of the entries ``row``, of which n count, end to end."""
        before = np.cumsum(n) - n
        return self.ids[np.arange(int(n.sum())) + np.repeat(self.at[row] - before, n)]

    def rows(self, keys: pa.Array, learn) -> np.ndarray:
        """Entry of each (distinct) key; ``learn(new keys)`` gives (n, ids)."""
        known = pc.index_in(keys, value_set=self.keys)
        if not known.null_count:
            return known.to_numpy(zero_copy_only=False).astype(np.int64)
        gap = pc.is_null(known)
        first, new = len(self.keys), keys.filter(gap)
        self.add(new, *learn(new))
        row = known.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        row[gap.to_numpy(zero_copy_only=False)] = first + np.arange(len(new))
        return row


class TextEncoder:
    """``encode(texts)`` -> (offsets, ids): ids of text i are
    ``ids[offsets[i]:offsets[i + 1]]``. A special token that stands in a text
    is text, or with ``special`` its own id, as the library has it by default."""

    def __init__(self, path: str, special: bool = False):
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not special
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values() if special or not t.special]
        self.alphabet = _byte_alphabet()
        self.chunks, self.pieces = _Memo(), _Memo()

    def whole(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _learn_pieces(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of the pre-tokenizer; START marks one without leading space."""
        space, look, tokenize = self.alphabet[0x20], self.alphabet, self.tok.model.tokenize
        n, flat = np.zeros(len(keys), np.int64), []
        for i, key in enumerate(keys.to_pylist()):
            piece = key[1:] if key[0] == START else " " + key
            if piece.isascii() and piece.isalpha():
                ids = [t.id for t in tokenize(piece)]
            elif piece[1:].isalpha() and piece.isascii() and piece[0] == " ":
                ids = [t.id for t in tokenize(space + piece[1:])]
            else:
                ids = [t.id for t in tokenize("".join([look[b] for b in piece.encode()]))] if piece else ()
            flat += ids
            n[i] = len(ids)
        return n, np.array(flat, np.uint32)

    def _odd(self, chunk: str) -> list[int] | None:
        """Ids of a chunk that is no plain word; None where a cut is not safe."""
        lead = " "
        if chunk.startswith(START):
            chunk, lead = chunk[1:], ""
            if not chunk:
                return []
        if not chunk or chunk[-1].isspace():
            return None
        return [t.id for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(lead + chunk)
                for t in self.tok.model.tokenize(piece)]

    def _learn_chunks(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        groups = pc.extract_regex(keys, PLAIN)
        plain = pc.is_valid(groups)
        odd = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        own = [self._odd(c) for c in keys.take(pa.array(odd)).to_pylist()]
        groups = groups.filter(plain)
        # pieces of a plain chunk, in order; an absent one has no ids
        parts = [groups.field("a"), *(pc.binary_join_element_wise(START, groups.field(f), "")
                                      for f in "bcde")]
        coded = pa.concat_arrays(parts).dictionary_encode()
        if len(self.pieces.keys) >= MEMO_PIECES:
            self.pieces = _Memo()
        row = self.pieces.rows(coded.dictionary, self._learn_pieces)
        row = row[coded.indices.to_numpy(zero_copy_only=False)].reshape(5, -1).T
        each = self.pieces.n[row]
        n = np.zeros(len(keys), np.int64)
        n[plain.to_numpy(zero_copy_only=False)] = each.sum(axis=1)
        for i, ids in zip(odd, own):
            n[i] = UNSAFE if ids is None else len(ids)
        real = np.maximum(n, 0)
        ids = np.zeros(int(real.sum()), np.uint32)
        mine = np.zeros(len(keys), bool)
        mine[odd] = True
        mine = np.repeat(mine, real)
        ids[~mine] = self.pieces.gather(row.reshape(-1), each.reshape(-1))
        ids[mine] = [x for o in own if o for x in o]
        return n, ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.string()), "")
        n_texts = len(texts)
        if not n_texts:
            return np.zeros(1, np.int64), np.zeros(0, np.uint32)
        marked = pc.binary_join_element_wise(START, texts, "")
        lists = pc.split_pattern(marked, " ")
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary
        if len(self.chunks.keys) >= MEMO_CHUNKS:
            self.chunks = _Memo()
        row = self.chunks.rows(words, self._learn_chunks)
        row = row[coded.indices.to_numpy(zero_copy_only=False)]
        n = self.chunks.n[row]
        ends = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        ends -= ends[0]
        unsafe = pc.match_substring(texts, START).to_numpy(zero_copy_only=False).copy()
        for token in self.added:
            unsafe |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        text_of = None
        if (n == UNSAFE).any():
            text_of = np.repeat(np.arange(n_texts), np.diff(ends))
            unsafe[text_of[n == UNSAFE]] = True
        if unsafe.any():
            if text_of is None:
                text_of = np.repeat(np.arange(n_texts), np.diff(ends))
            n = np.where(unsafe[text_of], 0, n)
        offsets = np.concatenate([[0], np.cumsum(n)])[ends]
        ids = self.chunks.gather(row, n)
        if unsafe.any():
            parts, sizes = [], np.diff(offsets)
            done = 0
            for i in np.flatnonzero(unsafe):
                own = np.array(self.whole(texts[int(i)].as_py()), np.uint32)
                parts += [ids[done:offsets[i]], own]
                done, sizes[i] = offsets[i], len(own)
            ids = np.concatenate([*parts, ids[done:]])
            offsets = np.concatenate([[0], np.cumsum(sizes)])
        return offsets, ids


@functools.lru_cache(maxsize=1)
def encoder(path: str, special: bool = False) -> TextEncoder:
    """One encoder for each worker process and vocabulary file."""
    return TextEncoder(path, special)


def with_end(offsets: np.ndarray, ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts, each followed by ``end_id``."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
    return offsets + np.arange(n + 1), out
