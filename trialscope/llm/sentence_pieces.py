"""Operator 1: SentencePiece encoding and decoding by a shared-prefix Viterbi.

A text is cut into marked words (a run of marks, then other characters; a
space is a mark, and a text begins with one). Distinct words are sorted, so
that they stand in the order of a depth-first walk through their trie; the
forward states of the prefix that a word shares with the one before are kept,
and only the rest of the word is extended.

For a unigram model the forward state of a prefix is its best score and last
piece. A BPE model has no additive scores: there a path is possible if every
two neighbours can stand side by side in the order of the merges, and each
prefix has exactly one possible path, which is what merging gives. Its forward
state is that path's last piece. Both walks are the same code. Words with
several marks in a row are merged directly, as the pieces of marks share one
score.

Decoding is a table of bytes by piece, gathered with numpy.

Defined results: a null or empty text has no ids and decodes to ''; a mark
character U+2581 in a text reads as a space; bytes that are no UTF-8 decode to
U+FFFD; rows with equal doc_id are encoded apart; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from . import shared
from .tokens import UNSAFE, _Memo

MARK = "▁"
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$")
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NEVER = float("inf")
MEMO_WORDS = 1_000_000    # words that a worker remembers before it starts afresh
MEMO_BORDERS = 200_000  # borders between two pieces that a worker remembers


class _Ends:
    """The pieces of two characters and more that end at each place."""

    def __init__(self, pieces: Iterable[str]):
        self.longest, self.trie = 1, ahocorasick.Automaton()
        for p in pieces:
            if len(p) > 1:
                self.trie.add_word(p, (len(p), p))
                self.longest = max(self.longest, len(p))
        if len(self.trie):
            self.trie.make_automaton()

    def after(self, word: str, known: int) -> list[tuple[int, tuple[int, str]]]:
        """(last character, (length, piece)) of the pieces that end behind the
        first ``known`` characters: by their ends, at one end the longest first."""
        if not len(self.trie):
            return []
        found = self.trie.iter(word, max(0, known + 1 - self.longest))
        return [f for f in found if f[0] >= known]


class _Unigram:
    """Forward state of a prefix: (last piece, its length, best score)."""

    def __init__(self, score: dict[str, float], unknown: float):
        self.score, self.unknown = score, unknown
        self.ends = _Ends(score)

    start = ("", 0, 0.0)

    def extend(self, word: str, known: int, states: list) -> None:
        """The states of the prefixes longer than ``known``; of equal scores
        the shortest last piece."""
        found = self.ends.after(word, known)
        p = 0
        for i in range(known + 1, len(word) + 1):
            best = (word[i - 1], 1, states[i - 1][2] + self.score.get(word[i - 1], self.unknown))
            while p < len(found) and found[p][0] == i - 1:
                n, piece = found[p][1]
                total = states[i - n][2] + self.score[piece]
                if total > best[2] or (total == best[2] and n < best[1]):
                    best = (piece, n, total)
                p += 1
            states.append(best)


class _Merges:
    """Forward state of a prefix: (last piece, its length)."""

    def __init__(self, score: dict[str, float]):
        self.rank = {p: -s for p, s in score.items() if len(p) > 1}
        self.longest = max(map(len, score), default=1)
        # every piece that merging its characters gives back, with the pieces
        # at its right and left end in the order they form, and when they do
        self.right: dict[str, list[tuple[str, float]]] = {}
        self.left: dict[str, list[tuple[str, float]]] = {}
        for piece in sorted(self.rank, key=len):
            parts = self.merge(piece, until=piece)
            if len(parts) == 2:
                a, b = parts
                r = self.rank[piece]
                self.right[piece] = [*self.right.get(b, [(b, 0.0)]), (piece, r)]
                self.left[piece] = [*self.left.get(a, [(a, 0.0)]), (piece, r)]
        self.beside: dict[tuple[str, str], bool] = {}
        self.ends = _Ends(self.right)

    start = ("", 0)

    def merge(self, word: str, until: str | None = None) -> list[str]:
        """Merge neighbours, best score first, then leftmost; ``until`` stops
        before that piece would form."""
        parts = list(word)
        while len(parts) > 1:
            r, k = min((self.rank.get(a + b, NEVER), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if r == NEVER or (len(parts) == 2 and until == parts[0] + parts[1]):
                break
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def fits(self, a: str, b: str) -> bool:
        """No merge crosses the border of a|b while both form: the pieces at
        the border grow in the order of the ranks, and no pair that meets
        there ranks before the next growth (of equal ranks, the left first)."""
        key = (a, b)
        known = self.beside.get(key)
        if known is None:
            xs, ys = self.right.get(a, [(a, 0.0)]), self.left.get(b, [(b, 0.0)])
            i = j = 0
            known = True
            while True:
                grow_a = xs[i + 1][1] if i + 1 < len(xs) else NEVER
                grow_b = ys[j + 1][1] if j + 1 < len(ys) else NEVER
                r = self.rank.get(xs[i][0] + ys[j][0], NEVER)
                if r < grow_a and r <= grow_b and r != NEVER:
                    known = False
                    break
                if grow_a == grow_b == NEVER:
                    break
                if grow_a <= grow_b:
                    i += 1
                else:
                    j += 1
            if len(self.beside) >= MEMO_BORDERS:
                self.beside.clear()
            self.beside[key] = known
        return known

    def extend(self, word: str, known: int, states: list) -> None:
        """The states of the prefixes longer than ``known``: the longest last
        piece that can stand beside the one before it."""
        found, beside, p = self.ends.after(word, known), self.beside, 0
        many = len(found)
        for i in range(known + 1, len(word) + 1):
            state = None
            while p < many and found[p][0] < i:
                if state is None:
                    n, piece = found[p][1]
                    if n == i:
                        state = (piece, n)
                    else:
                        before = states[i - n][0]
                        fits = beside.get((before, piece))
                        if fits or (fits is None and self.fits(before, piece)):
                            state = (piece, n)
                p += 1
            states.append(state or (word[i - 1], 1))


def _shared(a: str, b: str) -> int:
    """Length of the prefix that two words share."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class PieceCodec:
    """Encodes and decodes with one model file."""

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("only models with the identity normaliser and a leading mark are encoded here")
        if not spec.byte_fallback or spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models with byte fallback are encoded here")
        score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in score):
            raise ValueError("a piece of this model goes beyond a marked word")
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.byte_id = np.zeros(256, np.int64)
        raw = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                b = int(p.piece[3:5], 16)
                self.byte_id[b] = i
                raw.append(bytes([b]))
            else:
                raw.append(b"" if p.type == CONTROL else spec.unk_surface.encode() if p.type == UNKNOWN
                           else p.piece.replace(MARK, " ").encode())
        self.bytes_n = np.array([len(b) for b in raw], np.int64)
        self.bytes_at = np.cumsum(self.bytes_n) - self.bytes_n
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.marked = np.array([p.type == NORMAL and p.piece.startswith(MARK) for p in model.pieces] + [False])
        self.score, self.bpe = score, spec.model_type == BPE
        self.words = _Memo()

    @functools.cached_property
    def walk(self) -> _Merges | _Unigram:
        """Made when first needed: workers that only decode stay small."""
        return (_Merges(self.score) if self.bpe else
                _Unigram(self.score, min(self.score.values(), default=0.0) - 10.0))

    def _ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            i = self.id_of.get(p)
            if i is not None:
                out.append(i)
            else:
                out += self.byte_id[list(p.encode())].tolist()
        return out

    def encode_sorted(self, words: list[str]) -> Iterator[list[str]]:
        """Pieces of each of the sorted words, walking their trie depth first."""
        walk, before, states = self.walk, "", [self.walk.start]
        for word in words:
            shared_n = _shared(before, word)
            del states[shared_n + 1:]
            walk.extend(word, shared_n, states)
            before, pieces, i = word, [], len(word)
            while i:
                state = states[i]
                pieces.append(state[0])
                i -= state[1]
            pieces.reverse()
            yield pieces

    def word_ids(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of distinct marked words, in any order."""
        odd = {w for w in words if MARK in w[1:]} if isinstance(self.walk, _Merges) else set()
        plain = sorted(w for w in words if w not in odd)
        out = {w: self._ids(p) for w, p in zip(plain, self.encode_sorted(plain))}
        return out | {w: self._ids(self._merge_marks(w)) for w in odd}

    def _merge_marks(self, word: str) -> list[str]:
        """A word behind several marks. Marks merge last; the last one belongs
        to the word as far as merging goes."""
        marks = len(word) - len(word.lstrip(MARK))
        if marks == len(word):
            return self._runs(marks)
        inner = next(self.encode_sorted([word[marks - 1:]]))
        if inner[0] == MARK:  # the last mark stayed alone and joins the run
            return self._runs(marks) + inner[1:]
        return self._runs(marks - 1) + inner

    def _runs(self, n: int) -> list[str]:
        """Equal scores merge leftmost first: the longest pieces from the left."""
        out = []
        while n:
            k = next(k for k in range(min(n, self.walk.longest), 0, -1) if k == 1 or MARK * k in self.walk.rank)
            out.append(MARK * k)
            n -= k
        return out

    def _learn(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = keys.to_pylist()
        ids = self.word_ids([MARK + w for w in words if w])
        found = [ids[MARK + w] if w else None for w in words]
        n = np.array([UNSAFE if f is None else len(f) for f in found], np.int64)
        return n, np.array([x for f in found if f for x in f], np.uint32)

    def whole(self, text: str) -> list[int]:
        """Ids of one text, for any white space."""
        words = WORDS.findall((MARK + text).replace(" ", MARK)) if text else []
        ids = self.word_ids(list(set(words)))
        return [x for w in words for x in ids[w]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i are ids[offsets[i]:offsets[i + 1]]."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        if len(self.words.keys) >= MEMO_WORDS:
            self.words = _Memo()
        row = self.words.rows(coded.dictionary, self._learn)[coded.indices.to_numpy(zero_copy_only=False)]
        n = self.words.n[row]
        ends = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        ends -= ends[0]
        text_of = np.repeat(np.arange(len(texts)), np.diff(ends))
        own = pc.match_substring(texts, MARK).to_numpy(zero_copy_only=False).copy()
        own[text_of[n == UNSAFE]] = True  # an empty chunk: two spaces, or one at an end
        n = np.where(own[text_of], 0, n)
        offsets = np.concatenate([[0], np.cumsum(n)])[ends]
        ids = self.words.gather(row, n)
        if own.any():
            parts, sizes, done = [], np.diff(offsets), 0
            for i in np.flatnonzero(own):
                one = np.array(self.whole(texts[int(i)].as_py()), np.uint32)
                parts += [ids[done:offsets[i]], one]
                done, sizes[i] = offsets[i], len(one)
            ids = np.concatenate([*parts, ids[done:]])
            offsets = np.concatenate([[0], np.cumsum(sizes)])
        return offsets, ids

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> list[str]:
        """Texts of the ids; the mark that begins a text is dropped."""
        n = self.bytes_n[ids]
        before = np.concatenate([[0], np.cumsum(n)])
        raw = self.bytes[np.arange(int(before[-1])) + np.repeat(self.bytes_at[ids] - before[:-1], n)].tobytes()
        at = before[offsets]
        first = np.searchsorted(before, at[:-1], side="right") - 1  # the id that gives a text's first byte
        drop = self.marked[np.append(ids, -1)[first]] & (at[:-1] < at[1:])
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip((at[:-1] + drop).tolist(), at[1:].tolist())]


@functools.lru_cache(maxsize=1)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.text_slices(batches):
            offsets, ids = codec(path).encode(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)),
                                                                 pa.array(ids.astype(np.int32)))],
                names=["doc_id", "ids"])
    return run


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids) of every whole text."""
    return shared.id_text(docs).mapInArrow(_encoder(model), "doc_id long, ids array<int>")


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = part.column("ids")
                offsets = ids.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
                flat = ids.flatten().to_numpy(zero_copy_only=False)
                texts = codec(path).decode(offsets - offsets[0], flat)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.array(texts, pa.string())],
                                                 names=["doc_id", "ids", "text"])
    return run


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, text) for rows (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoder(model), "doc_id long, ids array<int>, text string")
