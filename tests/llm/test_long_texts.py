"""Texts beyond the slice of 4 MB that Python steps hold: every operator that
reads texts takes them whole."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from trialscope.llm import exact_dedup, merkle, quality_rules, shared, simhash, superminhash, token_counts

from . import fixtures as fx
from .test_duplicates import plain_exact, plain_fingerprint
from .test_merkle import plain as plain_merkle
from .test_quality import plain_counts
from .test_superminhash import plain as plain_groups


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(3000)]
    long = " ".join(rng.choice(words) + ("\n" if rng.random() < 0.05 else "") for _ in range(900_000))
    assert len(long) > shared.SLICE_BYTES + (1 << 20)
    near = long.replace(words[0], "other")
    texts = ["short text of a few words", long, near, " " + long, "", long[:5000], None]
    return [fx.row(k, t) for k, t in enumerate(texts)]


def test_slices_hold_one_long_text_or_few_bytes(rows):
    texts = [r[1] or "" for r in rows] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    parts = list(shared.text_slices(iter([batch])))
    assert [i for p in parts for i in p.column("doc_id").to_pylist()] == list(range(len(texts)))
    for p in parts:
        assert p.num_rows == 1 or sum(len(t) for t in p.column("text").to_pylist()) <= shared.SLICE_BYTES


def test_duplicates_of_long_texts(spark, rows):
    docs, pairs = fx.docs(spark, rows), fx.pairs(rows)
    assert Counter(map(tuple, exact_dedup.exact_duplicates(docs).collect())) == plain_exact(pairs)
    got = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: format(plain_fingerprint(t), "016x") for i, t in pairs}
    assert Counter(map(tuple, superminhash.near_duplicates(docs).collect())) == plain_groups(pairs)
    assert exact_dedup.keep_first(docs).count() == 5 and docs.schema == exact_dedup.keep_first(docs).schema


def test_manifest_rules_and_tokens_of_long_texts(spark, rows):
    docs, pairs = fx.docs(spark, rows), fx.pairs(rows)
    assert Counter(map(tuple, merkle.manifest_proofs(docs).collect())) == plain_merkle([r[:5] for r in rows])
    got = {r.doc_id: tuple(r)[1:6] for r in quality_rules.quality_rules(docs, fx.labels(spark, [])).collect()}
    assert got == {i: plain_counts(t) for i, t in pairs}
    lengths = {r.doc_id: r.n_tokens for r in token_counts.encoded_lengths(docs, fx.BYTE_BPE).collect()}
    bpe = Tokenizer.from_file(fx.BYTE_BPE)
    assert lengths == {i: len(bpe.encode(t, add_special_tokens=False).ids) for i, t in pairs}
