"""The registered queries encode as the library does by default: an added token
that stands in a text is its own id."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from trialscope.llm import registry
from trialscope.llm.tokens import encoder

from . import fixtures as fx

TEXTS = ["<|endoftext|>", "one <|endoftext|> two", "a<|endoftext|>b  c\n", "<|endoftext|><|endoftext|> end", "<|endoftext", "plain"]


@pytest.fixture(scope="module")
def default():
    tok = Tokenizer.from_file(fx.BYTE_BPE)
    return lambda text: tok.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("special"))
    fx.docs(spark, [fx.row(k, t) for k, t in enumerate(TEXTS)]).write.parquet(f"{path}/documents.parquet")
    return path


def test_ids_equal_the_library(default):
    texts = TEXTS + [t or "" for t in fx.texts()]
    offsets, ids = encoder(fx.BYTE_BPE, True).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [default(t) for t in texts]
    assert 50256 in ids


def test_registered_queries(spark, sf_dir, default):
    coded = [np.array(default(t) + [0], "<u4") for t in TEXTS]
    want = Counter((k, zlib.crc32(c.tobytes())) for k, c in enumerate(coded))
    packed = registry.queries()["op4_best_fit_packing"](spark, sf_dir)
    stage = dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    files = registry.queries()["op9_token_files"](spark, sf_dir)
    for got in (packed, stage, files):
        assert Counter((r.doc_id, r.ids_crc32) for r in got.collect()) == want
    counts = registry.queries()["op2_token_counts"](spark, sf_dir).where("asked = 'length'").collect()
    assert {r.n_tokens: r.n_docs for r in counts} == Counter(len(c) - 1 for c in coded)
