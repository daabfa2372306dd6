"""The pipeline: each stage against a brute-force version of its decision, on
odd rows and on the driver's documents; the registered entries."""

import re

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from trialscope.llm import quality_gam, quality_rules, registry, simhash

from . import fixtures as fx
from .test_duplicates import plain_components

SF = "/root/testdata/sf0.001"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    fx.labels(spark).write.parquet(f"{path}/labels.parquet")
    fx.docs(spark).write.parquet(f"{path}/documents.parquet")
    return path


def ids(df):
    return sorted(str(r.doc_id) for r in df.select("doc_id").collect())


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "exact_duplicates", "simhash_near_duplicates", "best_fit_packing"]


def test_every_stage_keeps_columns_and_decides_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = fx.labels(spark)
    rules = stage("quality_rules")(spark, docs, sf_dir)
    judged = quality_rules.quality_rules(docs, labels).collect()
    assert rules.schema == docs.schema
    assert ids(rules) == sorted(str(r.doc_id) for r in judged if r.kept)
    scored = quality_gam.quality(docs, labels).collect()
    good = stage("quality_classifier")(spark, docs, sf_dir)
    assert good.schema == docs.schema and ids(good) == sorted(str(r.doc_id) for r in scored if r.predicted)
    rows = fx.pairs(fx.edge_rows())
    exact = stage("exact_duplicates")(spark, docs, sf_dir)
    assert exact.schema == docs.schema
    best = {}
    for i, t in rows:  # the most code points, then the least doc_id
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[key] = min(best.get(key, (1, True, 0, None)), (-len(t), i is None, i or 0, i))
    got = {re.sub(r"[\x20\x09-\x0D]", "", r.text or ""): r for r in exact.collect()}
    assert len(got) == exact.count() == len(best)  # one row a group
    assert {k: (-len(r.text or ""), r.doc_id) for k, r in got.items()} == {k: (v[0], v[3]) for k, v in best.items()}
    fp = np.array([simhash.fingerprint(t.encode()) for _, t in rows], np.uint64)
    groups = {}
    for (i, t), g in zip(rows, plain_components(fp)):
        groups.setdefault(g, []).append(i)
    near = stage("simhash_near_duplicates")(spark, docs, sf_dir)
    assert near.schema == docs.schema
    names = sorted(str(min((i for i in m if i is not None), default=None)) for m in groups.values())
    assert ids(near) == names  # one row a group


def test_dedup_stages_leave_one_of_repeated_rows(spark, sf_dir):
    texts = {"a b c": 3, "d e f g": 2, "": 2}
    rows = [fx.row(1, t) for t, n in texts.items() for _ in range(n)]  # one doc_id for different texts
    rows += [fx.row(None, "n o id")] * 2 + [fx.row(2, "a b  c"), fx.row(0, None)]
    docs = fx.docs(spark, rows).repartition(5)
    exact = stage("exact_duplicates")(spark, docs, sf_dir).collect()
    assert sorted((str(r.doc_id), r.text) for r in exact) == sorted(
        [("2", "a b  c"), ("1", "d e f g"), ("0", None), ("None", "n o id")], key=str)
    near = stage("simhash_near_duplicates")(spark, docs, sf_dir).collect()
    assert sorted((str(r.doc_id), r.text) for r in near) == sorted(
        [("1", "a b c"), ("1", "d e f g"), ("0", None), ("None", "n o id")], key=str)


def test_every_stage_takes_an_empty_table(spark, sf_dir):
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, fx.docs(spark, []), sf_dir).count() == 0, name


def test_run_is_the_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SF)
    assert sorted(got.select(key).collect()) == sorted(docs.select(key).collect())
    assert got.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_run_on_odd_rows(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_registered():
    names = set(registry.queries())
    assert names <= set(entry.queries()) and "pipeline" in names
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert set(registry.oracle_sql()) <= names
