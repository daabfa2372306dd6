"""Operators 5, 7 and 8: counts against brute force, decoding against an
exhaustive search, learning on held-out rows."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from trialscope.llm import quality_gam, quality_rules, text_stats, toxicity
from trialscope.llm.shared import id_text

from . import fixtures as fx

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words, seen, repeated = WORD.findall(text), {}, set()
    for k in range(len(words) - 7):
        seen.setdefault(tuple(words[k:k + 8]), []).append(k)
    for at in seen.values():
        if len(at) > 1:
            repeated.update(*(range(k, k + 8) for k in at))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(repeated))


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_counts():
    rng = random.Random(1)
    few = ["a", "b", "é", "|", "x#", "\n", "\r\n", "\x0b", " "]
    for text in [t or "" for t in fx.texts()] + [" ".join(rng.choices(few, k=rng.randint(0, 60))) for _ in range(400)]:
        assert text_stats.base(text.encode()) == plain_counts(text)


def test_quality_rules_over_a_table(spark):
    got = quality_rules.quality_rules(fx.docs(spark), fx.labels(spark)).collect()
    want = sorted((i is not None, i or 0, *plain_counts(t)) for i, t in fx.pairs(fx.edge_rows()))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.content_words >= quality_rules.CONTENT_SHARE * r.n_words)
    assert any(r.kept for r in got) and any(r.base_failed for r in got)
    assert quality_rules.quality_rules(fx.docs(spark, []), fx.labels(spark)).count() == 0


def test_rows_pass_whole(spark):
    docs, labels = fx.docs(spark), fx.labels(spark, [])
    kept = quality_rules.keep_passing(docs, labels)
    assert kept.schema == docs.schema
    judged = [r[:2] for r in quality_rules.quality_rules(docs, labels).select("kept", "doc_id").collect()]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for k, i in judged if k)
    good = quality_gam.keep_good(docs, labels, threshold=0.9)
    assert good.schema == docs.schema and good.count() == 0  # without labels every score is 0.5
    assert quality_gam.keep_good(docs, labels, threshold=0.5).count() == docs.count()


def model_of(rng):
    return {"emit": rng.normal(size=(quality_rules.WIDTH, 2)).tolist(), "move": rng.normal(size=(2, 2)).tolist(),
            "first": rng.normal(size=2).tolist()}


def path_score(model, feats, path):
    emit = np.array(model["emit"])
    return (model["first"][path[0]] + sum(emit[f, s].sum() for f, s in zip(feats, path))
            + sum(model["move"][a][b] for a, b in zip(path, path[1:])))


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(0)
    for n in range(1, 9):
        for _ in range(10):
            model, feats = model_of(rng), rng.integers(0, quality_rules.WIDTH, (n, len(quality_rules.LINE_BINS)))
            got = path_score(model, feats, quality_rules.viterbi(model, feats))
            best = max(path_score(model, feats, p) for p in itertools.product((0, 1), repeat=n))
            assert got == pytest.approx(best)


def test_crf_learns_emissions_and_moves():
    rng = np.random.default_rng(1)
    noise = lambda n: rng.integers(0, quality_rules.WIDTH, (n, len(quality_rules.LINE_BINS)))
    docs = []
    for k in range(200):
        feats = noise(int(rng.integers(1, 12)))
        feats[:, 0] = np.where(rng.random(len(feats)) < 0.8, k % 2, 2 + k % 2)
        docs.append((feats, k % 2))
    model = quality_rules.fit_crf(docs)
    hits = [(quality_rules.viterbi(model, x) == y).mean() for x, y in docs]
    assert np.mean(hits) > 0.97 and model["move"][0][0] > model["move"][0][1]
    one = quality_rules.fit_crf([d for d in docs if d[1]])
    assert all((quality_rules.viterbi(one, x) == 1).all() for x, _ in docs[:20])
    assert (quality_rules.viterbi(quality_rules.fit_crf([]), docs[0][0]) == 1).all()


def plain_line_features(lines):
    seen, out = set(), []
    for line in lines:
        text = line.decode()
        words = WORD.findall(text)
        n, size = len(words), max(1, len(line))
        share = lambda cls: len(re.findall(cls, text))
        values = (n, share(r"[#*$%&|<>]") / max(1, n), text.count("!") / max(1, n), share("[A-Z]") / size,
                  sum(a == b for a, b in zip(words, words[1:])) / max(1, n), len(set(words)) / n if n > 7 else 1.0,
                  share("[0-9]") / size, float(n > 0 and line in seen),
                  float(bool(re.search(r"[.!?][ \t\n\x0b\x0c\r]*$", text))), size / max(1, n))
        seen |= {line} if n else set()
        at = 0
        row = []
        for v, (_, bounds) in zip(values, quality_rules.LINE_BINS):
            row.append(at + sum(v > b for b in bounds))
            at += len(bounds) + 1
        out.append((row, n))
    return out


def test_line_features():
    texts = [t or "" for t in fx.texts()] + ["!! a a a B7 #|", "x\nx\n \n\nEnd.  \r\nA b c d e f g h a a", "\n"]
    for text in texts:
        lines = text.encode().split(b"\n")
        feats, words = quality_rules.line_features(lines)
        assert [(f, w) for f, w in zip(feats.tolist(), words.tolist())] == plain_line_features(lines)


def test_expected_counts_equal_the_sum_over_all_paths():
    rng = np.random.default_rng(5)
    model = {k: np.array(v) for k, v in model_of(rng).items()}
    size = np.array([6, 3, 3, 1])
    feats = rng.integers(0, quality_rules.WIDTH, (int(size.sum()), len(quality_rules.LINE_BINS)))
    want = {k: np.zeros_like(v) for k, v in model.items()}
    logs = []
    for a, n in zip(np.cumsum(size) - size, size):
        paths = list(itertools.product((0, 1), repeat=int(n)))
        weight = np.exp([path_score(model, feats[a:a + n], p) for p in paths])
        logs.append(np.log(weight.sum()))
        for p, w in zip(paths, weight / weight.sum()):
            want["first"][p[0]] += w
            for f, s in zip(feats[a:a + n], p):
                np.add.at(want["emit"][:, s], f, w)
            for s, t in zip(p, p[1:]):
                want["move"][s, t] += w
    got, total = quality_rules.expected(model, feats, size)
    assert np.allclose(total, logs) and all(np.allclose(got[k], want[k]) for k in want)


def held_out_texts():
    import duckdb
    sf = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"SELECT doc_id, text, quality FROM '{sf}/documents.parquet' JOIN '{sf}/labels.parquet' "
                      "USING (doc_id) WHERE quality IS NOT NULL ORDER BY 1").fetchall()
    return [(t, y) for i, t, y in rows if held(i)]


def test_mixed_documents_of_the_held_out_fold(spark):
    """Whole texts of one label inside texts of the other: both kinds of lines
    are found, and `kept` agrees with the labels of texts as they are."""
    sf = "/root/testdata/sf0.1"
    model = quality_rules.fit(*(spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels")))
    rows = held_out_texts()
    kept = [[quality_rules.verdict(t.encode(), model)[5:7] for t, y in rows if y == kind] for kind in (0, 1)]
    passed = [k for failed, k in kept[1] if not failed]
    assert len(passed) > 500 and np.mean(passed) > 0.98 and np.mean([k for _, k in kept[0]]) < 0.05
    bad, good = ([t.encode().split(b"\n") for t, y in rows if y == kind] for kind in (0, 1))
    rng, right, lines, one_state = np.random.default_rng(5), [0, 0], [0, 0], 0
    for k, g in enumerate(good):
        pair = [(bad[k % len(bad)], 0), (g, 1)]
        (host, own), (guest, other) = pair if rng.random() < 0.5 else pair[::-1]
        at = int(rng.integers(0, len(host) + 1))
        want = np.array([own] * at + [other] * len(guest) + [own] * (len(host) - at))
        feats, words = quality_rules.line_features(host[:at] + guest + host[at:])
        got = quality_rules.viterbi(model, feats)
        for s in (0, 1):
            mine = (want == s) & (words > 0)
            right[s] += int((got[mine] == s).sum())
            lines[s] += int(mine.sum())
        one_state += len(set(got[words > 0].tolist())) == 1
    assert right[0] / lines[0] > 0.9 and right[1] / lines[1] > 0.95
    assert one_state < 0.12 * len(good)


def test_the_fit_leaves_out_whole_texts_that_do_not_fit():
    long = b"a line of a long text\n" * (quality_rules.MOST_LINES + 1)
    texts = [b"one line", b"two\nlines", long, long * 200]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array([1, 0, 1, 0]), pa.array([t.decode() for t in texts])],
                                       names=["doc_id", "label", "text"])
    rows = [r for b in quality_rules._sampled(iter([batch])) for r in b.to_pylist()]
    assert [(r["doc_id"], r["label"]) for r in rows] == [(1, 1), (2, 0)]


@pytest.mark.parametrize("budget", [0, 9, 20, 1000])
def test_a_budget_takes_whole_documents_in_hash_order(spark, budget):
    from trialscope.llm.labelled import hash_order, within_budget
    from pyspark.sql import functions as F
    rows = [(k, "x" * (1 + k % 5)) for k in range(8)] + [(3, "yy")]
    got = within_budget(spark.createDataFrame(rows, "doc_id long, t string"), F.length("t"), budget)
    taken, free = set(), budget
    for i in sorted(range(8), key=hash_order):
        n = sum(len(t) for j, t in rows if j == i)
        if n <= free:
            taken.add(i)
            free -= n
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[0] in taken)


def test_splices_keep_lines_and_labels_together():
    rng = np.random.default_rng(8)
    mark = lambda y, n: (np.full((n, 2), y * 100) + np.arange(n)[:, None], np.full(n, y))
    docs = [mark(int(rng.integers(0, 2)), int(rng.integers(1, 9))) for _ in range(30)]
    made = quality_rules.splices(docs)
    pairs = min(sum(y[0] == k for _, y in docs) for k in (0, 1))
    assert len(made) == 2 * pairs and pairs > 5
    for x, y in made:
        assert (x[:, 0] // 100 == y).all() and len(set(y)) == 2
        assert (np.abs(np.diff(y)).sum()) <= 2


def test_gam_learns_shapes_and_a_pair():
    rng = np.random.default_rng(2)
    x = np.zeros((6000, len(text_stats.FEATURES)))
    x[:, :4] = rng.normal(size=(6000, 4))
    y = ((np.abs(x[:, 0]) > 1) | (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = quality_gam.fit_gam(x[:5000], y[:5000])
    assert ((quality_gam.score_gam(model, x[5000:]) > 0.5) == y[5000:]).mean() > 0.9
    main = model | {"pairs": []}
    assert ((quality_gam.score_gam(main, x[5000:]) > 0.5) == y[5000:]).mean() < 0.75
    assert (quality_gam.score_gam(quality_gam.fit_gam(x[:0], y[:0]), x[:5]) == 0.5).all()
    assert (quality_gam.score_gam(quality_gam.fit_gam(x[:9], np.ones(9)), x) > 0.9).all()


def test_gam_scores_are_the_sum_of_lookups():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (400, len(text_stats.FEATURES))).astype(float)
    model = quality_gam.fit_gam(x, (x[:, 0] > 2).astype(float))
    for row, got in zip(x[:50], quality_gam.score_gam(model, x[:50])):
        total = model["intercept"]
        for edges, table, v in zip(model["edges"], model["tables"], row):
            total += table[sum(e <= v for e in edges)]
        for p in model["pairs"]:
            total += p["table"][sum(e <= row[p["a"]] for e in p["edges_a"])][sum(e <= row[p["b"]] for e in p["edges_b"])]
        assert got == pytest.approx(1 / (1 + np.exp(-total)))


def plain_features(text):
    words = [w.lower().strip(".,;:!?\"'()[]|#*$%&") for w in text.split()]
    words = [w for w in words if w]
    h = [np.array([xxhash.xxh64_intdigest(w.encode())], np.uint64) for w in words]
    found = [toxicity._mixed(a, 1) for a in h]
    for gap, salt in ((1, 2), (2, 3)):
        found += [toxicity._mixed(toxicity._mixed(a, salt) + b, salt) for a, b in zip(h, h[gap:])]
    for k in toxicity.STEMS:
        found += [toxicity._mixed(np.array([xxhash.xxh64_intdigest(w[:k].encode())], np.uint64), 16 + k) for w in words]
    return sorted(int(f[0] >> np.uint64(64 - toxicity.BITS)) for f in found)


def test_hashed_features():
    texts = ["", "One", "one two", "a b c d", " lead  and trail ", "|| !! x", "Ünï cödé wörds, here."]
    text, at = toxicity.hashed_features(pa.array(texts))
    assert [sorted(at[text == k].tolist()) for k in range(len(texts))] == [plain_features(t) for t in texts]


def test_ftrl_update_by_hand():
    model = toxicity.Ftrl(4, alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    z, n, bias = np.zeros(16), np.zeros(16), np.zeros(2)
    rng = np.random.default_rng(4)
    for _ in range(50):
        at, y = np.unique(rng.integers(0, 16, 4)), int(rng.integers(0, 2))
        w = {i: 0.0 if abs(z[i]) <= 0.1 else -(z[i] - np.sign(z[i]) * 0.1) / ((1 + n[i] ** 0.5) / 0.5 + 0.2) for i in at}
        b = -bias[0] / ((1 + bias[1] ** 0.5) / 0.5 + 0.2)
        g = 1 / (1 + np.exp(-(sum(w.values()) + b))) - y
        for i in at:
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5 * w[i]
            n[i] += g * g
        bias += (g - ((bias[1] + g * g) ** 0.5 - bias[1] ** 0.5) / 0.5 * b, g * g)
        model.learn(at, y)
        assert np.allclose(model.z, z) and np.allclose(model.n, n) and np.allclose(model.bias, bias)


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    docs, rows = fx.docs(spark), [(k, k % 2, k % 2) for k in range(70)]
    turned = [(k, 1 - q, 1 - t) if held(k) else (k, q, t) for k, q, t in rows]
    assert rows != turned
    for make in (toxicity.toxicity, quality_gam.quality, quality_rules.quality_rules):
        a, b = (sorted(map(str, make(docs, fx.labels(spark, r)).collect())) for r in (rows, turned))
        assert a == b


@pytest.mark.parametrize("make,cut", [(toxicity.toxicity, 0.5), (quality_gam.quality, 0.3)])
def test_scored_tables(spark, make, cut):
    for labels in (fx.labels(spark), fx.labels(spark, [])):
        got = make(fx.docs(spark), labels).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in fx.pairs(fx.edge_rows()))
        for r in got:
            assert r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
    assert {r.score for r in got} == {0.5}
    assert make(fx.docs(spark, []), fx.labels(spark)).count() == 0


@pytest.mark.parametrize("make,target,least", [(toxicity.toxicity, "toxic", 0.95), (quality_gam.quality, "quality", 0.97)])
def test_held_out_accuracy(spark, make, target, least):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = make(docs, labels).join(labels, "doc_id").where("held_out").select("predicted", target).collect()
    assert len(rows) > 500 and np.mean([r[0] == r[1] for r in rows]) > least


def test_id_text_ignores_clashing_columns(spark):
    assert id_text(fx.docs(spark)).columns == ["doc_id", "text"]
