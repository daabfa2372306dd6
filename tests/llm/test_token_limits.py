"""Operator 2: limits that are no document's length, and the registered answers."""

import numpy as np
import pytest

from trialscope.llm import registry, token_counts

SF = "/root/testdata/sf0.001"


def check(rows, n):
    for r in rows:
        assert r.n_docs == (n == r.n_tokens).sum() and r.docs_longer == (n > r.n_tokens).sum()
        assert r.tokens_longer == n[n > r.n_tokens].sum() and r.truncated_total == np.minimum(n, r.n_tokens).sum()
        assert (r.total_docs, r.total_tokens) == (len(n), n.sum())
        assert r.quantile == pytest.approx((n <= r.n_tokens).mean())


def test_any_limit(spark):
    n = np.array([3, 3, 7, 1023, 1024, 2047, 2049, 5000, 5000, 9000])
    histogram = token_counts.length_histogram(spark.createDataFrame([(int(x),) for x in n], "n_tokens long"))
    limits = token_counts.context_limits(histogram)
    wanted = [0, 2, 3, 5, 1000, 1024, 2048, 4096, 8999, 9000, 10 ** 6]
    rows = token_counts.at_limits(limits, [*wanted, 5]).collect()
    assert sorted(r.n_tokens for r in rows) == wanted
    check(rows, n)
    none = spark.createDataFrame([], "n_tokens long")
    assert token_counts.token_counts(token_counts.length_histogram(none)).count() == 0


def test_registered_query_answers_usual_limits_and_quantiles(spark):
    rows = registry.queries()["op2_token_counts"](spark, SF).collect()
    by = {k: [r for r in rows if r.asked == k] for k in ("length", "limit", "quantile")}
    n = np.repeat([r.n_tokens for r in by["length"]], [r.n_docs for r in by["length"]])
    check(rows, n)
    assert sorted(r.n_tokens for r in by["limit"]) == sorted(token_counts.LIMITS)
    assert sorted(r.p for r in by["quantile"]) == sorted(token_counts.QUANTILES)
    for r in by["quantile"]:
        assert r.n_tokens == np.sort(n)[max(0, int(np.ceil(round(r.p * len(n), 9))) - 1)]
