"""Operator 4: residual sequences that still fit together are few among many full ones."""

from collections import defaultdict

import numpy as np
import pytest

from trialscope.llm import packing


def merged(spark, fill, **sizes):
    first = spark.createDataFrame([(k, int(f)) for k, f in enumerate(fill)], "bin long, fill long").repartition(16)
    where = packing.merge_rounds(first, 2048, **sizes).collect()
    assert sorted(r.bin for r in where) == list(range(len(fill)))
    held = defaultdict(list)
    for r in where:
        held[r.root].append((r.shift, int(fill[r.bin])))
    for parts in held.values():
        at = 0
        for shift, n in sorted(parts):
            assert shift == at
            at += n
        assert at <= 2048
    return sorted(sum(n for _, n in parts) for parts in held.values())


@pytest.mark.parametrize("seed", [0, 1])
def test_no_two_sequences_still_fit_together(spark, seed):
    rng = np.random.default_rng(seed)
    fill = rng.permutation([2047] * 9000 + [1600] * 40 + [700] * 9 + [300] * 3 + [1] * 2)
    sums = merged(spark, fill, fan_in=4, round_items=500)
    assert sums[0] + sums[1] > 2048


def test_random_sequences(spark):
    fill = np.random.default_rng(3).integers(1020, 2048, 9000)
    fill[:12] = [5, 9, 30, 31, 200, 210, 400, 410, 600, 800, 1000, 1020]
    sums = merged(spark, fill, fan_in=8, round_items=700)
    assert sums[0] + sums[1] > 2048
