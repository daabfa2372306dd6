"""Operator 5: no weight is dropped; too many are an error."""

import numpy as np
import pyarrow as pa
import pytest

from trialscope.llm import toxicity


def test_fit_keeps_every_weight(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_WEIGHTS", 5)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(200), pa.int64()), pa.array([k % 2 for k in range(200)], pa.int32()),
         pa.array([[x + 100 * (k % 2) for x in range(20)] for k in range(200)], pa.list_(pa.int32()))],
        names=["doc_id", "label", "features"])
    (out,) = toxicity._fit(iter([batch]))
    feature, weight = (out.column(k).to_numpy() for k in ("feature", "weight"))
    assert feature.tolist() == [*range(20), *range(100, 120), -1] and np.all(weight[:-1] != 0)
    weights = spark.createDataFrame(list(zip(feature.tolist(), weight.tolist())), toxicity.WEIGHTS)
    with pytest.raises(ValueError, match="more weights"):
        toxicity.score(spark.createDataFrame([(1, "a")], "doc_id long, text string"), weights)
