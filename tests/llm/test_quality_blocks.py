import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from custlens.llm import quality


def texts(n):
    draw = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        words = draw.choice(["alpha", "beta", "gamma", "delta"], 12)
        rows.append((i, " ".join(words) + (". End, of it." if good ^ (i % 11 == 0) else " $$ || 99 ##")))
        labels.append((i, int(good)))
    return rows, labels


def test_all_labelled_documents_are_learnt_from(spark):
    rows, labels = texts(600)
    found = quality.measured(spark.createDataFrame(rows, "doc_id long, text string"))
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    in_blocks = quality.train(found, known, rows=100)
    learnt = {r.doc_id for r in known.filter(~quality.held_out("doc_id")).collect()}
    x = np.array([quality.features(pa.array([t]))[0] for i, t in rows if i in learnt])
    good = np.array([g for i, g in labels if i in learnt])
    assert len(x) > 400
    np.testing.assert_allclose(in_blocks.mean, x.mean(axis=0))
    np.testing.assert_allclose(in_blocks.scale, x.std(axis=0) + 1e-6)
    raw = in_blocks.raw(x)
    assert in_blocks.cut == pytest.approx(np.quantile(raw, (good == 0).mean()))
    whole = quality.fit(x, good)
    assert np.corrcoef(raw, whole.raw(x))[0, 1] > 0.99
    again = quality.train(found.orderBy(F.desc("_id")), known, rows=100)
    np.testing.assert_allclose(again.weights, in_blocks.weights, rtol=1e-6, atol=1e-9)


def test_every_row_is_paired(spark):
    label = np.array([1] * 70 + [0] * 30)
    z = np.eye(100)
    pairs = quality._paired(z, label, 10)
    assert len(pairs) == 70 and (pairs[:, :70].sum(axis=0) == 1).all() and set(-pairs[:, 70:].sum(axis=0)) <= {2, 3}
