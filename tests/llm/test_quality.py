import random

import numpy as np
import pytest

from stemma.llm import quality
from tests.llm.cases import SF, clash_docs, empty_docs, folder, hard_docs

LABELS = "doc_id bigint, quality int, toxic int"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    good = y == 1
    return (rank[good].mean() - (good.sum() - 1) / 2) / (~good).sum()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = quality.op8_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    y = np.array([r.quality for r in rows])
    assert auc(np.array([r.score for r in rows]), y) > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_normal_equations_equal_direct_fit(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, len(quality.NAMES)))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.7).astype(float)
    df = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)], "x array<double>, y double").repartition(5)
    model = quality.fit(df)
    z = quality.Model(x.mean(0), x.std(0)).features(x)
    direct = np.linalg.solve(z.T @ z + np.eye(z.shape[1]), z.T @ y)
    assert np.allclose(model.weights, direct, atol=1e-6)
    assert (np.diff(model.value) >= 0).all()


def test_isotonic_brute_force():
    rng = random.Random(3)
    v = np.array([rng.random() for _ in range(40)])
    w = np.array([rng.randint(1, 5) for _ in range(40)], float)
    got = quality.isotonic(v, w)
    want = [max(min(np.average(v[i : j + 1], weights=w[i : j + 1]) for j in range(k, 40)) for i in range(k + 1)) for k in range(40)]
    assert np.allclose(got, want)


@pytest.mark.parametrize("make", [hard_docs, clash_docs, empty_docs])
@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(i, i % 2, 0) for i in range(60)] + [(None, 1, 1), (2, None, None)]])
def test_hard_rows(spark, tmp_path, make, labels):
    docs = make(spark)
    sf = folder(spark, tmp_path, docs, labels=spark.createDataFrame(labels, LABELS))
    rows = quality.op8_quality_classifier(spark, sf).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
