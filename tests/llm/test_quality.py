"""Positive-unlabelled quality scores: held-out accuracy, the risk itself, the prior, odd rows."""

import zlib

import numpy as np
import pytest

from clipwarden.llm import quality, queries


def auc(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    n = labels.sum()
    return (ranks[labels == 1].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op11(spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    truth = np.array([labels[r.doc_id] for r in rows])
    scores = np.array([r.score for r in rows])
    assert auc(scores, truth) > 0.99
    assert (scores[truth == 1] >= 0.3).mean() > 0.99 and (scores[truth == 0] < 0.3).mean() > 0.9


def two_clouds(rng, n, prior, width=6):
    far = np.zeros(width)
    far[:2] = 3.0
    pos = rng.normal(size=(n, width))
    mixed = np.where(rng.random(2 * n)[:, None] < prior, rng.normal(size=(2 * n, width)), rng.normal(size=(2 * n, width)) + far)
    one = lambda x: np.column_stack((x, np.ones(len(x)))).astype(np.float32)
    return one(pos), one(mixed), one(rng.normal(size=(500, width)) + far)


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.9])
def test_prior_and_negatives_without_labels(prior):
    pos, mixed, neg = two_clouds(np.random.default_rng(4), 2000, prior)
    found = quality.estimate_prior(pos, mixed)
    assert abs(found - prior) < 0.06
    w = quality.non_negative_fit(pos, mixed, found)
    assert (quality.logistic(pos @ w) >= 0.3).mean() > 0.9 and (quality.logistic(neg @ w) >= 0.3).mean() < 0.5
    truth = np.repeat([1, 0], [len(pos), len(neg)])
    assert auc(np.concatenate((pos, neg)) @ w, truth) > 0.98


def test_risk_is_non_negative_where_the_plain_one_is_not():
    """With more features than rows the unbiased risk falls below zero; the corrected fit stays near it."""
    rng = np.random.default_rng(0)
    pos, unl = (rng.normal(size=(30, 200)).astype(np.float32) for _ in range(2))
    w = quality.non_negative_fit(pos, unl, 0.5)
    bracket = np.logaddexp(0, unl @ w).mean() - 0.5 * np.logaddexp(0, pos @ w).mean()
    assert bracket > -0.2


def test_features_of_slices(monkeypatch):
    text = "Some é text. With, many 123 SIGNS!!\n" * 50
    whole = quality.features(text)
    monkeypatch.setattr(quality, "SLICE", 64)
    assert np.allclose(quality.features(text), whole)
    assert quality.features("").shape == whole.shape


def test_odd_rows(spark, make, empty):
    rows = [(k, f"plain words of number {k} stand here in a line, and so on.") for k in range(40)]
    rows += [(k, "### $$$ | !! ### | $$$") for k in range(40, 60)]
    rows += [(60, None), (61, ""), (62, "x" * 300_000), (0, "again"), (None, "no id"), (None, None)]
    docs = make(rows)
    labels = spark.createDataFrame(
        [(k, 1) for k in range(30)] + [(k, 0) for k in range(40, 50)] + [(1, 0), (2, None), (None, 1), (999, 1)],
        "doc_id bigint, quality int",
    )
    got = quality.score(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    good = [r.score for r in got if r.doc_id is not None and 2 < r.doc_id < 40]
    bad = [r.score for r in got if r.doc_id is not None and 40 <= r.doc_id < 60]
    assert min(good) > max(bad)
    same = {r.score for r in got if r.doc_id in (60, 61)}
    assert len(same) == 1
    assert {r.score for r in quality.score(docs, labels.filter("quality = 0")).collect()} == {0.0}
    assert quality.score(empty, labels).count() == 0
    # negative labels do not matter
    other = labels.withColumn("quality", labels.quality.cast("int")).filter("quality is null or quality = 1 or doc_id = 1")
    assert {(r.doc_id, r.score) for r in quality.score(docs, other).collect()} == {(r.doc_id, r.score) for r in got}
