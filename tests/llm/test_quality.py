import zlib

import numpy as np
import pyarrow as pa
import pytest

from slaflow.llm import quality
from slaflow.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    from llm.conftest import load

    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in load(f"{sf}/labels.parquet")}
    rows = QUERIES["op3_quality"](spark, sf).collect()
    assert len(rows) == len(load(f"{sf}/documents.parquet"))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    test = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = {y: np.mean([(s >= 0.5) == y for s, t in test if t == y]) for y in (0, 1)}
    assert right[0] > 0.95 and right[1] > 0.98


def test_labels_of_held_out_rows_are_not_learnt(spark, make_docs):
    from pyspark.sql import functions as F

    from conftest import SF01

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, flipped)
    assert a.prior == b.prior and all(np.array_equal(x, y) for x, y in zip(a.w, b.w))


def test_positives_alone_give_the_same_model(spark):
    """Neither the prior nor the fit reads a negative label."""
    from llm.conftest import load

    from conftest import SF01

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    a, b = quality.train(docs, labels), quality.train(docs, labels.where("quality = 1"))
    assert a.prior == b.prior and all(np.array_equal(x, y) for x, y in zip(a.w, b.w))
    known = {r["doc_id"]: r["quality"] for r in load(f"{SF01}/labels.parquet") if r["quality"] is not None}
    assert abs(a.prior - np.mean(list(known.values()))) < 0.05
    rows = [r for r in quality.score(docs, b).select("doc_id", "score").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    right = [(r["score"] >= 0.5) == known[r["doc_id"]] for r in rows if r["doc_id"] in known]
    assert len(right) > 100 and np.mean(right) > 0.97


@pytest.mark.parametrize("share", [0.1, 0.5, 0.9])
def test_best_bin(share):
    rng = np.random.default_rng(3)
    s_pos = rng.normal(4, 1, 3000)
    s_unl = np.concatenate([rng.normal(4, 1, int(4000 * share)), rng.normal(0, 1, 4000 - int(4000 * share))])
    ones = np.ones(4000)
    found = quality.best_bin(s_pos, s_unl, ones)
    assert abs(found - share) < 0.04
    # a row of weight two is a row twice; weight 0 is none
    weights = rng.integers(0, 3, 4000)
    cuts = np.unique(s_pos)
    share_above = lambda s, c: np.mean(s >= c)
    doubled = np.repeat(s_unl, weights)
    slack = np.sqrt(np.log(40) / 2 / 3000) + np.sqrt(np.log(40) / 2 / 4000)
    bounds = [(share_above(doubled, c) + 1.01 * slack) / share_above(s_pos, c) for c in cuts]
    c = cuts[int(np.argmin(bounds))]
    assert np.isclose(quality.best_bin(s_pos, s_unl, weights.astype(float)), share_above(doubled, c) / share_above(s_pos, c))


def test_weights_are_all_learnable_texts(spark, make_docs):
    rows = _texts(300) + [(1000 + k, "one hot text that many ids share") for k in range(150)]
    stats = quality._statistics(make_docs(rows).select("doc_id", "text").repartition(5))
    x = quality.features(pa.array([t for _, t in rows]))
    mean, scale = quality._mean_and_scale(stats)
    points = x[::40]
    weights = quality._weights(stats, points, mean, scale)
    cut = lambda a: np.clip((a - mean) / scale, -8, 8)
    apart = ((cut(x)[:, None] - cut(points)[None]) ** 2).sum(2).round(9)
    assert weights.sum() == len(rows)
    assert weights.tolist() == np.bincount(apart.argmin(1), minlength=len(points)).tolist()


def test_unlabelled_risk_is_weighted():
    rng = np.random.default_rng(2)
    pos, unl, weights = rng.normal(1, 1, 20), rng.normal(-1, 1, 30), rng.integers(1, 4, 30)
    risk, _, g = quality.pu_risk(pos, unl, 0.3, weights.astype(float))
    plain, _, every = quality.pu_risk(pos, np.repeat(unl, weights), 0.3)
    assert np.isclose(risk, plain)
    assert np.allclose(g, np.add.reduceat(every, np.concatenate([[0], np.cumsum(weights)[:-1]])))


def test_a_single_positive(spark, make_docs):
    rows = _texts(40)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(make_docs(rows), labels, may_learn=lambda c: quality.F.lit(True))
    assert model.fitted and model.prior == 0.5
    assert all(0 <= r["score"] <= 1 for r in quality.score(make_docs(rows), model).collect())


def test_risk_and_gradient():
    rng = np.random.default_rng(1)
    for shift in (0.0, 6.0):  # the second makes the negative part negative
        pos, unl = rng.normal(shift, 1, 40), rng.normal(0, 1, 60) - shift
        pos, unl = (pos, unl) if not shift else (-pos + 2 * shift, unl)
        risk, g_pos, g_unl = quality.pu_risk(pos, unl, 0.9)
        loss = lambda z: np.logaddexp(0, -z)
        negative = loss(-unl).mean() - 0.9 * loss(-pos).mean()
        assert np.isclose(risk, 0.9 * loss(pos).mean() + max(0, negative))
        step = 1e-6
        moved = pos.copy()
        moved[3] += step
        if negative >= 0:
            assert np.isclose((quality.pu_risk(moved, unl, 0.9)[0] - risk) / step, g_pos[3], atol=1e-5)
        else:
            raised = loss(-(unl - 0.1 * g_unl)).mean() - 0.9 * loss(-(pos - 0.1 * g_pos)).mean()
            assert raised > negative


def test_features_against_plain_python():
    texts = ["", "THE!! END!!\nnow", "a a a b", "é😀 | x | y", "word " * 7, "\n\n"]
    x = quality.features(pa.array(texts))
    assert x.shape == (6, quality.N_FEATURES) and not x[0, :12].any()
    assert np.isclose(x[1, 0], 6 / len(texts[1])) and np.isclose(x[2, 9], 2 / 4) and np.isclose(x[4, 9], 6 / 7)
    assert np.isclose(x[1, 11], 2 / 3)
    whole = quality.features(pa.array(texts * 3))
    assert np.allclose(whole, np.concatenate([x, x, x]))


def test_without_positives_every_score_is_the_prior(spark, odd_docs, odd_rows):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.score(odd_docs, quality.train(odd_docs, labels)).collect()
    assert len(rows) == len(odd_rows) and {r["score"] for r in rows} == {0.5}


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, 1, 0), (4, 1, None), (None, 1, 0), (5, None, 0), (8, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(odd_docs, labels)
    out = quality.score(odd_docs, model)
    assert sorted(out.columns) == sorted(odd_docs.columns)
    rows = out.collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    same = {}
    for r in rows:
        assert same.setdefault(r["text"] or "", r["score"]) == r["score"]
    assert quality.score(no_docs, model).count() == 0 and not quality.train(no_docs, labels).fitted


def _texts(n):
    return [(k, ("plain words of a good text " if k % 2 else "BUY!! NOW!! $$$ ") * (k % 9 + 1)) for k in range(n)]


def test_rows_that_are_all_labelled_fit_a_model(spark, make_docs):
    rows = _texts(60)
    labels = spark.createDataFrame([(k, k % 2, 0) for k, _ in rows], "doc_id long, quality int, toxic int")
    model = quality.train(make_docs(rows), labels)
    assert model.fitted
    scores = {r["doc_id"]: r["score"] for r in quality.score(make_docs(rows), model).collect()}
    assert min(scores[k] for k in range(1, 60, 2)) > max(scores[k] for k in range(0, 60, 2))


def test_scale_is_that_of_all_learnable_rows(spark, make_docs):
    rows = [(k, t) for k, t in _texts(90)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(make_docs(rows), labels, max_unlabelled=5, may_learn=lambda c: quality.F.lit(True))
    x = quality.features(pa.array([t for _, t in rows]))
    assert np.allclose(model.mean, x.mean(0), atol=1e-6) and np.allclose(model.scale, x.std(0) + 1e-6, atol=1e-6)


def test_a_sampled_id_has_one_row(make_docs):
    rows = [(1, f"text number {k} of a hot id") for k in range(200)] + [(2, "another one")]
    x = quality._features_of(make_docs(rows).select("doc_id", "text"))
    assert len(x) == 2 and any(np.array_equal(x[0], y) for y in quality.features(pa.array([t for _, t in rows[:200]])))
    again = quality._features_of(make_docs(rows[::-1]).select("doc_id", "text"))
    assert np.array_equal(x, again)
