"""Operator 5: the pairwise fit against plain gradient descent on the same pairs,
its threshold against counting, and the query's rows against both."""

import zlib

import numpy as np
import pyarrow as pa

from strata.llm import quality
from strata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def descent(x, y, pairs, penalty, seed):
    """The minimum of the same loss by small steps, pair by pair loss written out."""
    mean, scale = x.mean(axis=0), np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    good, bad = rng.choice(np.flatnonzero(y == 1), pairs), rng.choice(np.flatnonzero(y == 0), pairs)
    w = np.zeros(x.shape[1])
    for _ in range(20_000):
        margin = (z[good] - z[bad]) @ w
        # d/dw of mean log(1 + exp(-margin)) + penalty |w|^2 / 2
        slope = -((z[good] - z[bad]) / (1 + np.exp(margin))[:, None]).mean(axis=0) + penalty * w
        w -= 0.5 * slope
    return z, w


def test_fit_is_the_minimum_of_the_pairwise_loss():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)) * [1, 5, 0.1, 0] + [0, 2, 0, 7]
    y = (x[:, 0] + x[:, 1] / 5 + rng.normal(size=300) * 0.7 > 0.3).astype(int)
    model = quality.fit(x, y, pairs=400, penalty=0.05, seed=5)
    z, w = descent(x, y, 400, 0.05, 5)
    assert np.allclose(model["w"], w, atol=1e-6)
    # as many rows lie below the threshold as have label 0
    assert (z @ w < model["threshold"]).sum() == (y == 0).sum()
    s = quality.scores(model, x)
    assert np.allclose(s, 1 / (1 + np.exp(-(z @ w - model["threshold"]))), atol=1e-6) and ((s >= 0.5) == (z @ w >= model["threshold"])).all()


def test_query_rows_are_scores_of_the_fit(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    label = {r.doc_id: r.quality for r in labels.collect()}
    learnt = {i for i in label if zlib.crc32(str(i).encode()) % 3 != 1}
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(texts)
    x = quality.features(quality.tallies(pa.array([texts[i] for i in ids], pa.string())))
    single = x.astype(np.float32).astype(np.float64)  # as it is learnt from
    model = quality.trained(docs, labels)
    rows = np.array([i in learnt for i in ids])
    z, zs = (np.clip((v - model["mean"]) / model["scale"], -8, 8) @ model["w"] for v in (x, single))
    assert np.allclose(model["mean"], single[rows].mean(axis=0), atol=1e-9)
    assert (zs[rows] < model["threshold"]).sum() == sum(label[i] == 0 for i in ids if i in learnt)
    want = dict(zip(ids, 1 / (1 + np.exp(-np.clip(z - model["threshold"], -30, 30)))))
    got = QUERIES["op5_quality_classifier"](spark, SF).collect()
    assert len(got) == len(ids)
    for r in got:
        assert abs(r.score - want[r.doc_id]) < 1e-9 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.5)
