"""Operator 13 learns from every candidate: none is left out, and the sums that Spark makes give the trees of plain arrays."""

from collections import Counter

import numpy as np
from llm_helpers import odd_documents
from test_pii import corpus

from strata.llm import pii


def test_all_candidates_are_learnt_from(spark, rng):
    long_text = " ".join(str(rng.randint(10**11, 10**12)) for _ in range(1500)) + " +1 (222) 555-1234" * 200
    docs = [*corpus(rng, 2000), (9000, long_text, None), (9001, None, None), (None, long_text, None)]
    want = Counter()
    for _, text, _ in docs:
        base = set(pii.base_spans(text or ""))
        want.update((pii.KINDS.index(k), int(pii._label(k, a, b, base))) for k, a, b in pii.candidates(text or ""))
    got = pii.examples(odd_documents(spark, docs)).groupBy("kind", "y").count().collect()
    assert {(r.kind, r.y): r["count"] for r in got} == dict(want)
    assert max(want.values()) > 5000  # more than the 2,500 of a kind that were kept once, and more than 10 of one document


def test_weights_of_long_documents(spark):
    df = odd_documents(spark, [(1, " ".join(["+1 (222) 555-1234"] * 40), None), (2, "a@b.cc or d@e.ff", None)])
    rows = pii.examples(df).filter("y = 1").groupBy("kind").sum("w").collect()
    assert {r.kind: round(r["sum(w)"] / pii.UNIT, 2) for r in rows} == {pii.KINDS.index("phone"): 10, pii.KINDS.index("email"): 2}


def test_sums_of_spark_give_the_trees_of_plain_arrays(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(900, pii.WIDTH)), 1)
    y = ((x[:, 0] > 0.25) ^ (x[:, 3] > -0.4)).astype(int)
    rows = spark.createDataFrame([(3, int(b), False, pii.UNIT, a.tobytes()) for a, b in zip(x, y, strict=True)],
                                 "kind long, y long, held boolean, w long, x binary").repartition(5)
    totals = {(3, 0): int((y == 0).sum()) * pii.UNIT, (3, 1): int((y == 1).sum()) * pii.UNIT}
    cuts = pii.feature_cuts(rows, totals)
    for f, c in enumerate(cuts[3]):
        below = np.array([(x[:, f] <= v).mean() for v in c])
        assert len(c) >= 18 and np.abs(np.diff(below)).max() < 0.12
    got = pii.fitted(pii.coded(rows, cuts).checkpoint(), cuts, totals, rounds=8)[3]
    code, weight = pii._codes(x, cuts[3]), np.where(y == 1, 450 / (y == 1).sum(), 450 / (y == 0).sum())
    width = max(map(len, cuts[3])) + 1

    def sums(trees, growing, level):
        slopes = pii._slopes(pii._raised(code, trees[3], 0.0, pii.DEPTH), y, weight)
        return {3: tuple(pii._sums(code, pii._node(code, *growing[3], level), np.rint(v * pii.SCALE) / pii.SCALE, 1 << level, width) for v in slopes)}

    want = pii.boosted({3: 0.0}, cuts, sums, rounds=8)[3]
    assert len(got) == 8
    for (f, c, v), (f2, c2, v2) in zip(got, want, strict=True):
        assert (f == f2).all() and (c == c2).all() and np.allclose(v, v2)
    trees = pii.Trees().of_codes(got, cuts[3], 0.0)
    assert np.allclose(trees.scores(x), pii._raised(code, got, 0.0, pii.DEPTH)) and ((trees.scores(x) > 0) == y).mean() > 0.97
