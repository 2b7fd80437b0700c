"""Operators 11 and 12 against brute force, and their results for odd input."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from llm_helpers import odd_documents

from strata.llm import periodic, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- whitening ----------------------------------------------------------------

def exact(vectors):
    """n, deviations, covariance of x by whole numbers."""
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = [[n * a - s for a, s in zip(row, sums)] for row in x]
    d = len(sums)
    v = np.array([[sum(r[i] * r[j] for r in centred) / n ** 3 for j in range(d)] for i in range(d)])
    return n, deviations, v


def table(spark, vectors):
    rows = [(i, [float(c) for c in v], "x", None) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string, n string")


@pytest.mark.parametrize("shape", [(40, 7), (200, 3), (30, 40)])
def test_whitening_equals_eigenvectors(spark, shape):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=shape) * np.linspace(1, 9, shape[1])).astype(np.float32)
    vectors[1] = vectors[0]
    n, deviations, v = exact(vectors)
    values, parts = np.linalg.eigh(v)
    values, parts = values[::-1], parts[:, ::-1]
    out = whitening.whitened(table(spark, vectors)).toPandas().sort_values(["vec_id", "component"])
    k = min(32, shape[1])
    assert len(out) == len(vectors) * k and set(out["n"]) == {n}
    assert out["deviation"].tolist() == [e for e in deviations for _ in range(k)]
    x = np.floor(64 * vectors.astype(np.float64))
    x -= x.mean(axis=0)
    rank = min(k, n - 2) if n <= shape[1] else k  # two equal rows, centred
    got = out["whitened"].to_numpy().reshape(-1, k)[:, :rank]
    for c in range(rank):
        want = x @ parts[:, c] / np.sqrt(values[c])
        assert np.allclose(got[:, c], want, atol=1e-7) or np.allclose(got[:, c], -want, atol=1e-7)
    assert np.allclose(out["explained"].to_numpy()[:rank], values[:rank] / values.sum(), rtol=1e-9)
    assert out["whitened"].isna().sum() == (k - rank) * len(vectors)
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9


def test_factors():
    rng = np.random.default_rng(8)
    a = rng.normal(size=(12, 5)) * [100, 1, 0.5, 10, 3]
    v = a @ a.T
    g = whitening.pivoted_cholesky(v)
    assert g.shape[1] == 5 and np.allclose(g @ g.T, v, rtol=1e-9, atol=1e-9 * np.trace(v))
    assert np.argmax(np.diag(v)) == np.argmax(np.abs(g[:, 0]))
    order = []
    for c in range(5):  # a triangle: each column is 0 at the earlier pivots
        assert all(g[p, c] == 0 for p in order)
        order.append(int(np.abs(np.where(np.isin(np.arange(12), order), 0, g[:, c])).argmax()))
    values, vectors = whitening.jacobi(g)
    assert np.allclose(vectors.T @ vectors, np.eye(5), atol=1e-12)
    assert np.allclose(values, np.linalg.svd(a)[1] ** 2, rtol=1e-9) and (np.diff(values) <= 0).all()


def test_whitening_of_large_numbers_and_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, []), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]),
            (7, [1.0, 2.0, 3.0]), (None, [3.0, -4.0]), (1, [1.0, 2.0]), (8, [1e300, 0.0]), (9, [2e9, 7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = whitening.whitened(df).toPandas()
    assert sorted(out["vec_id"].fillna(-1)) == [-1, -1, 1, 1, 1, 1, 9, 9] and set(out["n"]) == {4}
    _, deviations, _ = exact([[1, 2], [3, -4], [1, 2]])
    x = [[int(64 * a) + 10**6, int(64 * b) + 10**6] for a, b in [(1, 2), (3, -4), (1, 2), (2e9, 7)]]
    sums = [sum(c) for c in zip(*x)]
    want = sum((4 * a - s) ** 2 for a, s in zip(x[3], sums))
    assert out[out["vec_id"] == 9]["deviation"].isna().all() == (want >= 1 << 63)
    assert whitening.whitened(df.filter("vec_id = 2")).count() == 0
    assert whitening.whitened(df.filter("false")).count() == 0
    same = whitening.whitened(df.filter("vec_id = 1")).toPandas()
    assert len(same) == 4 and same["whitened"].isna().all() and same["identity_error"].isna().all() and set(same["explained"]) == {0.0}


def test_exact_products():
    rng = np.random.default_rng(2)
    for most in (3, 1 << 20, 1 << 28):
        y = rng.integers(-most, most + 1, size=(60, 3))
        want = [[sum(int(r[i]) * int(r[j]) for r in y) for j in range(3)] for i in range(3)]
        assert whitening.products(y, most).tolist() == want


# --- periodic runs --------------------------------------------------------------

def brute(words, least=6, times=4):
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            if size >= max(least, times * q) and not any(
                    all(words[i + k] == words[i + k + r] for k in range(size - r)) for r in range(1, q)):
                out.append((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rng):
    out = []
    for _ in range(rng.randint(0, 6)):
        out += [str(rng.randint(0, 9)) for _ in range(rng.randint(0, 5))]
        unit = [str(rng.randint(0, 2)) for _ in range(rng.randint(1, 5))]
        size = rng.randint(1, 7 * len(unit))
        out += (unit * 8)[:size]
    return out


def test_lyndon_arrays(rng):
    for _ in range(300):
        x = [rng.randint(0, rng.choice([1, 3])) for _ in range(rng.randint(0, 14))]
        want = [max(k for k in range(1, len(x) - i + 1) if all(x[i:i + k] < x[i + j:i + k] for j in range(1, k))) for i in range(len(x))]
        assert periodic.lyndon_lengths(x) == want


def test_runs_equal_brute_force(spark, rng):
    docs = [(i, rng.choice([" ", "\n", "\t "]).join(repetitive(rng)), None) for i in range(250)]
    docs += [(500, None, None), (501, "", None), (502, " \n", None), (503, "a " * 30_000, None), (3, docs[3][1], None), (None, "x y " * 9, None)]
    out = periodic.periodic_runs(odd_documents(spark, docs), outputs=True).collect()
    assert len(out) == len(docs)
    got = sorted(((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in out), key=repr)
    want, some = [], 0
    for i, t, _ in docs:
        words = WORD.findall(t or "")
        runs = [(0, 30_000, 1)] if i == 503 else brute(words)
        some += len(runs)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     *[hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]))
    assert got == sorted(want, key=repr) and some > 100
    assert {r.collapsed.decode() for r in out if r.doc_id == 503} == {"a"}
    assert periodic.periodic_runs(odd_documents(spark, docs).filter("false")).count() == 0


def test_other_limits(rng):
    for least, times in ((2, 3), (9, 3), (5, 6)):
        for _ in range(150):
            words = repetitive(rng)
            ids = np.array([int(w) for w in words], np.int64)
            assert periodic.runs_of(ids, least, times) == brute(words, least, times)


def test_colliding_hashes_are_seen(monkeypatch):
    monkeypatch.setattr(periodic, "mixed", lambda h: h * np.uint64(0))  # all symbols hash alike
    x = np.array([1, 2, 1, 2, 1, 2, 1, 2, 3, 1, 2, 5, 5, 5, 5, 5, 5, 5, 1])
    assert periodic.runs_of(x) == [(0, 8, 2), (11, 7, 1)]


def test_planted_documents(spark):
    docs = [(i, " ".join(f"w{k}" for k in range(i % 37)), None) for i in range(120)] + [(200, None, None), (None, "a b", None)]
    got = {r.doc_id: r.text for r in periodic.planted(odd_documents(spark, docs)).collect()}
    changed = 0
    for i, t, _ in docs:
        words, h = WORD.findall(t or ""), zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
            changed += 1
            assert got[i] == " ".join(words)
        else:
            assert got[i] == t
    assert changed > 5
