"""Operators 4, 6 and 8 (and the suffix order) against brute force."""

import hashlib
import re
from collections import Counter

import pytest
from llm_helpers import near_copies, odd_documents

from strata.llm import jaccard, substring, suffix
from strata.llm.common import KEY

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def removed_words(docs, n):
    words = [WORD.findall(t or "") for _, t, _ in docs]
    first = {}
    for (i, _, _), w in zip(docs, words):
        for p in range(len(w) - n + 1):
            k = tuple(w[p:p + n])
            first[k] = min(first.get(k, float("inf")), float("inf") if i is None else i)
    out = []
    for (i, _, _), w in zip(docs, words):
        gone = [False] * len(w)
        for p in range(len(w) - n + 1):
            if first[tuple(w[p:p + n])] < (float("inf") if i is None else i):
                gone[p:p + n] = [True] * n
        left = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), sha(left.encode())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n,k", [(13, 5), (4, 2), (3, 3), (6, 1)])
def test_substring_dedup(spark, rng, n, k):
    docs = near_copies(rng)
    df = odd_documents(spark, docs).repartition(4)
    got = substring.deduplicated(df, min_words=n, k=k).drop("spans").collect()
    assert sorted(map(tuple, got), key=repr) == removed_words(docs, n)


def test_substring_spans_and_text(spark):
    w = [f"x{i}" for i in range(30)]
    df = spark.createDataFrame([(1, " ".join(w[:20])), (2, "a " + " ".join(w[3:19]) + " b")], "doc_id long, text string")
    r = {x.doc_id: x for x in substring.deduplicated(df, with_text=True).collect()}
    assert r[1].spans == [] and r[2].spans == [1, 17] and r[2].kept == "a b"
    assert substring.deduplicated(df.limit(0)).count() == 0


def removed_bytes(docs, n):
    count, raw = Counter(), [(t or "").encode() for _, t, _ in docs]
    for b in raw:
        count.update(b[p:p + n] for p in range(len(b) - n + 1))
    out = []
    for (i, _, _), b in zip(docs, raw):
        gone = [False] * (len(b) + 1)
        for p in range(len(b) - n + 1):
            if count[b[p:p + n]] > 1:
                gone[p:p + n] = [True] * n
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n,k,depth", [(30, 8, 3), (60, 16, 1)])
def test_suffix_dedup(spark, rng, n, k, depth):
    docs = [d for d in near_copies(rng, 40) if d[0] != 503] + [(504, "é" * 300, "c"), (505, "q" * 40, "c")]
    df = odd_documents(spark, docs).repartition(3)
    got = suffix.deduplicated(df, length=n, k=k, depth=depth).drop("spans").collect()
    assert sorted(map(tuple, got), key=repr) == removed_bytes(docs, n)


def test_suffix_order(spark, rng):
    strings = [[rng.choice([1, 2, 3]) for _ in range(rng.randint(1, 25))] for _ in range(10)] + [[5] * 20, [5] * 17, [7]]
    df = spark.createDataFrame(list(enumerate(strings)), "sid long, syms array<long>")
    got = [strings[r.sid][r.i:] for r in suffix.suffix_order(df).orderBy("rank").collect()]
    assert len(got) == sum(map(len, strings)) and got == sorted(got)


def test_suffix_dedup_empty(spark):
    assert suffix.deduplicated(odd_documents(spark, [])).count() == 0


def components(docs, n, percent):
    sets = []
    for _, t, _ in docs:
        w = WORD.findall((t or "").translate(LOW))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    up = list(range(len(docs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[top(i)] = top(j)
    ids = {}
    for i, a in enumerate(sets):
        if a:
            ids.setdefault(top(i), []).append(docs[i][0])
    out = []
    for i, a in enumerate(sets):
        of = [x for x in ids[top(i)] if x is not None] if a else [docs[i][0]]
        out.append((docs[i][0], len(a), min(of) if of else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("percent,block", [(85, 20_000), (60, 20_000), (70, 5)])
def test_jaccard_join(spark, rng, percent, block):
    docs = near_copies(rng, 120)
    df = odd_documents(spark, docs)
    got = jaccard.linked(df, percent=percent, block=block).drop("class_id", KEY).collect()
    assert sorted(map(tuple, got), key=repr) == components(docs, 4, percent)


def test_jaccard_deduplicated_rows(spark, rng):
    docs = near_copies(rng, 60)
    df = odd_documents(spark, docs)
    left = jaccard.deduplicated(df)
    assert left.columns == df.columns
    kept = {i for i, n, c in components(docs, 5, 80) if n == 0 or i == c}
    assert {r.doc_id for r in left.collect()} == kept
    assert jaccard.deduplicated(df.limit(0)).count() == 0


def test_signature_bounds_are_never_too_low(rng):
    import numpy as np
    for _ in range(200):
        a = np.unique(np.array([rng.getrandbits(64) for _ in range(rng.randint(1, 300))], np.uint64))
        b = np.unique(np.concatenate([a[:rng.randint(0, len(a))], np.array([rng.getrandbits(64) for _ in range(rng.randint(1, 60))], np.uint64)]))
        va, vb = jaccard.decoded_values(jaccard.encoded_values(a)), jaccard.decoded_values(jaccard.encoded_values(b))
        common = len(np.intersect1d(a, b))
        assert len(np.intersect1d(va, vb)) + min(len(a) - len(va), len(b) - len(vb)) >= common
        x, y = jaccard.signature(va, 256), jaccard.signature(vb, 256)
        ones = [int(np.bitwise_count(v).sum()) for v in (x, y)]
        assert int(np.bitwise_count(x & y).sum()) + min(len(a) - ones[0], len(b) - ones[1]) >= common
