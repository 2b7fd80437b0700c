"""The suffix order that the repeats are found with, on copies of many phrases."""

from llm_helpers import odd_documents
from test_text_operators import removed_bytes

from strata.llm import suffix


def test_long_copies_are_in_order(spark, rng, monkeypatch):
    x, y, p, q = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (3000, 2500, 300, 300))
    docs = [(i, a + b, "a") for i, (a, b) in enumerate([(x, p), (x, q), (y, p), (y, q), (p, x), (q, x), (y, y), (x, "")])]
    seen = []

    def order(strings, **given):
        out = real(strings, **given)
        seen.append((strings, given["name"], out))
        return out

    real = suffix.suffix_order
    # the recursion calls it by its name too: the outermost call comes last
    monkeypatch.setattr(suffix, "suffix_order", lambda strings, **given: order(strings, **{"name": "syms", **given}))
    got = suffix.deduplicated(odd_documents(spark, docs), length=40, k=12).drop("spans").collect()
    assert sorted(map(tuple, got), key=repr) == removed_bytes(docs, 40)
    strings, name, out = seen[-1]
    syms = {r.sid: list(r[name]) for r in strings.select("sid", name).collect()}
    assert max(map(len, syms.values())) > 100
    ranked = [syms[r.sid][r.i:] for r in out.orderBy("rank").collect()]
    assert ranked == sorted(ranked)
