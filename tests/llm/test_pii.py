"""Operator 13: base spans against plain patterns, the trees, what they add."""

import hashlib
import re

import numpy as np
from llm_helpers import odd_documents

from strata.llm import pii

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")))
                    or (kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)) or (kind == "phone" and 10 <= len(digits) <= 15)):
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def valid_card(rng, size=16):
    digits = "".join(rng.choice("0123456789") for _ in range(size - 1))
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def phone(rng):
    return f"1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"


def corpus(rng, n=2500):
    words = ["the", "of", "Über", "a", "été", "look", "at", "home", "🙂", "price", "5", "2024"]
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))
    docs = []
    for i in range(n):
        mail = f"{rng.choice(['ann', 'bo', 'cy'])}.{rng.randint(10, 99)}@mail{rng.randint(1, 9)}.example.com"
        middle = rng.choice([mail, "+" + phone(rng), valid_card(rng), valid_card(rng, 19), ".".join(str(rng.randint(0, 255)) for _ in range(4)),
                             str(rng.randint(10**15, 10**16)), "1.2.3.400", "12 34 56 78", "", str(rng.randint(10**9, 10**10)), "see a at b.c"])
        docs.append((i, f"{say(rng.randint(0, 9))} {middle} {say(rng.randint(0, 9))}", None))
    return docs


def test_base_spans_equal_plain_patterns(rng):
    pieces = ["a", "@", ".", "b@c.d", "+", "1", "12", "300", " ", "-", "(", ")", "1.2.3.4", "+1 (222) 555-1234", "4539578763621486", "é", "🙂", "..", "@@", "%"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert [f"{k}:{a}:{b}" for k, a, b in pii.base_spans(text)] == brute(text), text
    for text in ("9" * 30_000 + ".1.1.1", "0" * 9000 + "1.2.3.4", "a" * 200_000, "a@" * 50_000, "1." * 50_000, "+1" + " " * 100_000):
        assert pii.base_spans(text) is not None and list(pii.candidates(text)) is not None
    assert pii.base_spans("0" * 5000 + "1.2.3.4") == [("ip", 0, 5007)]


def test_trees_and_threshold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = pii.Trees().fit(x[:1500], y[:1500])
    s = trees.scores(x[1500:])
    assert ((s > 0) == (y[1500:] == 1)).mean() > 0.97
    a, b = pii.calibrated(s, y[1500:])
    assert a > 0
    least = pii.threshold(s, y[1500:], 0.95)
    assert y[1500:][s >= least].mean() >= 0.95 and (s >= least).sum() > 150
    assert pii.threshold(rng.normal(size=200), np.tile([0.0, 1.0], 100), 0.95) == np.inf
    flat = pii.Trees(rounds=3).fit(np.zeros((10, 2)), np.array([0.0, 1.0] * 5))
    assert np.allclose(flat.scores(np.zeros((1, 2))), 0)


def test_results_and_what_is_added(spark, rng):
    docs = corpus(rng)
    model = pii.trained(odd_documents(spark, docs))
    told = [(10000, f"call {phone(rng)} now", "phone"), (10001, f"look at {phone(rng)}", "phone"),
            (10002, "the bo.77 [at] mail3.example.com of", "email"), (10003, "of ann.31 at mail4 dot example dot com the", "email")]
    clean = [(10100, "the order 1234567890123456 of home", None), (10101, "look at home.Then of the", None), (10102, "version 1.2.3.999 12 34", None)]
    docs += [(i, t, None) for i, t, _ in told] + clean
    docs += [(20000, None, None), (20001, "", None), (20002, "+1 (222) 555-1234 " * 5000, None), (5, docs[5][1], None), (None, "x@y.z", None)]
    df = odd_documents(spark, docs, "spans string, kind long, base_sha256 string, n_email string, start long")
    assert {"email", "phone"} <= set(model)
    spans = pii.found(df, model, redact=True)
    text = {r.doc_id: r.redacted for r in spans.collect()}
    got = pii.digests(spans).collect()
    assert len(got) == len(docs)
    texts = {i: t or "" for i, t, _ in docs}
    for r in got:
        base = brute(texts[r.doc_id])
        every = r.spans.split(",") if r.spans else []
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in every if s in set(base)] == base and r.n_added == len(every) - len(base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s.startswith(k + ":") for s in base) for k, _ in PLAIN)
        ends = [tuple(map(int, s.split(":")[1:])) for s in every]
        assert all(0 <= a < b <= len(texts[r.doc_id]) for a, b in ends)
    added = {r.doc_id: r.spans for r in got if r.n_added}
    for i, t, kind in told:
        assert added[i].startswith(kind + ":") and f"[{kind}]" in text[i]
        assert not re.search(r"555-\d{4}|example", text[i])
    assert not {i for i, *_ in clean} & set(added)
    assert text[None] == "[email]" and text[20000] == "" and text[20002].strip() == " ".join(["[phone]"] * 5000)
    assert pii.found(df, model).collect()[0] == pii.found(df, model).collect()[0]


def test_few_examples_and_an_empty_table(spark):
    df = odd_documents(spark, [(1, "mail a@b.c", None)])
    assert pii.trained(df) == {} and pii.trained(df.filter("false")) == {}
    assert [r.spans for r in pii.digests(pii.found(df)).collect()] == ["email:5:10"]
    assert pii.found(df.filter("false")).count() == 0


def test_redaction_joins_overlapping_spans():
    assert pii.redacted("ab12cd", [("ip", 1, 3), ("card", 2, 4), ("phone", 5, 6)]) == "a[ip+card]c[phone]"
