"""Totals of branch views from their layers, staged changes by staged path, and row numbers on both ways."""

import random

from pyspark.sql import functions as F

from strata.functions import ordered as ORD
from strata.operators import listing as L
from strata.operators import objects as OB
from tests.conftest import rows


def _state(spark):
    refs = spark.createDataFrame(
        [("r", "a", "c1"), ("r", "twice", "c1"), ("r", "twice", "c1"), ("r", "both", "c1"), ("r", "both", "c2"), ("r", "clean", "c2")],
        "repository string, branch string, commit_id string")
    commits = spark.createDataFrame([("r", "c1", "m1"), ("r", "c2", "m2")], "repository string, commit_id string, meta_range_id string")
    entries = spark.createDataFrame(
        [("r", "m1", "d/x", "k1", 1), ("r", "m1", "d/y", "k2", None), ("r", "m1", "top", "k3", 3), ("r", "m2", "d/x", "k4", 4),
         ("r", "m2", "e/z", "k5", 5), ("r", "m1", None, "k6", 6)],
        "repository string, meta_range_id string, path string, checksum string, size_bytes long")
    staging = spark.createDataFrame(
        [("r", b, *op) for b in ("a", "twice", "both", "gone") for op in (
            ("d/x", "delete", None, None, 1), ("d/y", "put", "k9", 9, 2), ("new/p", "put", "k8", None, 3), ("top", "put", "k3", 3, 4),
            ("e/z", "delete", None, None, 5))],
        "repository string, branch string, path string, op string, checksum string, size_bytes long, seq long"
    ).withColumn("physical_address", F.lit(None).cast("string"))
    return refs.select("repository", "branch"), refs, commits, entries, staging


def test_totals_of_layers_equal_those_of_rows(spark):
    state = _state(spark)
    layers, view = L.branch_layers(*state), L.branch_view(*state)
    assert view.count() == 4 + 5 + 4 + 2  # a: null path and three puts; twice: the null path twice; both: one null path; clean
    for call in (lambda v: OB.symlink_manifest(v), lambda v: OB.list_objects(v, prefix="", delimiter="/"),
                 lambda v: OB.list_objects(v, prefix="d/", delimiter=None, after="d/x"), lambda v: OB.list_objects(v, prefix="", amount=1)):
        want = call(view)
        assert rows(call(layers), *want.columns) == rows(want)


def test_layers_without_broadcast(spark, monkeypatch):
    state = _state(spark)
    want, changed = rows(OB.symlink_manifest(L.branch_view(*state))), rows(L.branch_changes(*state))
    monkeypatch.setattr(L, "small_side", lambda keys: keys)
    assert rows(OB.symlink_manifest(L.branch_layers(*state))) == want
    assert rows(L.branch_changes(*state)) == changed


def test_changes_meet_listings_at_staged_paths_only(spark):
    branches, refs, commits, entries, staging = _state(spark)
    got = rows(L.branch_changes(branches, refs, commits, entries, staging), "branch", "path", "change")
    assert got == sorted([
        ("a", "d/x", "removed"), ("a", "d/y", "changed"), ("a", "new/p", "added"),
        ("twice", "d/x", "removed"), ("twice", "d/x", "removed"), ("twice", "d/y", "changed"), ("twice", "d/y", "changed"), ("twice", "new/p", "added"),
        ("both", "d/x", "removed"), ("both", "d/x", "removed"), ("both", "d/y", "changed"), ("both", "new/p", "added"), ("both", "e/z", "removed")])
    # many branches of one listing: its rows are not copied to each of them on the way
    many = spark.range(500).select(F.lit("r").alias("repository"), F.concat(F.lit("b"), F.col("id").cast("string")).alias("branch"), F.lit("c1").alias("commit_id"))
    plan = L.branch_changes(many.select("repository", "branch"), many, commits, entries, staging)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 1 and "path" in joins[0]


def test_row_numbers_by_window_and_by_chunks(spark, monkeypatch):
    df = (spark.range(500).withColumn("k", F.when(F.col("id") % 9 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 3).cast("string"))))
          .withColumn("at", (F.col("id") * 7919) % 503))
    want = {(r.k, r.at): r.n for r in df.where("k IS NOT NULL").selectExpr("k", "at", "row_number() OVER (PARTITION BY k ORDER BY at) AS n").collect()}
    for most in (0, 1_000_000):
        monkeypatch.setattr(ORD, "MOST_IN_TASK", most)
        got = ORD.row_number_within(df, ["k"], ["at"], "n").collect()
        assert {(r.k, r.at): r.n for r in got} == want and len(got) == len(want)


def test_pages_over_an_overlay(spark):
    """Pages by brute force: branches of one listing that hide and add entries, one named by two
    commits, one by two rows, a commit, and a delimiter of each kind."""
    rng = random.Random(11)
    listing = {m: {f"{rng.choice('ab')}/{rng.choice('xy')}{rng.choice(['', '/'])}{i}": rng.randint(1, 9) for i in range(60)} for m in ("m1", "m2")}
    heads = [("b1", "c1"), ("b2", "c1"), ("two", "c1"), ("two", "c2"), ("same", "c1"), ("same", "c1"), ("plain", "c2"), ("lost", "cx")]
    refs = spark.createDataFrame([("r", *h) for h in heads], "repository string, branch string, commit_id string")
    commits = spark.createDataFrame([("r", "c1", "m1"), ("r", "c2", "m2"), ("r", "cx", None)], "repository string, commit_id string, meta_range_id string")
    entries = spark.createDataFrame([("r", m, p, p, n) for m, of in listing.items() for p, n in of.items()],
                                    "repository string, meta_range_id string, path string, checksum string, size_bytes long")
    staged = {b: {**{p: None for p in rng.sample(sorted(listing["m1"]), 25)}, **{f"{rng.choice('ab')}/n{i}": i for i in range(6)},
                  **{p: 100 for p in rng.sample(sorted(listing["m1"]), 5)}} for b in ("b1", "b2", "two", "lost")}
    staged["b2"] = {p: None for p in listing["m1"]} | {"a/only": 7}
    staging = spark.createDataFrame([("r", b, p, "delete" if n is None else "put", None if n is None else p, n, i) for b, of in staged.items()
                                     for i, (p, n) in enumerate(of.items())],
                                    "repository string, branch string, path string, op string, checksum string, size_bytes long, seq long"
                                    ).withColumn("physical_address", F.lit(None).cast("string"))
    asked = [(i, ref, rng.choice(["", "a", "a/", "b/x", "b/x/1", "zz"]), rng.choice(["", "/", "/"]), rng.choice(["", "a/", "b/x", "a/n3"]), rng.randint(1, 25))
             for i, ref in enumerate(["b1", "b2", "two", "plain", "c2", "lost"] * 9)]
    req = spark.createDataFrame([(i, "r", *q) for i, *q in asked],
                                "seq long, repository string, ref string, prefix string, delimiter string, after string, amount int")
    meta = {"c1": "m1", "c2": "m2", "cx": None}
    want = []
    for seq, ref, prefix, delimiter, after, amount in asked:
        own = staged.get(ref, {})
        shown = [(p, n) for b, c in (heads if ref != "c2" else [("c2", "c2")]) if b == ref and meta[c] for p, n in listing[meta[c]].items() if p not in own]
        shown += [(p, n) for p, n in own.items() if n is not None]
        found = {}
        for p, n in shown:
            if p.startswith(prefix):
                at = p.find(delimiter, len(prefix)) if delimiter else -1
                found.setdefault(p if at < 0 else p[:at + 1], []).append(n)
        keys = sorted(k for k in found if k > after)
        more = len(keys) > amount
        want += [(seq, k, len(found[k]), sum(found[k]), i, more, keys[amount - 1] if more else None) for i, k in enumerate(keys[:amount], 1)]
        want += [(seq, None, None, None, None, False, None)] * (not keys)
    cols = ["seq", "entry", "n_objects", "total_bytes", "position", "has_more", "next_after"]
    got = rows(OB.list_objects_at(req, refs, commits, entries, staging), *cols)
    assert sorted(set(got), key=repr) == sorted(want, key=repr)  # a request on a ref of two rows is answered to each
    assert {r for r in got if got.count(r) > 1} == {r for r in want if asked[r[0]][1] == "two"}
