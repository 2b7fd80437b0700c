"""Listings, identity, commits, merge base, merges."""
import pytest
from pyspark.sql import functions as F

from strata.operators import commits as C
from strata.operators import listing as L
from strata.operators import merge as MG
from tests.conftest import rows

ENTRIES = "repository string, meta_range_id string, path string, physical_address string, checksum string, size_bytes long"
COMMITS = ("repository string, commit_id string, committer string, message string, meta_range_id string, "
           "generation long, version int, creation_date timestamp_ntz")
PARENTS = "repository string, commit_id string, pos int, parent_id string"
REFS = "repository string, branch string, commit_id string, hidden boolean"
STAGING = ("repository string, branch string, path string, op string, physical_address string, checksum string, "
           "size_bytes long, seq long")


def entries(spark, listing):
    return spark.createDataFrame([("r", mr, p, ck, ck, 1) for mr, files in listing.items()
                                  for p, ck in files.items()], ENTRIES)


def test_classify_truth_table(spark):
    cases = [("a", "a", "a", "unchanged"), ("a", "b", "b", "same_change"), ("a", "b", "a", "take_source"),
             ("a", "a", "b", "keep_dest"), ("a", "b", "c", "conflict"), (None, "b", None, "take_source"),
             ("a", None, "a", "take_source"), ("a", None, "b", "conflict"), (None, "x", "x", "same_change"),
             ("a", None, None, "same_change")]
    df = spark.createDataFrame(cases, "b string, s string, d string, want string")
    got = df.select(L.classify(F.col("b"), F.col("s"), F.col("d")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_listing_id_order_free_and_incremental(spark):
    e = entries(spark, {"m1": {"a": "1", "b": "2", "c": "3"}, "m2": {"c": "3", "a": "1", "b": "2"},
                        "m3": {"a": "1", "b": "9", "d": "4"}})
    ids = dict((r.meta_range_id, r.listing_id) for r in L.listing_identity(L.listing_stats(e)).collect())
    assert ids["m1"] == ids["m2"] != ids["m3"]
    # m1 → m3 by deltas: change b, remove c, add d
    ch = spark.createDataFrame([("b", "2", "9"), ("c", "3", None), ("d", None, "4")],
                               "path string, old string, new string")
    d = ch.select(*[x.alias(f"d{i}") for i, x in enumerate(L.change_lanes(F.col("path"), F.col("old"), F.col("new")))])
    tot = d.agg(*[F.sum(f"d{i}").alias(f"d{i}") for i in range(3)]).first()
    st = L.listing_stats(e).where("meta_range_id = 'm1'").first()
    from strata.functions import hashing as H
    new = spark.range(1).select(H.listing_id(F.lit(st.lane0) + F.lit(tot.d0), F.lit(st.lane1) + F.lit(tot.d1),
                                             F.lit(st.n_entries + tot.d2)).alias("x")).first().x
    assert new == ids["m3"]


def _repo(spark):
    e = entries(spark, {"base": {"a": "1", "b": "1", "c": "1"},
                        "src": {"a": "2", "b": "1", "c": "5", "n": "1"},
                        "dst": {"a": "1", "b": "3", "c": "6"}})
    commits = spark.createDataFrame([
        ("r", "c0", "u", "m", "base", 1, 1, None), ("r", "cs", "u", "m", "src", 2, 1, None),
        ("r", "cd", "u", "m", "dst", 2, 1, None)], COMMITS)
    parents = spark.createDataFrame([("r", "cs", 0, "c0"), ("r", "cd", 0, "c0")], PARENTS)
    refs = spark.createDataFrame([("r", "main", "cd", False), ("r", "feat", "cs", False)], REFS)
    return e, commits, parents, refs


def test_merge_base_and_log(spark):
    e, commits, parents, refs = _repo(spark)
    pairs = spark.createDataFrame([("r", "cs", "cd"), ("r", "cs", "cs")], "repository string, a string, b string")
    assert rows(C.merge_base(pairs, commits, parents), "a", "b", "base_id") == [("cs", "cd", "c0"), ("cs", "cs", "cs")]
    heads = spark.createDataFrame([("r", "feat", "cs")], "repository string, ref_name string, commit_id string")
    assert rows(C.log_commits(heads, commits, parents), "position", "commit_id") == [(1, "cs"), (2, "c0")]


def test_merge_outcomes_and_identity(spark):
    e, commits, parents, refs = _repo(spark)
    req = spark.createDataFrame([
        (1, "r", "feat", "main", False, False), (2, "r", "feat", "main", True, False),
        (3, "r", "feat", "main", True, False), (4, "r", "main", "main", False, False),
        (5, "r", "nope", "main", False, False)],
        "seq long, repository string, source_ref string, destination_branch string, force boolean, allow_empty boolean")
    out = MG.merge_refs(req.withColumn("date", F.lit(1700000000).cast("long")), refs, commits, parents, e)
    got = dict((r.seq, r) for r in out.collect())
    assert got[1].outcome == "conflict" and got[1].n_conflict == 1 and got[1].n_take_source == 2
    assert got[2].outcome == "merged" and got[3].outcome == "retry_next_batch"
    assert got[4].outcome == "nothing_to_merge"           # merge(x, x)
    assert got[5].outcome == "ref_not_found"
    # forced merge listing: a←2 (take), b=3 (keep), c←5 (conflict, source wins), n←1 (take)
    want = entries(spark, {"x": {"a": "2", "b": "3", "c": "5", "n": "1"}})
    wid = L.listing_identity(L.listing_stats(want)).first().listing_id
    assert got[2].meta_range_id == wid


def test_commit_then_diff_is_empty(spark):
    e, commits, parents, refs = _repo(spark)
    staging = spark.createDataFrame([
        ("r", "main", "a", "put", "1", "1", 1, 1),       # same checksum: no change
        ("r", "main", "b", "delete", None, None, None, 2),
        ("r", "main", "z", "put", "7", "7", 1, 3),
        ("r", "main", "z", "put", "8", "8", 1, 4)], STAGING)
    req = spark.createDataFrame([(1, "r", "main", "msg", 1700000000), (2, "r", "main", "msg2", 1700000001),
                                 (3, "r", "feat", "m", 1700000000)],
                                "seq long, repository string, branch string, message string, date long")
    out = C.commit_branches(req, refs, commits, e, staging)
    got = dict((r.seq, r) for r in out.collect())
    assert got[1].outcome == "committed" and got[1].n_changes == 2 and got[1].generation == 3
    assert got[2].outcome == "retry_next_batch"
    assert got[3].outcome == "nothing_to_commit"
    deltas = C.commit_deltas(out, e, staging)
    new_entries = deltas["entries"]
    assert rows(new_entries, "path", "checksum") == [("a", "1"), ("c", "6"), ("z", "8")]
    # the stored listing hashes to the id the commit announced
    ident = L.listing_identity(L.listing_stats(new_entries)).first()
    assert ident.listing_id == got[1].meta_range_id
    # committing again on the new state finds nothing to commit
    refs2 = refs.where("branch <> 'main'").unionByName(
        deltas["refs"].select("repository", "branch", "commit_id", F.lit(False).alias("hidden")))
    commits2 = commits.unionByName(deltas["commits"].select(*commits.columns), allowMissingColumns=True)
    again = C.commit_branches(req.where("seq = 1"), refs2, commits2, e.unionByName(new_entries),
                              deltas["staging"])
    assert again.first().outcome == "nothing_to_commit"


@pytest.mark.parametrize("revert", [True, False])
def test_revert_and_cherry_pick(spark, revert):
    e, commits, parents, refs = _repo(spark)
    req = spark.createDataFrame([(1, "r", "main", "feat", True)],
                                "seq long, repository string, branch string, commit_ref string, force boolean")
    fn = MG.revert_commit if revert else MG.cherry_pick
    r = fn(req, refs, commits, parents, e).first()
    assert r.outcome == ("reverted" if revert else "picked")


def test_three_way_summary_counts_only_changed_paths(spark):
    base = {f"p{i:05d}": str(i) for i in range(5000)}
    src = dict(base, p00007="x", p00100="y")
    src.pop("p00200")
    dst = dict(base, p00007="z", p04000="w")
    e = entries(spark, {"b": base, "s": src, "d": dst})
    triples = spark.createDataFrame([("r", "b", "s", "d"), ("r", "b", "b", "b"), ("r", "d", "s", "b")],
                                    "repository string, base_range string, source_range string, dest_range string")
    got = {r.base_range + r.source_range + r.dest_range: r for r in L.three_way_summary(triples, e).collect()}
    assert got["bsd"].n_unchanged == 4996 and got["bsd"].n_conflict == 1 and got["bsd"].n_take_source == 2
    assert got["bbb"].n_unchanged == 5000
    sides = [(t, s, p, c) for t, n in (("bsd", "bsd"), ("dsb", "dsb"))
             for s, side in zip(("base", "source", "dest"), n) for p, c in {"b": base, "s": src, "d": dst}[side].items()]
    df = spark.createDataFrame(sides, "t string, side string, path string, checksum string")
    for r in L.three_way(df, ["t"]).groupBy("t", "class").count().collect():
        assert got[r.t][f"n_{r['class']}"] == r["count"]


def test_conflict_free_merge_is_symmetric(spark):
    e = entries(spark, {"base": {"a": "1", "b": "1", "c": "1"},
                        "src": {"a": "2", "b": "1", "c": "1", "n": "1"},
                        "dst": {"a": "1", "b": "3"}})
    commits = spark.createDataFrame([
        ("r", "c0", "u", "m", "base", 1, 1, None), ("r", "cs", "u", "m", "src", 2, 1, None),
        ("r", "cd", "u", "m", "dst", 2, 1, None)], COMMITS)
    parents = spark.createDataFrame([("r", "cs", 0, "c0"), ("r", "cd", 0, "c0")], PARENTS)
    refs = spark.createDataFrame([("r", "main", "cd", False), ("r", "feat", "cs", False)], REFS)
    req = spark.createDataFrame([(1, "r", "feat", "main"), (2, "r", "main", "feat")],
                                "seq long, repository string, source_ref string, destination_branch string")
    out = {r.seq: r for r in MG.merge_refs(req.withColumn("date", F.lit(1).cast("long")),
                                            refs, commits, parents, e).collect()}
    assert out[1].outcome == out[2].outcome == "merged"
    assert out[1].meta_range_id == out[2].meta_range_id
    want = entries(spark, {"x": {"a": "2", "b": "3", "n": "1"}})
    assert out[1].meta_range_id == L.listing_identity(L.listing_stats(want)).first().listing_id


def test_commit_source_metarange_and_head_moved(spark):
    e, commits, parents, refs = _repo(spark)
    staging = spark.createDataFrame([], STAGING)
    req = spark.createDataFrame([(1, "r", "main", "src", None), (2, "r", "feat", None, "zz"),
                                 (3, "r", "feat", None, "cs")],
                                "seq long, repository string, branch string, source_metarange string, "
                                "expected_head string")
    out = {r.seq: r for r in C.commit_branches(req.withColumn("date", F.lit(1).cast("long")), refs, commits, e,
                                               staging).collect()}
    src_id = L.listing_identity(L.listing_stats(e)).where("meta_range_id = 'src'").first().listing_id
    assert out[1].outcome == "committed" and out[1].meta_range_id == src_id
    assert out[2].outcome == "head_moved"
    assert out[3].outcome == "nothing_to_commit"


def test_merge_from_commit_id_equals_branch(spark):
    e, commits, parents, refs = _repo(spark)
    req = spark.createDataFrame([(1, "r", "feat", "main"), (2, "r", "cs", "main")],
                                "seq long, repository string, source_ref string, destination_branch string")
    out = MG.merge_refs(req.withColumn("force", F.lit(True)).withColumn("date", F.lit(1).cast("long")),
                        refs, commits, parents, e)
    got = {r.seq: r for r in out.collect()}
    assert got[1].n_conflict == got[2].n_conflict == 1 and got[1].base_id == got[2].base_id == "c0"
    assert got[1].outcome == "merged" and got[2].outcome == "retry_next_batch"


def test_merge_deltas_materialize_the_announced_listing(spark):
    e, commits, parents, refs = _repo(spark)
    req = spark.createDataFrame([(1, "r", "feat", "main", True)],
                                "seq long, repository string, source_ref string, destination_branch string, "
                                "force boolean")
    out = MG.merge_refs(req.withColumn("date", F.lit(1).cast("long")), refs, commits, parents, e)
    d = MG.merge_deltas(out, e)
    got = out.first()
    assert rows(d["entries"], "path", "checksum") == [("a", "2"), ("b", "3"), ("c", "5"), ("n", "1")]
    assert L.listing_identity(L.listing_stats(d["entries"])).first().listing_id == got.meta_range_id
    c = d["commits"].first()
    assert c.parents == ["cd", "cs"] and c.commit_id == got.commit_id
    assert rows(d["refs"], "branch", "commit_id") == [("main", got.commit_id)]


def test_revert_deltas_restore_the_parent_listing(spark):
    e, commits, parents, refs = _repo(spark)
    # revert feat's head (cs) on feat itself: the result is cs's parent listing (base)
    req = spark.createDataFrame([(1, "r", "feat", "cs", False)],
                                "seq long, repository string, branch string, commit_ref string, force boolean")
    out = MG.revert_commit(req.withColumn("date", F.lit(5).cast("long")), refs, commits, parents, e)
    r = out.first()
    assert r.outcome == "reverted" and r.commit_id is not None and r.generation == 3
    d = MG.single_commit_deltas(out, e)
    want = L.listing_identity(L.listing_stats(e)).where("meta_range_id = 'base'").first().listing_id
    assert r.meta_range_id == want
    assert rows(d["entries"]) == [] or \
        L.listing_identity(L.listing_stats(d["entries"])).first().listing_id == want
    assert d["commits"].first().parents == ["cs"]


def test_history_of_any_depth(spark):
    """A linear history far longer than any cap, with a side branch."""
    n = 3000
    edges = [("r", f"c{i:05d}", 0, f"c{i - 1:05d}") for i in range(1, n)]
    edges += [("r", "s0", 0, "c00010")] + [("r", f"s{i}", 0, f"s{i - 1}") for i in range(1, 40)]
    parents = spark.createDataFrame(edges, "repository string, commit_id string, pos int, parent_id string")
    gens = [("r", f"c{i:05d}", i + 1) for i in range(n)] + [("r", f"s{i}", 12 + i) for i in range(40)]
    commits = spark.createDataFrame(gens, "repository string, commit_id string, generation long")
    pairs = spark.createDataFrame([("r", f"c{n - 1:05d}", "s39"), ("r", f"c{n - 1:05d}", "c00500"), ("r", "s3", "s3")],
                                  "repository string, a string, b string")
    assert sorted(r.base_id for r in C.merge_base(pairs, commits, parents).collect()) == ["c00010", "c00500", "s3"]
    seeds = spark.createDataFrame([("r", f"c{n - 1:05d}"), ("r", "s39")], "repository string, seed string")
    got = {r.seed: r["count"] for r in C.ancestors(seeds, parents).groupBy("seed").count().collect()}
    assert got == {f"c{n - 1:05d}": n, "s39": 40 + 11}


def test_merge_base_of_no_pairs(spark):
    none = spark.createDataFrame([], "repository string, a string, b string")
    commits = spark.createDataFrame([("r", "c", 1)], "repository string, commit_id string, generation long")
    parents = spark.createDataFrame([], "repository string, commit_id string, pos int, parent_id string")
    assert C.merge_base(none, commits, parents).count() == 0


def test_listing_without_stored_stats_is_not_empty(spark):
    e = entries(spark, {"x": {"a": "1"}, "y": {"b": "2", "c": "3"}})
    whole = L.listing_identity(L.listing_stats(e))
    stored = whole.where("meta_range_id = 'x'")
    wanted = spark.createDataFrame([("r", "x"), ("r", "y"), ("r", "z")], "repository string, meta_range_id string")
    got = L.listing_identity(L.stats_for(e, wanted, stored))
    assert rows(got, "meta_range_id", "listing_id") == rows(whole, "meta_range_id", "listing_id")


def test_branch_view_equals_simulation_with_a_hot_path(spark):
    import random
    rnd = random.Random(9)
    e, commits, parents, refs = _repo(spark)            # main → listing dst {a:1, b:3, c:6}
    ops, seq = [], 0
    for _ in range(600):
        seq += 1
        path = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", "c", "d"])
        if rnd.random() < 0.3:
            ops.append(("r", "main", path, "delete", None, None, None, seq))
        else:
            ck = f"k{rnd.randint(0, 5)}"
            ops.append(("r", "main", path, "put", ck, ck, 1, seq))
    staging = spark.createDataFrame(ops, STAGING)
    view = L.branch_view(spark.createDataFrame([("r", "main")], "repository string, branch string"),
                         refs, commits, e, staging)
    want = {"a": "1", "b": "3", "c": "6"}
    for _, _, path, op, _, ck, _, _ in ops:
        if op == "put":
            want[path] = ck
        else:
            want.pop(path, None)
    assert rows(view, "path", "checksum") == sorted(want.items())


def test_commit_outcomes_equal_simulation(spark):
    import random
    rnd = random.Random(21)
    e, commits, parents, refs = _repo(spark)
    heads = {"main": "cd", "feat": "cs"}
    listing = {"main": {"a": "1", "b": "3", "c": "6"}, "feat": {"a": "2", "b": "1", "c": "5", "n": "1"}}
    ops = []
    for s in range(1, 200):
        br, path = rnd.choice(["main", "feat"]), rnd.choice(["a", "b", "c", "n", "q"])
        if rnd.random() < 0.3:
            ops.append(("r", br, path, "delete", None, None, None, s))
        else:
            ck = rnd.choice(["1", "2", "3", "5", "6", "9"])
            ops.append(("r", br, path, "put", ck, ck, 1, s))
    staging = spark.createDataFrame(ops, STAGING)
    reqs = [(s, "r", rnd.choice(["main", "feat", "zz", ""]), rnd.random() < 0.3, rnd.random() < 0.3,
             rnd.choice([None, "cd", "cs", "bad"])) for s in range(1, 40)]
    df = spark.createDataFrame(reqs, "seq long, repository string, branch string, allow_empty boolean, "
                                     "force boolean, expected_head string").withColumn("date", F.lit(1).cast("long"))
    got = {r.seq: (r.outcome, r.n_changes) for r in C.commit_branches(df, refs, commits, e, staging).collect()}
    last = {}
    for _, br, path, op, _, ck, _, _ in ops:
        last[(br, path)] = (op, ck)
    want, done = {}, set()
    for seq, _, br, allow, force, expected in reqs:
        if br == "":
            want[seq] = ("invalid", 0)
        elif br not in heads:
            want[seq] = ("branch_not_found", 0)
        elif expected is not None and expected != heads[br] and not force:
            want[seq] = ("head_moved", 0)
        elif br in done:
            want[seq] = ("retry_next_batch", 0)
        else:
            done.add(br)
            n = 0
            for (b, path), (op, ck) in last.items():
                if b == br and ((op == "put" and listing[br].get(path) != ck) or
                                (op == "delete" and path in listing[br])):
                    n += 1
            want[seq] = ("nothing_to_commit" if n == 0 and not allow else "committed", n)
    for seq, (outcome, n) in want.items():
        assert got[seq][0] == outcome, (seq, got[seq], outcome)
        if outcome in ("committed", "nothing_to_commit"):
            assert got[seq][1] == n


def test_three_way_and_merged_listing_equal_simulation(spark):
    import random
    rnd = random.Random(13)
    names = [f"p{i}" for i in range(200)]

    def listing():
        return {p: rnd.choice("123") for p in names if rnd.random() < 0.8}
    base = listing()
    src = {p: (rnd.choice("1234") if rnd.random() < 0.3 else c) for p, c in base.items() if rnd.random() < 0.9}
    dst = {p: (rnd.choice("1234") if rnd.random() < 0.3 else c) for p, c in base.items() if rnd.random() < 0.9}
    src.update({f"s{i}": "7" for i in range(5)})
    dst.update({"s0": "7", "s1": "8"})
    e = entries(spark, {"b": base, "s": src, "d": dst})
    t = spark.createDataFrame([("r", "b", "s", "d")], "repository string, base_range string, source_range string, "
                                                      "dest_range string")
    got = L.three_way_summary(t, e).first()
    counts, merged = {c: 0 for c in L.CLASSES}, {}
    for p in set(base) | set(src) | set(dst):
        b, s, d = base.get(p), src.get(p), dst.get(p)
        cls = ("unchanged" if s == d == b else "same_change" if s == d else "take_source" if d == b
               else "keep_dest" if s == b else "conflict")
        counts[cls] += 1
        v = s if cls in ("take_source", "conflict") else d          # forced merge
        if v is not None:
            merged[p] = v
    assert {c: getattr(got, f"n_{c}") for c in L.CLASSES} == counts
    done = t.withColumn("force", F.lit(True)).withColumn("meta_range_id", F.lit("m"))
    out = L.merged_listing(done, e)
    assert rows(out, "path", "checksum") == sorted(merged.items())


def test_merge_bases_with_few_and_with_many_edges(spark, monkeypatch):
    import random
    rng = random.Random(8)
    parents, gen = {0: []}, {0: 0}
    for i in range(1, 24):
        parents[i] = rng.sample(range(max(0, i - 9), i), min(i, rng.choice([1, 1, 2])))
        gen[i] = 1 + max(gen[p] for p in parents[i])
    parents[70], gen[70] = [], 0  # of no kin

    def above(c):
        out, todo = set(), [c]
        while todo:
            x = todo.pop()
            if x not in out:
                out.add(x)
                todo += parents[x]
        return out

    name = "c{:02d}".format
    pairs = [(rng.randrange(24), rng.randrange(24)) for _ in range(30)] + [(70, 5), (70, 70)]
    want = []
    for a, b in set(pairs):
        both = above(a) & above(b)
        best = min(both, key=lambda c: (-gen[c], name(c))) if both else None
        want.append((name(a), name(b), name(best) if both else None))
    commits = spark.createDataFrame([("r", name(c), g) for c, g in gen.items()], "repository string, commit_id string, generation long")
    edges = spark.createDataFrame([("r", name(c), k, name(p)) for c, ps in parents.items() for k, p in enumerate(ps)],
                                  "repository string, commit_id string, pos int, parent_id string")
    df = spark.createDataFrame([("r", name(a), name(b)) for a, b in pairs], "repository string, a string, b string")
    for small in (C.small_side, lambda d: d):
        monkeypatch.setattr(C, "small_side", small)
        assert rows(C.merge_base(df, commits, edges), "a", "b", "base_id") == sorted(want, key=repr)
