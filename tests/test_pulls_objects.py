"""Pull requests, objects and symlinks."""
import os
import random

from pyspark.sql import functions as F

from strata.operators import listing as L
from strata.operators import objects as OB
from strata.operators import pulls as PR
from tests.conftest import rows

PRS = ("repository string, id string, status string, title string, description string, author string, "
       "source_branch string, destination_branch string, merged_commit_id string, creation_date timestamp_ntz, "
       "closed_date timestamp_ntz")


def _prs(spark, n=300, seed=3):
    rnd = random.Random(seed)
    data = [("r" if rnd.random() < 0.7 else "s", f"pr_{i:05d}", rnd.choice(["open", "closed", "merged"]),
             "t", None, "u", "b", "main", None, None, None) for i in range(n)]
    return spark.createDataFrame(data, PRS)


def test_list_pages_match_brute_force(spark):
    prs = _prs(spark)
    rnd = random.Random(5)
    reqs = [(i, rnd.choice(["r", "s", "x"]), rnd.choice(["", "pr_000", "pr_001", "pr_0019", "pr_9"]),
             rnd.choice(["", f"pr_{rnd.randint(0, 320):05d}", "pr_"]), rnd.randint(1, 6),
             rnd.choice(["open", "closed", "all"])) for i in range(60)]
    req = spark.createDataFrame(reqs, "seq long, repository string, prefix string, after string, amount int, "
                                      "status string")
    out = PR.list_pull_requests(req, prs)
    assert {r.seq for r in out.collect()} == set(range(60))   # every request has a row
    got = rows(out.where("id IS NOT NULL"), "seq", "id", "position", "has_more", "next_after")
    allp = [(r.repository, r.id, r.status) for r in prs.collect()]
    want = []
    for seq, repo, prefix, after, amount, status in reqs:
        m = sorted(i for rp, i, st in allp if rp == repo and i.startswith(prefix) and i > after
                   and (status == "all" or (status == "open") == (st == "open")))
        more = len(m) > amount
        for pos, i in enumerate(m[:amount], 1):
            want.append((seq, i, pos, more, m[amount - 1] if more else None))
    assert got == sorted(want, key=repr)


def test_create_update_fetch(spark):
    refs = spark.createDataFrame([("r", "main", "c", False), ("r", "f", "d", False)],
                                 "repository string, branch string, commit_id string, hidden boolean")
    req = spark.createDataFrame([(1, "r", "t1", "f", "main"), (2, "r", "t2", "zz", "main"),
                                 (3, "r", "t3", "main", None), (4, "r", None, "f", "main")],
                                "seq long, repository string, title string, source_branch string, "
                                "destination_branch string")
    out = PR.create_pull_requests(req, refs)
    assert rows(out, "seq", "outcome") == [(1, "created"), (2, "branch_not_found"), (3, "same_branch"),
                                          (4, "invalid")]
    prs = _prs(spark, 5)
    up = spark.createDataFrame([(1, "r", "pr_00000", "closed"), (2, "r", "nope", None)],
                               "seq long, repository string, id string, status string")
    got = rows(PR.update_pull_requests(up, prs), "seq", "outcome")
    assert got[1] == (2, "not_found")
    f = PR.fetch_pull_requests(up.select("seq", "repository", "id"), prs)
    assert rows(f, "seq", "outcome")[1] == (2, "not_found")


def _objects_state(spark):
    entries = spark.createDataFrame([("r", "m1", "a/x.txt", "k1", "k1", 3)],
                                    "repository string, meta_range_id string, path string, physical_address string, "
                                    "checksum string, size_bytes long")
    commits = spark.createDataFrame([("r", "c1", "m1", 1)],
                                    "repository string, commit_id string, meta_range_id string, generation long")
    refs = spark.createDataFrame([("r", "main", "c1", False)],
                                 "repository string, branch string, commit_id string, hidden boolean")
    staging = spark.createDataFrame([], "repository string, branch string, path string, op string, "
                                        "physical_address string, checksum string, size_bytes long, seq long")
    return refs, commits, entries, staging


def test_put_fetch_round_trip(spark):
    refs, commits, entries, staging = _objects_state(spark)
    req = spark.createDataFrame([(1, "r", "main", "a/x.txt", bytearray(b"new"), False),
                                 (2, "r", "main", "b/y.txt", bytearray(b"hello"), False),
                                 (3, "r", "main", "b/y.txt", bytearray(b"again"), False),
                                 (4, "r", "main", "b/z.txt", bytearray(b"hello"), True),
                                 (5, "r", "nope", "b/z.txt", bytearray(b"x"), True)],
                                "seq long, repository string, branch string, path string, content binary, "
                                "overwrite boolean")
    out = OB.put_objects(req, refs, commits, entries, staging)
    assert rows(out, "seq", "outcome") == [(1, "exists"), (2, "stored"), (3, "exists"), (4, "stored"),
                                          (5, "branch_not_found")]
    d = OB.put_deltas(out)
    assert d["contents"].count() == 1          # "hello" stored once
    staging2 = staging.unionByName(d["staged"])
    freq = spark.createDataFrame([(1, "r", "main", "b/y.txt"), (2, "r", "c1", "b/y.txt"), (3, "r", "main", "q")],
                                 "seq long, repository string, ref string, path string")
    f = OB.fetch_objects(freq, refs, commits, entries, staging2, d["contents"])
    got = dict((r.seq, r) for r in f.collect())
    assert bytes(got[1].content) == b"hello" and got[1].file_name == "y.txt" and got[1].file_length == 5
    assert got[2].outcome == "path_not_found"   # a commit id does not see staged changes
    assert got[3].outcome == "path_not_found"


def test_binary_file_source_and_symlinks(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "one.txt").write_bytes(b"abc")
    files = spark.read.format("binaryFile").load(str(src))
    assert files.select(F.sha2("content", 256).alias("k")).first().k == \
        "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    view = spark.createDataFrame([("d1/a", "p2"), ("d1/0", "p1"), ("d2/x/y", "p3")],
                                 "path string, physical_address string").withColumn("size_bytes", F.lit(1))
    loc = str(tmp_path / "links")
    OB.write_symlinks(view, loc)
    d1 = [p for p in os.listdir(loc) if p.startswith("dir=d1")][0]
    lines = []
    for fn in sorted(os.listdir(os.path.join(loc, d1))):
        if fn.startswith("part-"):
            lines += open(os.path.join(loc, d1, fn)).read().split()
    assert lines == ["p1", "p2"]
    assert rows(OB.symlink_manifest(view), "dir", "n_files") == [("d1", 2), ("d2/x", 1)]
    lo = OB.list_objects(view, prefix="d", delimiter="/")
    assert rows(lo, "entry", "kind", "n_objects") == [("d1/", "prefix", 2), ("d2/", "prefix", 1)]


def test_delete_copy_deltas_and_list_once(spark):
    refs, commits, entries, staging = _objects_state(spark)
    req = spark.createDataFrame([(1, "r", "main", "a/x.txt", "b/copy.txt"), (2, "r", "main", "nope", "z")],
                                "seq long, repository string, branch string, path string, dest_path string")
    cp = OB.copy_objects(req, refs, commits, entries, staging)
    assert rows(cp, "seq", "outcome") == [(1, "copied"), (2, "path_not_found")]
    d = OB.mutation_deltas(cp)
    assert rows(d, "path", "op", "physical_address") == [("b/copy.txt", "put", "k1")]
    de = OB.delete_objects(req.drop("dest_path"), refs, commits, entries, staging)
    staging2 = staging.unionByName(OB.mutation_deltas(de))
    st = OB.stat_objects(req.select("seq", "repository", F.col("branch").alias("ref"), "path"),
                         refs, commits, entries, staging2)
    assert rows(st, "seq", "outcome") == [(1, "path_not_found"), (2, "path_not_found")]
    prs = _prs(spark, 50)
    once = PR.list_pull_requests_once(prs, "r", prefix="pr_0001", after="pr_00012", amount=3, status="all")
    want = sorted(r.id for r in prs.collect() if r.repository == "r" and r.id.startswith("pr_0001")
                  and r.id > "pr_00012")[:3]
    assert [r.id for r in once.collect()] == want


def test_apply_pr_outcomes(spark):
    first = F.col("id") == "pr_00000"
    prs = (_prs(spark, 4).withColumn("status", F.when(first, "open").otherwise(F.col("status")))
           .withColumn("repository", F.when(first, "r").otherwise(F.col("repository"))))
    up = spark.createDataFrame([(1, "r", "pr_00000", "retitled", "closed"), (2, "r", "pr_00000", "again", None)],
                               "seq long, repository string, id string, title string, status string")
    out = PR.update_pull_requests(up, prs)
    new = {r.id: r for r in PR.apply_pr_outcomes(prs, out).collect()}
    old = {r.id: r for r in prs.collect()}
    # the second update sees the first one's status
    assert new["pr_00000"].title == "again" and new["pr_00000"].status == "closed"
    got = {r.seq: r for r in out.collect()}
    assert got[1].title == "retitled" and got[2].status == "closed"
    assert new["pr_00001"] == old["pr_00001"] and len(new) == len(old)


def test_read_at_ref_reads_the_listed_files(spark, tmp_path):
    a, b, c = (str(tmp_path / n) for n in ("a", "b", "c"))
    spark.range(3).write.parquet(a)
    spark.range(10, 12).write.parquet(b)
    spark.range(100, 101).write.parquet(c)
    view = spark.createDataFrame([("tables/t/part-0", a), ("tables/t/part-1", b), ("other/x", c)],
                                 "path string, physical_address string")
    got = OB.read_at_ref(view, "tables/t/")
    assert sorted(r.id for r in got.collect()) == [0, 1, 2, 10, 11]


def test_hot_symlink_directory_is_split_across_tasks(spark, tmp_path):
    view = spark.createDataFrame([(f"hot/f{i:04d}", f"a{i:04d}") for i in range(400)] + [("cold/x", "c")],
                                 "path string, physical_address string")
    loc = str(tmp_path / "links")
    OB.write_symlinks(view, loc, num_partitions=4)
    hot = os.path.join(loc, [d for d in os.listdir(loc) if d.startswith("dir=hot")][0])
    parts = sorted(f for f in os.listdir(hot) if f.startswith("part-"))
    assert len(parts) > 1                           # one directory, several writer tasks
    chunks = [open(os.path.join(hot, f)).read().split() for f in parts]
    assert all(c == sorted(c) for c in chunks)      # each file in path order
    assert sorted(sum(chunks, [])) == [f"a{i:04d}" for i in range(400)]


def test_put_outcomes_equal_sequential_processing(spark):
    import random
    rnd = random.Random(4)
    refs, commits, entries, staging = _objects_state(spark)      # a/x.txt is committed on main
    reqs = [(s, "r", "main", rnd.choice(["a/x.txt", "b/1", "b/2", "b/3"]), bytearray(f"v{s}".encode()),
             rnd.random() < 0.3) for s in range(1, 120)]
    df = spark.createDataFrame(reqs, "seq long, repository string, branch string, path string, "
                                     "content binary, overwrite boolean")
    got = {r.seq: r.outcome for r in OB.put_objects(df, refs, commits, entries, staging).collect()}
    visible, want = {"a/x.txt"}, {}
    for seq, _, _, path, _, overwrite in reqs:
        want[seq] = "stored" if overwrite or path not in visible else "exists"
        visible.add(path)
    assert got == want


def test_list_objects_equals_simulation(spark):
    import random
    rnd = random.Random(8)
    paths = sorted({"/".join(rnd.choice(["a", "b", "c"]) for _ in range(rnd.randint(1, 4))) + f".{i}"
                    for i in range(300)})
    view = spark.createDataFrame([(p, 1) for p in paths], "path string, size_bytes long")
    for prefix, after in (("", ""), ("a/", ""), ("a/b", "a/b/c"), ("zzz", "")):
        got = {(r.entry, r.kind): r.n_objects for r in OB.list_objects(view, prefix, "/", after).collect()}
        want = {}
        for p in paths:
            if p.startswith(prefix) and p > after:
                rest = p[len(prefix):]
                key = (prefix + rest[:rest.index("/") + 1], "prefix") if "/" in rest else (p, "object")
                if key[0] <= after:   # the page before ended with this entry
                    continue
                want[key] = want.get(key, 0) + 1
        assert got == want, prefix


def test_list_pull_requests_reports_every_request(spark):
    prs = spark.createDataFrame([("r", f"pr_{i}", "open") for i in range(5)], "repository string, id string, status string")
    req = spark.createDataFrame([(1, "r", 2_000_000_000, "all"), (2, "r", 1, "odd"), (3, "nope", 1, "all"), (4, "r", 0, "all")],
                                "seq long, repository string, amount int, status string")
    out = PR.list_pull_requests(req, prs)
    assert rows(out.where("seq > 1"), "seq", "outcome", "ok", "id") == [
        (2, "invalid", False, None), (3, "fetched", True, None), (4, "invalid", False, None)]
    assert [r.id for r in out.where("seq = 1").orderBy("position").collect()] == [f"pr_{i}" for i in range(5)]


def test_root_directory_and_paging(spark):
    view = spark.createDataFrame([("root.txt", 1), ("p/A/1", 1), ("p/A/2", 1), ("p/B", 1)], "path string, size_bytes long")
    assert rows(OB.symlink_manifest(view), "dir", "n_files") == [("", 1), ("p", 1), ("p/A", 2)]
    assert rows(OB.list_objects(view, "p/", "/", after="p/A/"), "entry") == [("p/B",)]
    assert rows(OB.list_objects(view, "p/", "/", amount=1), "entry") == [("p/A/",)]


def test_closing_and_reopening_set_the_closed_date(spark):
    prs = spark.sql("SELECT 'r' AS repository, id, status, 't' AS title, 'd' AS description, closed AS closed_date FROM VALUES "
                    "('a', 'open', NULL), ('b', 'closed', TIMESTAMP_NTZ '2024-01-01 00:00:00') AS t(id, status, closed)")
    req = spark.createDataFrame([(1, "r", "a", "closed", 86400), (2, "r", "b", "open", None)],
                                "seq long, repository string, id string, status string, date long")
    after = PR.apply_pr_outcomes(prs, PR.update_pull_requests(req, prs))
    got = {r.id: (r.status, r.closed_date and r.closed_date.isoformat()) for r in after.collect()}
    assert got == {"a": ("closed", "1970-01-02T00:00:00"), "b": ("open", None)}


def test_symlinks_by_request(spark, tmp_path):
    refs, commits, entries, staging = _objects_state(spark)
    req = spark.createDataFrame([(1, "r", "main"), (2, "r", "gone"), (3, "r", "")], "seq long, repository string, branch string")
    out = OB.create_symlinks(req, refs, commits, entries, staging, str(tmp_path / "links"))
    assert rows(out, "seq", "outcome") == [(1, "created"), (2, "branch_not_found"), (3, "invalid")]
    where = out.where("ok").first().location
    lines = [r.value for r in spark.read.option("recursiveFileLookup", "true").text(where).collect()]
    assert len(lines) == L.branch_view(refs.select("repository", "branch").where("branch = 'main'"), refs, commits, entries, staging).count()
