"""Batches one after another, request and stream forms, and what they must not lose."""

import datetime
import json
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strata.functions import outcomes as O
from strata.functions.paging import pages, prefix_counts
from strata.operators import objects as OB
from strata.operators import pulls as PR
from strata.operators import refs as R
from strata.operators import state as STATE
from strata.operators import wait as WT
from strata.plans.sequences import ORACLE, QUERIES
from strata.sources.tables import DRIVER_TABLES
from strata.streaming import watch as ST
from tests.conftest import SF_SMALL, rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    assert entry.queries()[name] is QUERIES[name] and entry.oracle_sql()[name] == ORACLE[name]
    sdf = QUERIES[name](spark, SF_SMALL)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    at = [names.index(c) for c in sorted(names)]
    assert sorted(names) == sorted(sdf.columns)
    got = sorted((tuple(r[c] for c in sorted(names)) for r in sdf.collect()), key=repr)
    assert got == sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=repr) and got


def state(spark):
    commits = spark.createDataFrame([("r", "c1", "m1", 1), ("r", "c2", "m2", 2)], "repository string, commit_id string, meta_range_id string, generation long")
    refs = spark.createDataFrame([("r", "main", "c2", False), ("r", "a b/ü%", "c1", False), ("r", "x", "c1", True)],
                                 "repository string, branch string, commit_id string, hidden boolean")
    entries = spark.createDataFrame([("r", m, p, f"{m}{p}", f"{m}{p}", 3) for m in ("m1", "m2") for p in ("d1/a", "d1/b", "d2/e=f/c", "top")],
                                    "repository string, meta_range_id string, path string, physical_address string, checksum string, size_bytes long")
    staging = spark.createDataFrame([("r", "x", "d1/a", "delete", None, None, None, 1), ("r", "x", "d1/b", "delete", None, None, None, 1),
                                     ("r", "x", "new/n", "put", "n", "n", 1, 2), ("r", "main", "new/m", "put", "m", "m", 1, 1)],
                                    "repository string, branch string, path string, op string, physical_address string, checksum string, size_bytes long, seq long")
    return refs, commits, entries, staging


# --- branches and their deltas --------------------------------------------------

def test_tombstones_reach_the_next_state(spark):
    refs, commits, _, staging = state(spark)
    log = spark.createDataFrame([(1, "delete", "r", "x", None), (2, "create", "r", "x", "main"), (3, "delete", "r", "main", None), (4, "create", "r", "y", "x")],
                                "seq long, op string, repository string, branch string, source string")
    deltas = R.branch_deltas(R.apply_ref_log(log, refs, commits))
    assert rows(deltas["refs"], "branch", "commit_id", "deleted") == [("main", None, True), ("x", "c2", False), ("y", "c1", False)]
    assert rows(deltas["dropped"], "branch") == [("main",), ("x",)]
    now = {"refs": refs, "staging": staging}
    for _ in range(2):  # applying a delta again changes nothing
        now = STATE.apply_deltas(now, deltas)
        assert rows(now["refs"], "branch", "commit_id") == [("a b/ü%", "c1"), ("x", "c2"), ("y", "c1")]
        assert now["refs"].columns == refs.columns and now["staging"].count() == 0
    made = R.branch_deltas(R.create_branches(spark.createDataFrame([(1, "r", "z")], "seq long, repository string, branch string"), refs, commits))
    assert made["dropped"].count() == 0 and STATE.apply_deltas({"refs": refs}, made)["refs"].count() == 4


def test_pull_request_ids_are_not_made_twice(spark):
    refs, *_ = state(spark)
    req = spark.createDataFrame([(1, "r", "t", "x"), (2, "r", "t", "x"), (2, "r", "t", "x")], "seq long, repository string, title string, source_branch string")
    prs = spark.createDataFrame([], "repository string, id string, status string, title string, description string, author string, source_branch string, "
                                    "destination_branch string, creation_date timestamp_ntz, merged_commit_id string, closed_date timestamp_ntz")
    seen = set()
    for batch in range(3):
        out = PR.create_pull_requests(req, refs, prs).checkpoint()
        assert rows(out, "seq", "outcome") == [(1, "created"), (2, "retry_next_batch"), (2, "retry_next_batch")]
        delta = {"pull_requests": PR.new_pull_request_rows(out, F.lit(None).cast("timestamp_ntz")).checkpoint()}
        ids = {r.id for r in delta["pull_requests"].collect()}
        assert len(ids) == 1 and not ids & seen
        seen |= ids
        prs = STATE.apply_deltas({"pull_requests": prs}, delta)["pull_requests"].checkpoint()
        assert prs.count() == batch + 1
    assert rows(PR.create_pull_requests(req.limit(1), refs), "outcome") == [("created",)]
    taken = prs.limit(1).withColumn("id", PR.pr_id(F.lit("r"), F.lit(1), F.lit("t"), F.lit(1)))  # what the next one would get
    assert rows(PR.create_pull_requests(req.where("seq = 1"), refs, taken), "outcome", "id") == [("retry_next_batch", None)]


# --- symlinks -------------------------------------------------------------------

def links(spark, where):
    got = spark.read.schema("value string, repository string, branch string, dir string").text(where)
    return sorted((r.branch, r.dir or "", r.value) for r in got.collect())


def test_symlinks_of_other_branches_stay(spark, tmp_path):
    refs, commits, entries, staging = state(spark)
    where = str(tmp_path / "links")
    ask = lambda *names: spark.createDataFrame([(i, "r", b) for i, b in enumerate(names)], "seq long, repository string, branch string")
    one = OB.create_symlinks(ask("main", "a b/ü%"), refs, commits, entries, staging.limit(0), where)
    first = links(spark, where)
    assert {b for b, *_ in first} == {"main", "a b/ü%"} and len(first) == 8
    for r in one.collect():  # the location of each branch is where its files are
        assert spark.read.option("recursiveFileLookup", "true").text(r.location).count() == 4
    OB.create_symlinks(ask("x"), refs, commits, entries, staging, where)
    second = links(spark, where)
    assert [r for r in second if r[0] != "x"] == first
    assert [r for r in second if r[0] == "x"] == [("x", "", "m1top"), ("x", "d2/e=f", "m1d2/e=f/c"), ("x", "new", "n")]
    # again, with the directory d1 gone: its files go too; a branch without files has none
    gone = staging.where("branch = 'x' AND op = 'delete'")
    gone = gone.withColumn("branch", F.lit("main")).unionByName(
        entries.where("meta_range_id = 'm1'").select("repository", F.lit("a b/ü%").alias("branch"), "path", F.lit("delete").alias("op"),
                                                     "physical_address", "checksum", "size_bytes", F.lit(1).cast("long").alias("seq")))
    OB.create_symlinks(ask("main", "a b/ü%", "gone"), refs, commits, entries, gone, where)
    third = links(spark, where)
    assert [r for r in third if r[0] == "main"] == [("main", "", "m2top"), ("main", "d2/e=f", "m2d2/e=f/c")]
    assert not [r for r in third if r[0] == "a b/ü%"] and [r for r in third if r[0] == "x"] == [r for r in second if r[0] == "x"]
    assert not [f for f in os.listdir(where) if f.startswith("_staged")]


# --- files at a ref --------------------------------------------------------------

def test_many_paths_stay_in_the_cluster(spark):
    n = 100_000
    view = spark.range(n).selectExpr("concat('t/f', id) AS path", "sha2(string(id), 256) AS checksum")
    contents = spark.range(n).selectExpr("sha2(string(id), 256) AS checksum", "encode(concat(id, '\\nx', id), 'UTF-8') AS content")
    got = OB.read_at_ref(view, "t/", fmt="text", schema="value string", contents=contents)
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    assert got.selectExpr("count(*)", "count(DISTINCT value)").first()[:] == (2 * n, 2 * n)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "text"])
def test_formats(spark, tmp_path, fmt):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    some = spark.createDataFrame([("é", "1"), ("b", None)], "value string, n string")
    cols = ["value"] if fmt == "text" else ["value", "n"]
    options = {"header": "true"} if fmt == "csv" else {}
    some.select(*cols).coalesce(1).write.format(fmt).options(**options).save(a)
    some.select("value").coalesce(1).write.format(fmt).options(**options).save(b)  # lacks n
    view = spark.createDataFrame([("t/1", a), ("t/2", "file:" + b), ("u/1", b)], "path string, physical_address string")
    got = OB.read_at_ref(view, "t/", fmt=fmt, schema="value string, n int", keep=("path",), **options)
    n = [None, None] if fmt == "text" else [1, None]
    assert rows(got) == sorted([("t/1", "é", n[0]), ("t/1", "b", None), ("t/2", "é", None), ("t/2", "b", None)], key=repr)
    assert OB.read_at_ref(view, "none/", fmt=fmt, schema="value string").count() == 0
    with pytest.raises(ValueError):
        OB.read_at_ref(view, "t/", fmt="orc", schema="value string")
    empty = spark.createDataFrame([("k", b"")], "checksum string, content binary")
    one = spark.createDataFrame([("t/e", "k"), ("t/none", "z"), ("t/null", None)], "path string, checksum string")
    if fmt != "parquet":
        assert OB.read_at_ref(one, "t/", fmt=fmt, schema="value string", contents=empty).count() == 0


def test_lines_at_block_borders():
    import io

    from strata.sources.files import _lines
    for text in (b"", b"\n", b"a", b"a\n", b"a\r\nb\n\nc", b"x" * (1 << 20) + b"\n" + b"y" * 5, b"x" * ((1 << 20) - 1) + b"\r\nz\n"):
        got = [v for b in _lines(io.BytesIO(text)) for v in b["value"].to_pylist()]
        want = text.decode().replace("\r\n", "\n").split("\n")
        assert got == (want[:-1] if want[-1] == "" else want)


def test_bytes_of_puts_move_once(spark):
    refs, commits, entries, staging = state(spark)
    req = spark.createDataFrame([(i, "r", "main", f"p{i % 3}", bytes([i % 4]) * 9) for i in range(20)],
                                "seq long, repository string, branch string, path string, content binary")
    for conf, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(conf, value)
    try:
        deltas = OB.put_deltas(OB.put_objects(req, refs, commits, entries, staging))
        plan = deltas["contents"]._jdf.queryExecution().executedPlan()
        moved, todo = [], [plan]
        while todo:
            p = todo.pop()
            if p.nodeName() == "Exchange" and "content#" in p.output().toString():
                moved.append(p.toString())
            todo += [p.children().apply(i) for i in range(p.children().size())]
        assert len(moved) == 1, moved
        assert deltas["contents"].count() == 3  # of twenty uploads three paths are stored, once each
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# --- pages and request forms ------------------------------------------------------

def test_pages_equal_sorting(spark):
    rng = random.Random(4)
    names = sorted({rng.choice("ab") + "".join(rng.choice("xyz/") for _ in range(rng.randint(0, 4))) for _ in range(80)})
    items = [(g, k) for g in ("g", "h") for k in names if rng.random() < 0.8]
    probes = [(i, rng.choice("ghi"), rng.choice(["", "a", "ax", "b/", "zz"]), rng.choice(["", "a", "by", "ax/"]), rng.randint(1, 30)) for i in range(60)]
    idf = spark.createDataFrame(items, "g string, key string")
    pdf = spark.createDataFrame(probes, "seq long, g string, prefix string, after string, amount int")
    want = []
    for seq, g, prefix, after, amount in probes:
        own = sorted(k for h, k in items if h == g and k.startswith(prefix) and k > after)
        more = len(own) > amount
        want += [(seq, k, i, more, own[amount - 1] if more else None) for i, k in enumerate(own[:amount], 1)]
    assert rows(pages(idf, pdf, ["g"])) == sorted(want, key=repr)
    counts = {seq: sum(h == g and k.startswith(p) for h, k in items * 2) for seq, g, p, *_ in probes}
    assert dict(prefix_counts(idf.unionAll(idf), pdf, ["g"], "n").collect()) == counts


def test_listing_requests(spark):
    st = state(spark)
    req = spark.createDataFrame([(1, "r", "main", "", "/", "", 2), (2, "r", "main", "d", "/", "d1/", 9), (3, "r", "c1", "d2/", "/", "", 9), (4, "r", "x", "", "", "", 9),
                                 (5, "r", "nope", "", "/", "", 9), (6, "r", "main", "", "/", "", 0), (7, "r", "main", "zz", "/", "", 5), (8, "r", "main", "d2/e=f/c", "=", "", 5)],
                                "seq long, repository string, ref string, prefix string, delimiter string, after string, amount int")
    got = {}
    for r in OB.list_objects_at(req, *st).orderBy("seq", "position").collect():
        got.setdefault(r.seq, []).append((r.outcome, r.entry, r.kind, r.n_objects, r.has_more, r.next_after))
    assert got == {
        1: [("fetched", "d1/", "prefix", 2, True, "d2/"), ("fetched", "d2/", "prefix", 1, True, "d2/")],
        2: [("fetched", "d2/", "prefix", 1, False, None)],
        3: [("fetched", "d2/e=f/", "prefix", 1, False, None)],
        4: [("fetched", "d2/e=f/c", "object", 1, False, None), ("fetched", "new/n", "object", 1, False, None), ("fetched", "top", "object", 1, False, None)],
        5: [("ref_not_found", None, None, None, False, None)], 6: [("invalid", None, None, None, False, None)],
        7: [("fetched", None, None, None, False, None)], 8: [("fetched", "d2/e=f/c", "object", 1, False, None)]}


def test_reset_requests(spark):
    refs, _, _, staging = state(spark)
    req = spark.createDataFrame([(1, "r", "x", "d1/"), (2, "r", "x", None), (3, "r", "main", "d1/"), (4, "r", "q", None), (5, "r", " ", None)],
                                "seq long, repository string, branch string, prefix string")
    out = OB.reset_branches(req, refs, staging)
    assert rows(out, "seq", "outcome", "n_dropped", "ok") == [(1, "reset", 2, True), (2, "reset", 3, True), (3, "nothing_to_reset", 0, False),
                                                              (4, "branch_not_found", None, False), (5, "invalid", None, False)]
    assert OB.reset_branch(staging, out.where("ok")).count() == 1


def test_no_requests(spark):
    refs, commits, *_ = state(spark)
    out = R.create_branches(None, refs, commits, values={"repository": "r", "branch": "n", "source": "x"})
    assert rows(out, "seq", "branch", "outcome", "commit_id") == [(0, "n", "created", "c1")]
    assert rows(R.fetch_branches(None, refs, values={"repository": "r", "branch": "x"}), "outcome", "commit_id") == [("fetched", "c1")]
    assert rows(R.delete_branches(None, refs, values={"repository": "r", "branch": ""}), "outcome") == [("invalid",)]
    with pytest.raises(ValueError):
        R.fetch_branches(refs, refs, values={"repository": "r"})


def test_branch_attributes(spark):
    refs, *_ = state(spark)
    assert rows(R.branch_attributes(refs), "branch_id", "branch_commit_id", "hidden") == [
        ("a b/ü%", "c1", "false"), ("main", "c2", "false"), ("x", "c1", "true")]


# --- streams ----------------------------------------------------------------------

LOOKS = "repository string, branch string, seq long, observed_at timestamp_ntz, commit_id string"


def test_a_seed_counts_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    seed = spark.createDataFrame([("r", "a", "c1"), ("r", "b", "c1")], "repository string, branch string, commit_id string")
    commits = spark.createDataFrame([("r", "c2", "me", "m", "mr", None, 1, 2, {"k": "v"})],
                                    "repository string, commit_id string, committer string, message string, meta_range_id string, "
                                    "creation_date timestamp_ntz, version int, generation long, metadata map<string,string>")
    parents = spark.createDataFrame([("r", "c2", 0, "c1")], "repository string, commit_id string, pos int, parent_id string")
    looks = [[("r", "a", 1, None, "c1"), ("r", "b", 1, None, "c2"), ("r", "n", 1, None, "c9")], [("r", "a", 2, None, None)], [("r", "a", 3, None, "c1")]]
    for batch in looks:  # each with a restart on the same checkpoint
        spark.createDataFrame(batch, LOOKS).write.mode("append").parquet(src)
        ST.run_available(ST.wait_commits_stream(ST.file_stream(spark, src, LOOKS), seed, commits, parents), out, ck)
    got = spark.read.parquet(out)
    assert rows(got, "branch", "seq", "commit_id", "committer") == [("a", 3, "c1", None), ("b", 1, "c2", "me"), ("n", 1, "c9", None)]
    every = spark.createDataFrame([r for b in looks for r in b], LOOKS)
    assert rows(WT.with_commit(WT.wait_commits(every, seed), commits, parents), "branch", "seq") == rows(got, "branch", "seq")


def test_a_branch_made_anew_shows_again_and_state_goes(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    schema = "repository string, branch string, commit_id string, listing long, listed_at timestamp_ntz"
    names = [{"a", "b"}, {"a"}, {"a", "b"}, {"a", "c"}, {"a"}, {"a", "b"}, {"a"}, {"a"}, {"a"}, {"a"}]
    want, before = [], set()
    for i, now in enumerate(names, 1):
        want += [(b, i) for b in now - before]
        before = now
        rows_ = spark.createDataFrame([("r", b, "c", i) for b in now], "repository string, branch string, commit_id string, listing long")
        rows_.selectExpr("*", f"TIMESTAMP_NTZ '2024-01-01 {i:02d}:00:00' AS listed_at").write.mode("append").parquet(src)
        ST.run_available(ST.listed_branches_stream(ST.file_stream(spark, src, schema), keep_seconds=5400), out, ck)
    assert rows(spark.read.parquet(out), "branch", "listing") == sorted(want)
    kept = spark.read.format("statestore").load(ck)
    assert rows(kept.selectExpr("key.branch AS branch"), "branch") == [("a",)]  # b and c are gone for longer


def test_routes_of_a_repeated_batch_are_written_once(spark, tmp_path):
    src, ok, failed, ck = (str(tmp_path / n) for n in ("in", "ok", "failed", "ck"))
    refs, commits, *_ = state(spark)
    schema = "seq long, repository string, branch string, source string"
    operator = lambda b: R.create_branches(b, refs, commits).select("seq", "outcome")
    spark.createDataFrame([(1, "r", "n", "main"), (2, "r", "", "main"), (3, "r", "o", "nope")], schema).write.parquet(src)
    stopped = {"yes": True}

    def once(write):
        def run(rows_, batch_id):
            write(rows_, batch_id)
            if stopped.pop("yes", False):
                raise RuntimeError("lost after the first route was written")
        return run

    stream = ST.file_stream(spark, src, schema)
    write = O.route_each(once(O.write_once(ok)), O.write_once(failed))
    q = (stream.writeStream.foreachBatch(lambda b, i: write(operator(b), i)).option("checkpointLocation", ck).trigger(availableNow=True).start())
    with pytest.raises(Exception, match="lost after"):
        q.awaitTermination()
    for _ in range(2):
        ST.run_routes(ST.file_stream(spark, src, schema), operator, ok, failed, ck)
    assert rows(spark.read.parquet(ok), "seq", "outcome") == [(1, "created")]
    assert rows(spark.read.parquet(failed), "seq", "outcome") == [(2, "invalid"), (3, "source_not_found")]


def test_a_listing_hands_few_columns_to_its_state_function(spark, tmp_path):
    """Each column costs a pandas column a branch; a timestamp costs the most."""
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    schema = "repository string, branch string, commit_id string, listing long, listed_at timestamp_ntz"
    at = lambda h: datetime.datetime(2024, 1, 1, h)
    # two listings in one batch, a text with commas, no commit, no branch name; then a late one
    for batch in ([("r", "a", "c,1", 1, at(1)), ("r", "a", "c2", 2, at(2)), ("r", None, None, 1, at(1)), ("r", "b", None, 2, at(2)), ("r", "b", "x", 2, at(2))],
                  [("r", "a", "c3", 4, at(4)), ("s", "a", "", 1, at(4))], [("r", "late", "c", 1, at(1)), ("s", "a", "c", 2, at(5))]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        stream = ST.listed_branches_stream(ST.file_stream(spark, src, schema), keep_seconds=5400)
        ST.run_available(stream, out, ck)
    got = rows(spark.read.schema(ST.LISTED).parquet(out))
    assert len(got) == 5 and set(got) - {("r", "b", "x", 2)} == {("r", None, None, 1), ("r", "a", "c,1", 1), ("r", "a", "c3", 4), ("r", "b", None, 2), ("s", "a", "", 1)}
    assert stream.schema.simpleString() == spark.createDataFrame([], ST.LISTED).schema.simpleString()
    node = next(n for n in json.loads(stream._jdf.queryExecution().analyzed().toJSON()) if n["class"].endswith("FlatMapGroupsInPandasWithState"))
    args = [x for x in node["functionExpr"] if x["class"].endswith("AttributeReference")]
    assert len(args) == 4 and {x["dataType"] for x in args} == {"string", "long"}
