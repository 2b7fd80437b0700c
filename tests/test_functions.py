"""Binding, validation, rendering, routing; sane versions of the listed quirks."""
from pyspark.sql import functions as F

from strata.functions import outcomes as O
from strata.functions.params import (Param, bind, rule_allowed, rule_positive,
                                     rule_required, self_requests, validate)
from strata.functions.render import metadata_map, render_list, render_map, render_ts
from strata.operators import commits as C
from strata.operators import pulls as PR
from strata.operators import wait as W
from tests.conftest import rows


def test_bind_precedence_and_types(spark):
    df = spark.createDataFrame(
        [(1, "a", {"amount": "5", "status": "open"}), (2, None, {"amount": "x"}), (3, " ", {})],
        "seq long, branch string, attributes map<string,string>")
    b = bind(df, [Param("branch", default="main"), Param("amount", "int", 1),
                  Param("status", default="all")])
    v = validate(b, [rule_positive("amount"),
                     rule_allowed("status", ["open", "closed", "all"])])
    assert rows(v, "seq", "branch", "amount", "status", "error_code") == [
        (1, "a", 5, "open", None), (2, "main", 1, "all", "bad_type:amount"), (3, "main", 1, "all", None)]
    b2 = bind(df, [Param("amount", "int")])
    v2 = validate(b2, [rule_required("amount")])
    assert rows(v2, "seq", "error_code") == [(1, None), (2, "bad_type:amount"), (3, "empty:amount")]


def test_first_failing_rule_wins(spark):
    df = spark.createDataFrame([(1, None, None)], "seq long, a string, b string")
    v = validate(df, [rule_required("a"), rule_required("b")])
    assert v.first().error_code == "empty:a"


def test_rendering(spark):
    df = spark.createDataFrame([(1700000000, ["p1", "p2"], {"b": "2", "a": "1"}, "", None, "t")],
                               "s long, ps array<string>, m map<string,string>, e string, n string, t string")
    r = df.select(
        render_ts(F.timestamp_add("SECOND", F.col("s"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))
        .alias("ts"),
        render_ts(F.lit(None).cast("timestamp_ntz")).alias("none"),
        render_list("ps").alias("l"), render_map("m").alias("m"),
        render_map(metadata_map(e=F.col("e"), n=F.col("n"), t=F.col("t"))).alias("meta")).first()
    assert r.ts == "2023-11-14T22:13:20+0000" and r.none is None
    assert r.l == "[p1, p2]" and r.m == "{a=1, b=2}" and r.meta == "{t=t}"


def test_routes_partition_outcomes(spark):
    df = spark.createDataFrame([(1, "created"), (2, "branch_exists"), (3, "ignored"), (4, "invalid")],
                               "seq long, outcome string")
    ok, bad = O.route(df)
    assert rows(ok, "seq") == [(1,), (3,)] and rows(bad, "seq") == [(2,), (4,)]   # each request once
    assert dict((r.outcome, r.n) for r in O.route_counts(df).collect())["created"] == 1
    assert self_requests(spark, repository="r").count() == 1


def test_commit_dates_in_seconds_round_trip(spark):
    entries = spark.createDataFrame([("r", "m", "a", "k", "k", 1)],
                                    "repository string, meta_range_id string, path string, "
                                    "physical_address string, checksum string, size_bytes long")
    commits = spark.createDataFrame([("r", "c0", "m", 1)],
                                    "repository string, commit_id string, meta_range_id string, generation long")
    refs = spark.createDataFrame([("r", "main", "c0", False)],
                                 "repository string, branch string, commit_id string, hidden boolean")
    staging = spark.createDataFrame([("r", "main", "b", "put", "k2", "k2", 1, 1)],
                                    "repository string, branch string, path string, op string, "
                                    "physical_address string, checksum string, size_bytes long, seq long")
    req = spark.createDataFrame([(1, "r", "main", 1700000000)],
                                "seq long, repository string, branch string, date long")
    out = C.commit_branches(req, refs, commits, entries, staging)
    d = C.commit_deltas(out, entries, staging)["commits"].first()
    assert str(d.creation_date) == "2023-11-14 22:13:20"


def test_open_pr_has_no_closed_date_and_unchanged_head_is_routed(spark):
    prs = spark.createDataFrame([("r", "p1", "open", "t", None, "u", "b", "main", None, None, None)],
                                "repository string, id string, status string, title string, description string, "
                                "author string, source_branch string, destination_branch string, "
                                "merged_commit_id string, creation_date timestamp_ntz, closed_date timestamp_ntz")
    f = PR.fetch_pull_requests(spark.createDataFrame([(1, "r", "p1")], "seq long, repository string, id string"),
                               prs).first()
    assert f.outcome == "fetched" and f.closed_date is None
    refs = spark.createDataFrame([("r", "main", "c1", False)],
                                 "repository string, branch string, commit_id string, hidden boolean")
    req = spark.createDataFrame([(1, "r", "main", "c1"), (2, "r", "main", "c0"), (3, "r", "gone", "c0")],
                                "seq long, repository string, branch string, previous_commit_id string")
    assert rows(W.changed_since(req, refs), "seq", "outcome") == [
        (1, "unchanged"), (2, "changed"), (3, "branch_not_found")]


def test_wait_state_is_per_branch_with_seed(spark):
    obs = spark.createDataFrame([
        ("r", "a", 1, "c1"), ("r", "b", 2, "c1"), ("r", "a", 3, "c1"), ("r", "a", 4, None),
        ("r", "a", 5, "c1"), ("r", "b", 6, "c2")],
        "repository string, branch string, seq long, commit_id string").withColumn(
        "observed_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    assert rows(W.wait_commits(obs), "seq") == [(1,), (2,), (5,), (6,)]
    seed = spark.createDataFrame([("r", "a", "c1")], "repository string, branch string, commit_id string")
    assert rows(W.wait_commits(obs, seed), "seq") == [(2,), (5,), (6,)]


def test_wait_commits_equals_simulation_on_a_hot_branch(spark):
    import random
    rnd = random.Random(3)
    looks = []
    for seq in range(2000):
        branch = "main" if rnd.random() < 0.6 else f"b{rnd.randint(0, 9)}"
        head = None if rnd.random() < 0.15 else f"c{rnd.randint(0, 3)}"
        looks.append(("r", branch, seq, head))
    obs = spark.createDataFrame(looks, "repository string, branch string, seq long, commit_id string") \
        .withColumn("observed_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    got = sorted(r.seq for r in W.wait_commits(obs).collect())
    last, want = {}, []
    for repo, branch, seq, head in looks:
        if head is not None and last.get(branch) != head:
            want.append(seq)
        last[branch] = head
    assert got == want


def test_a_key_side_is_broadcast_by_rows_and_bytes(spark):
    from strata.functions.joins import small_side
    keys = spark.range(50).selectExpr("id", "repeat('x', 100) AS branch", "map('k', id) AS more")
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(small_side(keys)) and hinted(small_side(keys.limit(0)))
    assert not hinted(small_side(keys, limit=49)) and not hinted(small_side(keys, most_bytes=5000))
