"""Branch operators: every outcome code on hand-sized inputs."""
from strata.operators import refs as R
from tests.conftest import rows

REFS = "repository string, branch string, commit_id string, hidden boolean"
COMMITS = "repository string, commit_id string"


def _state(spark):
    refs = spark.createDataFrame([("r", "main", "c1", False), ("r", "dev", "c2", True)], REFS)
    commits = spark.createDataFrame([("r", "c1"), ("r", "c2"), ("r", "c3")], COMMITS)
    return refs, commits


def test_create_outcomes(spark):
    refs, commits = _state(spark)
    req = spark.createDataFrame([
        (1, "r", "", "main", False, False, True),      # invalid
        (2, "r", "x", "nope", False, False, True),     # source_not_found
        (3, "r", "x", "c3", False, False, True),       # created from a commit id
        (4, "r", "x", "main", False, False, False),    # exists (earlier in batch) → branch_exists
        (5, "r", "dev", "main", True, False, True),    # overwritten (force before ignore)
        (6, "r", "main", "main", False, False, True),  # ignored
    ], "seq long, repository string, branch string, source string, force boolean, hidden boolean, "
       "ignore_exists boolean")
    out = R.create_branches(req, refs, commits)
    assert rows(out, "seq", "outcome", "commit_id") == [
        (1, "invalid", None), (2, "source_not_found", None), (3, "created", "c3"),
        (4, "branch_exists", None), (5, "overwritten", "c1"), (6, "ignored", None)]
    after = R.refs_after_create(out, refs)
    assert rows(after, "branch", "commit_id") == [("dev", "c1"), ("main", "c1"), ("x", "c3")]
    # re-applying ignored requests changes nothing
    again = R.create_branches(req.where("seq = 6"), after, commits)
    assert rows(R.refs_after_create(again, after)) == rows(after)


def test_delete_outcomes(spark):
    refs, _ = _state(spark)
    req = spark.createDataFrame([(1, "r", "dev", False), (2, "r", "dev", True), (3, "r", "zz", False),
                                 (4, "r", None, False)],
                                "seq long, repository string, branch string, force boolean")
    out = R.delete_branches(req, refs)
    assert rows(out, "seq", "outcome") == [(1, "deleted"), (2, "branch_not_found"),
                                          (3, "branch_not_found"), (4, "invalid")]
    assert rows(R.refs_after_delete(out, refs), "branch") == [("main",)]


def test_ref_log_interleaved(spark):
    refs, commits = _state(spark)
    req = spark.createDataFrame([
        (1, "r", "delete", "dev", "main"), (2, "r", "delete", "dev", "main"),
        (3, "r", "create", "dev", "main"), (4, "r", "create", "dev", "main"),
        (5, "r", "delete", "dev", "main"), (6, "r", "create", "dev", "nope"),
        (7, "r", "delete", "dev", "main")],
        "seq long, repository string, op string, branch string, source string")
    out = R.apply_ref_log(req, refs, commits)
    assert rows(out, "seq", "outcome") == [
        (1, "deleted"), (2, "branch_not_found"), (3, "created"), (4, "ignored"),
        (5, "deleted"), (6, "source_not_found"), (7, "branch_not_found")]


def test_fetch_list_new_resolve(spark):
    refs, commits = _state(spark)
    req = spark.createDataFrame([(1, "r", "main"), (2, "r", "nope")], "seq long, repository string, branch string")
    assert rows(R.fetch_branches(req, refs), "seq", "outcome", "commit_id") == [
        (1, "fetched", "c1"), (2, "not_found", None)]
    assert rows(R.list_branches(refs), "branch") == [("main",)]
    assert rows(R.list_branches(refs, include_hidden=True), "branch") == [("dev",), ("main",)]
    seen = refs.where("branch = 'main'")
    assert rows(R.new_branches(refs, seen), "branch") == [("dev",)]
    rr = spark.createDataFrame([(1, "r", "dev"), (2, "r", "c3"), (3, "r", "zz")],
                               "seq long, repository string, ref string")
    assert rows(R.resolve_refs(rr, refs, commits), "seq", "resolved_kind", "resolved_commit") == [
        (1, "branch", "c2"), (2, "commit", "c3"), (3, None, None)]


def test_ref_log_equals_sequential_processing(spark):
    import random
    rnd = random.Random(11)
    refs, commits = _state(spark)
    snapshot = {("r", "main"), ("r", "dev")}
    reqs = []
    for seq in range(1, 400):
        branch = rnd.choice(["main", "dev", "x", "y", "z", ""])
        op = rnd.choice(["create", "delete"])
        source = rnd.choice(["main", "c3", "nope"])
        reqs.append((seq, "r", op, branch, source, rnd.random() < 0.3, rnd.random() < 0.5))
    df = spark.createDataFrame(reqs, "seq long, repository string, op string, branch string, source string, "
                                     "force boolean, ignore_exists boolean")
    got = {r.seq: r.outcome for r in R.apply_ref_log(df, refs, commits).collect()}
    state, want = set(snapshot), {}
    for seq, repo, op, branch, source, force, ignore in reqs:
        key = (repo, branch)
        if branch == "":
            want[seq] = "invalid"
        elif op == "create":
            if source == "nope":
                want[seq] = "source_not_found"
            elif key not in state:
                want[seq] = "created"
            elif force:
                want[seq] = "overwritten"
            elif ignore:
                want[seq] = "ignored"
            else:
                want[seq] = "branch_exists"
            if source != "nope":
                state.add(key)
        else:
            want[seq] = "deleted" if key in state else "branch_not_found"
            state.discard(key)
    assert got == want


def test_create_and_delete_equal_sequential_processing(spark):
    import random
    rnd = random.Random(5)
    refs, commits = _state(spark)
    creates = [(s, "r", rnd.choice(["main", "dev", "x", "y", ""]), rnd.choice(["main", "c3", "nope"]),
                rnd.random() < 0.3, rnd.random() < 0.5) for s in range(1, 300)]
    df = spark.createDataFrame(creates, "seq long, repository string, branch string, source string, "
                                        "force boolean, ignore_exists boolean")
    got = {r.seq: r.outcome for r in R.create_branches(df, refs, commits).collect()}
    state, want = {("r", "main"), ("r", "dev")}, {}
    for seq, repo, branch, source, force, ignore in creates:
        if branch == "":
            want[seq] = "invalid"
            continue
        if source == "nope":
            want[seq] = "source_not_found"
            continue
        exists = (repo, branch) in state
        want[seq] = ("created" if not exists else "overwritten" if force else
                     "ignored" if ignore else "branch_exists")
        state.add((repo, branch))
    assert got == want
    deletes = [(s, "r", rnd.choice(["main", "dev", "x", ""])) for s in range(1, 100)]
    dd = spark.createDataFrame(deletes, "seq long, repository string, branch string")
    got = {r.seq: r.outcome for r in R.delete_branches(dd, refs).collect()}
    state, want = {("r", "main"), ("r", "dev")}, {}
    for seq, repo, branch in deletes:
        if branch == "":
            want[seq] = "invalid"
        else:
            want[seq] = "deleted" if (repo, branch) in state else "branch_not_found"
            state.discard((repo, branch))
    assert got == want
