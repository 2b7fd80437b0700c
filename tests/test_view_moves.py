"""A branch view is expanded to its branches last: nothing that grows with branches x paths is shuffled."""

import json
import random

from pyspark.sql import functions as F

from strata.operators import listing as L
from tests.conftest import rows


def _view(spark, rng, branches=40, paths=60, ops=3):
    """A view of branches that share a listing, each with staged ops, some on the same paths; and its rows."""
    refs = [("r", f"b{i}", "c") for i in range(branches)] + [("r", "twice", "c"), ("r", "twice", "c"), ("r", "clean", "c")]
    listed = [("r", "m", f"p{i}", f"k{i}", i) for i in range(paths)] + [("r", "m", None, "kn", 1), ("other", "m", "p0", "ko", 1)]
    staging = []
    for _, b, _ in dict.fromkeys(refs):
        if b != "clean":
            for seq, path in enumerate([*rng.sample([f"p{i}" for i in range(paths)], ops), "p0", "new"]):
                op = rng.choice(["put", "delete"])
                staging.append(("r", b, path, op, *(("s", 9, "s") if op == "put" else (None, None, None)), seq))
    staging.append(("r", "clean", None, "delete", None, None, None, 1))
    want = []
    for _, b, _ in refs:
        over = {p for _, o, p, *_ in staging if o == b} - {None}
        want += [("r", b, p, k, n, k, "committed") for r, _, p, k, n in listed if r == "r" and p not in over]
    want += [("r", b, p, c, n, a, "staged") for _, b, p, op, c, n, a, _ in staging if op == "put"]
    state = (spark.createDataFrame(refs, "repository string, branch string, commit_id string"),
             spark.createDataFrame([("r", "c", "m")], "repository string, commit_id string, meta_range_id string"),
             spark.createDataFrame(listed, "repository string, meta_range_id string, path string, checksum string, size_bytes long"),
             spark.createDataFrame(staging, "repository string, branch string, path string, op string, checksum string, size_bytes long, "
                                            "physical_address string, seq long"))
    return L.branch_view(state[0].select("repository", "branch"), *state), want


def test_rows_of_branches_that_stage_the_same_paths(spark, monkeypatch):
    view, want = _view(spark, random.Random(4))
    assert rows(view) == sorted(want, key=repr)
    monkeypatch.setattr(L, "small_side", lambda keys: keys)
    assert rows(_view(spark, random.Random(4))[0]) == sorted(want, key=repr)


def test_branches_are_not_expanded_before_a_join_by_path(spark):
    view, _ = _view(spark, random.Random(4))
    plan = json.loads(view._jdf.queryExecution().optimizedPlan().toJSON())
    by_path = [n for n in plan if n["class"].endswith("plans.logical.Join") and "path" in json.dumps(n.get("condition"))]
    assert len(by_path) == 1
    names = {part["name"] for e in by_path[0]["condition"] for part in (e if isinstance(e, list) else [e]) if "name" in part}
    assert names == {"repository", "path"}  # the ops of a path, whatever the branch, beside the listings' rows
