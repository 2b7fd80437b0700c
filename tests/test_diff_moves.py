"""Comparing listings moves an entry once, to its path; few asked paths keep other rows in place."""
import re

from strata.operators import listing as L
from strata.operators import objects as OB
from tests.conftest import rows


def _entries(spark):
    out = [("r", "a", f"p{i}", f"x{i}", 1) for i in range(9)] + [("r", "b", f"p{i}", f"x{i if i % 2 else -i}", 1) for i in range(3, 12)]
    out += [("r", "b", "p3", "x0", 1), ("r", "c", "p1", None, 1), ("s", "a", "p1", "y", 1)]
    return spark.createDataFrame([(*e, e[3]) for e in out],
                                 "repository string, meta_range_id string, path string, checksum string, size_bytes long, physical_address string")


def test_an_entry_moves_once_for_all_pairs(spark, monkeypatch):
    e = _entries(spark)
    pairs = spark.createDataFrame([("r", "a", "b"), ("r", "b", "a"), ("r", "", "c"), ("r", "a", None), ("s", "a", "b"), ("r", "a", "c")],
                                  "repository string, range_a string, range_b string")
    d = L.diff_ranges(pairs, e)
    got = rows(d)
    plan = d._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert sum("path#" in m for m in moved) == 1 and not any("path#" in m and "range_" in m for m in moved), moved
    monkeypatch.setattr(L, "small_side", lambda df: df)
    assert got == rows(L.diff_ranges(pairs, e)) and len(got) > 20


def test_few_asked_paths_keep_other_rows_in_place(spark, monkeypatch):
    e = _entries(spark)
    refs = spark.createDataFrame([("r", "main", "k")], "repository string, branch string, commit_id string")
    commits = spark.createDataFrame([("r", "k", "a")], "repository string, commit_id string, meta_range_id string")
    staging = spark.createDataFrame([("r", "main", f"p{i}", "put" if i % 3 else "delete", f"z{i}", f"z{i}", 2, 1) for i in range(5)],
                                    "repository string, branch string, path string, op string, physical_address string, "
                                    "checksum string, size_bytes long, seq long")
    req = spark.createDataFrame([(i, "r", "main", p) for i, p in enumerate(["p0", "p1", "p7", "p7", "none", None])],
                                "seq long, repository string, ref string, path string")
    out = OB.stat_objects(req, refs, commits, e, staging)
    got = rows(out, "seq", "outcome", "checksum")
    plan = out._jdf.queryExecution().executedPlan().toString()
    semi = [ln for ln in plan.splitlines() if "LeftSemi" in ln and "path#" in ln]
    assert len(semi) >= 2, "entries and staging are met with the asked paths first"
    monkeypatch.setattr(OB, "small_side", lambda df: df)
    assert got == rows(OB.stat_objects(req, refs, commits, e, staging), "seq", "outcome", "checksum")
    assert [r[2] for r in got if r[0] == 2] == ["x7"] and [r[2] for r in got if r[0] == 1] == ["z1"]
