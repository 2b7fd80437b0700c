"""Merges and commits: what is looked up stays in place, an entry moves once and its checksum in half its bytes."""
import random
import re

from pyspark.sql import functions as F

from strata.functions import hashing as H
from strata.functions.joins import rows_among, small_side
from strata.operators import listing as L
from tests.conftest import rows

HEX = [f"{i:032x}" for i in range(1 << 12, (1 << 12) + 5)]
ODD = [None, "", "x", "AB", "abc", "ab\n", "0a"]


def _moved(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    return re.findall(r"Exchange \w+\(([^)]*)\)", plan)


def _listings(spark):
    rnd = random.Random(3)
    e = [("r", m, f"p{i}", rnd.choice(HEX + ODD if i % 3 else HEX[:1]), 1) for m in "abcd" for i in range(40) if rnd.random() < 0.8 or i % 5 == 0]
    e += [("r", "a", None, HEX[1], 1), ("r", "b", None, HEX[2], 1), ("r", "c", None, HEX[2], 1), ("r", "d", None, HEX[3], 1)]
    e += [("r", "a", "p3", "zz", 1), ("r", "a", "p6", HEX[4], 1), ("s", "a", "p1", "y", 1)]
    entries = spark.createDataFrame(e, "repository string, meta_range_id string, path string, checksum string, size_bytes long")
    t = [("r", x, y, z) for x in ("", "a", "b") for y in "abc" for z in "bd"] + [("r", "a", "b", "gone"), ("r", "a", None, "b"), ("s", "a", "", "a")]
    return entries, spark.createDataFrame(t, "repository string, base_range string, source_range string, dest_range string")


def test_triples_are_compared_where_the_paths_are(spark, monkeypatch):
    entries, t = _listings(spark)
    changes = L.triple_changes(t, entries)
    moved = _moved(changes)
    assert sum("path#" in m for m in moved) == 1 and not any("_triple" in m for m in moved), moved
    seen = changes.where("ck_base IS NOT NULL OR ck_source IS NOT NULL OR ck_dest IS NOT NULL")
    got, summary = rows(seen, *L.TRIPLE, "path", "ck_base", "ck_source", "ck_dest"), rows(L.three_way_summary(t, entries))
    monkeypatch.setattr(L, "small_side", lambda df: df)
    many = L.triple_changes(t, entries).where("NOT (ck_base <=> ck_source AND ck_base <=> ck_dest)")
    assert got == rows(many, *L.TRIPLE, "path", "ck_base", "ck_source", "ck_dest") and len(got) > 100
    assert summary == rows(L.three_way_summary(t, entries))


def test_checksums_move_packed(spark):
    texts = HEX + ODD
    df = spark.createDataFrame([(c,) for c in texts], "c string").select("c", *H.packed("c"))
    got = df.select("c", H.unpacked(F.col("hex_bytes"), F.col("other")).alias("back"), F.length("hex_bytes").alias("n")).collect()
    assert all(r.c == r.back for r in got) and {r.n for r in got if r.c in HEX} == {16}
    staging = spark.createDataFrame([("r", "b", f"p{i}", "put" if i % 4 else "delete", c, 1, c, s) for i, c in enumerate(texts) for s in (1, 2)],
                                    "repository string, branch string, path string, op string, checksum string, size_bytes long, "
                                    "physical_address string, seq long")
    base = spark.createDataFrame([("r", "m", f"p{i}", c if i % 2 else HEX[0]) for i, c in enumerate(texts)],
                                 "repository string, base_range string, path string, checksum string")
    firsts = spark.createDataFrame([("r", "b", "m")], "repository string, branch string, base_range string")
    key = ["repository", "base_range"]
    last = L.last_checksums(staging, firsts).join(firsts, ["repository", "branch"])
    got = rows(L.changes_at(last, base, [*key, "path"]), "path", "old_checksum", "new_checksum")
    whole = L.staged_changes(L.last_staged(staging).join(firsts, ["repository", "branch"]), base.withColumn("size_bytes", F.lit(1)), key)
    assert got == rows(whole, "path", "old_checksum", "new_checksum") and len(got) > 4


def test_lookups_of_few_names_move_neither_side(spark):
    commits = spark.createDataFrame([("r", f"c{i}", f"m{i}", i) for i in range(50)] + [("r", "c1", "m9", 9), (None, "c1", "m", 1)],
                                    "repository string, commit_id string, meta_range_id string, generation long").repartition(3)
    asked = spark.createDataFrame([("r", "c1", None), ("r", "c2", "c1"), (None, "c1", "c3"), ("s", "c4", "c4")],
                                  "repository string, a string, b string").repartition(3).checkpoint()
    named = L.commits_among(commits, asked, "a", "b")
    assert named.count() == 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = L.head_range(L.head_range(asked, named, "a", out="ra"), named, "b", out="rb")
        assert not any("repository" in m for m in _moved(out))
        assert rows(out) == rows(L.head_range(L.head_range(asked, commits, "a", out="ra"), commits, "b", out="rb"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows_among(commits, asked.select("repository", F.col("a").alias("commit_id"))).count() == 3


def test_counting_a_key_side_moves_no_keys(spark):
    sent = []
    class Keys:  # noqa: E306
        def agg(self, *a):
            return spark.range(9).select(F.col("id")).agg(*a)

        def limit(self, n):
            sent.append(n)
            return spark.range(9).limit(n)
    keys = Keys()
    assert small_side(keys, limit=3) is keys and not sent
