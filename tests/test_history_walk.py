"""History walks: edges stay where they are, and many edges give the same answers as few."""
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import commits as C
from tests.conftest import rows


def _history(spark, n=40):
    rnd = random.Random(7)
    up = {i: sorted(rnd.sample(range(i), min(i, rnd.choice([1, 1, 2])))) for i in range(n)}
    gen = {}
    for i in range(n):
        gen[i] = 1 + max([gen[j] for j in up[i]], default=0)
    names = {i: f"c{(i * 17) % n:02d}" for i in range(n)}
    edges = [("r", names[i], k, names[j]) for i in range(n) for k, j in enumerate(up[i])]
    commits = spark.createDataFrame([("r", names[i], gen[i]) for i in range(n)], "repository string, commit_id string, generation long")
    below = {}
    for i in range(n):
        below[i] = {i}.union(*[below[j] for j in up[i]])
    return commits, spark.createDataFrame(edges, "repository string, commit_id string, pos int, parent_id string"), names, gen, below


def test_a_round_does_not_move_the_edges(spark):
    commits, parents, names, _, _ = _history(spark)
    starts = C._starts(commits.where("generation > 5").select("repository", F.col("commit_id").alias("commit")))
    edges, _ = C.key_history(parents, starts)
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = starts.join(edges, F.col("node") == F.col("child"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
        edges.unpersist()
    top = plan.split("InMemoryRelation")[0]
    assert "SortMergeJoin" in top and top.count("Exchange hashpartitioning") == 1 and "hashpartitioning(node" in top


@pytest.mark.parametrize("many", [False, True])
def test_many_edges_give_the_answers_of_few(spark, monkeypatch, many):
    commits, parents, names, gen, below = _history(spark)
    if many:
        monkeypatch.setattr(C, "small_side", lambda df: df)
        monkeypatch.setattr(C, "MOST_PIECES", 2)
    heads = [39, 38, 30, 12]
    seeds = spark.createDataFrame([("r", names[i]) for i in heads] + [("r", None), (None, names[3])], "repository string, seed string")
    got = rows(C.ancestors(seeds.where("repository IS NOT NULL AND seed IS NOT NULL"), parents), "seed", "commit_id")
    assert got == sorted(((names[i], names[j]) for i in heads for j in below[i]), key=repr)
    pairs = spark.createDataFrame([("r", names[a], names[b]) for a in heads for b in (39, 25, 7)], "repository string, a string, b string")
    want = []
    for a in heads:
        for b in (39, 25, 7):
            common = below[a] & below[b]
            best = min(common, key=lambda c: (-gen[c], names[c])) if common else None
            want.append((names[a], names[b], None if best is None else names[best], None if best is None else gen[best]))
    assert rows(C.merge_base(pairs, commits, parents), "a", "b", "base_id", "base_generation") == sorted(want, key=repr)
    log = C.log_commits(seeds.select("repository", F.col("seed").alias("ref_name"), F.col("seed").alias("commit_id")),
                        commits.withColumns({"message": F.lit("m"), "committer": F.lit("c")}), parents)
    assert log.count() == sum(len(below[i]) for i in heads)
