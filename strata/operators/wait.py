"""Watching branch heads: change detection over observations (batch form).

An observation is one look at a branch head (commit_id null = branch
absent).  Per branch, a look emits when the head is present and differs
from the previous look (or it is the first look and no seed says
otherwise).  "previous look" is a hot-key-safe ``lag`` (a busy branch may
hold a third of all looks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import outcomes as O
from strata.functions.ordered import previous_value
from strata.functions.params import Param, bind, rule_required, validate, without_requests

KEY = ["repository", "branch"]


def wait_commits(observations: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """Emissions of ``observations`` (repository, branch, seq, observed_at,
    commit_id).  ``seed`` (repository, branch, commit_id) gives the last
    known head per branch before the first look."""
    o = previous_value(observations, KEY, "seq", "commit_id", "_prev", first_flag="_first")
    if seed is not None:
        s = seed.select(*KEY, F.col("commit_id").alias("_seed"))
        o = o.join(s, KEY, "left")
        last = F.when(F.col("_first"), F.col("_seed")).otherwise(F.col("_prev"))
    else:
        last = F.col("_prev")
    emit = F.col("commit_id").isNotNull() & ~F.col("commit_id").eqNullSafe(last)
    return o.where(emit).drop("_prev", "_first", "_seed")


def with_commit(emitted: DataFrame, commits: DataFrame, parents: DataFrame, head: str = "commit_id") -> DataFrame:
    """Emissions (or ``changed_since`` rows) with the head commit's attributes;
    null where the commit is not known.  Works on streams too (``commits`` and
    ``parents`` are static)."""
    from strata.operators.commits import commit_attributes
    a = commit_attributes(commits, parents)
    a = a.select(F.col("repository").alias("_a_repo"), F.col("commit_id").alias("_a_id"),
                 *[F.col(c) for c in a.columns if c not in ("repository", "commit_id")])
    return (emitted.join(a, (emitted["repository"] == a["_a_repo"]) & (emitted[head] == a["_a_id"]), "left")
            .drop("_a_repo", "_a_id"))


def poll_sample(observations: DataFrame, interval: str = "1 hour") -> DataFrame:
    """At most one look per branch and interval: the newest one (a null
    head survives as the newest look, so it is wrapped in a struct)."""
    g = (observations.groupBy(*KEY, F.window("observed_at", interval).alias("w"))
         .agg(F.max_by(F.struct("seq", "observed_at", "commit_id"), F.col("seq")).alias("_last")))
    return g.select(*KEY, F.col("w.start").alias("window_start"), "_last.seq", "_last.observed_at",
                    "_last.commit_id")


@without_requests
def changed_since(requests: DataFrame, refs: DataFrame, commits: DataFrame | None = None, parents: DataFrame | None = None) -> DataFrame:
    """Per request: has the branch head moved away from ``previous_commit_id``?
    ``unchanged`` is not a success: such a request is not passed on.  With
    ``commits`` and ``parents`` a changed one has the attributes of its head."""
    r = validate(bind(requests, [Param("repository"), Param("branch"), Param("previous_commit_id")]),
                 [rule_required("repository"), rule_required("branch")])
    heads = refs.select(*KEY, F.col("commit_id").alias("head"))
    r = r.join(heads, KEY, "left")
    outcome = O.first_match((F.col("error_code").isNotNull(), O.INVALID),
                            (F.col("head").isNull(), O.BRANCH_NOT_FOUND),
                            (F.col("head").eqNullSafe(F.col("previous_commit_id")), O.UNCHANGED),
                            default=O.CHANGED)
    r = r.withColumn("outcome", outcome).withColumn("ok", O.ok_col())
    if commits is None:
        return r
    return with_commit(r.withColumn("_moved", F.when(F.col("ok"), F.col("head"))), commits, parents, head="_moved").drop("_moved")
