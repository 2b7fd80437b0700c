"""Branch operators: resolve, create, delete, fetch, list, new, ref log.

Requests in one batch are ordered by ``seq``; a request sees the state before
the batch plus the effect of earlier requests on the same key.  Where only
"is there an earlier effective request" matters, that is a ``min(seq)``
aggregate joined back (partial aggregation, safe for hot keys); where the
last earlier effect matters, the chunked window of ``functions.ordered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import outcomes as O
from strata.functions.joins import small_side
from strata.functions.ordered import previous_value
from strata.functions.params import Param, bind, rule_allowed, rule_required, validate, without_requests

KEY = ["repository", "branch"]


def resolve_refs(df: DataFrame, refs: DataFrame, commits: DataFrame, ref: str = "ref",
                 out: str = "resolved_commit", kind: str = "resolved_kind") -> DataFrame:
    """Resolve a ref column that names a branch or a commit id.

    Branch names win over commit ids (two left joins + coalesce)."""
    b = refs.select(F.col("repository").alias("_rb_repo"), F.col("branch").alias("_rb_ref"),
                    F.col("commit_id").alias("_rb_commit"))
    c = commits.select(F.col("repository").alias("_rc_repo"), F.col("commit_id").alias("_rc_ref"))
    res = (df.join(b, (df["repository"] == b["_rb_repo"]) & (df[ref] == b["_rb_ref"]), "left")
             .join(c, (F.col("repository") == c["_rc_repo"]) & (F.col(ref) == c["_rc_ref"]), "left"))
    return (res.withColumn(kind, F.when(F.col("_rb_commit").isNotNull(), F.lit("branch"))
                                  .when(F.col("_rc_ref").isNotNull(), F.lit("commit")))
               .withColumn(out, F.coalesce(F.col("_rb_commit"), F.col("_rc_ref")))
               .drop("_rb_repo", "_rb_ref", "_rb_commit", "_rc_repo", "_rc_ref"))


def _snapshot_head(df: DataFrame, refs: DataFrame, out: str = "head") -> DataFrame:
    r = refs.select(F.col("repository").alias("_h_repo"), F.col("branch").alias("_h_branch"),
                    F.col("commit_id").alias(out))
    return (df.join(r, (df["repository"] == r["_h_repo"]) & (df["branch"] == r["_h_branch"]), "left")
              .drop("_h_repo", "_h_branch"))


CREATE_PARAMS = [
    Param("repository"), Param("branch"),
    Param("source", default="main"),
    Param("force", "boolean", False),
    Param("hidden", "boolean", False),
    Param("ignore_exists", "boolean", True),
]


def _bind_branch_requests(requests: DataFrame, params: list[Param], *rules) -> DataFrame:
    r = bind(requests, params)
    return validate(r, [rule_required("repository"), rule_required("branch"), *rules])


def _create_outcome(exists_before: Column) -> Column:
    return O.first_match(
        (F.col("error_code").isNotNull(), O.INVALID),
        (F.col("source_commit").isNull(), O.SOURCE_NOT_FOUND),
        (~exists_before, O.CREATED),
        (F.col("force"), O.OVERWRITTEN),
        (F.col("ignore_exists"), O.IGNORED),
        default=O.BRANCH_EXISTS)


@without_requests
def create_branches(requests: DataFrame, refs: DataFrame, commits: DataFrame) -> DataFrame:
    """Create branches from a source ref (default ``main``).

    Precedence: invalid → source_not_found → created (absent) → overwritten
    (exists, force) → ignored (exists, ignore_exists) → branch_exists.  The
    source resolves against the snapshot; "exists" = in the snapshot or an
    earlier effective request on the same key."""
    r = _bind_branch_requests(requests, CREATE_PARAMS)
    r = resolve_refs(r, refs, commits, ref="source", out="source_commit", kind="source_kind")
    r = _snapshot_head(r, refs)
    effective = F.col("error_code").isNull() & F.col("source_commit").isNotNull()
    first = (r.where(effective).groupBy(*KEY)
              .agg(F.min("seq").alias("_first_effective")))
    r = r.join(first, KEY, "left")
    exists_before = F.col("head").isNotNull() | (F.col("_first_effective") < F.col("seq"))
    r = r.withColumn("outcome", _create_outcome(exists_before))
    return (r.withColumn("ok", O.ok_col())
             .withColumn("commit_id", F.when(F.col("outcome").isin(O.CREATED, O.OVERWRITTEN),
                                             F.col("source_commit")))
             .drop("_first_effective", "source_kind"))


def refs_after_create(outcomes: DataFrame, refs: DataFrame) -> DataFrame:
    """New ``refs`` state: the last created/overwritten request per key wins."""
    last = (outcomes.where(F.col("outcome").isin(O.CREATED, O.OVERWRITTEN))
            .groupBy(*KEY)
            .agg(F.max_by(F.struct("commit_id", "hidden"), F.col("seq")).alias("_v"))
            .select(*KEY, "_v.commit_id", "_v.hidden"))
    kept = refs.join(last.select(*KEY), KEY, "left_anti")
    return kept.select(*KEY, "commit_id", "hidden").unionByName(last)


DELETE_PARAMS = [Param("repository"), Param("branch"), Param("force", "boolean", False)]


@without_requests
def delete_branches(requests: DataFrame, refs: DataFrame) -> DataFrame:
    """The first valid request on an existing branch deletes it; any other
    valid request reports ``branch_not_found``.  ``force`` is carried."""
    r = _bind_branch_requests(requests, DELETE_PARAMS)
    r = _snapshot_head(r, refs)
    first = (r.where(F.col("error_code").isNull() & F.col("head").isNotNull())
              .groupBy(*KEY).agg(F.min("seq").alias("_first")))
    r = r.join(first, KEY, "left")
    outcome = O.first_match(
        (F.col("error_code").isNotNull(), O.INVALID),
        (F.col("head").isNotNull() & (F.col("_first") == F.col("seq")), O.DELETED),
        default=O.BRANCH_NOT_FOUND)
    return (r.withColumn("outcome", outcome).withColumn("ok", O.ok_col())
             .withColumn("commit_id", F.when(F.col("outcome") == O.DELETED, F.col("head")))
             .drop("_first"))


def refs_after_delete(outcomes: DataFrame, refs: DataFrame) -> DataFrame:
    gone = outcomes.where(F.col("outcome") == O.DELETED).select(*KEY)
    return refs.join(gone, KEY, "left_anti")


def apply_ref_log(requests: DataFrame, refs: DataFrame, commits: DataFrame) -> DataFrame:
    """Interleaved create/delete requests (column ``op``) on the same refs.

    Every request's effect on existence is known without the state: a valid
    create with a resolvable source leaves the branch present, a valid delete
    leaves it absent.  Existence before a request is the last such effect
    earlier in the batch, else the snapshot.  Any other ``op`` is invalid."""
    params = CREATE_PARAMS + [Param("op")]
    r = _bind_branch_requests(requests, params, rule_required("op"), rule_allowed("op", ["create", "delete"]))
    r = resolve_refs(r, refs, commits, ref="source", out="source_commit", kind="source_kind")
    r = _snapshot_head(r, refs)
    valid = F.col("error_code").isNull()
    effect = (F.when(valid & (F.col("op") == "create") & F.col("source_commit").isNotNull(), F.lit(True))
               .when(valid & (F.col("op") == "delete"), F.lit(False)))
    r = r.withColumn("_effect", effect)
    r = previous_value(r, KEY, "seq", "_effect", "_prior", ignore_nulls=True)
    exists_before = F.coalesce(F.col("_prior"), F.col("head").isNotNull())
    delete_outcome = O.first_match((~valid, O.INVALID), (exists_before, O.DELETED),
                                   default=O.BRANCH_NOT_FOUND)
    r = r.withColumn("outcome", F.when(F.col("op").eqNullSafe("create"), _create_outcome(exists_before))
                                 .otherwise(delete_outcome))
    return (r.withColumn("ok", O.ok_col())
             .withColumn("exists_before", exists_before)
             .withColumn("commit_id", F.when(F.col("outcome").isin(O.CREATED, O.OVERWRITTEN), F.col("source_commit")))
             .drop("_effect", "_prior", "source_kind"))


def refs_after_log(outcomes: DataFrame, refs: DataFrame) -> DataFrame:
    """New ``refs`` state after ``apply_ref_log``: per key the last request
    that created, overwrote or deleted it decides."""
    last = (outcomes.where(F.col("outcome").isin(O.CREATED, O.OVERWRITTEN, O.DELETED))
            .groupBy(*KEY).agg(F.max_by(F.struct("outcome", "commit_id", "hidden"), F.col("seq")).alias("_v"))
            .select(*KEY, "_v.outcome", "_v.commit_id", "_v.hidden"))
    kept = refs.select(*KEY, "commit_id", "hidden").join(last.select(*KEY), KEY, "left_anti")
    return kept.unionByName(last.where(F.col("outcome") != O.DELETED).drop("outcome"))


def branch_deltas(outcomes: DataFrame) -> dict[str, DataFrame]:
    """State deltas of ``create_branches``, ``delete_branches`` or ``apply_ref_log``
    outcomes: ``refs`` has the last effect on each branch, with ``deleted`` on the
    tombstone of one that is gone; ``dropped`` names the branches that were deleted
    at some point, also if they were made anew, whose staging goes."""
    made = F.col("outcome").isin(O.CREATED, O.OVERWRITTEN)
    hidden = F.coalesce("hidden", F.lit(False)) if "hidden" in outcomes.columns else F.lit(False)
    last = (outcomes.where(made | (F.col("outcome") == O.DELETED)).groupBy(*KEY)
            .agg(F.max_by(F.struct("outcome", "commit_id", hidden.alias("hidden")), F.col("seq")).alias("_v"),
                 F.max((F.col("outcome") == O.DELETED).cast("int")).alias("_dropped")))
    gone = F.col("_v.outcome") == O.DELETED
    refs = last.select(*KEY, F.when(~gone, F.col("_v.commit_id")).alias("commit_id"),
                       F.when(~gone, F.col("_v.hidden")).alias("hidden"), gone.alias("deleted"))
    return {"refs": refs, "dropped": last.where("_dropped = 1").select(*KEY)}


def staging_after_delete(staging: DataFrame, dropped: DataFrame) -> DataFrame:
    """Staged rows without those of deleted branches: a deleted branch takes its
    uncommitted changes with it, so re-creating it does not revive them."""
    return staging.join(small_side(dropped.select(*KEY).distinct()), KEY, "left_anti")


def branch_attributes(refs: DataFrame) -> DataFrame:
    """Branch → flat attributes."""
    return refs.select("repository", F.col("branch").alias("branch_id"), F.col("commit_id").alias("branch_commit_id"),
                       F.coalesce(F.col("hidden"), F.lit(False)).cast("string").alias("hidden"))


FETCH_PARAMS = [Param("repository"), Param("branch")]


@without_requests
def fetch_branches(requests: DataFrame, refs: DataFrame) -> DataFrame:
    """Enrich requests with the branch head; unmatched → ``not_found``."""
    r = _bind_branch_requests(requests, FETCH_PARAMS)
    rr = refs.select(F.col("repository").alias("_f_repo"), F.col("branch").alias("_f_branch"),
                     "commit_id", "hidden")
    r = (r.join(rr, (r["repository"] == rr["_f_repo"]) & (r["branch"] == rr["_f_branch"]), "left")
          .drop("_f_repo", "_f_branch"))
    outcome = O.first_match((F.col("error_code").isNotNull(), O.INVALID),
                            (F.col("commit_id").isNull(), O.NOT_FOUND), default=O.FETCHED)
    return r.withColumn("outcome", outcome).withColumn("ok", O.ok_col())


def list_branches(refs: DataFrame, repository: str | None = None,
                  include_hidden: bool = False, ordered: bool = False) -> DataFrame:
    """Branches of a repository (all when ``None``); hidden ones on request."""
    r = refs
    if repository is not None:
        r = r.where(F.col("repository") == repository)
    if not include_hidden:
        r = r.where(~F.coalesce(F.col("hidden"), F.lit(False)))
    r = r.select("repository", "branch", "commit_id")
    return r.orderBy("repository", "branch") if ordered else r


def new_branches(refs_now: DataFrame, refs_seen: DataFrame | None) -> DataFrame:
    """"First all branches, then only new ones": anti join with the last listing."""
    now = refs_now.select("repository", "branch", "commit_id")
    if refs_seen is None:
        return now
    return now.join(refs_seen.select(*KEY), KEY, "left_anti")
