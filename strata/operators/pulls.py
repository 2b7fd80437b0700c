"""Pull requests: create, fetch, list (cursor pages), merge, update."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import outcomes as O
from strata.functions.joins import rows_among, small_side
from strata.functions.ordered import last_values, running_sum
from strata.functions.params import Param, bind, rule_allowed, rule_positive, rule_required, validate, without_requests
from strata.functions.render import render_ts
from strata.operators.merge import merge_deltas, merge_refs
from strata.operators.state import naive_time

PKEY = ["repository", "id"]
OPEN, CLOSED, MERGED, ALL = "open", "closed", "merged", "all"

CREATE_PARAMS = [Param("repository"), Param("title"), Param("description"),
                 Param("source_branch", default="main"), Param("destination_branch", default="main"),
                 Param("author", default="unknown")]


def pr_id(repository: Column, seq: Column, title: Column, stored: Column | None = None) -> Column:
    """Deterministic id of a new pull request; ``stored``: how many its
    repository has already (null: none), so that no later batch makes it again."""
    parts = [repository, seq.cast("string"), title, *([F.when(stored > 0, stored.cast("string"))] if stored is not None else [])]
    return F.concat(F.lit("pr_"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16))


@without_requests
def create_pull_requests(requests: DataFrame, refs: DataFrame, prs: DataFrame | None = None) -> DataFrame:
    """invalid → branch_not_found (either side) → same_branch → created (open).

    With the stored ``prs`` an id also depends on how many pull requests its
    repository has, so batches whose ``seq`` and titles repeat get new ids; an
    id that is taken all the same (a hash collision, or a ``seq`` that the batch
    has twice) is not given again: ``retry_next_batch``."""
    r = validate(bind(requests, CREATE_PARAMS),
                 [rule_required("repository"), rule_required("title")])
    names = refs.select("repository", "branch")
    src = names.select("repository", F.col("branch").alias("source_branch"), F.lit(True).alias("_src"))
    dst = names.select("repository", F.col("branch").alias("destination_branch"), F.lit(True).alias("_dst"))
    r = (r.join(src, ["repository", "source_branch"], "left")
          .join(dst, ["repository", "destination_branch"], "left"))
    outcome = O.first_match(
        (F.col("error_code").isNotNull(), O.INVALID),
        (F.col("_src").isNull() | F.col("_dst").isNull(), O.BRANCH_NOT_FOUND),
        (F.col("source_branch") == F.col("destination_branch"), O.SAME_BRANCH),
        default=O.CREATED)
    r = r.withColumn("outcome", outcome)
    done = F.col("outcome") == O.CREATED
    if prs is None:
        r = r.withColumn("id", F.when(done, pr_id(F.col("repository"), F.col("seq"), F.col("title"))))
    else:
        stored = prs.groupBy("repository").agg(F.count(F.lit(1)).alias("_stored"))
        r = r.join(stored, "repository", "left")
        r = r.withColumn("id", F.when(done, pr_id(F.col("repository"), F.col("seq"), F.col("title"), F.col("_stored"))))
        once = (r.where(done).groupBy(*PKEY).agg(F.count(F.lit(1)).alias("_times"))
                .join(prs.select(*PKEY, F.lit(True).alias("_taken")), PKEY, "left")
                .where("_times > 1 OR _taken").select(*PKEY, F.lit(True).alias("_again")))
        r = r.join(once, PKEY, "left")
        r = r.withColumn("outcome", F.when(done & F.col("_again").isNotNull(), F.lit(O.RETRY_NEXT_BATCH)).otherwise(F.col("outcome")))
        r = r.withColumn("id", F.when(F.col("outcome") == O.CREATED, F.col("id"))).drop("_stored", "_again")
    return (r.withColumn("ok", O.ok_col())
             .withColumn("status", F.when(F.col("outcome") == O.CREATED, F.lit(OPEN)))
             .drop("_src", "_dst"))


def new_pull_request_rows(outcomes: DataFrame, created_at: Column) -> DataFrame:
    """Rows to append to ``pull_requests`` for created requests."""
    return outcomes.where(F.col("outcome") == O.CREATED).select(
        "repository", "id", "status", "title", "description", F.col("author"),
        "source_branch", "destination_branch", created_at.alias("creation_date"),
        F.lit(None).cast("string").alias("merged_commit_id"),
        F.lit(None).cast("timestamp_ntz").alias("closed_date"))


def pr_attributes(prs: DataFrame) -> DataFrame:
    """Pull request → flat attributes; an open PR has no closed date (null)."""
    return prs.select("repository", "id", "status", "title", "description", "author", "source_branch",
                      "destination_branch", "merged_commit_id",
                      render_ts("creation_date").alias("creation_date"),
                      render_ts("closed_date").alias("closed_date"))


@without_requests
def fetch_pull_requests(requests: DataFrame, prs: DataFrame) -> DataFrame:
    r = validate(bind(requests, [Param("repository"), Param("id")]),
                 [rule_required("repository"), rule_required("id")])
    a = pr_attributes(prs).withColumnRenamed("repository", "_a_repo").withColumnRenamed("id", "_a_id")
    j = r.join(a, (r["repository"] == a["_a_repo"]) & (r["id"] == a["_a_id"]), "left")
    outcome = O.first_match((F.col("error_code").isNotNull(), O.INVALID),
                            (F.col("_a_id").isNull(), O.NOT_FOUND), default=O.FETCHED)
    return j.withColumn("outcome", outcome).withColumn("ok", O.ok_col()).drop("_a_repo", "_a_id")


LIST_PARAMS = [Param("repository"), Param("prefix", default=""), Param("after", default=""),
               Param("amount", "int", 1), Param("status", default=ALL)]


# Fixed: ranks per block of the page join.
RANK_BLOCK = 1024


def _status_class(status: Column) -> Column:
    return F.when(status == OPEN, F.lit(OPEN)).otherwise(F.lit(CLOSED))


@without_requests
def list_pull_requests(requests: DataFrame, prs: DataFrame) -> DataFrame:
    """One page per request: ids > ``after`` starting with ``prefix`` in
    status class open / closed (= not open) / all, ascending, first
    ``amount`` (default 1), with ``has_more`` and the ``next_after`` cursor.
    Every request has at least one row with its outcome (``id`` null if it is
    invalid or its page is empty).

    Ids with a prefix form one contiguous run of the sorted ids, so the page
    starts after ``lo = max(#ids < prefix, #ids <= after)``.  PR ranks and
    both counts come from one running count over PR rows and probe rows
    (hot-key safe); the page is then a range of ranks, joined by blocks of
    ``RANK_BLOCK`` ranks that end with the last PR — never all request × PR
    pairs, and no row per unit of a caller's ``amount``."""
    r = validate(bind(requests, LIST_PARAMS),
                 [rule_required("repository"), rule_positive("amount"),
                  rule_allowed("status", [OPEN, CLOSED, ALL])])
    valid = r.where(F.col("error_code").isNull())
    # only repositories that some valid request names are ranked
    asked = prs.join(valid.select("repository").distinct(), "repository", "left_semi")
    classes = F.array(F.lit(ALL), _status_class(F.col("status")))
    pr_rows = asked.select("repository", F.explode(classes).alias("class"), F.col("id").alias("key"),
                         F.lit(1).alias("kind"), F.lit(None).cast("long").alias("seq"), F.lit(1).alias("w"))
    probes = valid.select("repository", F.col("status").alias("class"), "seq", "prefix", "after")
    lo_prefix = probes.select("repository", "class", F.col("prefix").alias("key"), F.lit(0).alias("kind"),
                              "seq", F.lit(0).alias("w"))
    lo_after = probes.select("repository", "class", F.col("after").alias("key"), F.lit(2).alias("kind"),
                             "seq", F.lit(0).alias("w"))
    u = pr_rows.unionByName(lo_prefix).unionByName(lo_after)
    ranked = running_sum(u, ["repository", "class"], ["key", "kind", "seq"], "w", "rank")
    ranks = ranked.where(F.col("kind") == 1).select("repository", "class", "rank", F.col("key").alias("id"))
    lo = (ranked.where(F.col("kind") != 1).groupBy("seq").agg(F.max("rank").alias("lo")))
    total = ranks.groupBy("repository", "class").agg(F.max("rank").alias("_total"))
    blocks = ranks.withColumn("_block", F.floor(F.col("rank") / RANK_BLOCK).cast("long"))
    want = (valid.join(lo, "seq").withColumnRenamed("status", "class").join(total, ["repository", "class"])
            .withColumn("_hi", F.least(F.col("lo") + F.col("amount").cast("long") + 1, F.col("_total")))
            .where(F.col("_hi") > F.col("lo")))
    page = (want.select("seq", "repository", "class", "prefix", "amount", "lo", "_hi",
                        F.explode(F.sequence(F.floor((F.col("lo") + 1) / RANK_BLOCK).cast("long"),
                                             F.floor(F.col("_hi") / RANK_BLOCK).cast("long"))).alias("_block"))
            .join(blocks, ["repository", "class", "_block"])
            .where((F.col("rank") > F.col("lo")) & (F.col("rank") <= F.col("_hi")) & F.col("id").startswith(F.col("prefix")))
            .withColumn("position", (F.col("rank") - F.col("lo")).cast("long")))
    summary = page.groupBy("seq").agg(
        (F.max("position") > F.max("amount")).alias("has_more"),
        F.max(F.when(F.col("position") == F.col("amount"), F.col("id"))).alias("_last"))
    found = (page.where(F.col("position") <= F.col("amount")).join(summary, "seq")
             .select("seq", "id", "position", "has_more", F.when(F.col("has_more"), F.col("_last")).alias("next_after")))
    outcome = F.when(F.col("error_code").isNotNull(), F.lit(O.INVALID)).otherwise(F.lit(O.FETCHED))
    return (r.select("seq", "repository", outcome.alias("outcome")).withColumn("ok", O.ok_col())
            .join(found, "seq", "left").withColumn("has_more", F.coalesce("has_more", F.lit(False))))


def list_pull_requests_once(prs: DataFrame, repository: str, prefix: str = "", after: str = "",
                            amount: int = 1, status: str = ALL) -> DataFrame:
    """Constant-parameter form: filter + orderBy + limit (TakeOrderedAndProject)."""
    p = prs.where((F.col("repository") == repository) & F.col("id").startswith(prefix) & (F.col("id") > after))
    if status != ALL:
        p = p.where(_status_class(F.col("status")) == status)
    return p.orderBy("id").limit(amount)


MERGE_PR_PARAMS = [Param("repository"), Param("id"), Param("date", "long"), Param("force", "boolean", False)]


def merge_pull_requests(requests: DataFrame, prs: DataFrame, refs: DataFrame, commits: DataFrame,
                        parents: DataFrame, entries: DataFrame, listings: DataFrame | None = None) -> DataFrame:
    """not_found → not_open → the merge's own outcome; a merged PR becomes
    ``merged`` with its merge commit and closed date.  ``merge`` holds the merge's
    own row, from which ``merge_pr_deltas`` makes the state deltas."""
    r = validate(bind(requests, MERGE_PR_PARAMS), [rule_required("repository"), rule_required("id"), rule_positive("date")])
    p = prs.select("repository", "id", F.col("status").alias("pr_status"), "source_branch",
                   "destination_branch", F.col("merged_commit_id").alias("pr_merged_commit_id"))
    r = r.checkpoint(eager=True)
    r = r.join(rows_among(p, r.select(*PKEY)), PKEY, "left").checkpoint(eager=True)
    mergeable = F.col("error_code").isNull() & (F.col("pr_status") == OPEN)
    mreq = r.where(mergeable).select(
        "seq", "repository", F.col("source_branch").alias("source_ref"), "destination_branch",
        F.concat(F.lit("merge "), F.col("id")).alias("message"), "date", "force",
        F.lit(False).alias("allow_empty"))
    mo = merge_refs(mreq, refs, commits, parents, entries, listings=listings).select(
        "seq", F.col("outcome").alias("merge_outcome"), F.col("commit_id").alias("merge_commit"), "n_conflict",
        F.struct(*MERGE_FIELDS).alias("merge"))
    r = r.join(small_side(mo.checkpoint(eager=True)), "seq", "left")
    outcome = F.coalesce(F.when(F.col("error_code").isNotNull(), F.lit(O.INVALID))
                          .when(F.col("pr_status").isNull(), F.lit(O.NOT_FOUND))
                          .when(F.col("pr_status") != OPEN, F.lit(O.NOT_OPEN)),
                         F.col("merge_outcome"))
    r = r.withColumn("outcome", outcome).withColumn("ok", O.ok_col())
    done = F.col("outcome") == O.MERGED
    # the merge's own time: the request's date, or the batch time if it has none
    closed = F.timestamp_add("SECOND", F.col("merge.creation_seconds"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return (r.withColumn("status", F.when(done, F.lit(MERGED)).otherwise(F.col("pr_status")))
             .withColumn("merged_commit_id", F.when(done, F.col("merge_commit"))
                         .otherwise(F.col("pr_merged_commit_id")))
             .withColumn("closed_date", F.when(done, closed)))


MERGE_FIELDS = ["outcome", "commit_id", "committer", "message", "metadata", "meta_range_id", "generation", "creation_seconds",
                "hidden", "dest_commit", "source_commit", "base_range", "source_range", "dest_range", "force", "destination_branch"]


def merge_pr_deltas(outcomes: DataFrame, entries: DataFrame, listings: DataFrame | None = None) -> dict[str, DataFrame]:
    """State deltas of merged pull requests: those of the merges; the pull
    requests themselves change by ``apply_pr_outcomes``."""
    done = outcomes.where(F.col("outcome") == O.MERGED).select("repository", "merge.*")
    return merge_deltas(done, entries, listings)


def apply_pr_outcomes(prs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """New ``pull_requests`` state after merge or update outcomes: changed
    PRs (last successful request per id by ``seq``) replace their rows."""
    done = outcomes.where(F.col("outcome").isin(O.MERGED, O.UPDATED))
    fields = [c for c in ("status", "title", "description", "merged_commit_id", "closed_date") if c in done.columns]
    last = (done.groupBy(*PKEY).agg(F.max_by(F.struct(*fields), F.col("seq")).alias("_n"))
                .select(*PKEY, *[F.col(f"_n.{c}").alias(f"_new_{c}") for c in fields]))
    # closing sets the closed date (the request's, if it has one), reopening clears it
    j = prs.join(last, PKEY, "left")
    for c in fields:
        j = j.withColumn(c, F.when(F.col("_new_status").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)))
    return j.drop(*[f"_new_{c}" for c in fields])


UPDATE_PARAMS = [Param("repository"), Param("id"), Param("title"), Param("description"), Param("status"), Param("date", "long")]
UPDATE_FIELDS = ("title", "description", "status")


def update_pull_requests(requests: DataFrame, prs: DataFrame) -> DataFrame:
    """invalid → not_found → bad_transition (a merged PR cannot change
    status) → updated.  Each row shows the PR after the request: a field is
    the value set by this or the last earlier successful update of the same
    PR in the batch, else the stored value."""
    r = validate(bind(requests, UPDATE_PARAMS),
                 [rule_required("repository"), rule_required("id"), rule_allowed("status", [OPEN, CLOSED]), rule_positive("date")])
    p = prs.select("repository", "id", *([F.col("closed_date").alias("old_closed")] if "closed_date" in prs.columns
                                         else [F.lit(None).cast("timestamp_ntz").alias("old_closed")]), *[F.col(f).alias(f"old_{f}") for f in UPDATE_FIELDS])
    r = r.join(p, PKEY, "left")
    outcome = O.first_match(
        (F.col("error_code").isNotNull(), O.INVALID),
        (F.col("old_status").isNull(), O.NOT_FOUND),
        ((F.col("old_status") == MERGED) & F.col("status").isNotNull() & (F.col("status") != MERGED),
         O.BAD_TRANSITION),
        default=O.UPDATED)
    r = r.withColumn("outcome", outcome).withColumn("ok", O.ok_col())
    done = F.col("outcome") == O.UPDATED
    r = r.withColumns({f"_u_{f}": F.when(done, F.col(f)) for f in UPDATE_FIELDS})
    r = last_values(r, PKEY, "seq", {f"_u_{f}": f"_p_{f}" for f in UPDATE_FIELDS})
    r = r.withColumns({f: F.coalesce(F.col(f"_u_{f}"), F.col(f"_p_{f}"), F.col(f"old_{f}")) for f in UPDATE_FIELDS})
    # closing sets the closed date (the request's date, or now), reopening clears it
    now = F.coalesce(naive_time(F.col("date")), F.current_timestamp().cast("timestamp_ntz"))
    r = r.withColumn("closed_date", F.when(done & (F.col("status") == CLOSED), F.coalesce("old_closed", now))
                     .when(~done | (F.col("status") != OPEN), F.col("old_closed"))).drop("old_closed")
    return r.drop(*[f"{pre}{f}" for pre in ("_u_", "_p_", "old_") for f in UPDATE_FIELDS])
