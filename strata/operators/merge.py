"""Merges: merge a ref into a branch, revert a commit, cherry-pick a commit.

All three are a three-way merge of listings (base, source, dest).  Requests
are reduced to distinct listing triples, each triple is classified once
(``listing.three_way_summary``: one groupBy over tagged rows), and the small
per-triple summary is joined back.  The merged listing's identity is the
dest identity plus the summed lane deltas of the paths taken from source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import hashing as H
from strata.functions import outcomes as O
from strata.functions.joins import rows_among, small_side
from strata.functions.params import Param, bind, rule_positive, rule_required, validate, without_requests
from strata.functions.render import kept_metadata, sorted_metadata_text
from strata.operators import commits as C
from strata.operators import listing as L
from strata.operators.refs import resolve_refs
from strata.operators.state import commit_delta

NO_RANGE = ""   # stands for an empty listing (no common ancestor / no parent)


def _first_per_key(df: DataFrame, cond: Column, key: list[str], out: str) -> DataFrame:
    first = df.where(cond).groupBy(*key).agg(F.min("seq").alias("_first_seq"))
    return (df.join(small_side(first.checkpoint(eager=True)), key, "left")
              .withColumn(out, cond & (F.col("seq") == F.col("_first_seq")))
              .drop("_first_seq"))


def _with_summary(r: DataFrame, entries: DataFrame, ok_rows: Column,
                  listings: DataFrame | None = None) -> DataFrame:
    """Attach per-triple class counts and lane deltas (zero for other rows)."""
    r = r.withColumn("base_range", F.coalesce(F.col("base_range"), F.lit(NO_RANGE)))
    triples = r.where(ok_rows).select(*L.TRIPLE).distinct()
    # a row a triple: sent to the requests, which stay where they are
    summary = small_side(L.three_way_summary(triples, entries, listings=listings).checkpoint(eager=True))
    r = r.join(summary, L.TRIPLE, "left")
    for c in L.CLASSES:
        r = r.withColumn(f"n_{c}", F.coalesce(F.col(f"n_{c}"), F.lit(0)).cast("long"))
    return r


def _merged_range(r: DataFrame, entries: DataFrame, take_conflicts: Column,
                  listings: DataFrame | None = None) -> DataFrame:
    stats = L.stats_for(entries, r.select("repository", F.col("dest_range").alias("meta_range_id")), listings)
    stats = stats.select("repository", F.col("meta_range_id").alias("dest_range"),
                         F.col("n_entries").alias("_dn"), F.col("lane0").alias("_d0"),
                         F.col("lane1").alias("_d1"))
    r = r.join(small_side(stats), ["repository", "dest_range"], "left")
    zero = F.lit(0).cast(H.DEC)

    def lane(i):
        ts = F.coalesce(F.col(f"ts_d{i}"), zero)
        cf = F.when(take_conflicts, F.coalesce(F.col(f"cf_d{i}"), zero)).otherwise(zero)
        return F.coalesce(F.col(f"_d{i}"), zero) + ts + cf

    n = (F.coalesce(F.col("_dn"), F.lit(0)) + F.coalesce(F.col("ts_d2"), F.lit(0))
         + F.when(take_conflicts, F.coalesce(F.col("cf_d2"), F.lit(0))).otherwise(F.lit(0)))
    r = r.withColumn("_merged_range", H.listing_id(lane(0), lane(1), n))
    return r.drop("_dn", "_d0", "_d1", *[f"{t}_d{i}" for t in ("ts", "cf") for i in range(3)])


MERGE_PARAMS = [
    Param("repository"), Param("source_ref"), Param("destination_branch"),
    Param("message", default=""), Param("committer", default="unknown"), Param("date", "long"),
    Param("force", "boolean", False), Param("allow_empty", "boolean", False),
]


@without_requests
def merge_refs(requests: DataFrame, refs: DataFrame, commits: DataFrame, parents: DataFrame,
               entries: DataFrame, batch_seconds: Column | None = None,
               listings: DataFrame | None = None) -> DataFrame:
    """Merge ``source_ref`` (branch or commit) into ``destination_branch``.

    Precedence: invalid → ref_not_found → nothing_to_merge → conflict (not
    forced) → retry_next_batch (one merge per destination per batch) →
    merged.  Forced merges take the source side of conflicting paths."""
    req = requests if "metadata" in requests.columns else requests.withColumn(
        "metadata", F.create_map().cast("map<string,string>"))
    r = validate(bind(req, MERGE_PARAMS),
                 [rule_required("repository"), rule_required("source_ref"),
                  rule_required("destination_branch"), rule_positive("date")])
    r = r.withColumn("metadata", kept_metadata("metadata"))
    r = r.checkpoint(eager=True)
    named = lambda col, name: r.select("repository", F.col(col).alias(name))
    source_refs = rows_among(refs.select("repository", "branch", "commit_id"), named("source_ref", "branch"))
    source_commits = rows_among(commits.select("repository", "commit_id"), named("source_ref", "commit_id"))
    dest = rows_among(refs.select("repository", "branch", "commit_id", "hidden"), named("destination_branch", "branch")).select(
        "repository", F.col("branch").alias("destination_branch"), F.col("commit_id").alias("dest_commit"), "hidden")
    r = resolve_refs(r, source_refs, source_commits, ref="source_ref", out="source_commit", kind="source_kind")
    # requests are small next to listings: cut their lineage once (reliable
    # checkpoint) so the merge-base loop and every later branch reuse them
    r = r.drop("hidden").join(dest, ["repository", "destination_branch"], "left").checkpoint(eager=True)
    found = F.col("error_code").isNull() & F.col("source_commit").isNotNull() & F.col("dest_commit").isNotNull()
    pairs = r.where(found).select("repository", F.col("source_commit").alias("a"), F.col("dest_commit").alias("b"))
    mb = C.merge_base(pairs, commits, parents).select(
        "repository", F.col("a").alias("source_commit"), F.col("b").alias("dest_commit"), "base_id")
    r = r.join(small_side(mb.checkpoint(eager=True)), ["repository", "source_commit", "dest_commit"], "left").checkpoint(eager=True)
    named = L.commits_among(commits, r, "source_commit", "dest_commit", "base_id")
    r = L.head_range(r, named, "source_commit", out="source_range", generation_out="source_generation")
    r = L.head_range(r, named, "dest_commit", out="dest_range", generation_out="dest_generation")
    r = L.head_range(r, named, "base_id", out="base_range").checkpoint(eager=True)
    r = _with_summary(r, entries, found, listings)
    moving = F.col("n_take_source") + F.col("n_conflict")
    blocked = (F.col("n_conflict") > 0) & ~F.col("force")
    candidate = found & ((moving > 0) | F.col("allow_empty")) & ~blocked
    r = _first_per_key(r, candidate, ["repository", "destination_branch"], "_is_first")
    outcome = O.first_match(
        (F.col("error_code").isNotNull(), O.INVALID),
        (~found, O.REF_NOT_FOUND),
        ((moving == 0) & ~F.col("allow_empty"), O.NOTHING_TO_MERGE),
        (blocked, O.CONFLICT),
        (~F.col("_is_first"), O.RETRY_NEXT_BATCH),
        default=O.MERGED)
    r = r.withColumn("outcome", outcome).withColumn("ok", O.ok_col())
    r = _merged_range(r, entries, F.col("force"), listings)
    done = F.col("outcome") == O.MERGED
    seconds = F.coalesce(F.col("date"), batch_seconds if batch_seconds is not None
                         else C.epoch_seconds(F.current_timestamp().cast("timestamp_ntz")))
    parents_text = F.concat_ws(",", F.col("dest_commit"), F.col("source_commit"))
    return (r.withColumn("meta_range_id", F.when(done, F.col("_merged_range")))
             .withColumn("generation", F.when(done, F.greatest("dest_generation", "source_generation") + 1)
                         .cast("long"))
             .withColumn("creation_seconds", F.when(done, seconds))
             .withColumn("commit_id", F.when(done, H.commit_id(
                 F.col("repository"), parents_text, F.col("_merged_range"), F.col("committer"),
                 F.col("message"), seconds, sorted_metadata_text("metadata"))))
             .drop("_merged_range", "_is_first", "source_kind"))


def merge_deltas(outcomes: DataFrame, entries: DataFrame, listings: DataFrame | None = None) -> dict[str, DataFrame]:
    """State deltas of ``merge_refs`` outcomes: two-parent commits, their
    parents, the destination refs moved to them, and the merged listings."""
    done = outcomes.where(F.col("outcome") == O.MERGED)
    return commit_delta(done, "destination_branch", F.array("dest_commit", "source_commit"),
                        L.merged_listing(done, entries, listings))


def _first_parent(commits_rows: DataFrame, parents: DataFrame, commit_col: str, out: str) -> DataFrame:
    p = parents.where(F.col("pos") == 0).select(
        F.col("repository").alias("_p_repo"), F.col("commit_id").alias("_p_child"), F.col("parent_id").alias(out))
    return (commits_rows.join(p, (commits_rows["repository"] == p["_p_repo"])
                              & (commits_rows[commit_col] == p["_p_child"]), "left")
            .drop("_p_repo", "_p_child"))


PICK_PARAMS = [Param("repository"), Param("branch"), Param("commit_ref"), Param("force", "boolean", False),
               Param("message"), Param("committer", default="unknown"), Param("date", "long")]


def _single_commit_merge(requests: DataFrame, refs: DataFrame, commits: DataFrame, parents: DataFrame,
                         entries: DataFrame, revert: bool, listings: DataFrame | None = None) -> DataFrame:
    r = validate(bind(requests, PICK_PARAMS),
                 [rule_required("repository"), rule_required("branch"), rule_required("commit_ref"), rule_positive("date")])
    r = resolve_refs(r, refs, commits, ref="commit_ref", out="target_commit", kind="target_kind")
    r = r.drop("hidden").join(refs.select("repository", "branch", F.col("commit_id").alias("dest_commit"), "hidden"),
               ["repository", "branch"], "left")
    r = _first_parent(r, parents, "target_commit", "parent_commit")
    r = L.head_range(r, commits, "target_commit", out="target_range")
    r = L.head_range(r, commits, "parent_commit", out="parent_range")
    r = L.head_range(r, commits, "dest_commit", out="dest_range", generation_out="dest_generation")
    r = r.checkpoint(eager=True)
    if revert:   # undo target: base = target, source = its parent
        r = r.withColumn("base_range", F.col("target_range")).withColumn("source_range", F.col("parent_range"))
    else:        # replay target: base = its parent, source = target
        r = r.withColumn("base_range", F.col("parent_range")).withColumn("source_range", F.col("target_range"))
    found = F.col("error_code").isNull() & F.col("target_commit").isNotNull() & F.col("dest_commit").isNotNull()
    has_parent = F.col("parent_commit").isNotNull()
    r = _with_summary(r, entries, found & has_parent, listings)
    moving = F.col("n_take_source") + F.col("n_conflict")
    blocked = (F.col("n_conflict") > 0) & ~F.col("force")
    candidate = found & has_parent & (moving > 0) & ~blocked
    r = _first_per_key(r, candidate, ["repository", "branch"], "_is_first")
    outcome = O.first_match(
        (F.col("error_code").isNotNull(), O.INVALID),
        (~found, O.REF_NOT_FOUND),
        (~has_parent, O.NO_PARENT),
        (moving == 0, O.NOTHING_TO_REVERT if revert else O.NOTHING_TO_PICK),
        (blocked, O.CONFLICT),
        (~F.col("_is_first"), O.RETRY_NEXT_BATCH),
        default=O.REVERTED if revert else O.PICKED)
    r = r.withColumn("outcome", outcome).withColumn("ok", O.ok_col())
    r = _merged_range(r, entries, F.col("force"), listings)
    done = F.col("outcome") == (O.REVERTED if revert else O.PICKED)
    verb = "revert " if revert else "cherry-pick "
    message = F.coalesce(F.col("message"), F.concat(F.lit(verb), F.col("target_commit")))
    seconds = F.coalesce(F.col("date"), C.epoch_seconds(F.current_timestamp().cast("timestamp_ntz")))
    return (r.withColumn("meta_range_id", F.when(done, F.col("_merged_range")))
             .withColumn("message", message)
             .withColumn("creation_seconds", F.when(done, seconds))
             .withColumn("generation", F.when(done, F.col("dest_generation") + 1).cast("long"))
             .withColumn("commit_id", F.when(done, H.commit_id(
                 F.col("repository"), F.col("dest_commit"), F.col("_merged_range"), F.col("committer"),
                 message, seconds, F.lit(""))))
             .drop("_merged_range", "_is_first", "target_kind"))


def single_commit_deltas(outcomes: DataFrame, entries: DataFrame, listings: DataFrame | None = None) -> dict[str, DataFrame]:
    """State deltas of revert / cherry-pick outcomes: a one-parent commit on
    the branch, the branch moved to it, and the new listing."""
    done = (outcomes.where(F.col("outcome").isin(O.REVERTED, O.PICKED))
            .withColumn("metadata", F.create_map().cast("map<string,string>")))
    return commit_delta(done, "branch", F.array("dest_commit"), L.merged_listing(done, entries, listings))


def revert_commit(requests, refs, commits, parents, entries, listings=None) -> DataFrame:
    """Undo ``commit_ref`` on ``branch`` (three-way: base = commit, source = its parent)."""
    return _single_commit_merge(requests, refs, commits, parents, entries, True, listings)


def cherry_pick(requests, refs, commits, parents, entries, listings=None) -> DataFrame:
    """Replay ``commit_ref`` onto ``branch`` (three-way: base = its parent, source = commit)."""
    return _single_commit_merge(requests, refs, commits, parents, entries, False, listings)
