"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables through ``Fixtures`` and runs whole
tables through one operator (or a short chain), so its work grows with the
input.  Output columns are flat scalars so the oracle comparison is exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import outcomes as O
from strata.functions.params import Param, bind, rule_positive, rule_required, validate
from strata.functions.render import metadata_map as _metadata_map
from strata.functions.render import render_map
from strata.operators import commits as C
from strata.operators import listing as L
from strata.operators import merge as MG
from strata.operators import objects as OB
from strata.operators import pulls as PR
from strata.operators import refs as R
from strata.operators import state as STATE
from strata.operators import wait as WT
from strata.session import scratch_path
from strata.sources.fixtures import Fixtures, observations_from
from strata.streaming import watch as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: The queries whose SQL asks for ``main`` only, over every ref and with staging on many branches.
ALL_REFS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def all_refs(fn):
    ALL_REFS[fn.__name__.removeprefix("q_")] = fn
    return fn


# ---------------------------------------------------------------- F1-F3, B1 --
@query
def q_bind_validate(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    s = F.col("seq")
    branch = F.when(s % 23 == 0, "feature/x").when(s % 29 == 0, "_tmp").otherwise(F.col("branch"))
    req = fx.requests.select(
        "seq", "repository", "op", branch.alias("branch"), "source", (s % 2 == 0).alias("ignore_exists"),
        F.when(s % 13 == 0, "maybe").when(s % 3 == 0, "true").otherwise("false").alias("force"),
        F.when(s % 17 == 0, "abc").when(s % 19 == 0, "-5").otherwise((s + 1).cast("string")).alias("date"),
        F.when(s % 31 == 0, "many").when(s % 37 == 0, "0").otherwise("3").alias("amount"))
    b = bind(req, [Param("repository"), Param("op"), Param("branch"), Param("source", default="main"),
                   Param("force", "boolean", False), Param("ignore_exists", "boolean", True),
                   Param("date", "long"), Param("amount", "int", 1)])
    v = validate(b, [rule_required("repository"), rule_required("branch"), rule_positive("date"), rule_positive("amount")])
    return v.withColumn("valid", F.col("error_code").isNull())


def _create_requests(fx):
    return fx.requests_of("create").drop("allow_empty", "ts")


@query
def q_resolve_refs(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    ref = (F.when(F.col("seq") % 3 == 0, F.md5(F.concat(F.col("repository"), F.lit(":"),
                                                       (F.col("seq") % 50).cast("string"))))
            .otherwise(F.col("branch")))
    req = fx.requests.select("seq", "repository", ref.alias("ref"))
    res = R.resolve_refs(req, fx.refs, fx.commits)
    return res.select("seq", "repository", "ref", "resolved_kind",
                      F.col("resolved_commit").alias("commit_id"))


@query
def q_create_branches(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = R.create_branches(_create_requests(fx), fx.refs, fx.commits)
    return out.select("seq", "repository", "branch", "source", "force", "ignore_exists", "hidden",
                      "outcome", "ok", "commit_id")


@query
def q_route_counts(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = R.create_branches(_create_requests(fx), fx.refs, fx.commits)
    return O.route_counts(out).select("outcome", "ok", "n")


@query
def q_delete_branches(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    req = fx.requests_of("delete").select("seq", "repository", "branch", "force")
    out = R.delete_branches(req, fx.refs)
    return out.select("seq", "repository", "branch", "force", "outcome", "ok", "commit_id")


@query
def q_apply_ref_log(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    s = F.col("seq")
    req = fx.requests_where_op("create", "delete").select(
        "seq", "repository", "op", "branch", "source", (s % 3 == 0).alias("force"),
        (s % 2 == 0).alias("ignore_exists"), (s % 11 == 0).alias("hidden"))
    out = R.apply_ref_log(req, fx.refs, fx.commits)
    return out.select("seq", "repository", "op", "branch", "outcome", "ok", "exists_before")


@query
def q_fetch_branches(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    req = fx.requests_of("fetch").select("seq", "repository", "branch")
    out = R.fetch_branches(req, fx.refs)
    return out.select("seq", "repository", "branch", "commit_id", "hidden", "outcome", "ok")


@query
def q_list_branches(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return R.list_branches(fx.refs)


@query
def q_new_branches(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    created = R.create_branches(_create_requests(fx), fx.refs, fx.commits)
    now = R.refs_after_create(created, fx.refs)
    return R.new_branches(now, fx.refs)


# ------------------------------------------------------------- listings ------


@query
def q_three_way(spark, sf_dir):
    """Flagship: what would each repository's merge do, path by path, counted."""
    fx = Fixtures(spark, sf_dir)
    tw = L.three_way(fx.manifest.select("repository", "side", "path", "checksum"), ["repository"])
    return tw.groupBy("repository", "class").agg(F.count(F.lit(1)).cast("long").alias("n"))


@query
def q_listing_id(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    st = L.listing_identity(L.listing_stats(fx.entries))
    return st.select("repository", "meta_range_id", "n_entries", "total_bytes", "listing_id")


def _main_branches(fx):
    return fx.refs.where(F.col("branch") == "main").select("repository", "branch")


def _all_branches(fx):
    return fx.refs.select("repository", "branch")


def _spread_staging(fx):
    """The fixture's staging, two thirds of it moved from ``main`` to 25 other
    branches of its repository, by order key."""
    k = F.substring_index("path", "/", -1).cast("long")
    return fx.staging.withColumn("branch", F.when(k % 3 == 0, F.lit("main")).otherwise(
        F.concat(F.lit("b_"), (k % 5 + 5 * (1 + k % 25)).cast("string"))))


def _view_rows(view):
    return view.select("repository", "branch", "path", "checksum", "size_bytes", "origin")


@query
def q_branch_view(spark, sf_dir):
    return _view_rows(_main_view(Fixtures(spark, sf_dir)))


@all_refs
def q_branch_view_all(spark, sf_dir):
    return _view_rows(_all_view(Fixtures(spark, sf_dir)))


def _diff_branch(fx, branches, staging):
    ch = L.branch_changes(branches, fx.refs, fx.commits, fx.entries, staging)
    return ch.select("repository", "branch", "path", "change", "old_checksum", "new_checksum")


@query
def q_diff_branch(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return _diff_branch(fx, _main_branches(fx), fx.staging)


@all_refs
def q_diff_branch_all(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return _diff_branch(fx, _all_branches(fx), _spread_staging(fx))


@query
def q_diff_refs(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    mains = fx.refs.where(F.col("branch") == "main").select("repository", F.col("branch").alias("left_ref"))
    req = (fx.refs.where(F.col("branch") != "main").select("repository", "branch", F.col("branch").alias("right_ref"))
           .join(mains, "repository"))
    return L.diff_refs(req, fx.refs, fx.commits, fx.entries).select("repository", "branch", "n_added", "n_removed", "n_changed")


# -------------------------------------------------------------- commits ------
@query
def q_commit_attributes(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return C.commit_attributes(fx.commits, fx.parents)


@query
def q_metadata_map(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    p = fx.pull_requests
    m = _metadata_map(author=F.col("author"), description=F.col("description"), title=F.col("title"))
    return p.select("repository", "id", render_map(m).alias("metadata"),
                    F.size(m).cast("long").alias("n_keys"))


@query
def q_fetch_commits(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    req = fx.requests.select("seq", "repository",
                             F.md5(F.concat(F.col("repository"), F.lit(":"), F.col("seq").cast("string")))
                             .alias("commit_id"))
    out = C.fetch_commits(req, fx.commits, fx.parents)
    return out.select("seq", "repository", "commit_id", "committer", "message", "meta_range_id",
                      "creation_date", "version", "generation", "parents", "outcome", "ok")


def _branch_vs_main(fx):
    main = fx.refs.where(F.col("branch") == "main").select("repository", F.col("commit_id").alias("b"))
    return (fx.refs.where(F.col("branch") != "main")
            .select("repository", "branch", F.col("commit_id").alias("a")).join(main, "repository"))


@query
def q_merge_base(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    pairs = _branch_vs_main(fx)
    mb = C.merge_base(pairs, fx.commits, fx.parents)
    return (pairs.join(mb, ["repository", "a", "b"], "left")
            .select("repository", "branch", F.col("a").alias("head"), F.col("b").alias("main_head"),
                    "base_id", F.col("base_generation").cast("long").alias("base_generation")))


def _log(fx, refs):
    heads = refs.select("repository", F.col("branch").alias("ref_name"), "commit_id")
    return C.log_commits(heads, fx.commits, fx.parents).select(
        "repository", "ref_name", "commit_id", "generation", "message", "position")


@query
def q_log_commits(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return _log(fx, fx.refs.where(F.col("branch") == "main"))


@all_refs
def q_log_commits_all(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return _log(fx, fx.refs)


def _commit_requests(fx):
    s = F.col("seq")
    return fx.requests_where_op("commit").select(
        "seq", "repository",
        F.when(s % 3 == 0, F.lit("main")).otherwise(F.col("branch")).alias("branch"),
        F.concat(F.lit("commit "), s.cast("string")).alias("message"),
        C.epoch_seconds(F.col("ts")).alias("date"),
        (s % 3 == 0).alias("force"), (s % 4 == 0).alias("allow_empty"),
        F.create_map(F.lit("source"), F.col("source")).alias("metadata"))


@query
def q_commit_branches(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = C.commit_branches(_commit_requests(fx), fx.refs, fx.commits, fx.entries, fx.staging,
                            listings=fx.listings)
    return out.select("seq", "repository", "branch", "outcome", "ok", "head", "n_changes",
                      "meta_range_id", "generation", "commit_id")


@query
def q_ref_log_state(spark, sf_dir):
    """Refs after a batch of interleaved creates and deletes."""
    fx = Fixtures(spark, sf_dir)
    s = F.col("seq")
    req = fx.requests_where_op("create", "delete").select(
        "seq", "repository", "op", "branch", "source", (s % 3 == 0).alias("force"),
        (s % 2 == 0).alias("ignore_exists"), (s % 11 == 0).alias("hidden"))
    return R.refs_after_log(R.apply_ref_log(req, fx.refs, fx.commits), fx.refs)


@query
def q_commit_then_commit(spark, sf_dir):
    """Two batches on the same branches: the second reads the state after the
    first; listing identities are made again from the raw entries."""
    fx = Fixtures(spark, sf_dir)
    state = {"refs": fx.refs.select("repository", "branch", "commit_id", "hidden"), "commits": fx.commits, "parents": fx.parents,
             "entries": fx.entries, "listings": fx.listings, "staging": fx.staging}
    out = C.commit_branches(_commit_requests(fx), fx.refs, fx.commits, fx.entries, fx.staging, listings=fx.listings)
    deltas = {k: v.checkpoint(eager=True) for k, v in C.commit_deltas(out.checkpoint(eager=True), fx.entries, fx.staging,
                                                                      fx.listings).items()}
    after = STATE.apply_deltas(state, deltas)
    again = deltas["refs"].select(F.lit(1).cast("long").alias("seq"), "repository", "branch", F.lit("again").alias("message"),
                                  F.lit(1700000000).cast("long").alias("date"), F.lit(True).alias("allow_empty"))
    second = C.commit_branches(again, after["refs"], after["commits"], after["entries"], after["staging"],
                               listings=after["listings"])
    ids = L.listing_identity(L.listing_stats(after["entries"], second.select("repository", "meta_range_id")))
    return (second.join(ids.select("repository", "meta_range_id", "n_entries", "listing_id"), ["repository", "meta_range_id"], "left")
            .select("repository", "branch", "head", "outcome", "meta_range_id", "generation", "commit_id", "n_entries", "listing_id"))


# --------------------------------------------------------------- merges ------


def _merge_requests(fx):
    s = F.col("seq")
    return fx.requests_where_op("merge").select(
        "seq", "repository", F.col("branch").alias("source_ref"), F.lit("main").alias("destination_branch"),
        F.concat(F.lit("merge "), s.cast("string")).alias("message"), C.epoch_seconds(F.col("ts")).alias("date"),
        (s % 3 == 0).alias("force"), (s % 4 == 0).alias("allow_empty"))


def _merge_outcomes(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return MG.merge_refs(_merge_requests(fx), fx.refs, fx.commits, fx.parents, fx.entries, listings=fx.listings)


@query
def q_merge_refs(spark, sf_dir):
    out = _merge_outcomes(spark, sf_dir)
    return out.select("seq", "repository", "source_ref", "destination_branch", "outcome", "ok", "base_id",
                      "n_take_source", "n_conflict", "n_keep_dest", "n_same_change", "n_unchanged",
                      "meta_range_id", "generation", "commit_id")


@query
def q_merge_summary(spark, sf_dir):
    out = _merge_outcomes(spark, sf_dir)
    return (out.groupBy("repository", "outcome")
               .agg(F.count(F.lit(1)).cast("long").alias("n"),
                    F.sum("n_conflict").cast("long").alias("conflicts"),
                    F.sum("n_take_source").cast("long").alias("taken")))


def _pick_requests(fx):
    return (fx.refs.where(F.col("branch") != "main")
            .select(F.lit(0).cast("long").alias("seq"), "repository", "branch",
                    F.lit("main").alias("commit_ref"), F.col("hidden").alias("force")))


@query
def q_revert_commit(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = MG.revert_commit(_pick_requests(fx), fx.refs, fx.commits, fx.parents, fx.entries, fx.listings)
    return out.select("repository", "branch", "target_commit", "outcome", "ok", "n_take_source",
                      "n_conflict", "n_keep_dest", "meta_range_id")


@query
def q_cherry_pick(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = MG.cherry_pick(_pick_requests(fx), fx.refs, fx.commits, fx.parents, fx.entries, fx.listings)
    return out.select("repository", "branch", "target_commit", "outcome", "ok", "n_take_source",
                      "n_conflict", "n_keep_dest", "meta_range_id")


# -------------------------------------------------------- pull requests ------


def _lpad_seq(c="seq"):
    return F.concat(F.lit("pr_"), F.lpad(F.col(c).cast("string"), 9, "0"))


@query
def q_create_pull_requests(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    s = F.col("seq")
    req = fx.requests_where_op("merge").select(
        "seq", "repository", F.concat(F.lit("title "), s.cast("string")).alias("title"),
        F.when(s % 2 == 0, F.concat(F.lit("about "), s.cast("string"))).alias("description"),
        F.col("branch").alias("source_branch"),
        F.when(s % 7 == 0, F.col("branch")).otherwise(F.lit("main")).alias("destination_branch"))
    out = PR.create_pull_requests(req, fx.refs)
    return out.select("seq", "repository", "id", "title", "source_branch", "destination_branch", "status",
                      "outcome", "ok")


@query
def q_fetch_pull_requests(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    req = fx.requests.select("seq", "repository", _lpad_seq().alias("id"))
    out = PR.fetch_pull_requests(req, fx.pull_requests)
    return out.select("seq", "repository", "id", "status", "title", "description", "author", "source_branch",
                      "destination_branch", "merged_commit_id", "creation_date", "closed_date", "outcome", "ok")


def _list_requests(fx):
    s = F.col("seq")
    return fx.requests_where_op("fetch").select(
        "seq", "repository",
        F.when(s % 3 == 0, F.lit("")).when(s % 3 == 1, F.lit("pr_00000")).otherwise(F.lit("pr_000001"))
         .alias("prefix"),
        F.when(s % 2 == 0, F.lit("")).otherwise(_lpad_seq()).alias("after"),
        (F.lit(1) + s % 5).cast("int").alias("amount"),
        F.when(s % 3 == 0, F.lit("open")).when(s % 3 == 1, F.lit("closed")).otherwise(F.lit("all")).alias("status"))


@query
def q_list_pull_requests(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return PR.list_pull_requests(_list_requests(fx), fx.pull_requests)


@query
def q_merge_pull_requests(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    req = fx.requests_where_op("create").select(
        "seq", "repository", _lpad_seq().alias("id"), C.epoch_seconds(F.col("ts")).alias("date"))
    out = PR.merge_pull_requests(req, fx.pull_requests, fx.refs, fx.commits, fx.parents, fx.entries,
                                 fx.listings)
    return out.select("seq", "repository", "id", "outcome", "ok", "status", "merged_commit_id", "n_conflict")


@query
def q_update_pull_requests(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    s = F.col("seq")
    req = fx.requests_where_op("fetch").select(
        "seq", "repository", _lpad_seq().alias("id"),
        F.when(s % 2 == 0, F.concat(F.lit("retitled "), s.cast("string"))).alias("title"),
        F.when(s % 3 == 0, F.lit("closed")).when(s % 3 == 1, F.lit("open")).alias("status"))
    out = PR.update_pull_requests(req, fx.pull_requests)
    return out.select("seq", "repository", "id", "outcome", "ok", "status", "title", "description")


# -------------------------------------------------------------- objects ------


@query
def q_put_objects(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    req = fx.objects.select(F.col("doc_id").alias("seq"), "repository", F.lit("main").alias("branch"),
                            F.regexp_replace("path", r"/[^/]*$", "/latest.txt").alias("path"), "content",
                            (F.col("doc_id") % 2 == 0).alias("overwrite"))
    out = OB.put_objects(req, fx.refs, fx.commits, fx.entries, fx.staging)
    return out.select("seq", "repository", "branch", "path", "checksum", "size_bytes", "outcome", "ok")


def _state_after_doc_puts(fx):
    """State after uploading every document to ``main``: staging with the
    staged puts, and content bytes once per checksum (partitioned by
    checksum prefix).  The puts' rows are written once beside the staging that
    is there, as a put batch would append them."""
    def puts():
        req = fx.objects.select(F.col("doc_id").alias("seq"), "repository", F.lit("main").alias("branch"),
                                "path", "content", F.lit(True).alias("overwrite"))
        return OB.put_deltas(OB.put_objects(req, fx.refs, fx.commits, fx.entries, fx.staging))
    staging = fx.staging.unionByName(fx.stored("staged_puts", lambda: puts()["staged"], cluster_by=("path",)))
    contents = fx.stored("contents", lambda: puts()["contents"], partition_by=("prefix",),
                         cluster_by=("checksum",))
    return staging, contents


@query
def q_fetch_objects(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    staging, contents = _state_after_doc_puts(fx)
    ref = (F.when(F.col("doc_id") % 4 == 0, F.md5(F.concat(F.col("repository"), F.lit(":1"))))
            .otherwise(F.lit("main")))
    req = fx.objects.select(F.col("doc_id").alias("seq"), "repository", ref.alias("ref"), "path")
    out = OB.fetch_objects(req, fx.refs, fx.commits, fx.entries, staging, contents)
    return out.select("seq", "repository", "ref", "path", "outcome", "ok", "file_name", "file_length",
                      F.sha2("content", 256).alias("content_sha"))


def _path_requests(fx):
    s = F.col("seq")
    return fx.requests.select(
        "seq", "repository", F.lit("main").alias("ref"), F.lit("main").alias("branch"),
        F.concat(F.lit("orders/"), F.when(s % 2 == 0, F.lit("O")).otherwise(F.lit("F")), F.lit("/"),
                 s.cast("string")).alias("path"))


@query
def q_stat_objects(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = OB.stat_objects(_path_requests(fx).drop("branch"), fx.refs, fx.commits, fx.entries, fx.staging)
    return out.select("seq", "repository", "ref", "path", "checksum", "size_bytes", "outcome", "ok")


@query
def q_head_objects(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = OB.head_objects(_path_requests(fx).drop("branch"), fx.refs, fx.commits, fx.entries, fx.staging)
    return out.select("seq", "repository", "path")


@query
def q_delete_objects(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = OB.delete_objects(_path_requests(fx).drop("ref"), fx.refs, fx.commits, fx.entries, fx.staging)
    return out.select("seq", "repository", "branch", "path", "outcome", "ok")


@query
def q_copy_objects(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    req = _path_requests(fx).drop("ref").withColumn("dest_path", F.concat(F.lit("copies/"), F.col("path")))
    out = OB.copy_objects(req, fx.refs, fx.commits, fx.entries, fx.staging)
    return out.select("seq", "repository", "branch", "path", "dest_path", "checksum", "outcome", "ok")


@query
def q_reset_branch(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    req = _main_branches(fx).withColumn("prefix", F.lit("orders/O/"))
    kept = OB.reset_branch(fx.staging, req)
    return kept.select("repository", "branch", "path", "op", "checksum", "size_bytes")


def _main_view(fx):
    return L.branch_view(_main_branches(fx), fx.refs, fx.commits, fx.entries, fx.staging)


def _main_layers(fx):
    return L.branch_layers(_main_branches(fx), fx.refs, fx.commits, fx.entries, fx.staging)


def _all_layers(fx):
    return L.branch_layers(_all_branches(fx), fx.refs, fx.commits, fx.entries, _spread_staging(fx))


def _all_view(fx):
    return L.branch_view(_all_branches(fx), fx.refs, fx.commits, fx.entries, _spread_staging(fx))


@query
def q_list_objects(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return OB.list_objects(_main_layers(fx), prefix="orders/", delimiter="/")


@all_refs
def q_list_objects_all(spark, sf_dir):
    return OB.list_objects(_all_layers(Fixtures(spark, sf_dir)), prefix="orders/", delimiter="/")


@query
def q_symlink_manifest(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return OB.symlink_manifest(_main_layers(fx))


@all_refs
def q_symlink_manifest_all(spark, sf_dir):
    return OB.symlink_manifest(_all_layers(Fixtures(spark, sf_dir)))


# ------------------------------------------------------------------ watch ----


@query
def q_wait_commits(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return WT.wait_commits(fx.observations).select("repository", "branch", "seq", "observed_at", "commit_id")


@query
def q_poll_sample(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    sampled = WT.poll_sample(fx.observations, "1 hour")
    return WT.wait_commits(sampled).select("repository", "branch", "window_start", "commit_id")


@query
def q_changed_since(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    s = F.col("seq")
    cnt = fx.commits.groupBy("repository").agg(F.count(F.lit(1)).alias("cnt"))
    k = F.substring(F.col("branch"), 3, 20).try_cast("long")
    req = (fx.requests_where_op("fetch").join(cnt, "repository", "left")
           .select("seq", "repository", "branch",
                   F.when(s % 4 == 0, F.md5(F.concat(F.col("repository"), F.lit(":"),
                                                     (F.lit(1) + (k * 37) % F.col("cnt")).cast("string"))))
                    .otherwise(F.md5(F.concat(F.col("repository"), F.lit(":"), s.cast("string"))))
                    .alias("previous_commit_id")))
    out = WT.changed_since(req, fx.refs)
    return out.select("seq", "repository", "branch", "previous_commit_id", "head", "outcome", "ok")


# -------------------------------------------------------------- streams ------


@query
def q_stream_wait_commits(spark, sf_dir):
    """Events file as a stream → keyed state → parquet sink; read back."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    events = ST.file_stream(spark, sf_dir.rstrip("/"), schema, glob="events.parquet")
    out, ck = scratch_path(spark, "wait-out"), scratch_path(spark, "wait-ck")
    ST.run_available(ST.wait_commits_stream(observations_from(events)), out, ck)
    return spark.read.schema(ST.OUT_SCHEMA).parquet(out)


@query
def q_stream_new_branches(spark, sf_dir):
    """Two branch listings (before / after a batch of creates) arrive as a
    stream; the first emits every branch, the second only new ones."""
    fx = Fixtures(spark, sf_dir)
    before = fx.refs.select("repository", "branch", "commit_id")
    created = R.create_branches(_create_requests(fx), fx.refs, fx.commits)
    after = R.refs_after_create(created, fx.refs).select("repository", "branch", "commit_id")
    src, out, ck = (scratch_path(spark, n) for n in ("listings", "new-out", "new-ck"))
    schema = before.schema
    for snap in (before, after):
        snap.write.mode("append").parquet(src)
        stream = ST.new_branches_stream(spark.readStream.schema(schema).parquet(src))
        ST.run_available(stream, out, ck)
    return spark.read.schema(schema).parquet(out)
