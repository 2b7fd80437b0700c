"""Objects: put, fetch, stat/head, delete, copy, list, reset, symlinks.

Metadata is planned first (request → ref → listing entry, a few joins on
(repository, path)); bytes live in ``contents`` keyed by checksum and are
joined last, so executors read only the objects asked for and identical
contents are stored once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions import outcomes as O
from strata.functions.joins import rows_among, small_side
from strata.functions.ordered import row_number_within
from strata.functions.paging import overlaid_pages, pages, prefix_counts
from strata.functions.params import Param, bind, rule_positive, rule_required, validate
from strata.operators import listing as L
from strata.operators.refs import resolve_refs
from strata.sources.files import read_paths

PKEY = ["repository", "branch", "path"]


def lookup_paths(requests: DataFrame, refs: DataFrame, commits: DataFrame, entries: DataFrame,
                 staging: DataFrame, ref: str = "ref") -> DataFrame:
    """Resolve (repository, ``ref``, path) to the visible entry.

    A branch ref sees its staged changes (last op per path), a commit id
    only its committed listing.  Adds ref_commit, ref_kind, checksum,
    size_bytes, physical_address (null = path absent)."""
    # each ref is resolved once, however many requests name it
    refs_asked = requests.select("repository", ref).distinct()
    if small_side(refs_asked) is not refs_asked:  # few refs are named: no other refs and commits move
        refs = rows_among(refs.select("repository", "branch", "commit_id"), refs_asked.withColumnRenamed(ref, "branch"))
        heads = refs.select("repository", "commit_id").unionByName(refs_asked.withColumnRenamed(ref, "commit_id"))
        commits = rows_among(commits.select("repository", "commit_id", "meta_range_id"), heads)
    named = resolve_refs(refs_asked, refs, commits, ref=ref, out="ref_commit", kind="ref_kind")
    named = L.head_range(named, commits, "ref_commit", out="_ref_range").checkpoint(eager=True)
    r = requests.join(small_side(named), ["repository", ref], "left")
    committed = entries.select(
        "repository", F.col("meta_range_id").alias("_ref_range"), "path",
        F.col("checksum").alias("_c_ck"), F.col("size_bytes").alias("_c_size"),
        F.coalesce(F.col("physical_address"), F.col("checksum")).alias("_c_addr"))
    # only the listings that are asked for are read, and only their and the branches' rows are moved
    committed = committed.join(small_side(named.select("repository", "_ref_range").distinct()), ["repository", "_ref_range"], "left_semi")
    paths = requests.select("repository", "path").distinct()
    asked = small_side(paths)
    if asked is not paths:  # few paths are asked for: no other rows move
        committed = committed.join(asked, ["repository", "path"], "left_semi")
        staging = staging.join(asked, ["repository", "path"], "left_semi")
    wanted = named.where(F.col("ref_kind") == "branch").select("repository", F.col(ref).alias("branch")).distinct()
    r = r.join(committed, ["repository", "_ref_range", "path"], "left")
    staged = L.last_staged(staging, wanted).select(
        F.col("repository").alias("_s_repo"), F.col("branch").alias("_s_ref"), F.col("path").alias("_s_path"),
        F.col("op").alias("_s_op"),
        F.col("checksum").alias("_s_ck"), F.col("size_bytes").alias("_s_size"),
        F.col("physical_address").alias("_s_addr"))
    r = r.join(staged, (r["repository"] == staged["_s_repo"]) & (r[ref] == staged["_s_ref"])
               & (r["path"] == staged["_s_path"]) & (r["ref_kind"] == "branch"), "left")
    r = r.drop("_s_repo", "_s_path")
    use_staged = F.col("_s_op").isNotNull()

    def pick(s: str, c: str) -> Column:
        return F.when(use_staged, F.when(F.col("_s_op") == "put", F.col(s))).otherwise(F.col(c))

    return (r.withColumn("checksum", pick("_s_ck", "_c_ck"))
             .withColumn("size_bytes", pick("_s_size", "_c_size"))
             .withColumn("physical_address", pick("_s_addr", "_c_addr"))
             .drop("_ref_range", "_c_ck", "_c_size", "_c_addr", "_s_ref", "_s_op", "_s_ck", "_s_size", "_s_addr"))


def _path_outcome(found_ok: str) -> Column:
    return O.first_match((F.col("error_code").isNotNull(), O.INVALID),
                         (F.col("ref_commit").isNull(), O.REF_NOT_FOUND),
                         (F.col("checksum").isNull(), O.PATH_NOT_FOUND), default=found_ok)


LOOKUP_PARAMS = [Param("repository"), Param("ref"), Param("path")]
def _lookup_rules():
    return [rule_required("repository"), rule_required("ref"), rule_required("path")]


def stat_objects(requests, refs, commits, entries, staging) -> DataFrame:
    """Object metadata at (ref, path); absent → ``path_not_found``."""
    r = validate(bind(requests, LOOKUP_PARAMS), _lookup_rules())
    r = lookup_paths(r, refs, commits, entries, staging)
    return r.withColumn("outcome", _path_outcome(O.FETCHED)).withColumn("ok", O.ok_col())


def head_objects(requests, refs, commits, entries, staging) -> DataFrame:
    """Existence check: only requests whose path is visible at the ref."""
    return stat_objects(requests, refs, commits, entries, staging).where(F.col("ok"))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def content_prefix(checksum: Column) -> Column:
    """Partition key of ``contents``: the first two hex characters."""
    return F.substring(checksum, 1, 2)


def fetch_objects(requests, refs, commits, entries, staging, contents) -> DataFrame:
    """Read objects: metadata lookup, then join ``contents`` on the address.

    When ``contents`` is stored partitioned by ``prefix`` the join also
    matches on it, so dynamic partition pruning reads only the partitions
    that hold requested objects (never every stored byte)."""
    r = stat_objects(requests, refs, commits, entries, staging)
    c = contents.select(F.col("checksum").alias("_k"), "content",
                        *([F.col("prefix").alias("_p")] if "prefix" in contents.columns else []))
    cond = r["physical_address"] == c["_k"]
    if "_p" in c.columns:
        cond = cond & (content_prefix(r["physical_address"]) == c["_p"])
    r = r.join(c, cond, "left").drop("_k", "_p")
    return (r.withColumn("file_name", F.when(F.col("ok"), file_name(F.col("path"))))
             .withColumn("file_length", F.when(F.col("ok"), F.octet_length("content").cast("long"))))


PUT_PARAMS = [Param("repository"), Param("branch"), Param("path"), Param("overwrite", "boolean", False)]


def put_objects(requests: DataFrame, refs, commits, entries, staging) -> DataFrame:
    """Upload ``content`` (BINARY) at (branch, path).

    checksum = sha256(content) is also the physical address, so equal bytes
    share one address.  Create-only requests fail with ``exists`` when the
    path is visible on the branch or an earlier valid request in the batch
    wrote it; with ``overwrite`` every valid request is stored and the last
    by ``seq`` (unique in the batch) stays visible."""
    r = validate(bind(requests, PUT_PARAMS),
                 [rule_required("repository"), rule_required("branch"), rule_required("path"),
                  (F.col("content").isNull(), "empty:content")])
    # decisions are made without the bytes, which join once, last
    r = (r.withColumn("checksum", F.sha2("content", 256)).withColumn("size_bytes", F.octet_length("content").cast("long"))
         .withColumn("ref", F.col("branch")).drop("content"))
    looked = lookup_paths(r.select("seq", "repository", "ref", "path"), refs, commits, entries, staging)
    looked = looked.select("seq", F.col("ref_kind").alias("_kind"), F.col("checksum").alias("_visible_ck"))
    r = r.join(looked, "seq", "left")
    valid = F.col("error_code").isNull() & (F.col("_kind") == "branch")
    first = r.where(valid).groupBy("repository", "branch", "path").agg(F.min("seq").alias("_first"))
    r = r.join(first, PKEY, "left")
    earlier = F.col("_first") < F.col("seq")
    outcome = O.first_match(
        (F.col("error_code").isNotNull(), O.INVALID),
        (F.col("_kind").isNull() | (F.col("_kind") != "branch"), O.BRANCH_NOT_FOUND),
        (~F.col("overwrite") & (F.col("_visible_ck").isNotNull() | earlier), O.EXISTS),
        default=O.STORED)
    r = r.withColumn("outcome", outcome).withColumn("ok", O.ok_col()).drop("ref", "_kind", "_visible_ck", "_first")
    return r.join(requests.select("seq", "content"), "seq", "left")


def _after_stored(staged: DataFrame, staging: DataFrame | None) -> DataFrame:
    """Batch rows numbered after all stored ones of their branch, so that a
    batch whose ``seq`` starts again at 1 does not lose to older changes."""
    if staging is None:
        return staged
    last = staging.groupBy("repository", "branch").agg(F.max("seq").alias("_last"))
    return (staged.join(last, ["repository", "branch"], "left")
            .withColumn("seq", F.col("seq") + F.greatest(F.coalesce("_last", F.lit(0)), F.lit(0))).drop("_last"))


def put_deltas(outcomes: DataFrame, contents: DataFrame | None = None,
               staging: DataFrame | None = None) -> dict[str, DataFrame]:
    """``staged`` rows for stored uploads (after those of ``staging``) and content
    rows not stored yet (once per checksum; append them, partitioned by
    checksum prefix).  Checksums are decided on first, then the bytes of the
    chosen requests are picked by ``seq``."""
    stored = outcomes.where(F.col("outcome") == O.STORED)
    staged = stored.select("repository", "branch", "path", F.lit("put").alias("op"),
                           F.col("checksum").alias("physical_address"), "checksum", "size_bytes", "seq")
    chosen = stored.groupBy("checksum").agg(F.min("seq").alias("seq"))
    if contents is not None:
        chosen = chosen.join(contents.select("checksum"), "checksum", "left_anti")
    new_contents = (stored.select("seq", "content").join(chosen, "seq")
                    .select("checksum", "content", content_prefix(F.col("checksum")).alias("prefix")))
    return {"staged": _after_stored(staged, staging), "contents": new_contents}


def _mutation_requests(requests: DataFrame, extra: list[Param]) -> DataFrame:
    r = validate(bind(requests, [Param("repository"), Param("branch"), Param("path")] + extra),
                 [rule_required("repository"), rule_required("branch"), rule_required("path")])
    return r.withColumn("ref", F.col("branch"))


def delete_objects(requests: DataFrame, refs, commits, entries, staging) -> DataFrame:
    """Stage deletes; a path not visible on the branch → ``path_not_found``
    (and only the first request per path deletes it)."""
    r = _mutation_requests(requests, [])
    r = lookup_paths(r, refs, commits, entries, staging)
    can = F.col("error_code").isNull() & (F.col("ref_kind") == "branch") & F.col("checksum").isNotNull()
    first = r.where(can).groupBy(*PKEY).agg(F.min("seq").alias("_first"))
    r = r.join(first, PKEY, "left")
    outcome = O.first_match(
        (F.col("error_code").isNotNull(), O.INVALID),
        (F.col("ref_kind").isNull() | (F.col("ref_kind") != "branch"), O.BRANCH_NOT_FOUND),
        (~can | (F.col("_first") != F.col("seq")), O.PATH_NOT_FOUND),
        default=O.DELETED)
    return r.withColumn("outcome", outcome).withColumn("ok", O.ok_col()).drop("_first", "ref")


def copy_objects(requests: DataFrame, refs, commits, entries, staging) -> DataFrame:
    """Stage a put at ``dest_path`` with the source entry's address (no bytes move)."""
    r = _mutation_requests(requests, [Param("dest_path")])
    r = validate(r, [rule_required("dest_path")], out="_dest_error")
    r = r.withColumn("error_code", F.coalesce("error_code", "_dest_error")).drop("_dest_error")
    r = lookup_paths(r, refs, commits, entries, staging)
    outcome = O.first_match(
        (F.col("error_code").isNotNull(), O.INVALID),
        (F.col("ref_kind").isNull() | (F.col("ref_kind") != "branch"), O.BRANCH_NOT_FOUND),
        (F.col("checksum").isNull(), O.PATH_NOT_FOUND),
        default=O.COPIED)
    return r.withColumn("outcome", outcome).withColumn("ok", O.ok_col()).drop("ref")


def mutation_deltas(outcomes: DataFrame, staging: DataFrame | None = None) -> DataFrame:
    """Staging rows (after those of ``staging``) of ``delete_objects`` / ``copy_objects`` outcomes: a
    'delete' per deleted path, a 'put' at ``dest_path`` with the source's
    address (no bytes move) per copy."""
    deleted = outcomes.where(F.col("outcome") == O.DELETED).select(
        "repository", "branch", "path", F.lit("delete").alias("op"),
        F.lit(None).cast("string").alias("physical_address"), F.lit(None).cast("string").alias("checksum"),
        F.lit(None).cast("long").alias("size_bytes"), "seq")
    if "dest_path" not in outcomes.columns:
        return _after_stored(deleted, staging)
    copied = outcomes.where(F.col("outcome") == O.COPIED).select(
        "repository", "branch", F.col("dest_path").alias("path"), F.lit("put").alias("op"),
        "physical_address", "checksum", "size_bytes", "seq")
    return _after_stored(deleted.unionByName(copied), staging)


def reset_branch(staging: DataFrame, requests: DataFrame) -> DataFrame:
    """Drop staged changes of (repository, branch) requests, all or under an
    optional ``prefix``; returns the staging rows that remain."""
    req = requests.select("repository", "branch",
                          F.coalesce(F.col("prefix"), F.lit("")).alias("_prefix")
                          if "prefix" in requests.columns else F.lit("").alias("_prefix"))
    req = small_side(req).alias("q")
    return staging.alias("s").join(
        req, (F.col("s.repository") == F.col("q.repository")) & (F.col("s.branch") == F.col("q.branch"))
        & F.col("s.path").startswith(F.col("q._prefix")), "left_anti")


def reset_branches(requests: DataFrame, refs: DataFrame, staging: DataFrame) -> DataFrame:
    """Drop staged changes of a branch, all or under ``prefix`` (default: all): one
    outcome row per request, invalid → branch_not_found → nothing_to_reset →
    reset, with ``n_dropped``, the staged operations that it drops (each request
    sees the staging before the batch).  ``reset_branch`` gives the staging left."""
    r = validate(bind(requests, [Param("repository"), Param("branch"), Param("prefix", default="")]),
                 [rule_required("repository"), rule_required("branch")])
    r = r.join(refs.select("repository", "branch", F.lit(True).alias("_head")), ["repository", "branch"], "left")
    probes = r.where(F.col("error_code").isNull() & F.col("_head")).select("seq", "repository", "branch", "prefix")
    items = staging.select("repository", "branch", F.col("path").alias("key"))
    r = r.join(prefix_counts(items, probes, ["repository", "branch"], "n_dropped"), "seq", "left")
    outcome = O.first_match((F.col("error_code").isNotNull(), O.INVALID), (F.col("_head").isNull(), O.BRANCH_NOT_FOUND),
                            (F.col("n_dropped") == 0, O.NOTHING_TO_RESET), default=O.RESET)
    return r.withColumn("outcome", outcome).withColumn("ok", O.ok_col()).drop("_head")


LIST_PARAMS = [Param("repository"), Param("ref"), Param("prefix", default=""), Param("delimiter", default=""),
               Param("after", default=""), Param("amount", "int", 1000)]


def list_objects_at(requests: DataFrame, refs: DataFrame, commits: DataFrame, entries: DataFrame, staging: DataFrame) -> DataFrame:
    """One page of a listing per request: the entries of ``ref`` (a branch with its
    staged changes, or a commit) under ``prefix`` and after ``after``, in order, the
    first ``amount``; with a ``delimiter`` deeper paths are one entry, ``kind`` 'prefix',
    with counts.  invalid → ref_not_found → fetched; a request whose page is empty has
    one row without entry.  ``next_after`` is the cursor of the next page, if any.

    A prefix is a directory (up to its last delimiter) and the rest, a stem.  Each
    listing's paths become entries of the requested directories once, however many refs
    show it; entries and requests are sorted in one pass (``functions.paging``).  What a
    branch has staged changes only the entries that it touches there, so a request
    costs its page, not its listing (refs that several rows of ``refs`` lead to
    different listings are listed on their own)."""
    r = validate(bind(requests, LIST_PARAMS), [rule_required("repository"), rule_required("ref"), rule_positive("amount")])
    r = resolve_refs(r, refs, commits, ref="ref", out="ref_commit", kind="ref_kind")
    r = r.withColumn("dir", F.when(F.col("delimiter") == "", F.lit("")).otherwise(F.expr(
        "left(prefix, length(prefix) - length(substring_index(prefix, delimiter, -1)))"))).checkpoint(eager=True)
    valid = F.col("error_code").isNull() & F.col("ref_commit").isNotNull()
    at, inner = ["repository", "ref"], ["delimiter", "dir"]
    asked = r.where(valid).select(*at, "ref_kind", "ref_commit").distinct()
    branches = asked.where("ref_kind = 'branch'").select("repository", F.col("ref").alias("branch")).distinct()
    layers = L.branch_layers(branches, refs, commits, entries, staging)
    fixed = L.head_range(asked.where("ref_kind = 'commit'").select(*at, "ref_commit").distinct(), commits, "ref_commit")
    named = (layers.heads.withColumnRenamed("branch", "ref").unionByName(
        fixed.groupBy(*at, "meta_range_id").agg(F.count(F.lit(1)).alias("copies"))).where("meta_range_id IS NOT NULL"))
    lists = named.groupBy(*at).agg(F.count(F.lit(1)).alias("_lists"))
    named = named.join(lists, at).checkpoint(eager=True)
    plain, odd = named.where("_lists = 1").drop("_lists"), named.where("_lists > 1").drop("_lists")
    listed = (entries.join(small_side(named.select(*L.RANGE).distinct()), L.RANGE, "left_semi").select(*L.RANGE, "path", "size_bytes"))
    want = r.where(valid).select(*at, *inner).distinct().join(plain, at, "left").checkpoint(eager=True)
    sums = lambda n, size: [F.sum(n).alias("n"), F.sum(n * F.col(size)).alias("bytes"),
                            F.sum(F.when(F.col(size).isNotNull(), n).otherwise(0)).alias("sized")]
    base = (_placed(listed, want.where("meta_range_id IS NOT NULL").select(*L.RANGE, *inner), L.RANGE)
            .groupBy(*L.RANGE, *inner, "key").agg(F.max("kind").alias("kind"), *sums(F.lit(1).cast("long"), "size_bytes"))
            .checkpoint(eager=True))
    # what branches have staged, as paths that are added or taken away
    staged = layers.staged.withColumnRenamed("branch", "ref").select(*at, "path", "op", "size_bytes")
    moved = named.drop("_lists").join(staged.select(*at).distinct(), at, "left_semi")
    hidden = (staged.select(*at, "path").join(small_side(moved), at).join(listed, [*L.RANGE, "path"])
              .select(*at, "path", "size_bytes", (-F.col("copies")).alias("_n")))
    added = staged.where("op = 'put'").select(*at, "path", "size_bytes", F.lit(1).cast("long").alias("_n")).unionByName(
        small_side(odd).join(listed, L.RANGE).select(*at, "path", "size_bytes", F.col("copies").alias("_n")))
    over = hidden.unionByName(added).checkpoint(eager=True)
    there = want.join(over.select(*at).distinct(), at, "left_semi").checkpoint(eager=True)
    change = _placed(over, there.select(*at, *inner), at).groupBy(*at, *inner, "key").agg(F.max("kind").alias("kind"), *sums(F.col("_n"), "size_bytes"))
    old = base.select(*L.RANGE, *inner, "key", *[F.col(c).alias(f"_{c}") for c in ("n", "bytes", "sized")])
    total = lambda c: (F.coalesce(c, F.lit(0)) + F.coalesce(F.col(f"_{c}") * F.col("copies"), F.lit(0))).alias(c)
    touched = (change.join(there, [*at, *inner]).join(old, [*L.RANGE, *inner, "key"], "left")
               .select(*at, *L.RANGE[1:], *inner, "key", "kind", *map(total, ("n", "bytes", "sized")), F.col("_n").isNotNull().alias("listed"))
               .checkpoint(eager=True))
    probes = r.where(valid).select("seq", *at, *inner, "prefix", "after", "amount").dropDuplicates(["seq"]).join(
        small_side(want), [*at, *inner])
    changed = touched.select(*at, *inner).distinct()
    group, own = [*L.RANGE, *inner], [*at, *inner]
    page = pages(base.select(*group, "key"), probes.join(changed, own, "left_anti"), group)
    if not touched.isEmpty():
        page = page.unionByName(overlaid_pages(
            base.select(*group, "key"), probes.join(changed, own, "left_semi"), group, own,
            touched.where("listed").select(*own, "meta_range_id", "key"), touched.where("n > 0").select(*own, "key")))
    # a seq that several requests have gives rows to each of them
    asks = (r.where(valid).select("seq", *own, F.count(F.lit(1)).over(Window.partitionBy("seq")).alias("_c"))
            .withColumn("_c", F.explode(F.sequence(F.lit(1).cast("long"), "_c"))).drop("_c").join(small_side(want), own))
    now = touched.where("n > 0").select(*own, "key", F.col("kind").alias("_kind"), F.struct("n", "bytes", "sized").alias("_now"))
    was = base.select(*group, "key", "kind", F.struct("n", "bytes", "sized").alias("_was"))
    entry = page.join(asks, "seq").join(was, [*group, "key"], "left").join(now, [*own, "key"], "left")
    count = lambda c: F.coalesce(F.col(f"_now.{c}"), F.col(f"_was.{c}") * F.col("copies"))
    page = entry.select("seq", F.col("key").alias("entry"), F.coalesce("_kind", "kind").alias("kind"), count("n").cast("long").alias("n_objects"),
                        F.when(count("sized") > 0, count("bytes")).cast("long").alias("total_bytes"), "position", "has_more", "next_after")
    outcome = O.first_match((F.col("error_code").isNotNull(), O.INVALID), (F.col("ref_commit").isNull(), O.REF_NOT_FOUND), default=O.FETCHED)
    return (r.select("seq", "repository", "ref", "prefix", outcome.alias("outcome")).withColumn("ok", O.ok_col())
            .join(page, "seq", "left").withColumn("has_more", F.coalesce("has_more", F.lit(False))))


def _placed(rows: DataFrame, asked: DataFrame, at: list[str]) -> DataFrame:
    """Rows (``at``, path) in each directory of ``asked`` (``at``, delimiter, dir) that
    they lie in, with the ``key`` and ``kind`` of their entry there."""
    cuts = rows.join(small_side(asked.select(*at, "delimiter").distinct()), at)
    dirs = F.when(F.col("delimiter") == "", F.array(F.lit(""))).otherwise(F.expr(
        "transform(sequence(0, size(split(path, '\\\\Q' || delimiter || '\\\\E')) - 1), "
        "n -> IF(n = 0, '', substring_index(path, delimiter, n) || delimiter))"))
    inside = cuts.withColumn("dir", F.explode(dirs)).join(small_side(asked.distinct()), [*at, "delimiter", "dir"], "left_semi")
    deep = F.expr("delimiter <> '' AND instr(substring(path, length(dir) + 1), delimiter) > 0")
    below = F.expr("substring_index(substring(path, length(dir) + 1), delimiter, 1)")
    return inside.withColumns({"key": F.when(deep, F.concat("dir", below, "delimiter")).otherwise(F.col("path")),
                               "kind": F.when(deep, F.lit("prefix")).otherwise(F.lit("object"))})


def list_objects(view: DataFrame | L.Layers, prefix: str = "", delimiter: str | None = "/",
                 after: str = "", amount: int | None = None) -> DataFrame:
    """Entries under ``prefix``; with a delimiter, deeper paths collapse into
    common prefixes ``kind = 'prefix'`` with counts.  ``after`` is the last entry
    of the page before (entries up to it are left out whole, so paging
    advances); ``amount`` limits the entries per listing, in order.  The layers of a
    view of many branches (``listing.branch_layers``) are counted listing by listing."""
    rest = F.substring(F.col("path"), len(prefix) + 1, 1 << 30)
    if delimiter:
        pos = F.instr(rest, delimiter)
        entry = F.when(pos > 0, F.concat(F.lit(prefix), F.substring(rest, 1, pos - 1), F.lit(delimiter))) \
                 .otherwise(F.col("path"))
        kind = F.when(pos > 0, F.lit("prefix")).otherwise(F.lit("object"))
    else:
        entry, kind = F.col("path"), F.lit("object")
    keep = F.col("path").startswith(prefix) & (F.col("path") > after) & (entry > after)
    keys = [c for c in ("repository", "branch") if isinstance(view, L.Layers) or c in view.columns]
    if isinstance(view, L.Layers):
        out = L.view_totals(view, keep, entry=entry, kind=kind).withColumnRenamed("n", "n_objects")
    else:
        out = (view.where(keep).select(*keys, entry.alias("entry"), kind.alias("kind"), "size_bytes")
               .groupBy(*keys, "entry", "kind")
               .agg(F.count(F.lit(1)).cast("long").alias("n_objects"),
                    F.sum("size_bytes").cast("long").alias("total_bytes")))
    if amount is None:
        return out
    return (row_number_within(out, keys, ["entry"], "_at") if keys else out.orderBy("entry").limit(amount).withColumn("_at", F.lit(1))) \
        .where(F.col("_at") <= amount).drop("_at")


def _dir_of(path: Column) -> Column:
    """Directory of a path; the root directory is the empty text."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def symlink_manifest(view: DataFrame | L.Layers) -> DataFrame:
    """Dry run of ``write_symlinks``: per directory, file count and bytes."""
    folder = _dir_of(F.col("path"))
    if isinstance(view, L.Layers):
        return L.view_totals(view, F.lit(True), dir=folder).withColumnRenamed("n", "n_files")
    keys = [c for c in ("repository", "branch") if c in view.columns]
    return (view.select(*keys, folder.alias("dir"), "size_bytes")
                .groupBy(*keys, "dir")
                .agg(F.count(F.lit(1)).cast("long").alias("n_files"),
                     F.sum("size_bytes").cast("long").alias("total_bytes")))


def _folder(name: str, value: Column) -> Column:
    """The folder that Spark writes a partition value to: what a path cannot
    hold is escaped."""
    odd = r"""["#%'*/:=?\\{\[\]^\x01-\x1f\x7f]"""
    char = lambda c: F.when(c.rlike(odd), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c)
    return F.concat(F.lit(f"{name}="), F.array_join(F.transform(F.split(value, ""), char), ""))


def write_symlinks(view: DataFrame, location: str, num_partitions: int | None = None) -> str:
    """One output directory per repository, branch and listing directory
    (``dir=<escaped>``; the view's own columns) whose
    text files list physical addresses ordered by path.

    Range partitioning on (dir, path) splits a huge directory over several
    tasks (each writes its own, internally sorted file), so one hot
    directory never lands in one task; no global sort."""
    n = num_partitions or int(view.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    addr = [F.col(c) for c in ("physical_address", "checksum") if c in view.columns]
    keys = [*[c for c in ("repository", "branch") if c in view.columns], "dir"]
    rows = view.withColumn("dir", _dir_of(F.col("path"))).select(*keys, "path", F.coalesce(*addr).alias("value"))
    (rows.repartitionByRange(n, *keys, "path").sortWithinPartitions(*keys, "path")
         .select(*keys, "value").write.mode("overwrite").partitionBy(*keys).text(location))
    return location


def _publish(folders: DataFrame, staged: str, location: str) -> None:
    """Replaces each folder (one row, column ``folder``) under ``location`` by the
    one under ``staged``, or removes it if there is none: renames only, one
    after another, as Spark's own commit of a job moves its partitions."""
    spark = folders.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(location).getFileSystem(spark._jsc.hadoopConfiguration())
    for row in folders.toLocalIterator():
        new, old = path(f"{staged}/{row.folder}"), path(f"{location}/{row.folder}")
        fs.delete(old, True)
        if fs.exists(new):
            fs.mkdirs(old.getParent())
            if not fs.rename(new, old):
                raise OSError(f"cannot move {new} to {old}")


def create_symlinks(requests: DataFrame, refs: DataFrame, commits: DataFrame, entries: DataFrame, staging: DataFrame,
                    location: str) -> DataFrame:
    """Symlink files of the requested branches under ``location``; one outcome
    row per request: invalid → branch_not_found → created, with the ``location``
    of its branch's files.

    All files are written by one job to a folder beside, then each requested
    branch's files replace those that it had before (directories that the branch
    no longer has go); the files of other branches stay as they are."""
    r = validate(bind(requests, [Param("repository"), Param("branch")]), [rule_required("repository"), rule_required("branch")])
    heads = refs.select("repository", "branch", F.lit(True).alias("_head"))
    r = r.join(heads, ["repository", "branch"], "left").checkpoint(eager=True)
    outcome = O.first_match((F.col("error_code").isNotNull(), O.INVALID),
                            (F.col("_head").isNull(), O.BRANCH_NOT_FOUND), default=O.CREATED)
    r = r.withColumn("outcome", outcome).withColumn("ok", O.ok_col())
    wanted = r.where("ok").select("repository", "branch").distinct()
    folder = F.concat(_folder("repository", F.col("repository")), F.lit("/"), _folder("branch", F.col("branch")))
    location = location.rstrip("/")
    staged = f"{location}/_staged-{uuid.uuid4().hex}"  # no reader looks into folders that begin so
    write_symlinks(L.branch_view(wanted, refs, commits, entries, staging), staged)
    _publish(wanted.select(folder.alias("folder")), staged, location)
    _removed(r.sparkSession, staged)
    return r.withColumn("location", F.when(F.col("ok"), F.concat(F.lit(location + "/"), folder))).drop("_head")


def _removed(spark, folder: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def read_at_ref(view: DataFrame, prefix: str, address_to_path=None, fmt: str = "parquet",
                schema=None, contents: DataFrame | None = None, keep: tuple[str, ...] = (), **options) -> DataFrame:
    """Table form of A13: read the data files a ref shows under ``prefix``
    (e.g. the parquet files of one table) as one DataFrame.

    ``view`` is a ``branch_view`` / listing of the ref, which may show a file at
    several paths: it is read once, or with ``keep`` (columns of the view that lead
    each row) once for each of their values.  With a ``schema`` the paths stay
    in the cluster and tasks read the files, from ``contents`` if given
    (``sources.files.read_paths``; formats: parquet, csv, json, text).  Without one
    it is taken from one file by Spark's reader; a ref without files then gives an
    empty table of one column.  ``address_to_path`` maps a physical address to a
    storage path (identity by default)."""
    spark = view.sparkSession
    addr = [F.col(c) for c in ("physical_address", "checksum") if c in view.columns]
    files = view.where(F.col("path").startswith(prefix)).select(*keep, F.coalesce(*addr).alias("address")).distinct()
    if schema is None:
        some = files.select("address").limit(1).collect()
        if not some:
            return spark.createDataFrame([], "value string")
        one = (address_to_path or (lambda a: a))(some[0].address)
        schema = spark.read.format(fmt).options(**options).load(one).schema
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return read_paths(files, schema, fmt, contents=contents, keep=keep, to_path=address_to_path, **options)
