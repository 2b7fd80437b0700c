"""Listings: committed listing of a ref, branch view, diffs, three-way, identity.

A listing is the set of ``entries`` rows of one ``meta_range_id``.  Many
requests share few listings, so operators first reduce requests to the
distinct listing ids (or id pairs / triples) they touch, do the path-level
work once per distinct id, and join the small per-id results back.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import hashing as H
from strata.functions import outcomes as O
from strata.functions.joins import rows_among, small_side
from strata.functions.params import Param, bind, rule_required, validate
from strata.operators.refs import resolve_refs

PATH_KEY = ["repository", "path"]

# Fixed three-way classes.
UNCHANGED = "unchanged"
SAME_CHANGE = "same_change"
TAKE_SOURCE = "take_source"
KEEP_DEST = "keep_dest"
CONFLICT = "conflict"
CLASSES = (UNCHANGED, SAME_CHANGE, TAKE_SOURCE, KEEP_DEST, CONFLICT)


def last_staged(staging: DataFrame, branches: DataFrame | None = None) -> DataFrame:
    """Last staged op per (repository, branch, path) by ``seq``, of the given
    ``branches`` (repository, branch) or all: other branches' rows are left
    out before any row moves (of many branches, only those that have staged rows
    are sent to the tasks).

    ``max_by`` merges map-side, so a path (or branch) with very many ops
    does not pile up in one task.  A physical address that is the checksum is
    not moved beside it."""
    if branches is not None:
        staging = staging.join(_staged_among(branches, staging), ["repository", "branch"], "left_semi")
    address = F.col("physical_address")
    v = F.struct("op", "checksum", "size_bytes", F.when(~address.eqNullSafe(F.col("checksum")), address).alias("physical_address"))
    return (staging.groupBy("repository", "branch", "path")
                   .agg(F.max_by(v, F.col("seq")).alias("_l"))
                   .select("repository", "branch", "path", "_l.op", "_l.checksum", "_l.size_bytes",
                           F.coalesce("_l.physical_address", "_l.checksum").alias("physical_address")))


def _staged_among(branches: DataFrame, staging: DataFrame, *cols: str) -> DataFrame:
    """The (repository, branch, ``cols``) rows of ``branches``, sent to all tasks if few;
    if many, those whose branch has staged rows, which are often few."""
    rows = branches.select("repository", "branch", *cols).distinct()
    few = small_side(rows)
    if few is not rows:
        return few
    return small_side(rows.join(staging.select("repository", "branch").distinct(), ["repository", "branch"], "left_semi").checkpoint(eager=True))


def head_range(df: DataFrame, commits: DataFrame, commit_col: str, out: str = "meta_range_id",
               generation_out: str | None = None) -> DataFrame:
    """Attach the meta_range_id (and generation) of the commit in ``commit_col``."""
    cols = [F.col("repository").alias("_hr_repo"), F.col("commit_id").alias("_hr_commit"),
            F.col("meta_range_id").alias(out)]
    if generation_out:
        cols.append(F.col("generation").alias(generation_out))
    c = commits.select(*cols)
    return (df.join(c, (df["repository"] == c["_hr_repo"]) & (df[commit_col] == c["_hr_commit"]), "left")
              .drop("_hr_repo", "_hr_commit"))


def commits_among(commits: DataFrame, df: DataFrame, *commit_cols: str) -> DataFrame:
    """The rows of ``commits`` that ``df`` names in ``commit_cols``, found once for all
    of them (``rows_among``)."""
    names = df.select("repository", F.explode(F.array(*commit_cols)).alias("commit_id"))
    return rows_among(commits.select("repository", "commit_id", "meta_range_id", "generation"), names)


def listing_rows(keys: DataFrame, entries: DataFrame, range_col: str = "meta_range_id") -> DataFrame:
    """Entries of the listings named by ``keys`` (one copy per key row).

    Few listings hold many entries, so ``keys`` is broadcast after a size
    check instead of shuffling ``entries`` by listing id."""
    keys = small_side(keys)
    e = entries.select(F.col("repository").alias("_l_repo"), F.col("meta_range_id").alias("_l_mr"),
                       "path", "checksum", "size_bytes",
                       F.coalesce(F.col("physical_address"), F.col("checksum")).alias("physical_address")
                       if "physical_address" in entries.columns else F.col("checksum").alias("physical_address"))
    return (keys.join(e, (keys["repository"] == e["_l_repo"]) & (keys[range_col] == e["_l_mr"]))
                .drop("_l_repo", "_l_mr"))


class Layers(NamedTuple):
    """A branch view that is not expanded: ``heads`` (repository, branch,
    meta_range_id, copies: how many rows of ``refs`` name them), the ``entries`` of
    their listings and the last staged ops of the branches, ``staged``."""
    heads: DataFrame
    entries: DataFrame
    staged: DataFrame


BRANCH = ["repository", "branch"]
RANGE = ["repository", "meta_range_id"]


def branch_layers(branches: DataFrame, refs: DataFrame, commits: DataFrame, entries: DataFrame, staging: DataFrame) -> Layers:
    """The layers of ``branch_view``: what its rows are made of, each listing once."""
    heads = branches.select(*BRANCH).distinct().join(refs.select(*BRANCH, "commit_id"), BRANCH)
    heads = (head_range(heads, commits, "commit_id").groupBy(*BRANCH, "meta_range_id").agg(F.count(F.lit(1)).alias("copies")))
    heads = heads.checkpoint(eager=True)
    # only branches that exist: a deleted branch shows nothing, staged or not
    staged = last_staged(staging, heads)
    address = F.col("physical_address") if "physical_address" in entries.columns else F.col("checksum")
    listed = (entries.join(small_side(heads.select(*RANGE).distinct()), RANGE, "left_semi")
              .select(*RANGE, "path", "checksum", "size_bytes", F.coalesce(address, F.col("checksum")).alias("physical_address")))
    return Layers(heads, listed, staged)


def branch_view(branches: DataFrame, refs: DataFrame, commits: DataFrame, entries: DataFrame,
                staging: DataFrame) -> DataFrame:
    """What a branch shows: its head listing overlaid with its last staged ops.

    ``branches`` has (repository, branch).  Deleted paths disappear, staged
    puts replace or add entries.  ``origin`` tells committed from staged.  A view of
    every branch has branches x paths rows; totals of it come from its layers
    (``view_totals``).  Rows are expanded to branches last, in the tasks that hold the
    listings: what is moved grows with listings and staged ops, not with that view."""
    heads, listed, staged = branch_layers(branches, refs, commits, entries, staging)
    heads = heads.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "_copy")
    touched = small_side(staged.select(*BRANCH).distinct())
    cols = [*BRANCH, "path", "checksum", "size_bytes", "physical_address"]
    committed = lambda some, rows: small_side(some).join(rows, RANGE)
    origin = F.lit("committed").alias("origin")
    # a listing's rows meet the staged ops of their path once, before they are expanded
    own = heads.join(touched, BRANCH, "left_semi")
    over = staged.groupBy(*PATH_KEY).agg(F.collect_set("branch").alias("_staged_on"))
    marked = listed.join(small_side(own.select(*RANGE).distinct()), RANGE, "left_semi").join(over, PATH_KEY, "left")
    hides = F.coalesce(F.array_contains("_staged_on", F.col("branch")), F.lit(False))
    kept = committed(own, marked).where(~hides).select(*cols, origin)
    puts = staged.where(F.col("op") == "put").select(*cols, F.lit("staged").alias("origin"))
    return committed(heads.join(touched, BRANCH, "left_anti"), listed).select(*cols, origin).unionByName(kept).unionByName(puts)


def view_totals(view: Layers, keep: Column, **groups: Column) -> DataFrame:
    """repository, branch, ``groups`` (of the path), n, total_bytes: the rows of
    the branch view where ``keep``, counted without expanding them.

    Each listing is counted once; a branch then has its listing's counts, less the
    entries under its staged paths, plus its puts."""
    sizes = [F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("bytes"), F.count("size_bytes").alias("sized")]
    named = [c.alias(k) for k, c in groups.items()]
    listed = view.entries.where(keep).select(*RANGE, *named, "size_bytes").groupBy(*RANGE, *groups).agg(*sizes)
    base = view.heads.join(listed, RANGE).select(*BRANCH, *groups, *[(F.col(c) * F.col("copies")).alias(c) for c in ("n", "bytes", "sized")])
    staged = view.staged.where(keep).select(*BRANCH, "path", *named, "op", "size_bytes")
    one = lambda sign: [sign.alias("n"), (sign * F.col("size_bytes")).alias("bytes"),
                        F.when(F.col("size_bytes").isNotNull(), sign).otherwise(0).alias("sized")]
    heads = view.heads
    if small_side(heads) is heads:  # of many branches, those with staged ops
        heads = heads.join(view.staged.select(*BRANCH).distinct(), BRANCH, "left_semi").checkpoint(eager=True)
    hidden = (staged.drop("op", "size_bytes").join(small_side(heads), BRANCH)
              .join(view.entries.where(keep).select(*RANGE, "path", "size_bytes"), [*RANGE, "path"]).select(*BRANCH, *groups, *one(-F.col("copies"))))
    puts = staged.where("op = 'put'").select(*BRANCH, *groups, *one(F.lit(1).cast("long")))
    # counted per kind of row first: the few sums of listings never meet the many staged rows
    change = hidden.unionByName(puts).groupBy(*BRANCH, *groups).agg(*[F.sum(c).alias(c) for c in ("n", "bytes", "sized")])
    total = base.unionByName(change).groupBy(*BRANCH, *groups).agg(*[F.sum(c).alias(c) for c in ("n", "bytes", "sized")])
    return total.where("n > 0").select(*BRANCH, *groups, F.col("n").cast("long").alias("n"),
                                       F.when(F.col("sized") > 0, F.col("bytes")).cast("long").alias("total_bytes"))


def staged_changes(last: DataFrame, base: DataFrame, key: Sequence[str]) -> DataFrame:
    """Effective changes of last staged ops against a base listing.

    ``last`` = last_staged rows with ``key`` columns; ``base`` = listing rows
    with the same ``key`` columns.  A put of the same checksum or a delete of
    an absent path is no change.  Returns one row per changed path with the
    base and new checksum (null = absent)."""
    b = base.select(*key, "path", F.col("checksum").alias("old_checksum"),
                    F.col("size_bytes").alias("old_size"))
    return _effective(last.join(b, [*key, "path"], "left"), key)


def _effective(j: DataFrame, key: Sequence[str]) -> DataFrame:
    """Staged ops beside the entry that they meet: those that change it."""
    new_ck = F.when(F.col("op") == "put", F.col("checksum"))
    changed = ~new_ck.eqNullSafe(F.col("old_checksum"))
    return (j.where(changed)
             .select(*key, "path", "old_checksum", "old_size",
                     new_ck.alias("new_checksum"),
                     F.when(F.col("op") == "put", F.col("size_bytes")).alias("new_size"),
                     F.when(F.col("op") == "put", F.col("physical_address")).alias("new_address"),
                     F.when(F.col("old_checksum").isNull(), F.lit("added"))
                      .when(new_ck.isNull(), F.lit("removed")).otherwise(F.lit("changed")).alias("change")))


def last_checksums(staging: DataFrame, branches: DataFrame) -> DataFrame:
    """Like ``last_staged``, but of the last op only the checksum that it leaves at its
    path (null = absent), packed."""
    staging = staging.join(_staged_among(branches, staging), BRANCH, "left_semi")
    v = F.struct(*H.packed(F.when(F.col("op") == "put", F.col("checksum"))))
    return staging.groupBy(*BRANCH, "path").agg(F.max_by(v, F.col("seq")).alias("_l")).select(*BRANCH, "path", "_l.hex_bytes", "_l.other")


def changes_at(last: DataFrame, probe: DataFrame, on: Sequence[str]) -> DataFrame:
    """Like ``staged_changes`` but the base is looked up per staged path, and checksums
    move packed: ``last`` is of ``last_checksums``, ``probe`` has the ``on`` key columns and
    ``checksum``.  Adds old_checksum and new_checksum."""
    j = last.join(probe.select(*on, F.struct(*H.packed("checksum")).alias("_old")), list(on), "left")
    j = j.withColumns({"old_checksum": H.unpacked(F.col("_old.hex_bytes"), F.col("_old.other")),
                       "new_checksum": H.unpacked(F.col("hex_bytes"), F.col("other"))})
    return j.where(~F.col("new_checksum").eqNullSafe(F.col("old_checksum"))).drop("_old", "hex_bytes", "other")


def change_lanes(old_path: Column, old_ck: Column, new_ck: Column) -> list[Column]:
    """Lane delta of replacing ``old_ck`` by ``new_ck`` at a path (nulls = absent)."""
    out = []
    for i in range(len(H.LANE_SLICES)):
        add = F.when(new_ck.isNotNull(), H.lane(H.entry_key(old_path, new_ck), i)).otherwise(F.lit(0).cast(H.DEC))
        sub = F.when(old_ck.isNotNull(), H.lane(H.entry_key(old_path, old_ck), i)).otherwise(F.lit(0).cast(H.DEC))
        out.append((add - sub).cast(H.DEC))
    out.append((F.when(new_ck.isNotNull(), 1).otherwise(0) - F.when(old_ck.isNotNull(), 1).otherwise(0)).cast("long"))
    return out


def listing_stats(entries: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Per (repository, meta_range_id): entry count, bytes and lane sums.

    With ``ranges`` only those listings are read (semi join).  One
    partial+final aggregate: listings never gather in one task."""
    e = entries
    if ranges is not None:
        e = e.join(small_side(ranges.select("repository", "meta_range_id").distinct()),
                   ["repository", "meta_range_id"], "left_semi")
    ls = H.lanes(F.col("path"), F.col("checksum"))
    return (e.groupBy("repository", "meta_range_id")
             .agg(F.count(F.lit(1)).cast("long").alias("n_entries"),
                  F.sum("size_bytes").cast("long").alias("total_bytes"),
                  *[F.sum(l).alias(f"lane{i}") for i, l in enumerate(ls)]))


def stats_for(entries: DataFrame, ranges: DataFrame, listings: DataFrame | None = None) -> DataFrame:
    """Stats of the listings in ``ranges``: from the stored ``listings`` table
    where it has them, else aggregated from ``entries`` (a listing that was
    stored without its row in ``listings`` is never taken for an empty one)."""
    if listings is None:
        return listing_stats(entries, ranges)
    key = ["repository", "meta_range_id"]
    wanted = ranges.select(*key).distinct()
    cols = [*key, "n_entries", "total_bytes", "lane0", "lane1"]
    known = listings.join(small_side(wanted), key, "left_semi").select(*cols)
    missing = wanted.join(listings.select(*key), key, "left_anti").checkpoint(eager=True)
    if missing.isEmpty():
        return known
    return known.unionByName(listing_stats(entries, missing).select(*cols))


def listing_identity(stats: DataFrame) -> DataFrame:
    return stats.withColumn("listing_id", H.listing_id(F.col("lane0"), F.col("lane1"), F.col("n_entries")))


def diff_ranges(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """Path-level diff for distinct (repository, range_a, range_b) pairs.

    An entry moves once, to its path, however many pairs read its listing; each path is
    then compared for the pairs of its repository in place.  Of very many pairs, the two
    sides are united with a tag and grouped by pair and path."""
    p = pairs.select("repository", "range_a", "range_b").distinct()
    few = small_side(p)
    if few is not p:
        g = _at_paths(p, entries, "range_a", "range_b").join(few, "repository")
        g = g.where(F.exists("_at", lambda x: x["meta_range_id"].isin(F.col("range_a"), F.col("range_b"))))
        return _differing(g.select("repository", "range_a", "range_b", "path", _checksum_in("range_a").alias("ck_a"),
                                   _checksum_in("range_b").alias("ck_b")))
    a = listing_rows(p, entries, "range_a").select("repository", "range_a", "range_b", "path",
                                                   F.col("checksum").alias("ck_a"),
                                                   F.lit(None).cast("string").alias("ck_b"))
    b = listing_rows(p, entries, "range_b").select("repository", "range_a", "range_b", "path",
                                                   F.lit(None).cast("string").alias("ck_a"),
                                                   F.col("checksum").alias("ck_b"))
    return _differing(a.unionByName(b).groupBy("repository", "range_a", "range_b", "path")
                      .agg(F.max("ck_a").alias("ck_a"), F.max("ck_b").alias("ck_b")))


def _at_paths(groups: DataFrame, entries: DataFrame, *range_cols: str) -> DataFrame:
    """repository, path, ``_at``: the entries of the listings that ``groups`` names, moved
    once to their path."""
    ranges = groups.select("repository", F.explode(F.array(*range_cols)).alias("meta_range_id")).distinct()
    return (entries.join(small_side(ranges), RANGE, "left_semi")
            .groupBy(*PATH_KEY).agg(F.collect_list(F.struct("meta_range_id", *H.packed("checksum"))).alias("_at")))


def _checksum_in(range_col: str) -> Column:
    own = F.filter("_at", lambda x: x["meta_range_id"] == F.col(range_col))
    return F.array_max(F.transform(own, lambda x: H.unpacked(x["hex_bytes"], x["other"])))


def _differing(g: DataFrame) -> DataFrame:
    change = (F.when(F.col("ck_a").isNull(), F.lit("added"))
               .when(F.col("ck_b").isNull(), F.lit("removed"))
               .when(F.col("ck_a") != F.col("ck_b"), F.lit("changed")))
    return g.withColumn("change", change).where(F.col("change").isNotNull())


def _counted(requests: DataFrame, changes: DataFrame, on: Sequence[str], missing: tuple[Column, str]) -> DataFrame:
    """One outcome row per request: invalid → not found → fetched, with the
    changes counted by kind (null where there is no answer)."""
    kinds = ("added", "removed", "changed")
    counts = changes.groupBy(*on).agg(*[F.count(F.when(F.col("change") == k, 1)).cast("long").alias(f"n_{k}") for k in kinds])
    out = requests.join(counts, list(on), "left")
    found = F.col("error_code").isNull() & ~missing[0]
    out = out.withColumns({f"n_{k}": F.when(found, F.coalesce(F.col(f"n_{k}"), F.lit(0).cast("long"))) for k in kinds})
    outcome = O.first_match((F.col("error_code").isNotNull(), O.INVALID), missing, default=O.FETCHED)
    return out.withColumn("outcome", outcome).withColumn("ok", O.ok_col())


def diff_refs(requests: DataFrame, refs: DataFrame, commits: DataFrame, entries: DataFrame) -> DataFrame:
    """Changes from ``left_ref`` to ``right_ref`` (branches or commit ids): one
    outcome row per request, invalid → ref_not_found → fetched, with
    n_added, n_removed, n_changed.  Each distinct pair of listings is compared
    once; ``diff_ranges`` of range_a, range_b has the paths."""
    r = validate(bind(requests, [Param("repository"), Param("left_ref"), Param("right_ref")]),
                 [rule_required("repository"), rule_required("left_ref"), rule_required("right_ref")])
    for ref, commit, out in (("left_ref", "left_commit", "range_a"), ("right_ref", "right_commit", "range_b")):
        r = resolve_refs(r, refs, commits, ref=ref, out=commit, kind=f"_{ref}").drop(f"_{ref}")
        r = head_range(r, commits, commit, out=out)
    on = ["repository", "range_a", "range_b"]
    changes = diff_ranges(r.where(F.col("error_code").isNull() & F.col("range_a").isNotNull() & F.col("range_b").isNotNull()), entries)
    return _counted(r, changes, on, (F.col("left_commit").isNull() | F.col("right_commit").isNull(), O.REF_NOT_FOUND))


def branch_changes(branches: DataFrame, refs: DataFrame, commits: DataFrame, entries: DataFrame, staging: DataFrame) -> DataFrame:
    """Path-level staged changes of the (repository, branch) rows that exist.

    Head listings are looked up at staged paths only, so work grows with the staged
    operations and the listings, never with branches x paths."""
    heads = branches.select("repository", "branch").distinct().join(refs.select("repository", "branch", "commit_id"), ["repository", "branch"])
    ranges = head_range(heads, commits, "commit_id").select(*BRANCH, "meta_range_id").checkpoint(eager=True)
    several = not ranges.groupBy(*BRANCH).count().where("count > 1").isEmpty()
    if small_side(ranges) is ranges:  # of many branches, those with staged rows
        ranges = ranges.join(staging.select(*BRANCH).distinct(), BRANCH, "left_semi").checkpoint(eager=True)
    last = last_staged(staging, ranges)
    listed = (entries.join(small_side(ranges.select(*RANGE).distinct()), RANGE, "left_semi")
              .select(*RANGE, "path", F.col("checksum").alias("old_checksum"), F.col("size_bytes").alias("old_size")))
    at = last.join(small_side(ranges), BRANCH)
    if not several:
        return _effective(at.join(listed, [*RANGE, "path"], "left"), BRANCH)
    # a branch that several rows of refs name has what any of their listings shows
    base = at.select(*BRANCH, "meta_range_id", "path").join(listed, [*RANGE, "path"]).select(*BRANCH, "path", "old_checksum", "old_size")
    return _effective(last.join(base, [*BRANCH, "path"], "left"), BRANCH)


def diff_branch(requests: DataFrame, refs: DataFrame, commits: DataFrame, entries: DataFrame, staging: DataFrame) -> DataFrame:
    """Staged changes of branches against their heads: one outcome row per
    request, invalid → branch_not_found → fetched, with n_added,
    n_removed, n_changed; ``branch_changes`` has the paths."""
    r = validate(bind(requests, [Param("repository"), Param("branch")]), [rule_required("repository"), rule_required("branch")])
    heads = refs.select("repository", "branch", F.col("commit_id").alias("head"))
    r = r.join(heads, ["repository", "branch"], "left")
    wanted = r.where(F.col("error_code").isNull() & F.col("head").isNotNull())
    return _counted(r, branch_changes(wanted, refs, commits, entries, staging), ["repository", "branch"],
                    (F.col("head").isNull(), O.BRANCH_NOT_FOUND))


def classify(b: Column, s: Column, d: Column) -> Column:
    """Three-way class of one path from base/source/dest checksums (null = absent)."""
    return (F.when(s.eqNullSafe(d) & s.eqNullSafe(b), F.lit(UNCHANGED))
             .when(s.eqNullSafe(d), F.lit(SAME_CHANGE))
             .when(d.eqNullSafe(b), F.lit(TAKE_SOURCE))
             .when(s.eqNullSafe(b), F.lit(KEEP_DEST))
             .otherwise(F.lit(CONFLICT)))


def three_way(sides: DataFrame, group: Sequence[str]) -> DataFrame:
    """Classify every path of tagged listings.

    ``sides`` has ``group`` columns, ``side`` in (base, source, dest), path,
    checksum.  One ``groupBy(group, path)`` over the union (one shuffle)
    instead of two full outer joins."""
    def pick(name: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col("checksum"))).alias(f"ck_{name}")
    g = sides.groupBy(*group, "path").agg(pick("base"), pick("source"), pick("dest"))
    return g.withColumn("class", classify(F.col("ck_base"), F.col("ck_source"), F.col("ck_dest")))


TRIPLE = ["repository", "base_range", "source_range", "dest_range"]


def _renamed(diffs: DataFrame, side: str) -> DataFrame:
    """Path changes base → ``side`` under the triple's column names."""
    return diffs.select("repository", F.col("range_a").alias("base_range"), F.col("range_b").alias(f"{side}_range"),
                        "path", F.col("ck_a").alias(f"_b_{side}"), F.col("ck_b").alias(f"ck_{side}"),
                        F.lit(True).alias(f"_in_{side}"))


def triple_changes(t: DataFrame, entries: DataFrame) -> DataFrame:
    """Per (triple, path) that differs between base and source or base and
    dest: base / source / dest checksums (null = absent).

    An entry moves once, to its path; a path that is not the same in all listings of its
    repository is compared there for each triple, and nothing moves again.  Of very many triples,
    each distinct pair of listings (base, source), (base, dest) is compared once, and a
    triple then joins its two small change sets.  No listing gathers in one row."""
    t = t.select(*TRIPLE).checkpoint(eager=True)
    few = small_side(t)
    if few is not t:
        return _changes_in_place(few, entries)
    pairs = (t.select("repository", F.col("base_range").alias("range_a"), F.col("source_range").alias("range_b"))
             .unionByName(t.select("repository", F.col("base_range").alias("range_a"),
                                   F.col("dest_range").alias("range_b")))
             .where(F.col("range_a") != F.col("range_b")).distinct())
    diffs = diff_ranges(pairs, entries).drop("change").checkpoint(eager=True)
    # changes are dealt by a triple's number, not by its names
    few = t.withColumn("_triple", F.monotonically_increasing_id()).checkpoint(eager=True)
    side = lambda name: (few.join(_renamed(diffs, name), ["repository", "base_range", f"{name}_range"])
                         .select("_triple", "path", f"_b_{name}", f"ck_{name}", f"_in_{name}"))
    both = side("source").join(side("dest"), ["_triple", "path"], "full_outer").join(few, "_triple")
    base = F.coalesce("_b_source", "_b_dest")
    return both.select(*TRIPLE, "path", base.alias("ck_base"),
                       F.when(F.col("_in_source"), F.col("ck_source")).otherwise(base).alias("ck_source"),
                       F.when(F.col("_in_dest"), F.col("ck_dest")).otherwise(base).alias("ck_dest"))


def _changes_in_place(t: DataFrame, entries: DataFrame) -> DataFrame:
    """``triple_changes`` of few triples, sent to the tasks that hold the paths."""
    sides = [c for c in TRIPLE if c != "repository"]
    used = t.select("repository", F.explode(F.array(*sides)).alias("_r")).groupBy("repository").agg(F.countDistinct("_r").alias("_n"))
    one = lambda c: F.size(F.array_distinct(f"_at.{c}")) == 1
    same = one("hex_bytes") & one("other") & (F.size(F.array_distinct("_at.meta_range_id")) == F.col("_n"))
    g = (_at_paths(t, entries, *sides).join(F.broadcast(used), "repository").where(~same)
         .join(t, "repository").where("base_range IS NOT NULL").withColumn("ck_base", _checksum_in("base_range")))
    # a side without a listing is as the base
    g = g.withColumns({f"ck_{s}": F.when(F.col(f"{s}_range").isNull(), F.col("ck_base")).otherwise(_checksum_in(f"{s}_range"))
                       for s in ("source", "dest")})
    changed = ~F.col("ck_base").eqNullSafe(F.col("ck_source")) | ~F.col("ck_base").eqNullSafe(F.col("ck_dest"))
    # entries without a path are not the same path on two sides: each side's change is a row of its own
    pair = lambda s, d: F.struct(F.col(s).alias("ck_source"), F.col(d).alias("ck_dest"))
    rows = F.when(F.col("path").isNull(), F.array(pair("ck_source", "ck_base"), pair("ck_base", "ck_dest"))).otherwise(
        F.array(pair("ck_source", "ck_dest")))
    return g.where(changed).select(*TRIPLE, "path", "ck_base", F.inline(rows)).where(changed)


def merged_listing(done: DataFrame, entries: DataFrame, listings: DataFrame | None = None) -> DataFrame:
    """Entries of merged listings: ``done`` has the triple columns, ``force``
    and the announced ``meta_range_id``.  A merged listing is the dest listing
    with the source's entry (or none) at the paths taken from the source.
    Listing ids that are stored already are left out before any path is read."""
    key = ["repository", "meta_range_id"]
    stored = (listings if listings is not None else entries).select(*key).distinct()
    d = (done.select(*TRIPLE, "force", "meta_range_id").dropDuplicates(key)
         .join(stored, key, "left_anti").checkpoint(eager=True))
    changes = triple_changes(d.select(*TRIPLE).distinct(), entries).join(d, TRIPLE)
    cls = classify(F.col("ck_base"), F.col("ck_source"), F.col("ck_dest"))
    taken = (changes.where((cls == TAKE_SOURCE) | ((cls == CONFLICT) & F.col("force")))
             .select(*key, "path", "source_range", "ck_source").checkpoint(eager=True))
    cols = [*key, "path", "physical_address", "checksum", "size_bytes"]
    kept = (listing_rows(d.select(*key, "dest_range"), entries, "dest_range")
            .join(taken.select(*key, "path"), [*key, "path"], "left_anti").select(*cols))
    src = entries.select("repository", F.col("meta_range_id").alias("source_range"), "path", "checksum", "size_bytes",
                         F.coalesce(F.col("physical_address"), F.col("checksum")).alias("physical_address"))
    put = (taken.where(F.col("ck_source").isNotNull()).join(src, ["repository", "source_range", "path"]).select(*cols))
    return kept.unionByName(put)


def three_way_summary(triples: DataFrame, entries: DataFrame, listings: DataFrame | None = None) -> DataFrame:
    """Per distinct triple: class counts and the lane delta that turns the
    dest listing into the merged one (take_source always, conflicts when
    forced).  Only changed paths are classified; the unchanged ones are the
    base listing's entries without them."""
    t = triples.select(*TRIPLE).distinct().checkpoint(eager=True)
    rows = triple_changes(t, entries)
    rows = rows.withColumn("class", classify(F.col("ck_base"), F.col("ck_source"), F.col("ck_dest")))
    d = change_lanes(F.col("path"), F.col("ck_dest"), F.col("ck_source"))
    aggs = [F.count(F.when(F.col("class") == c, 1)).cast("long").alias(f"n_{c}") for c in CLASSES[1:]]
    aggs.append(F.count("ck_base").cast("long").alias("_base_changed"))
    zeros = {}
    for tag, cls in (("ts", TAKE_SOURCE), ("cf", CONFLICT)):
        for i, expr in enumerate(d):
            zero = F.lit(0).cast(H.DEC) if i < len(H.LANE_SLICES) else F.lit(0).cast("long")
            zeros[f"{tag}_d{i}"] = zero
            aggs.append(F.sum(F.when(F.col("class") == cls, expr).otherwise(zero)).alias(f"{tag}_d{i}"))
    stats = (stats_for(entries, t.select("repository", F.col("base_range").alias("meta_range_id")), listings)
             .select("repository", F.col("meta_range_id").alias("base_range"), F.col("n_entries").alias("_n_base")))
    out = (t.join(rows.groupBy(*TRIPLE).agg(*aggs), TRIPLE, "left")
           .join(stats, ["repository", "base_range"], "left"))
    zeros |= {f"n_{c}": F.lit(0).cast("long") for c in CLASSES[1:]} | {c: F.lit(0).cast("long") for c in ("_base_changed", "_n_base")}
    out = out.withColumns({c: F.coalesce(F.col(c), z) for c, z in zeros.items()})
    return (out.withColumn(f"n_{UNCHANGED}", (F.col("_n_base") - F.col("_base_changed")).cast("long"))
               .drop("_n_base", "_base_changed"))
