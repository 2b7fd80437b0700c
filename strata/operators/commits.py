"""Commits: attributes, lookup, ancestry (merge base, log) and commit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import hashing as H
from strata.functions.joins import rows_among, small_side
from strata.functions import outcomes as O
from strata.functions.params import Param, bind, rule_positive, rule_required, validate, without_requests
from strata.functions.render import kept_metadata, render_list, render_map, render_ts, sorted_metadata_text
from strata.operators import listing as L
from strata.operators.state import commit_delta

CKEY = ["repository", "commit_id"]
# Fixed: generations that one job of a merge-base walk takes, and pieces of a closure that are read one by one.
ROUNDS = 2
MOST_PIECES = 16


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a naive-UTC timestamp, independent of the
    session time zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return (days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("long")


def parent_lists(parents: DataFrame) -> DataFrame:
    """(repository, commit_id) → ordered parent id array (a few per commit)."""
    return (parents.groupBy(*CKEY)
                   .agg(F.sort_array(F.collect_list(F.struct("pos", "parent_id"))).alias("_p"))
                   .select(*CKEY, F.col("_p.parent_id").alias("parents")))


def commit_attributes(commits: DataFrame, parents: DataFrame) -> DataFrame:
    """Commit → flat string attributes (dates, parent list, metadata map)."""
    c = commits.join(parent_lists(parents), CKEY, "left")
    return c.select(
        "repository", "commit_id", "committer", "message", "meta_range_id",
        render_ts("creation_date").alias("creation_date"),
        F.col("version").cast("long").alias("version"), F.col("generation").cast("long").alias("generation"),
        render_list(F.coalesce(F.col("parents"), F.array().cast("array<string>"))).alias("parents"),
        render_map(F.coalesce(F.col("metadata"), F.create_map().cast("map<string,string>"))).alias("metadata"))


@without_requests
def fetch_commits(requests: DataFrame, commits: DataFrame, parents: DataFrame) -> DataFrame:
    """Look commits up by id; unmatched requests are kept as ``not_found``."""
    r = validate(bind(requests, [Param("repository"), Param("commit_id")]),
                 [rule_required("repository"), rule_required("commit_id")])
    attrs = commit_attributes(commits, parents)
    a = attrs.select(*[F.col(c).alias(f"_a_{c}") if c in CKEY else F.col(c) for c in attrs.columns])
    j = r.join(a, (r["repository"] == a["_a_repository"]) & (r["commit_id"] == a["_a_commit_id"]), "left")
    outcome = O.first_match((F.col("error_code").isNotNull(), O.INVALID),
                            (F.col("_a_commit_id").isNull(), O.NOT_FOUND), default=O.FETCHED)
    return (j.withColumn("outcome", outcome).withColumn("ok", O.ok_col())
             .drop("_a_repository", "_a_commit_id"))


def node_key(repository: Column, commit_id: Column) -> Column:
    """16 bytes (md5) that stand for a commit of a repository while a history is
    walked; null if either is null."""
    return F.unhex(F.md5(F.concat(F.length(repository).cast("string"), F.lit(":"), repository, F.lit(":"), commit_id)))


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` kept by the executors, dealt by ``keys`` and sorted, so that a join on them
    moves and sorts its other side only.  Lost parts are made again from ``df``."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys).persist()


def key_history(parents: DataFrame, keep: DataFrame, generations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The history of the repositories of ``keep`` (repository, node) with
    its linear stretches contracted: (edges, owners), of nodes (``node_key``).

    A commit with one child and one parent that is not in ``keep`` is a chain
    commit; all others are key commits.  ``edges`` (child, ancestor) lead from each
    key commit to the next key commits below it, of known ``generation`` where
    ``generations`` (node, generation) are given; they are dealt by child and
    stay with the executors until the caller unpersists them.  ``owners``
    (node, owner) name the key commit above each chain commit.
    Owners are found by pointer doubling, so a linear history of n commits takes
    log2(n) rounds."""
    repos = small_side(keep.select("repository").distinct())
    n = int(parents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # dealt by parent: counting a commit's children and finding its generation then moves no edge
    e = (parents.join(repos, "repository", "left_semi")
         .select(node_key(F.col("repository"), F.col("commit_id")).alias("child"),
                 node_key(F.col("repository"), F.col("parent_id")).alias("parent"))
         .where("child IS NOT NULL AND parent IS NOT NULL").repartition(n, "parent").distinct().persist())
    ups = e.groupBy(F.col("child").alias("node")).agg(F.count(F.lit(1)).alias("_ups"))
    downs = (e.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("_downs"), F.min("child").alias("ptr")))
    chain = (downs.where("_downs = 1").join(ups.where("_ups = 1"), "node")
             .join(keep.select("node").distinct(), "node", "left_anti").select("node", "ptr"))
    members = chain.checkpoint(eager=True)
    owners = members
    while True:
        up = owners.select(F.col("node").alias("ptr"), F.col("ptr").alias("_next"))
        step = owners.join(up, "ptr", "left")
        owners = step.select("node", F.coalesce("_next", "ptr").alias("ptr")).checkpoint(eager=True)
        if owners.join(members.select(F.col("node").alias("ptr")), "ptr", "left_semi").isEmpty():
            break
    edges = (e.join(small_side(members.select(F.col("node").alias("parent"))), "parent", "left_anti")
             .join(small_side(owners.select(F.col("node").alias("child"), F.col("ptr").alias("_owner"))), "child", "left")
             .withColumn("child", F.coalesce("_owner", "child")).drop("_owner"))
    if generations is not None:
        edges = edges.join(generations.select(F.col("node").alias("parent"), "generation"), "parent")
    edges = edges.withColumnRenamed("parent", "ancestor")
    edges = _dealt(edges, "child")  # an edge may be there twice, where two chains lead to one commit
    edges.count()
    e.unpersist()
    return edges, owners.select("node", F.col("ptr").alias("owner"))


def _closure(starts: DataFrame, parents: DataFrame) -> DataFrame:
    """(seed, node): the ancestors of each seed, itself included; ``starts`` has
    repository, seed (a number) and node.

    Breadth-first over the contracted history (``key_history``): each round
    keeps only commits not seen before for that seed (anti join), so merge
    commits never multiply paths; the loop ends when no commit is new.  Chain
    commits then follow from their owners in one join.  Edges and what was seen
    stay where they are: a round moves its own rows only, as numbers and node keys.
    Frontiers are reliable checkpoints, so the plan stays shallow."""
    edges, owners = key_history(parents, starts)
    few = small_side(edges.select(F.col("child").alias("_child"), F.col("ancestor").alias("_up")))
    frontier = starts.select("seed", "node").where("node IS NOT NULL").checkpoint(eager=True)
    seen, pieces = [frontier], []
    while not frontier.isEmpty():
        pieces.append(_seen(frontier))
        if len(pieces) > MOST_PIECES:  # each round adds its own commits only; now and then the pieces become one
            for old in pieces:
                old.unpersist()
            seen = [reduce(DataFrame.unionByName, seen).checkpoint(eager=True)]
            pieces = [_seen(seen[0])]
        step = frontier.join(few, F.col("node") == F.col("_child")).select("seed", F.col("_up").alias("node")).distinct()
        for piece in pieces:
            step = step.join(piece, (F.col("seed") == F.col("_seed")) & (F.col("node") == F.col("_node")), "left_anti")
        frontier = step.checkpoint(eager=True)
        seen.append(frontier)
    for kept in (edges, *pieces):
        kept.unpersist()
    reached = reduce(DataFrame.unionByName, seen)
    own = small_side(owners.select(F.col("owner").alias("node"), F.col("node").alias("_member")))
    return reached.unionByName(reached.join(own, "node").select("seed", F.col("_member").alias("node")))


def _seen(frontier: DataFrame) -> DataFrame:
    return _dealt(frontier.select(F.col("seed").alias("_seed"), F.col("node").alias("_node")), "_seed", "_node")


def _starts(seeds: DataFrame) -> DataFrame:
    """Distinct (repository, commit), numbered as ``seed``, with their ``node``."""
    return (seeds.distinct().withColumn("node", node_key(F.col("repository"), F.col("commit")))
            .withColumn("seed", F.monotonically_increasing_id()).checkpoint(eager=True))


def ancestors(seeds: DataFrame, parents: DataFrame) -> DataFrame:
    """Ancestor closure (seed included) of distinct (repository, seed) commits
    (``_closure``), by commit id."""
    starts = _starts(seeds.select("repository", F.col("seed").alias("commit")))
    ids = [parents.select("repository", c) for c in ("commit_id", "parent_id")] + [starts.select("repository", "commit")]
    names = (reduce(DataFrame.union, ids).toDF("_repo", "commit_id").withColumn("node", node_key(F.col("_repo"), F.col("commit_id")))
             .groupBy("node").agg(F.first("commit_id").alias("commit_id")))
    return (_closure(starts, parents).join(names, "node").join(starts.drop("node"), "seed")
            .select("repository", F.col("commit").alias("seed"), "commit_id"))


def merge_base(pairs: DataFrame, commits: DataFrame, parents: DataFrame) -> DataFrame:
    """Best common ancestor of distinct (repository, a, b): the common
    ancestor of largest generation, ties to the smallest id; null if none.

    Generation-ordered walk over the contracted history (``key_history``; a
    chain commit is never the best common ancestor, because its only child is
    common too): per pair, the frontier holds commits with a side mask (1 =
    reached from a, 2 = from b).  Each round pops the frontier's highest
    generation; every child of a popped commit has a higher generation, so its
    mask is complete.  The first popped level with a mask-3 commit holds the
    answer, and the pair leaves the walk; the walk ends when no commit is
    left.  Few edges are sent to all tasks and a job takes ``ROUNDS`` generations; many
    stay where they are, and a round moves pairs only, as numbers and node keys.
    What a job leaves, answers and frontier, is one reliable checkpoint."""
    repo = F.col("repository")
    p = pairs.select("repository", "a", "b").distinct().withColumn("pair", F.monotonically_increasing_id()).checkpoint(eager=True)
    start = (p.select("repository", "pair", node_key(repo, F.col("a")).alias("node"), F.lit(1).alias("mask"))
             .unionByName(p.select("repository", "pair", node_key(repo, F.col("b")).alias("node"), F.lit(2).alias("mask"))))
    named = commits.select(node_key(repo, F.col("commit_id")).alias("node"), "generation", "commit_id")
    gen = named.drop("commit_id")
    edges, _ = key_history(parents, start, gen)
    steps = edges.select(F.col("child").alias("_child"), F.col("ancestor").alias("_parent"), F.col("generation").alias("_pgen"))
    few = small_side(steps)
    many = few is steps
    own = gen.join(small_side(start.select("node").distinct()), "node", "left_semi")
    frontier = (start.join(own, "node").groupBy("pair", "node", "generation").agg(F.bit_or("mask").alias("mask")).checkpoint(eager=True))
    found = []
    while not frontier.isEmpty():
        rows = frontier.withColumn("hit", F.lit(False))
        if many:
            rows = _popped(rows, few)
        else:  # several rounds a job; a pair that has its answer takes no part in the next
            for _ in range(ROUNDS):
                rows = _popped_in_place(rows, few)
        rows = rows.checkpoint(eager=True)
        found.append(rows.where("hit"))
        frontier = rows.where("NOT hit").drop("hit")
    edges.unpersist()
    best = (reduce(DataFrame.unionByName, found) if found else frontier).select("pair", "node", "generation")
    # many pairs share few bases: only their ids are looked up
    ids = named.select("node", "commit_id").join(small_side(best.select("node").distinct()), "node", "left_semi")
    best = (best.join(small_side(ids.distinct()), "node").groupBy("pair")
            .agg(F.min("commit_id").alias("base_id"), F.first("generation").alias("base_generation")))
    return p.join(best, "pair", "left").select("repository", "a", "b", "base_id", "base_generation")


def _tops(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with ``_done`` where their pair has a common commit at its highest generation."""
    top = Window.partitionBy("pair")
    f = rows.withColumn("_top", F.max("generation").over(top))
    at_top = F.col("generation") == F.col("_top")
    return f.withColumn("_done", F.max(F.col("hit") | (at_top & (F.col("mask") == 3))).over(top)), at_top


def _popped(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """One round of ``merge_base``: of each pair the highest generation of its
    frontier gives way to its parents, or, if the pair has common commits there, all
    its rows to the answers (``hit``).  A pair's frontier is small (its width)."""
    f, at_top = _tops(rows)
    pop = f.withColumn("_pop", at_top & ~F.col("_done")).where("NOT _done OR (generation = _top AND mask = 3)")
    grown = (pop.where("_pop").join(edges, F.col("node") == F.col("_child"))
             .select("pair", F.col("_parent").alias("node"), F.col("_pgen").alias("generation"), "mask", F.lit(False).alias("hit")))
    rest = pop.where("NOT _pop").select("pair", "node", "generation", "mask", F.col("_done").alias("hit"))
    return rest.unionByName(grown).groupBy("pair", "node", "generation", "hit").agg(F.bit_or("mask").alias("mask"))


def _popped_in_place(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``_popped`` with few edges, which are sent to all tasks: a row gives way to its
    parents where it is, so rows stay dealt by pair and a round moves none of them."""
    f, at_top = _tops(rows)
    f = f.where("NOT _done OR hit OR (generation = _top AND mask = 3)").withColumn("_pop", ~F.col("_done") & at_top)
    f = f.join(edges, F.col("_pop") & (F.col("node") == F.col("_child")), "left").where("NOT _pop OR _parent IS NOT NULL")
    return (f.select("pair", F.when(F.col("_pop"), F.col("_parent")).otherwise(F.col("node")).alias("node"),
                     F.when(F.col("_pop"), F.col("_pgen")).otherwise(F.col("generation")).alias("generation"),
                     "mask", F.col("_done").alias("hit"))
            .groupBy("pair", "node", "generation", "hit").agg(F.bit_or("mask").alias("mask")))


def log_commits(heads: DataFrame, commits: DataFrame, parents: DataFrame) -> DataFrame:
    """Commit log of each (repository, ref_name, commit_id) head: all
    ancestors, newest generation first (ties by id), with their position."""
    from strata.functions.ordered import row_number_within, small_groups
    starts = _starts(heads.select("repository", F.col("commit_id").alias("commit")))
    anc = _closure(starts, parents)
    seeds_of = (heads.select("repository", "ref_name", F.col("commit_id").alias("commit"))
                .join(starts.select("repository", "commit", "seed"), ["repository", "commit"]).select("repository", "ref_name", "seed"))
    info = commits.select(node_key(F.col("repository"), F.col("commit_id")).alias("node"), "commit_id", "generation", "message", "committer")
    logged = anc.join(info, "node").drop("node").join(seeds_of, "seed").drop("seed")
    logged = logged.select("repository", "ref_name", "commit_id", "generation", "message", "committer")
    lengths = seeds_of.join(anc.groupBy("seed").agg(F.count(F.lit(1)).alias("_n")), "seed")
    return row_number_within(logged, ["repository", "ref_name"], [F.col("generation").desc(), F.col("commit_id").asc()], "position",
                             small=small_groups(lengths, ["repository", "ref_name"], F.col("_n")))


COMMIT_PARAMS = [
    Param("repository"), Param("branch"), Param("message", default=""),
    Param("committer", default="unknown"), Param("date", "long"),
    Param("force", "boolean", False), Param("allow_empty", "boolean", False),
    Param("source_metarange"), Param("expected_head"),
]


@without_requests
def commit_branches(requests: DataFrame, refs: DataFrame, commits: DataFrame, entries: DataFrame,
                    staging: DataFrame, batch_seconds: Column | None = None,
                    listings: DataFrame | None = None) -> DataFrame:
    """Commit each branch's staged changes.

    Precedence: invalid → branch_not_found → metarange_not_found →
    head_moved → nothing_to_commit → retry_next_batch (only the first request
    per branch that has something to commit does so in a batch, since the next
    commit id depends on this one) → committed.  Changes are computed for
    staged paths only (left join with the base listing), once per branch and
    base; the new listing id is the base id plus the lane delta.  Empty
    metadata values are dropped."""
    cols = requests.columns
    req = requests if "metadata" in cols else requests.withColumn(
        "metadata", F.create_map().cast("map<string,string>"))
    r = validate(bind(req, COMMIT_PARAMS),
                 [rule_required("repository"), rule_required("branch"), rule_positive("date")])
    r = r.withColumn("metadata", kept_metadata("metadata"))
    heads = refs.select("repository", "branch", F.col("commit_id").alias("head"), "hidden")
    r = r.drop("hidden").checkpoint(eager=True)
    r = r.join(rows_among(heads, r.select("repository", "branch")), ["repository", "branch"], "left").checkpoint(eager=True)
    r = L.head_range(r, L.commits_among(commits, r, "head"), "head", out="head_range", generation_out="head_generation")
    r = r.withColumn("base_range", F.coalesce(F.col("source_metarange"), F.col("head_range")))
    r = r.checkpoint(eager=True)   # small request side, reused by every branch below
    valid = F.col("error_code").isNull()
    moved = (F.col("expected_head").isNotNull() & (F.col("expected_head") != F.col("head")) & ~F.col("force"))
    named = r.where(F.col("source_metarange").isNotNull()).select(
        "repository", F.col("source_metarange").alias("meta_range_id")).distinct()
    known = ((listings if listings is not None else entries).select("repository", "meta_range_id")
             .join(named, ["repository", "meta_range_id"], "left_semi").distinct()
             .select("repository", F.col("meta_range_id").alias("source_metarange"), F.lit(True).alias("_known")))
    r = r.join(small_side(known), ["repository", "source_metarange"], "left")
    unknown = F.col("source_metarange").isNotNull() & F.col("_known").isNull()
    eligible = valid & F.col("head").isNotNull() & ~unknown & ~moved
    # one evaluation per branch and base; these few keys are the small side of every join below
    firsts = small_side(r.where(eligible).select("repository", "branch", "base_range").distinct())
    # probe the base listing only at staged paths (fine key: listing, path)
    last = L.last_checksums(staging, firsts).join(firsts, ["repository", "branch"])
    # semi join on the (few) base listings first: a broadcast on the partition
    # columns, so only those listings' files are read (dynamic pruning)
    bases = small_side(firsts.select("repository", F.col("base_range").alias("meta_range_id")).distinct())
    probe = (entries.join(bases, ["repository", "meta_range_id"], "left_semi")
             .select("repository", F.col("meta_range_id").alias("base_range"), "path", "checksum"))
    ch = L.changes_at(last, probe, ["repository", "base_range", "path"])
    d = L.change_lanes(F.col("path"), F.col("old_checksum"), F.col("new_checksum"))
    delta = ch.groupBy("repository", "branch", "base_range").agg(
        F.count(F.lit(1)).cast("long").alias("n_changes"),
        *[F.sum(x).alias(f"_d{i}") for i, x in enumerate(d)])
    stats = L.stats_for(entries, firsts.select("repository", F.col("base_range").alias("meta_range_id")),
                        listings)
    stats = stats.select("repository", F.col("meta_range_id").alias("base_range"),
                         F.col("n_entries").alias("_bn"), F.col("lane0").alias("_b0"), F.col("lane1").alias("_b1"))
    # a row a branch and base: sent to the requests, which stay where they are
    r = (r.join(small_side(delta.checkpoint(eager=True)), ["repository", "branch", "base_range"], "left")
          .join(small_side(stats), ["repository", "base_range"], "left"))
    zero = F.lit(0).cast(H.DEC)
    new_range = H.listing_id(F.coalesce("_b0", zero) + F.coalesce("_d0", zero),
                             F.coalesce("_b1", zero) + F.coalesce("_d1", zero),
                             F.coalesce("_bn", F.lit(0)) + F.coalesce("_d2", F.lit(0)))
    n_changes = F.coalesce(F.col("n_changes"), F.lit(0)).cast("long")
    differing = F.col("source_metarange").isNotNull() & ~F.col("source_metarange").eqNullSafe(F.col("head_range"))
    nothing = (n_changes == 0) & ~F.col("allow_empty") & ~differing
    candidates = r.where(eligible & ~nothing).groupBy("repository", "branch").agg(F.min("seq").alias("_first"))
    r = r.join(small_side(candidates.checkpoint(eager=True)), ["repository", "branch"], "left")
    outcome = O.first_match(
        (~valid, O.INVALID),
        (F.col("head").isNull(), O.BRANCH_NOT_FOUND),
        (unknown, O.METARANGE_NOT_FOUND),
        (moved, O.HEAD_MOVED),
        (nothing, O.NOTHING_TO_COMMIT),
        (F.col("seq") != F.col("_first"), O.RETRY_NEXT_BATCH),
        default=O.COMMITTED)
    seconds = F.coalesce(F.col("date"), batch_seconds if batch_seconds is not None
                         else epoch_seconds(F.current_timestamp().cast("timestamp_ntz")))
    r = (r.withColumn("n_changes", n_changes).withColumn("outcome", outcome)
          .withColumn("ok", O.ok_col()))
    done = F.col("outcome") == O.COMMITTED
    r = (r.withColumn("meta_range_id", F.when(done, new_range))
          .withColumn("generation", F.when(done, F.col("head_generation") + 1).cast("long"))
          .withColumn("creation_seconds", F.when(done, seconds))
          .withColumn("commit_id", F.when(done, H.commit_id(
              F.col("repository"), F.col("head"), new_range, F.col("committer"), F.col("message"),
              seconds, sorted_metadata_text("metadata")))))
    return r.drop("_first", "_known", "_bn", "_b0", "_b1", "_d0", "_d1", "_d2")


def last_staged_for(staging: DataFrame, branches: DataFrame) -> DataFrame:
    """Last staged op per path of the given branches: other branches' rows are
    left out by a size-checked broadcast of the branch list before any row moves;
    staging is never shuffled by branch alone."""
    return L.last_staged(staging, branches)


def commit_deltas(outcomes: DataFrame, entries: DataFrame, staging: DataFrame,
                  listings: DataFrame | None = None) -> dict[str, DataFrame]:
    """State deltas of committed requests: commits, parents, refs, the entries
    and rows of listings that are not stored yet, and the staging that is left."""
    done = outcomes.where(F.col("outcome") == O.COMMITTED)
    key = ["repository", "meta_range_id"]
    stored = (listings if listings is not None else entries).select(*key).distinct()
    # two branches may reach the same content-addressed listing: it is stored once, and known ones not at all
    fresh = (done.select("repository", "branch", "base_range", "meta_range_id").dropDuplicates(key)
             .join(stored, key, "left_anti").checkpoint(eager=True))
    base = L.listing_rows(fresh, entries, "base_range")
    last = last_staged_for(staging, fresh)
    cols = [*key, "path", "physical_address", "checksum", "size_bytes"]
    kept = base.join(last.select("repository", "branch", "path"), ["repository", "branch", "path"], "left_anti")
    puts = last.where(F.col("op") == "put").join(small_side(fresh), ["repository", "branch"])
    new_entries = kept.select(*cols).unionByName(puts.select(*cols))
    staging_left = staging.join(small_side(done.select("repository", "branch")), ["repository", "branch"], "left_anti")
    return commit_delta(done, "branch", F.array("head"), new_entries) | {"staging": staging_left}
