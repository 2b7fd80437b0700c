"""Registered queries that run several batches one after another on the state that
the one before has made, and the request and stream forms over whole tables.

As in ``plans.queries`` each reads the driver's tables through ``Fixtures``; its
SQL is beside it and uses the oracle's fixture views only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import commits as C
from strata.operators import listing as L
from strata.operators import merge as MG
from strata.operators import objects as OB
from strata.operators import pulls as PR
from strata.operators import refs as R
from strata.operators import state as STATE
from strata.operators import wait as WT
from strata.plans import oracle as SQL
from strata.plans import queries as Q
from strata.session import scratch_path
from strata.sources.fixtures import Fixtures, commit_hash
from strata.streaming import watch as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str, *views: str, recursive: bool = False) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        body = SQL.with_fixtures(sql, *views)
        ORACLE[f.__name__] = "WITH RECURSIVE " + body[5:] if recursive else body
        return f
    return add


def _pinned(deltas: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Deltas as a batch would write them: they are read several times after."""
    return {k: v.checkpoint(eager=True) for k, v in deltas.items()}


# --- branches -----------------------------------------------------------------

#: The fixture's staging with two thirds of it on 25 more branches of each repository.
SPREAD = """
spread AS (SELECT s.* REPLACE (CASE WHEN k % 3 = 0 THEN 'main' ELSE concat('b_', k % 5 + 5 * (1 + k % 25)) END AS branch)
           FROM (SELECT *, CAST(regexp_extract(path, '([0-9]+)$', 1) AS BIGINT) AS k FROM fx_staging) s)"""

_DELETED = f"""
dreq AS (SELECT seq, repository, {SQL.blank('branch')} AS branch FROM fx_requests WHERE op = 'delete'),
gone AS (SELECT DISTINCT d.repository, d.branch FROM dreq d JOIN fx_refs r ON r.repository = d.repository AND r.branch = d.branch),
refs1 AS (SELECT * FROM fx_refs r WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.repository = r.repository AND g.branch = r.branch))"""


@query(f"""
WITH {_DELETED}, {SPREAD}, {SQL.CREATE_BASE.replace('fx_refs', 'refs1')},
made AS (SELECT repository, branch, arg_max(source_commit, seq) AS commit_id, arg_max(hidden, seq) AS hidden FROM cout
         WHERE outcome IN ('created', 'overwritten') GROUP BY repository, branch),
refs2 AS (SELECT repository, branch, commit_id, hidden FROM refs1 r
          WHERE NOT EXISTS (SELECT 1 FROM made m WHERE m.repository = r.repository AND m.branch = r.branch)
          UNION ALL SELECT repository, branch, commit_id, hidden FROM made),
left_over AS (SELECT s.repository, s.branch, count(*) AS n FROM spread s
              WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.repository = s.repository AND g.branch = s.branch) GROUP BY 1, 2)
SELECT r.repository, r.branch, r.commit_id, r.hidden, CAST(coalesce(n, 0) AS BIGINT) AS n_staged
FROM refs2 r LEFT JOIN left_over l ON l.repository = r.repository AND l.branch = r.branch""",
       "fx_requests", "fx_refs", "fx_commits", "fx_staging")
def delete_then_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of deletes, then one of creates on the refs that are left: all
    branches after both, with their staged operations (a branch that was deleted
    and made anew has none)."""
    fx = Fixtures(spark, sf_dir)
    state = {"refs": fx.refs.select("repository", "branch", "commit_id", "hidden"),
             "staging": Q._spread_staging(fx).select("repository", "branch", "path", "op", "seq")}
    gone = R.delete_branches(fx.requests_of("delete").select("seq", "repository", "branch", "force"), state["refs"])
    state = STATE.apply_deltas(state, _pinned(R.branch_deltas(gone)))
    made = R.create_branches(Q._create_requests(fx), state["refs"], fx.commits)
    state = STATE.apply_deltas(state, _pinned(R.branch_deltas(made)))
    staged = state["staging"].groupBy("repository", "branch").agg(F.count(F.lit(1)).alias("n_staged"))
    return state["refs"].join(staged, ["repository", "branch"], "left").withColumn("n_staged", F.coalesce("n_staged", F.lit(0).cast("long")))


@query("""
SELECT 0 AS seq, 'repo_1' AS repository, 'from_nothing' AS branch, 'main' AS source, 'created' AS outcome, commit_id
FROM fx_refs WHERE repository = 'repo_1' AND branch = 'main'""", "fx_refs", "fx_commits")
def create_without_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input mode "allowed": one create without incoming requests."""
    fx = Fixtures(spark, sf_dir)
    out = R.create_branches(None, fx.refs, fx.commits, values={"repository": "repo_1", "branch": "from_nothing"})
    return out.select(F.col("seq").cast("int").alias("seq"), "repository", "branch", "source", "outcome", "commit_id")


# --- merges -------------------------------------------------------------------

_NEW_COMMIT = """sha256(concat_ws('|', repository, dest_commit || ',' || source_commit, merged_range, committer, message, CAST(date AS VARCHAR), ''))"""


@query(f"""
WITH {SQL.MERGE_CORE},
made AS (SELECT repository, destination_branch AS ref_name, {_NEW_COMMIT} AS commit_id, dest_commit, source_commit, message,
                greatest(dest_generation, source_generation) + 1 AS generation FROM mo WHERE outcome = 'merged'),
members AS (SELECT m.repository, ref_name, a.commit_id FROM made m JOIN anc a ON a.repository = m.repository AND a.seed IN (dest_commit, source_commit)
            UNION SELECT repository, ref_name, commit_id FROM made),
told AS (SELECT repository, commit_id, generation, message FROM fx_commits UNION ALL SELECT repository, commit_id, generation, message FROM made)
SELECT m.repository, m.ref_name, m.commit_id, CAST(t.generation AS BIGINT) AS generation, t.message,
       CAST(row_number() OVER (PARTITION BY m.repository, m.ref_name ORDER BY t.generation DESC, m.commit_id) AS BIGINT) AS position
FROM members m JOIN told t ON t.repository = m.repository AND t.commit_id = m.commit_id""",
       "fx_requests", "fx_refs", "fx_commits", "fx_parents", "fx_entries", recursive=True)
def merge_then_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of merges, then the log of every branch that it moved."""
    fx = Fixtures(spark, sf_dir)
    state = {"refs": fx.refs.select("repository", "branch", "commit_id", "hidden"), "commits": fx.commits, "parents": fx.parents,
             "entries": fx.entries, "listings": fx.listings}
    out = MG.merge_refs(Q._merge_requests(fx), fx.refs, fx.commits, fx.parents, fx.entries, listings=fx.listings).checkpoint(eager=True)
    deltas = _pinned(MG.merge_deltas(out, fx.entries, fx.listings))
    state = STATE.apply_deltas(state, deltas)
    heads = deltas["refs"].select("repository", F.col("branch").alias("ref_name"), "commit_id")
    return C.log_commits(heads, state["commits"], state["parents"]).select(
        "repository", "ref_name", "commit_id", F.col("generation").cast("long").alias("generation"), "message", "position")


@query(f"""
WITH r0 AS (SELECT seq, repository, {SQL.LPAD_SEQ} AS id, CAST(epoch_ms(ts) // 1000 AS BIGINT) AS date FROM fx_requests WHERE op = 'create'),
r1 AS (SELECT r0.*, p.status AS pr_status, p.source_branch, p.destination_branch
       FROM r0 JOIN fx_pull_requests p ON p.repository = r0.repository AND p.id = r0.id),
q AS (SELECT seq, repository, source_branch AS source_ref, destination_branch, concat('merge ', id) AS message,
             'unknown' AS committer, date, false AS force, false AS allow_empty FROM r1 WHERE pr_status = 'open'),
{SQL.MERGE_TAIL},
made AS (SELECT mo.repository, substr(message, 7) AS id, {_NEW_COMMIT} AS commit_id, date, destination_branch FROM mo WHERE outcome = 'merged'),
heads AS (SELECT repository, destination_branch AS branch, commit_id FROM made
          UNION ALL SELECT repository, branch, commit_id FROM fx_refs r
          WHERE NOT EXISTS (SELECT 1 FROM made m WHERE m.repository = r.repository AND m.destination_branch = r.branch)),
after AS (SELECT p.repository, p.id, CASE WHEN m.id IS NOT NULL THEN 'merged' ELSE p.status END AS status,
                 coalesce(m.commit_id, p.merged_commit_id) AS merged_commit_id,
                 CASE WHEN m.id IS NOT NULL THEN TIMESTAMP '1970-01-01' + to_seconds(m.date) ELSE p.closed_date END AS closed_date,
                 p.destination_branch
          FROM fx_pull_requests p LEFT JOIN made m ON m.repository = p.repository AND m.id = p.id)
SELECT a.repository, a.id, a.status, a.merged_commit_id, CAST(epoch_ms(a.closed_date) // 1000 AS BIGINT) AS closed_seconds,
       h.commit_id IS NOT NULL AS is_head
FROM after a LEFT JOIN heads h ON h.repository = a.repository AND h.branch = a.destination_branch AND h.commit_id = a.merged_commit_id""",
       "fx_requests", "fx_refs", "fx_commits", "fx_parents", "fx_entries", "fx_pull_requests", recursive=True)
def merge_pr_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pull request after a batch of merges, and whether its merge commit is
    the head of its destination in the refs after the batch."""
    fx = Fixtures(spark, sf_dir)
    req = fx.requests_where_op("create").select("seq", "repository", Q._lpad_seq().alias("id"), C.epoch_seconds(F.col("ts")).alias("date"))
    out = PR.merge_pull_requests(req, fx.pull_requests, fx.refs, fx.commits, fx.parents, fx.entries, fx.listings).checkpoint(eager=True)
    state = {"refs": fx.refs.select("repository", "branch", "commit_id", "hidden"), "commits": fx.commits, "parents": fx.parents,
             "entries": fx.entries, "listings": fx.listings}
    state = STATE.apply_deltas(state, _pinned(PR.merge_pr_deltas(out, fx.entries, fx.listings)))
    prs = PR.apply_pr_outcomes(fx.pull_requests, out)
    heads = state["refs"].select("repository", F.col("branch").alias("destination_branch"), F.col("commit_id").alias("merged_commit_id"),
                                 F.lit(True).alias("is_head"))
    return (prs.join(heads, ["repository", "destination_branch", "merged_commit_id"], "left")
            .select("repository", "id", "status", "merged_commit_id", C.epoch_seconds(F.col("closed_date")).alias("closed_seconds"),
                    F.coalesce("is_head", F.lit(False)).alias("is_head")))


@query(f"""
WITH q AS (SELECT seq, repository, coalesce({SQL.blank('branch')}, 'main') AS source FROM fx_requests WHERE op = 'merge'),
made AS (SELECT q.repository, count(*) AS n FROM q JOIN fx_refs s ON s.repository = q.repository AND s.branch = q.source
         JOIN fx_refs d ON d.repository = q.repository AND d.branch = 'main' WHERE q.source <> 'main' GROUP BY 1),
stored AS (SELECT repository, count(*) AS n FROM fx_pull_requests GROUP BY 1)
SELECT s.repository, CAST(s.n + 2 * coalesce(m.n, 0) AS BIGINT) AS n_requests, CAST(s.n + 2 * coalesce(m.n, 0) AS BIGINT) AS n_ids,
       CAST(coalesce(m.n, 0) AS BIGINT) AS n_created_again
FROM stored s LEFT JOIN made m ON m.repository = s.repository""", "fx_requests", "fx_refs", "fx_commits", "fx_pull_requests")
def create_pull_requests_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch of creates twice (same seq, same titles): pull requests of
    each repository after both, and their different ids."""
    fx = Fixtures(spark, sf_dir)
    s = F.col("seq")
    req = fx.requests_where_op("merge").select("seq", "repository", F.concat(F.lit("title "), s.cast("string")).alias("title"),
                                               F.col("branch").alias("source_branch"))
    state = {"pull_requests": fx.pull_requests}
    for _ in range(2):
        out = PR.create_pull_requests(req, fx.refs, state["pull_requests"]).checkpoint(eager=True)
        rows = PR.new_pull_request_rows(out, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        state = STATE.apply_deltas(state, _pinned({"pull_requests": rows}))
    again = out.where("outcome = 'created'").groupBy("repository").agg(F.count(F.lit(1)).alias("n_created_again"))
    return (state["pull_requests"].groupBy("repository").agg(F.count(F.lit(1)).alias("n_requests"), F.countDistinct("id").alias("n_ids"))
            .join(again, "repository", "left").withColumn("n_created_again", F.coalesce("n_created_again", F.lit(0).cast("long"))))


# --- objects ------------------------------------------------------------------

_VIEW = SQL.MAIN_VIEW.replace("WHERE r.branch = 'main'", "")


@query(f"""
WITH {_VIEW}
SELECT v.repository, v.branch, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, CAST(count(*) AS BIGINT) AS n_files,
       min(checksum) AS first_address, max(checksum) AS last_address
FROM view v JOIN (SELECT DISTINCT repository, branch FROM fx_requests WHERE op = 'fetch') q
  ON q.repository = v.repository AND q.branch = v.branch
GROUP BY 1, 2, 3""", "fx_requests", "fx_refs", "fx_commits", "fx_entries", "fx_staging")
def symlink_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symlink files of the branches that requests name, made by two batches (the
    second makes some again), read back from storage."""
    fx = Fixtures(spark, sf_dir)
    asked = fx.requests_of("fetch").select("seq", "repository", "branch")
    where = scratch_path(spark, "symlinks")
    for batch in (asked.where("seq % 3 < 2"), asked.where("seq % 3 > 0")):
        OB.create_symlinks(batch, fx.refs, fx.commits, fx.entries, fx.staging, where)
    files = spark.read.schema("value string, repository string, branch string, dir string").text(where)
    return (files.groupBy("repository", "branch", "dir").agg(F.count(F.lit(1)).alias("n_files"), F.min("value").alias("first_address"),
                                                             F.max("value").alias("last_address")))


@query("""
WITH lines AS (SELECT repository, path, unnest(string_split(regexp_replace(decode(content), '\\n$', ''), chr(10))) AS line, octet_length(content) AS n
               FROM fx_objects WHERE repository IN (SELECT repository FROM fx_refs WHERE branch = 'main'))
SELECT repository, path, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars, max(line) AS last_line
FROM lines WHERE n > 0 GROUP BY 1, 2""", "fx_objects", "fx_refs", "fx_commits")
def read_lines_at_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents uploaded to ``main`` read back as the lines of text files at that
    ref: the paths and bytes stay in the cluster."""
    fx = Fixtures(spark, sf_dir)
    staging, contents = Q._state_after_doc_puts(fx)
    view = L.branch_view(Q._main_branches(fx), fx.refs, fx.commits, fx.entries, staging)
    lines = OB.read_at_ref(view, "docs/", fmt="text", schema="value string", contents=contents, keep=("repository", "path"))
    return lines.groupBy("repository", "path").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars"),
                                                   F.max("value").alias("last_line"))


_RESET = f"""
q AS (SELECT seq, repository, {SQL.blank('branch')} AS branch, CASE WHEN seq % 2 = 0 THEN 'orders/O/' WHEN seq % 3 = 0 THEN 'none/' ELSE '' END AS prefix
      FROM fx_requests WHERE op = 'fetch')"""


def _reset_requests(fx: Fixtures) -> DataFrame:
    s = F.col("seq")
    return fx.requests_of("fetch").select("seq", "repository", "branch", F.when(s % 2 == 0, F.lit("orders/O/")).when(s % 3 == 0, F.lit("none/"))
                                          .otherwise(F.lit("")).alias("prefix"))


@query(f"""
WITH {SPREAD}, {_RESET},
n AS (SELECT q.seq, count(s.path) AS n FROM q JOIN spread s ON s.repository = q.repository AND s.branch = q.branch AND starts_with(s.path, q.prefix)
      GROUP BY 1),
v AS (SELECT q.*, r.branch IS NOT NULL AS known, CASE WHEN r.branch IS NOT NULL THEN coalesce(n.n, 0) END AS n_dropped
      FROM q LEFT JOIN fx_refs r ON r.repository = q.repository AND r.branch = q.branch LEFT JOIN n ON n.seq = q.seq)
SELECT seq, repository, branch, prefix, CAST(n_dropped AS BIGINT) AS n_dropped,
       CASE WHEN branch IS NULL THEN 'invalid' WHEN NOT known THEN 'branch_not_found' WHEN n_dropped = 0 THEN 'nothing_to_reset' ELSE 'reset' END AS outcome,
       known AND coalesce(n_dropped, 0) > 0 AS ok
FROM v""", "fx_requests", "fx_refs", "fx_commits", "fx_staging")
def reset_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resets by request, over staging on many branches."""
    fx = Fixtures(spark, sf_dir)
    out = OB.reset_branches(_reset_requests(fx), fx.refs, Q._spread_staging(fx))
    return out.select("seq", "repository", "branch", F.coalesce("prefix", F.lit("")).alias("prefix"), "n_dropped", "outcome", "ok")


_LIST = f"""
q AS (SELECT seq, repository, {SQL.blank('branch')} AS ref, CASE seq % 4 WHEN 0 THEN '' WHEN 1 THEN 'orders/' WHEN 2 THEN 'orders/O/1' ELSE 'orders/F/' END AS prefix,
             CASE WHEN seq % 5 = 0 THEN '' ELSE '/' END AS delimiter, CASE WHEN seq % 7 = 0 THEN 'orders/F/' ELSE '' END AS after,
             1 + seq % 6 AS amount
      FROM fx_requests WHERE op = 'fetch')"""


def _list_requests(fx: Fixtures) -> DataFrame:
    s = F.col("seq")
    return fx.requests_of("fetch").select(
        "seq", "repository", F.col("branch").alias("ref"),
        F.when(s % 4 == 0, F.lit("")).when(s % 4 == 1, F.lit("orders/")).when(s % 4 == 2, F.lit("orders/O/1")).otherwise(F.lit("orders/F/")).alias("prefix"),
        F.when(s % 5 == 0, F.lit("")).otherwise(F.lit("/")).alias("delimiter"), F.when(s % 7 == 0, F.lit("orders/F/")).otherwise(F.lit("")).alias("after"),
        (1 + s % 6).cast("int").alias("amount"))


@query(f"""
WITH {_VIEW.replace('mains AS', _LIST.strip() + ', mains AS').replace('JOIN fx_commits c ON', 'JOIN (SELECT DISTINCT repository, ref FROM q) w ON w.repository = r.repository AND w.ref = r.branch JOIN fx_commits c ON')},
x AS (SELECT q.seq, q.prefix, q.amount, q.after, v.size_bytes, v.path,
             CASE WHEN q.delimiter <> '' AND instr(substr(v.path, length(q.prefix) + 1), q.delimiter) > 0
                  THEN q.prefix || substr(v.path, length(q.prefix) + 1, instr(substr(v.path, length(q.prefix) + 1), q.delimiter)) ELSE v.path END AS entry
      FROM q JOIN view v ON v.repository = q.repository AND v.branch = q.ref AND starts_with(v.path, q.prefix)),
e AS (SELECT seq, amount, entry, CASE WHEN entry = min(path) AND count(*) = 1 THEN 'object' ELSE 'prefix' END AS kind,
             count(*) AS n_objects, sum(size_bytes) AS total_bytes FROM x WHERE entry > after GROUP BY 1, 2, 3),
o AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY entry) AS position, count(*) OVER (PARTITION BY seq) AS total FROM e),
p AS (SELECT *, total > amount AS more, max(CASE WHEN position = amount THEN entry END) OVER (PARTITION BY seq) AS cursor FROM o)
SELECT q.seq, q.repository, q.ref,
       CASE WHEN q.ref IS NULL THEN 'invalid' WHEN r.branch IS NULL THEN 'ref_not_found' ELSE 'fetched' END AS outcome,
       p.entry, p.kind, CAST(p.n_objects AS BIGINT) AS n_objects, CAST(p.total_bytes AS BIGINT) AS total_bytes, CAST(p.position AS BIGINT) AS position,
       coalesce(p.more, false) AS has_more, CASE WHEN p.more THEN p.cursor END AS next_after
FROM q LEFT JOIN fx_refs r ON r.repository = q.repository AND r.branch = q.ref LEFT JOIN p ON p.seq = q.seq AND p.position <= q.amount""",
       "fx_requests", "fx_refs", "fx_commits", "fx_entries", "fx_staging")
def list_objects_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings by request: pages of any branch, prefix, delimiter and cursor."""
    fx = Fixtures(spark, sf_dir)
    out = OB.list_objects_at(_list_requests(fx), fx.refs, fx.commits, fx.entries, fx.staging)
    return out.select("seq", "repository", "ref", "outcome", "entry", "kind", "n_objects", "total_bytes", "position", "has_more", "next_after")


# --- watch --------------------------------------------------------------------

def _known_looks(observations: DataFrame) -> DataFrame:
    """Looks at heads that are commits of the fixture (every 60 of value the next)."""
    n = 1 + F.col("seq") % 40
    return observations.withColumn("commit_id", F.when(F.col("commit_id").isNotNull(), commit_hash(F.col("repository"), n)))


_LOOKS = "looks AS (SELECT * REPLACE (CASE WHEN commit_id IS NOT NULL THEN md5(concat(repository, ':', 1 + seq % 40)) END AS commit_id) FROM fx_observations)"
_ATTRS = "a.committer, a.message, a.meta_range_id, a.creation_date, a.version, a.generation, a.parents, a.metadata"
_ATTR_NAMES = ["committer", "message", "meta_range_id", "creation_date", "version", "generation", "parents", "metadata"]
_EMITTED = """
emitted AS (SELECT repository, branch, seq, observed_at, commit_id FROM (
              SELECT *, lag(commit_id) OVER w AS prev, row_number() OVER w AS i FROM looks WINDOW w AS (PARTITION BY repository, branch ORDER BY seq)) t
            WHERE commit_id IS NOT NULL AND commit_id IS DISTINCT FROM {before})"""


@query(f"""
WITH {SQL.COMMIT_ATTRS}, {_LOOKS}, {_EMITTED.format(before='prev')}
SELECT e.repository, e.branch, e.seq, e.commit_id, {_ATTRS}
FROM emitted e LEFT JOIN attrs a ON a.repository = e.repository AND a.commit_id = e.commit_id""", "fx_observations", "fx_commits", "fx_parents")
def wait_commits_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emissions with the eight attributes of their commit."""
    fx = Fixtures(spark, sf_dir)
    out = WT.with_commit(WT.wait_commits(_known_looks(fx.observations)), fx.commits, fx.parents)
    return out.select("repository", "branch", "seq", "commit_id", *_ATTR_NAMES)


@query(f"""
WITH {SQL.COMMIT_ATTRS},
q AS (SELECT seq, repository, {SQL.blank('branch')} AS branch, md5(concat(repository, ':', seq)) AS previous FROM fx_requests WHERE op = 'fetch'),
v AS (SELECT q.*, h.commit_id AS head FROM q LEFT JOIN fx_refs h ON h.repository = q.repository AND h.branch = q.branch),
o AS (SELECT *, CASE WHEN branch IS NULL THEN 'invalid' WHEN head IS NULL THEN 'branch_not_found' WHEN head = previous THEN 'unchanged' ELSE 'changed' END
             AS outcome FROM v)
SELECT o.seq, o.repository, o.branch, o.head, o.outcome, o.outcome = 'changed' AS ok, {_ATTRS}
FROM o LEFT JOIN attrs a ON a.repository = o.repository AND a.commit_id = o.head AND o.outcome = 'changed'""", "fx_requests", "fx_refs", "fx_commits", "fx_parents")
def changed_since_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests whose branch has moved, with the attributes of its head."""
    fx = Fixtures(spark, sf_dir)
    req = fx.requests_where_op("fetch").select("seq", "repository", "branch", commit_hash(F.col("repository"), F.col("seq")).alias("previous_commit_id"))
    out = WT.changed_since(req, fx.refs, fx.commits, fx.parents)
    return out.select("seq", "repository", "branch", "head", "outcome", "ok", *_ATTR_NAMES)


@query(f"""
WITH {SQL.COMMIT_ATTRS}, {_LOOKS},
seed AS (SELECT repository, branch, arg_min(commit_id, seq) AS commit_id FROM looks WHERE commit_id IS NOT NULL AND seq % 2 = 0 GROUP BY 1, 2),
{_EMITTED.format(before="CASE WHEN i = 1 THEN (SELECT s.commit_id FROM seed s WHERE s.repository = t.repository AND s.branch = t.branch) ELSE prev END")}
SELECT e.repository, e.branch, e.seq, e.commit_id, {_ATTRS}
FROM emitted e LEFT JOIN attrs a ON a.repository = e.repository AND a.commit_id = e.commit_id""", "fx_observations", "fx_commits", "fx_parents")
def stream_wait_commits_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of looks, with heads known before and the
    attributes of emitted commits; written by a sink and read back."""
    fx = Fixtures(spark, sf_dir)
    looks = _known_looks(fx.observations)
    seed = (looks.where("commit_id IS NOT NULL AND seq % 2 = 0").groupBy("repository", "branch")
            .agg(F.min_by("commit_id", "seq").alias("commit_id")).checkpoint(eager=True))
    events = ST.file_stream(spark, sf_dir.rstrip("/"), fx.table("events").schema, glob="events.parquet")
    out = ST.wait_commits_stream(_known_looks(Q.observations_from(events)), seed, fx.commits, fx.parents)
    where, ck = scratch_path(spark, "seeded-out"), scratch_path(spark, "seeded-ck")
    ST.run_available(out, where, ck)
    return spark.read.schema(out.schema).parquet(where).select("repository", "branch", "seq", "commit_id", *_ATTR_NAMES)


@query(f"""
WITH {_DELETED}, {SQL.CREATE_BASE.replace('fx_refs', 'refs1')},
made AS (SELECT repository, branch, arg_max(source_commit, seq) AS commit_id FROM cout WHERE outcome IN ('created', 'overwritten') GROUP BY 1, 2)
SELECT repository, branch, commit_id, CAST(1 AS BIGINT) AS listing FROM fx_refs
UNION ALL SELECT repository, branch, commit_id, 3 FROM made m
WHERE NOT EXISTS (SELECT 1 FROM refs1 r WHERE r.repository = m.repository AND r.branch = m.branch)""",
       "fx_requests", "fx_refs", "fx_commits")
def stream_listed_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three listings as a stream: before and after a batch of deletes, and after
    one of creates.  The first shows every branch, the third those that the
    second does not have, also if the first has them."""
    fx = Fixtures(spark, sf_dir)
    first = fx.refs.select("repository", "branch", "commit_id")
    gone = R.delete_branches(fx.requests_of("delete").select("seq", "repository", "branch", "force"), fx.refs).checkpoint(eager=True)
    refs = R.refs_after_delete(gone, fx.refs)
    made = R.create_branches(Q._create_requests(fx), refs, fx.commits).checkpoint(eager=True)
    now = R.refs_after_create(made, refs)
    src, out, ck = (scratch_path(spark, n) for n in ("listed", "listed-out", "listed-ck"))
    schema = "repository string, branch string, commit_id string, listing long, listed_at timestamp_ntz"
    for i, rows in enumerate((first, refs, now), 1):
        (rows.select("repository", "branch", "commit_id", F.lit(i).cast("long").alias("listing"),
                     F.lit(f"2024-01-01 0{i}:00:00").cast("timestamp_ntz").alias("listed_at")).write.mode("append").parquet(src))
        ST.run_available(ST.listed_branches_stream(ST.file_stream(spark, src, schema), keep_seconds=7200), out, ck)
    return spark.read.schema(ST.LISTED).parquet(out)


@query(f"""
WITH {SQL.CREATE_BASE}
SELECT seq, repository, branch, outcome, outcome IN {SQL.OK_CODES} AS ok FROM cout""", "fx_requests", "fx_refs", "fx_commits")
def stream_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create requests as a stream: the successes and failures of each batch go to
    two tables, once; both read back."""
    fx = Fixtures(spark, sf_dir)
    events = ST.file_stream(spark, sf_dir.rstrip("/"), fx.table("events").schema, glob="events.parquet")
    s = F.col("seq")
    asked = fx._requests(events).where("op = 'create'").select(
        "seq", "repository", "branch", "source", (s % 3 == 0).alias("force"), (s % 2 == 0).alias("ignore_exists"), (s % 11 == 0).alias("hidden"))
    ok, failed, ck = (scratch_path(spark, n) for n in ("route-ok", "route-failed", "route-ck"))
    ST.run_routes(asked, lambda batch: R.create_branches(batch, fx.refs, fx.commits).select("seq", "repository", "branch", "outcome"), ok, failed, ck)
    read = spark.read.schema("seq long, repository string, branch string, outcome string, batch long")
    both = read.parquet(ok).withColumn("ok", F.lit(True)).unionByName(read.parquet(failed).withColumn("ok", F.lit(False)))
    return both.select("seq", "repository", "branch", "outcome", "ok")
