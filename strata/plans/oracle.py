"""DuckDB oracle SQL for every registered query.

The fixture views are written once as SQL here (the Spark side builds them
with DataFrame plans in ``strata.sources.fixtures``) and prefixed to each
query as CTEs.  Only the driver tables are assumed to exist as views.
"""

from __future__ import annotations

FIX: dict[str, str] = {}

FIX["fx_commits"] = """
SELECT repository, n, md5(concat(repository, ':', n)) AS commit_id, committer, message,
       md5(concat('mr:', repository, ':', n % 3)) AS meta_range_id, creation_date,
       1 AS version, CAST(length(bin(n)) AS BIGINT) AS generation, k_status, k_priority
FROM (SELECT concat('repo_', o_orderkey % 5) AS repository,
             CAST(row_number() OVER (PARTITION BY o_orderkey % 5 ORDER BY o_orderkey) AS BIGINT) AS n,
             concat('user_', o_custkey) AS committer, o_orderpriority AS message,
             o_orderdate AS creation_date, o_orderstatus AS k_status, o_orderpriority AS k_priority
      FROM orders) t"""

FIX["fx_parents"] = """
SELECT repository, commit_id, 0 AS pos, md5(concat(repository, ':', n >> 1)) AS parent_id FROM fx_commits WHERE n > 1
UNION ALL
SELECT repository, commit_id, 1 AS pos, md5(concat(repository, ':', (n >> 1) - 1)) AS parent_id
FROM fx_commits WHERE n > 3 AND n % 7 = 0"""

FIX["fx_refs"] = """
SELECT c.repository, c.branch, md5(concat(c.repository, ':', 1 + (c.k * 37) % m.cnt)) AS commit_id, c.hidden
FROM (SELECT concat('repo_', c_custkey % 5) AS repository,
             CASE WHEN c_custkey < 5 THEN 'main' ELSE concat('b_', c_custkey) END AS branch,
             c_custkey AS k, c_mktsegment = 'HOUSEHOLD' AND c_custkey >= 5 AS hidden FROM customer) c
JOIN (SELECT repository, count(*) AS cnt FROM fx_commits GROUP BY repository) m ON c.repository = m.repository"""

FIX["fx_manifest"] = """
SELECT concat('repo_', o_orderkey % 5) AS repository, side, concat('orders/', o_orderstatus, '/', o_orderkey) AS path,
       md5(concat(o_orderkey, ':',
         CASE WHEN side = 'source' AND o_orderkey % 7 = 0 THEN 'v2'
              WHEN side = 'dest' AND o_orderkey % 35 = 0 AND o_orderkey % 2 = 0 THEN 'v2'
              WHEN side = 'dest' AND o_orderkey % 5 = 1 AND o_orderkey % 3 = 0 THEN 'v3'
              ELSE 'v1' END)) AS checksum,
       CAST(floor(o_totalprice) AS BIGINT) AS size_bytes
FROM orders CROSS JOIN (SELECT 'base' AS side UNION ALL SELECT 'source' UNION ALL SELECT 'dest') s
WHERE NOT (side = 'base'   AND o_orderkey % 10 = 9)
  AND NOT (side = 'source' AND (o_orderkey % 11 = 0 OR (o_orderkey % 10 = 9 AND o_orderkey % 4 <> 1)))
  AND NOT (side = 'dest'   AND (o_orderkey % 13 = 0 OR (o_orderkey % 10 = 9 AND o_orderkey % 3 <> 0)))"""

FIX["fx_entries"] = """
SELECT repository,
       md5(concat('mr:', repository, ':', CASE side WHEN 'base' THEN 0 WHEN 'source' THEN 1 ELSE 2 END)) AS meta_range_id,
       path, checksum, size_bytes
FROM fx_manifest"""

FIX["fx_staging"] = """
SELECT repository, branch, path, op,
       CASE WHEN op = 'put' THEN checksum END AS checksum,
       CASE WHEN op = 'put' THEN size_bytes END AS size_bytes,
       row_number() OVER (PARTITION BY repository, branch, path
                          ORDER BY l_linenumber, l_partkey, l_suppkey, op, size_bytes) AS seq
FROM (SELECT concat('repo_', l_orderkey % 5) AS repository, 'main' AS branch,
             concat('orders/', CASE l_linestatus WHEN 'O' THEN 'O' ELSE 'F' END, '/', l_orderkey) AS path,
             CASE WHEN l_returnflag = 'R' THEN 'delete' ELSE 'put' END AS op,
             md5(concat(l_orderkey, ':', l_partkey, ':', l_suppkey)) AS checksum,
             CAST(floor(l_extendedprice) AS BIGINT) AS size_bytes,
             l_orderkey, l_linenumber, l_partkey, l_suppkey
      FROM lineitem) s"""

FIX["fx_pull_requests"] = """
SELECT concat('repo_', o_orderkey % 5) AS repository,
       concat('pr_', lpad(CAST(o_orderkey AS VARCHAR(20)), 9, '0')) AS id,
       CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' ELSE 'merged' END AS status,
       concat('title ', o_orderpriority) AS title,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('desc ', o_orderkey) END AS description,
       o_orderdate AS creation_date, concat('user_', o_custkey) AS author,
       concat('b_', o_custkey) AS source_branch, 'main' AS destination_branch,
       CASE WHEN o_orderstatus = 'P' THEN md5(concat('pr', o_orderkey)) END AS merged_commit_id,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL '7' DAY END AS closed_date
FROM orders"""

FIX["fx_objects"] = """
SELECT concat('repo_', doc_id % 5) AS repository, concat('docs/', lang, '/', source, '/', doc_id, '.txt') AS path,
       doc_id, encode(text) AS content, CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes FROM documents"""

FIX["fx_observations"] = """
SELECT concat('repo_', user_id % 5) AS repository, concat('b_', user_id) AS branch, event_id AS seq, ts AS observed_at,
       CASE WHEN event_type = 'error' THEN NULL ELSE md5(concat('c', CAST(floor(value / 60) AS BIGINT))) END AS commit_id
FROM events"""

FIX["fx_requests"] = """
SELECT event_id AS seq, ts, concat('repo_', user_id % 6) AS repository,
       CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' WHEN 'purchase' THEN 'commit'
                       WHEN 'click' THEN 'fetch' ELSE 'merge' END AS op,
       CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 2 = 0 THEN concat('b_', user_id)
            ELSE concat('b_', event_id % 4000) END AS branch,
       CASE WHEN event_id % 5 = 0 THEN 'nope' ELSE 'main' END AS source
FROM events"""

DEPS = {
    "fx_parents": ["fx_commits"],
    "fx_refs": ["fx_commits"],
    "fx_entries": ["fx_manifest"],
}


def with_fixtures(body: str, *names: str) -> str:
    """Prefix ``body`` with the fixture CTEs it names (dependencies first)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({FIX[n]}\n)" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


# ----------------------------------------------------------------- queries --
ORACLE: dict[str, str] = {}

_BLANK = "CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END"


def blank(c: str) -> str:
    return _BLANK.format(c=c)


BRANCH_ERR = f"""CASE WHEN q.repository IS NULL OR trim(q.repository) = '' THEN 'empty:repository'
     WHEN q.branch IS NULL OR trim(q.branch) = '' THEN 'empty:branch' END"""

ORACLE["bind_validate"] = with_fixtures(f"""
SELECT seq, repository, op, branch, source, coalesce(TRY_CAST(force_text AS BOOLEAN), false) AS force, ignore_exists,
       TRY_CAST(date_text AS BIGINT) AS date, coalesce(TRY_CAST(amount_text AS INTEGER), 1) AS amount, error_code,
       error_code IS NULL AS valid
FROM (SELECT *, CASE WHEN TRY_CAST(force_text AS BOOLEAN) IS NULL THEN 'bad_type:force'
                     WHEN TRY_CAST(date_text AS BIGINT) IS NULL THEN 'bad_type:date'
                     WHEN TRY_CAST(amount_text AS INTEGER) IS NULL THEN 'bad_type:amount'
                     WHEN repository IS NULL OR trim(repository) = '' THEN 'empty:repository'
                     WHEN branch IS NULL THEN 'empty:branch'
                     WHEN TRY_CAST(date_text AS BIGINT) <= 0 THEN 'not_positive:date'
                     WHEN TRY_CAST(amount_text AS INTEGER) <= 0 THEN 'not_positive:amount' END AS error_code
      FROM (SELECT seq, repository, op,
                   CASE WHEN seq % 23 = 0 THEN 'feature/x' WHEN seq % 29 = 0 THEN '_tmp' ELSE {blank('branch')} END AS branch,
                   coalesce({blank('source')}, 'main') AS source,
                   CASE WHEN seq % 13 = 0 THEN 'maybe' WHEN seq % 3 = 0 THEN 'true' ELSE 'false' END AS force_text,
                   seq % 2 = 0 AS ignore_exists,
                   CASE WHEN seq % 17 = 0 THEN 'abc' WHEN seq % 19 = 0 THEN '-5' ELSE CAST(seq + 1 AS VARCHAR) END AS date_text,
                   CASE WHEN seq % 31 = 0 THEN 'many' WHEN seq % 37 = 0 THEN '0' ELSE '3' END AS amount_text
            FROM fx_requests) b) v""", "fx_requests")

ORACLE["resolve_refs"] = with_fixtures("""
SELECT q.seq, q.repository, q.ref,
       CASE WHEN r.commit_id IS NOT NULL THEN 'branch' WHEN c.commit_id IS NOT NULL THEN 'commit' END AS resolved_kind,
       coalesce(r.commit_id, c.commit_id) AS commit_id
FROM (SELECT seq, repository,
             CASE WHEN seq % 3 = 0 THEN md5(concat(repository, ':', seq % 50)) ELSE branch END AS ref
      FROM fx_requests) q
LEFT JOIN fx_refs r ON r.repository = q.repository AND r.branch = q.ref
LEFT JOIN fx_commits c ON c.repository = q.repository AND c.commit_id = q.ref""",
                                       "fx_requests", "fx_refs", "fx_commits")

# create requests with bound parameters, source resolved, snapshot head joined
CREATE_BASE = f"""
creq AS (
  SELECT seq, repository, {blank('branch')} AS branch, coalesce({blank('source')}, 'main') AS source,
         seq % 3 = 0 AS force, seq % 2 = 0 AS ignore_exists, seq % 11 = 0 AS hidden
  FROM fx_requests WHERE op = 'create'),
cres AS (
  SELECT q.*, {BRANCH_ERR} AS error_code,
         coalesce(sb.commit_id, sc.commit_id) AS source_commit, h.commit_id AS head
  FROM creq q
  LEFT JOIN fx_refs sb ON sb.repository = q.repository AND sb.branch = q.source
  LEFT JOIN fx_commits sc ON sc.repository = q.repository AND sc.commit_id = q.source
  LEFT JOIN fx_refs h ON h.repository = q.repository AND h.branch = q.branch),
cfirst AS (
  SELECT repository, branch, min(seq) AS first_eff FROM cres
  WHERE error_code IS NULL AND source_commit IS NOT NULL GROUP BY repository, branch),
cout AS (
  SELECT c.*, CASE WHEN error_code IS NOT NULL THEN 'invalid'
                   WHEN source_commit IS NULL THEN 'source_not_found'
                   WHEN NOT (head IS NOT NULL OR coalesce(f.first_eff < c.seq, false)) THEN 'created'
                   WHEN force THEN 'overwritten'
                   WHEN ignore_exists THEN 'ignored'
                   ELSE 'branch_exists' END AS outcome
  FROM cres c LEFT JOIN cfirst f ON f.repository = c.repository AND f.branch = c.branch)"""

OK_CODES = "('created','overwritten','ignored','deleted','fetched','committed','merged','updated','stored','copied','changed','reverted','picked')"

ORACLE["create_branches"] = with_fixtures(f"""
WITH {CREATE_BASE}
SELECT seq, repository, branch, source, force, ignore_exists, hidden, outcome,
       outcome IN {OK_CODES} AS ok,
       CASE WHEN outcome IN ('created', 'overwritten') THEN source_commit END AS commit_id
FROM cout""", "fx_requests", "fx_refs", "fx_commits")

ORACLE["route_counts"] = with_fixtures(f"""
WITH {CREATE_BASE}
SELECT outcome, outcome IN {OK_CODES} AS ok, CAST(count(*) AS BIGINT) AS n FROM cout GROUP BY outcome""",
                                       "fx_requests", "fx_refs", "fx_commits")

ORACLE["delete_branches"] = with_fixtures(f"""
WITH q AS (SELECT seq, repository, {blank('branch')} AS branch, seq % 3 = 0 AS force
           FROM fx_requests WHERE op = 'delete'),
v AS (SELECT q.*, {BRANCH_ERR} AS error_code, h.commit_id AS head
      FROM q LEFT JOIN fx_refs h ON h.repository = q.repository AND h.branch = q.branch),
f AS (SELECT repository, branch, min(seq) AS first_seq FROM v
      WHERE error_code IS NULL AND head IS NOT NULL GROUP BY repository, branch),
o AS (SELECT v.*, CASE WHEN error_code IS NOT NULL THEN 'invalid'
                       WHEN head IS NOT NULL AND f.first_seq = v.seq THEN 'deleted'
                       ELSE 'branch_not_found' END AS outcome
      FROM v LEFT JOIN f ON f.repository = v.repository AND f.branch = v.branch)
SELECT seq, repository, branch, force, outcome, outcome IN {OK_CODES} AS ok,
       CASE WHEN outcome = 'deleted' THEN head END AS commit_id FROM o""", "fx_requests", "fx_refs", "fx_commits")

REF_LOG = f"""
WITH q AS (SELECT seq, repository, op, {blank('branch')} AS branch, coalesce({blank('source')}, 'main') AS source,
                  seq % 3 = 0 AS force, seq % 2 = 0 AS ignore_exists
           FROM fx_requests WHERE op IN ('create', 'delete')),
v AS (SELECT q.*, {BRANCH_ERR} AS error_code, coalesce(sb.commit_id, sc.commit_id) AS source_commit,
             h.commit_id AS head
      FROM q
      LEFT JOIN fx_refs sb ON sb.repository = q.repository AND sb.branch = q.source
      LEFT JOIN fx_commits sc ON sc.repository = q.repository AND sc.commit_id = q.source
      LEFT JOIN fx_refs h ON h.repository = q.repository AND h.branch = q.branch),
e AS (SELECT v.*, CASE WHEN error_code IS NULL AND op = 'create' AND source_commit IS NOT NULL THEN true
                       WHEN error_code IS NULL AND op = 'delete' THEN false END AS effect FROM v),
p AS (SELECT e.*, coalesce(last_value(effect IGNORE NULLS) OVER (
                    PARTITION BY repository, branch ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    head IS NOT NULL) AS exists_before FROM e),
o AS (SELECT p.*, CASE WHEN op = 'create' THEN
                    CASE WHEN error_code IS NOT NULL THEN 'invalid'
                         WHEN source_commit IS NULL THEN 'source_not_found'
                         WHEN NOT exists_before THEN 'created'
                         WHEN force THEN 'overwritten'
                         WHEN ignore_exists THEN 'ignored' ELSE 'branch_exists' END
                  ELSE CASE WHEN error_code IS NOT NULL THEN 'invalid'
                            WHEN exists_before THEN 'deleted' ELSE 'branch_not_found' END END AS outcome FROM p)"""

ORACLE["apply_ref_log"] = with_fixtures(f"""{REF_LOG}
SELECT seq, repository, op, branch, outcome, outcome IN {OK_CODES} AS ok, exists_before FROM o""",
                                        "fx_requests", "fx_refs", "fx_commits")

ORACLE["ref_log_state"] = with_fixtures(f"""{REF_LOG},
l AS (SELECT repository, branch, outcome, source_commit, seq % 11 = 0 AS hidden FROM o
      WHERE outcome IN ('created', 'overwritten', 'deleted')
      QUALIFY row_number() OVER (PARTITION BY repository, branch ORDER BY seq DESC) = 1)
SELECT repository, branch, commit_id, hidden FROM fx_refs r
WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.repository = r.repository AND l.branch = r.branch)
UNION ALL SELECT repository, branch, source_commit, hidden FROM l WHERE outcome <> 'deleted'""",
                                        "fx_requests", "fx_refs", "fx_commits")

ORACLE["fetch_branches"] = with_fixtures(f"""
WITH q AS (SELECT seq, repository, {blank('branch')} AS branch FROM fx_requests WHERE op = 'fetch'),
v AS (SELECT q.*, {BRANCH_ERR} AS error_code, r.commit_id, r.hidden
      FROM q LEFT JOIN fx_refs r ON r.repository = q.repository AND r.branch = q.branch)
SELECT seq, repository, branch, commit_id, hidden,
       CASE WHEN error_code IS NOT NULL THEN 'invalid' WHEN commit_id IS NULL THEN 'not_found' ELSE 'fetched' END AS outcome,
       error_code IS NULL AND commit_id IS NOT NULL AS ok
FROM v""", "fx_requests", "fx_refs", "fx_commits")

ORACLE["list_branches"] = with_fixtures("""
SELECT repository, branch, commit_id FROM fx_refs WHERE NOT coalesce(hidden, false)""", "fx_refs")

ORACLE["new_branches"] = with_fixtures(f"""
WITH {CREATE_BASE},
last AS (SELECT repository, branch, arg_max(source_commit, seq) AS commit_id FROM cout
         WHERE outcome IN ('created', 'overwritten') GROUP BY repository, branch),
now AS (SELECT repository, branch, commit_id FROM fx_refs r
        WHERE NOT EXISTS (SELECT 1 FROM last l WHERE l.repository = r.repository AND l.branch = r.branch)
        UNION ALL SELECT repository, branch, commit_id FROM last)
SELECT * FROM now n WHERE NOT EXISTS (SELECT 1 FROM fx_refs r WHERE r.repository = n.repository AND r.branch = n.branch)""",
                                       "fx_requests", "fx_refs", "fx_commits")

# ------------------------------------------------------------- listings ------
M60 = 1 << 60


def lane_sql(i: int, path: str, ck: str) -> str:
    start = (1, 16)[i]
    return f"CAST(('0x' || substr(md5(concat_ws('|', {path}, {ck})), {start}, 15)) AS BIGINT)"


def mod_sql(x: str) -> str:
    return f"CAST((({x}) % {M60} + {M60}) % {M60} AS VARCHAR)"


def listing_id_sql(l0: str, l1: str, n: str) -> str:
    return f"sha256(concat_ws('|', {mod_sql(l0)}, {mod_sql(l1)}, CAST({n} AS VARCHAR)))"


def classify_sql(b: str, s: str, d: str) -> str:
    return f"""CASE WHEN {s} IS NOT DISTINCT FROM {d} AND {s} IS NOT DISTINCT FROM {b} THEN 'unchanged'
            WHEN {s} IS NOT DISTINCT FROM {d} THEN 'same_change'
            WHEN {d} IS NOT DISTINCT FROM {b} THEN 'take_source'
            WHEN {s} IS NOT DISTINCT FROM {b} THEN 'keep_dest' ELSE 'conflict' END"""


ORACLE["three_way"] = with_fixtures(f"""
WITH g AS (SELECT repository, path, max(CASE WHEN side = 'base' THEN checksum END) AS b,
                  max(CASE WHEN side = 'source' THEN checksum END) AS s,
                  max(CASE WHEN side = 'dest' THEN checksum END) AS d
           FROM fx_manifest GROUP BY repository, path)
SELECT repository, {classify_sql('b', 's', 'd')} AS class, CAST(count(*) AS BIGINT) AS n FROM g GROUP BY 1, 2""",
                                    "fx_manifest")

ORACLE["listing_id"] = with_fixtures(f"""
WITH s AS (SELECT repository, meta_range_id, CAST(count(*) AS BIGINT) AS n_entries,
                  CAST(sum(size_bytes) AS BIGINT) AS total_bytes,
                  sum({lane_sql(0, 'path', 'checksum')}) AS l0, sum({lane_sql(1, 'path', 'checksum')}) AS l1
           FROM fx_entries GROUP BY 1, 2)
SELECT repository, meta_range_id, n_entries, total_bytes, {listing_id_sql('l0', 'l1', 'n_entries')} AS listing_id
FROM s""", "fx_entries")

MAIN_LISTING = """
mains AS (SELECT r.repository, r.branch, c.meta_range_id AS base_range
          FROM fx_refs r JOIN fx_commits c ON c.repository = r.repository AND c.commit_id = r.commit_id
          WHERE r.branch = 'main'),
committed AS (SELECT m.repository, m.branch, e.path, e.checksum, e.size_bytes
              FROM mains m JOIN fx_entries e ON e.repository = m.repository AND e.meta_range_id = m.base_range),
last AS (SELECT s.repository, s.branch, s.path, s.op, s.checksum, s.size_bytes
         FROM fx_staging s JOIN mains USING (repository, branch)
         QUALIFY row_number() OVER (PARTITION BY s.repository, s.branch, s.path ORDER BY s.seq DESC) = 1)"""

ORACLE["branch_view"] = with_fixtures(f"""
WITH {MAIN_LISTING}
SELECT repository, branch, path, checksum, size_bytes, 'committed' AS origin FROM committed c
WHERE NOT EXISTS (SELECT 1 FROM last l WHERE l.repository = c.repository AND l.branch = c.branch AND l.path = c.path)
UNION ALL
SELECT repository, branch, path, checksum, size_bytes, 'staged' AS origin FROM last WHERE op = 'put'""",
                                      "fx_refs", "fx_commits", "fx_entries", "fx_staging")

ORACLE["diff_branch"] = with_fixtures(f"""
WITH {MAIN_LISTING},
ch AS (SELECT l.repository, l.branch, l.path, c.checksum AS old_checksum,
              CASE WHEN l.op = 'put' THEN l.checksum END AS new_checksum
       FROM last l LEFT JOIN committed c USING (repository, branch, path))
SELECT repository, branch, path,
       CASE WHEN old_checksum IS NULL THEN 'added' WHEN new_checksum IS NULL THEN 'removed' ELSE 'changed' END AS change,
       old_checksum, new_checksum
FROM ch WHERE new_checksum IS DISTINCT FROM old_checksum""",
                                      "fx_refs", "fx_commits", "fx_entries", "fx_staging")

ORACLE["diff_refs"] = with_fixtures("""
WITH req AS (SELECT r.repository, r.branch, cm.meta_range_id AS range_a, cb.meta_range_id AS range_b
             FROM fx_refs r JOIN fx_refs m ON m.repository = r.repository AND m.branch = 'main'
             LEFT JOIN fx_commits cm ON cm.repository = m.repository AND cm.commit_id = m.commit_id
             LEFT JOIN fx_commits cb ON cb.repository = r.repository AND cb.commit_id = r.commit_id
             WHERE r.branch <> 'main'),
p AS (SELECT DISTINCT repository, range_a, range_b FROM req),
d AS (SELECT p.repository, p.range_a, p.range_b, coalesce(a.path, b.path) AS path, a.checksum AS ck_a, b.checksum AS ck_b
      FROM p
      JOIN fx_entries a ON a.repository = p.repository AND a.meta_range_id = p.range_a
      FULL JOIN fx_entries b ON b.repository = p.repository AND b.meta_range_id = p.range_b AND b.path = a.path),
d2 AS (SELECT p.repository, p.range_a, p.range_b, x.path, x.ck_a, x.ck_b FROM p,
       LATERAL (SELECT coalesce(a.path, b.path) AS path, a.checksum AS ck_a, b.checksum AS ck_b
                FROM (SELECT path, checksum FROM fx_entries WHERE repository = p.repository AND meta_range_id = p.range_a) a
                FULL JOIN (SELECT path, checksum FROM fx_entries WHERE repository = p.repository AND meta_range_id = p.range_b) b
                ON a.path = b.path) x),
c AS (SELECT repository, range_a, range_b,
             count(*) FILTER (WHERE ck_a IS NULL) AS n_added,
             count(*) FILTER (WHERE ck_b IS NULL) AS n_removed,
             count(*) FILTER (WHERE ck_a <> ck_b) AS n_changed
      FROM d2 GROUP BY 1, 2, 3)
SELECT req.repository, req.branch, CAST(coalesce(n_added, 0) AS BIGINT) AS n_added,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_changed, 0) AS BIGINT) AS n_changed
FROM req LEFT JOIN c USING (repository, range_a, range_b)""", "fx_refs", "fx_commits", "fx_entries")

# -------------------------------------------------------------- commits ------
RENDER_TS = "strftime({c}, '%Y-%m-%dT%H:%M:%S') || '+0000'"

PARENT_TEXT = """(SELECT repository, commit_id, '[' || string_agg(parent_id, ', ' ORDER BY pos) || ']' AS parents
                 FROM fx_parents GROUP BY 1, 2)"""

COMMIT_ATTRS = f"""
attrs AS (SELECT c.repository, c.commit_id, c.committer, c.message, c.meta_range_id,
                 {RENDER_TS.format(c='c.creation_date')} AS creation_date,
                 CAST(c.version AS BIGINT) AS version, CAST(c.generation AS BIGINT) AS generation,
                 coalesce(p.parents, '[]') AS parents,
                 '{{priority=' || c.k_priority || ', status=' || c.k_status || '}}' AS metadata
          FROM fx_commits c LEFT JOIN {PARENT_TEXT} p USING (repository, commit_id))"""

ORACLE["commit_attributes"] = with_fixtures(f"WITH {COMMIT_ATTRS} SELECT * FROM attrs",
                                            "fx_commits", "fx_parents")

ORACLE["metadata_map"] = with_fixtures("""
WITH m AS (SELECT repository, id, list_filter([('author', author), ('description', description), ('title', title)],
                                              lambda x: x[2] IS NOT NULL AND x[2] <> '') AS kv FROM fx_pull_requests)
SELECT repository, id, '{' || array_to_string(list_transform(kv, lambda x: x[1] || '=' || x[2]), ', ') || '}' AS metadata,
       CAST(len(kv) AS BIGINT) AS n_keys FROM m""", "fx_pull_requests")

ORACLE["fetch_commits"] = with_fixtures(f"""
WITH {COMMIT_ATTRS},
q AS (SELECT seq, repository, md5(concat(repository, ':', seq)) AS commit_id FROM fx_requests)
SELECT q.seq, q.repository, q.commit_id, a.committer, a.message, a.meta_range_id, a.creation_date, a.version,
       a.generation, a.parents,
       CASE WHEN a.commit_id IS NULL THEN 'not_found' ELSE 'fetched' END AS outcome, a.commit_id IS NOT NULL AS ok
FROM q LEFT JOIN attrs a ON a.repository = q.repository AND a.commit_id = q.commit_id""",
                                        "fx_requests", "fx_commits", "fx_parents")

ANCESTORS = """
anc(repository, seed, commit_id) AS (
  SELECT repository, seed, seed FROM seeds
  UNION
  SELECT a.repository, a.seed, p.parent_id FROM anc a
  JOIN fx_parents p ON p.repository = a.repository AND p.commit_id = a.commit_id)"""

ORACLE["merge_base"] = "WITH RECURSIVE " + with_fixtures(f"""
WITH pairs AS (SELECT r.repository, r.branch, r.commit_id AS a, m.commit_id AS b
               FROM fx_refs r JOIN fx_refs m ON m.repository = r.repository AND m.branch = 'main'
               WHERE r.branch <> 'main'),
seeds AS (SELECT DISTINCT repository, a AS seed FROM pairs UNION SELECT DISTINCT repository, b FROM pairs),
{ANCESTORS},
best AS (SELECT p.repository, p.a, p.b,
                first(c.commit_id ORDER BY c.generation DESC, c.commit_id) AS base_id,
                max(c.generation) AS base_generation
         FROM (SELECT DISTINCT repository, a, b FROM pairs) p
         JOIN anc x ON x.repository = p.repository AND x.seed = p.a
         JOIN anc y ON y.repository = p.repository AND y.seed = p.b AND y.commit_id = x.commit_id
         JOIN fx_commits c ON c.repository = p.repository AND c.commit_id = x.commit_id
         GROUP BY 1, 2, 3)
SELECT p.repository, p.branch, p.a AS head, p.b AS main_head, best.base_id,
       CAST(best.base_generation AS BIGINT) AS base_generation
FROM pairs p LEFT JOIN best USING (repository, a, b)""", "fx_refs", "fx_commits", "fx_parents")[5:]

ORACLE["log_commits"] = "WITH RECURSIVE " + with_fixtures(f"""
WITH heads AS (SELECT repository, branch AS ref_name, commit_id FROM fx_refs WHERE branch = 'main'),
seeds AS (SELECT DISTINCT repository, commit_id AS seed FROM heads),
{ANCESTORS}
SELECT h.repository, h.ref_name, c.commit_id, c.generation, c.message,
       CAST(row_number() OVER (PARTITION BY h.repository, h.ref_name ORDER BY c.generation DESC, c.commit_id) AS BIGINT)
         AS position
FROM heads h JOIN anc a ON a.repository = h.repository AND a.seed = h.commit_id
JOIN fx_commits c ON c.repository = a.repository AND c.commit_id = a.commit_id""",
                                                        "fx_refs", "fx_commits", "fx_parents")[5:]


def lane_delta_sql(i: int, path: str, old: str, new: str) -> str:
    return (f"(CASE WHEN {new} IS NOT NULL THEN {lane_sql(i, path, new)} ELSE 0 END"
            f" - CASE WHEN {old} IS NOT NULL THEN {lane_sql(i, path, old)} ELSE 0 END)")


COMMITS = f"""
WITH q AS (SELECT seq, repository, CASE WHEN trim(b) = '' THEN NULL ELSE b END AS branch,
                  concat('commit ', seq) AS message, 'unknown' AS committer,
                  CAST(epoch_ms(ts) // 1000 AS BIGINT) AS date, seq % 3 = 0 AS force, seq % 4 = 0 AS allow_empty,
                  'source=' || source AS metadata_text
           FROM (SELECT *, CASE WHEN seq % 3 = 0 THEN 'main' ELSE branch END AS b FROM fx_requests WHERE op = 'commit')),
v AS (SELECT q.*, {BRANCH_ERR} AS error_code, h.commit_id AS head, c.meta_range_id AS head_range,
             c.generation AS head_generation
      FROM q LEFT JOIN fx_refs h ON h.repository = q.repository AND h.branch = q.branch
      LEFT JOIN fx_commits c ON c.repository = q.repository AND c.commit_id = h.commit_id),
v2 AS (SELECT v.*, v.head_range AS base_range FROM v),
firsts AS (SELECT DISTINCT repository, branch, head_range AS base_range FROM v2 WHERE error_code IS NULL AND head IS NOT NULL),
last AS (SELECT s.repository, s.branch, s.path, s.op, s.checksum FROM fx_staging s JOIN firsts USING (repository, branch)
         QUALIFY row_number() OVER (PARTITION BY s.repository, s.branch, s.path ORDER BY s.seq DESC) = 1),
base AS (SELECT f.repository, f.branch, e.path, e.checksum FROM firsts f
         JOIN fx_entries e ON e.repository = f.repository AND e.meta_range_id = f.base_range),
ch AS (SELECT l.repository, l.branch, l.path, b.checksum AS old_ck, CASE WHEN l.op = 'put' THEN l.checksum END AS new_ck
       FROM last l LEFT JOIN base b USING (repository, branch, path)
       WHERE (CASE WHEN l.op = 'put' THEN l.checksum END) IS DISTINCT FROM b.checksum),
delta AS (SELECT repository, branch, count(*) AS n_changes,
                 sum({lane_delta_sql(0, 'path', 'old_ck', 'new_ck')}) AS d0,
                 sum({lane_delta_sql(1, 'path', 'old_ck', 'new_ck')}) AS d1,
                 sum(CAST(new_ck IS NOT NULL AS INTEGER) - CAST(old_ck IS NOT NULL AS INTEGER)) AS dn
          FROM ch GROUP BY 1, 2),
stats AS (SELECT e.repository, e.meta_range_id AS base_range, count(*) AS bn,
                 sum({lane_sql(0, 'e.path', 'e.checksum')}) AS b0, sum({lane_sql(1, 'e.path', 'e.checksum')}) AS b1
          FROM fx_entries e WHERE (e.repository, e.meta_range_id) IN (SELECT repository, base_range FROM firsts)
          GROUP BY 1, 2),
o0 AS (SELECT v2.*, CAST(coalesce(d.n_changes, 0) AS BIGINT) AS n_changes,
             {listing_id_sql('coalesce(s.b0, 0) + coalesce(d.d0, 0)', 'coalesce(s.b1, 0) + coalesce(d.d1, 0)',
                             'coalesce(s.bn, 0) + coalesce(d.dn, 0)')} AS new_range,
             CASE WHEN error_code IS NOT NULL THEN 'invalid' WHEN head IS NULL THEN 'branch_not_found'
                  WHEN coalesce(d.n_changes, 0) = 0 AND NOT allow_empty THEN 'nothing_to_commit' END AS no
      FROM v2 LEFT JOIN delta d USING (repository, branch) LEFT JOIN stats s USING (repository, base_range)),
f AS (SELECT repository, branch, min(seq) AS first_seq FROM o0 WHERE no IS NULL GROUP BY 1, 2),
o AS (SELECT o0.*, coalesce(no, CASE WHEN seq = first_seq THEN 'committed' ELSE 'retry_next_batch' END) AS outcome
      FROM o0 LEFT JOIN f USING (repository, branch))"""

ORACLE["commit_branches"] = with_fixtures(f"""{COMMITS}
SELECT seq, repository, branch, outcome, outcome IN {OK_CODES} AS ok, head, n_changes,
       CASE WHEN outcome = 'committed' THEN new_range END AS meta_range_id,
       CAST(CASE WHEN outcome = 'committed' THEN head_generation + 1 END AS BIGINT) AS generation,
       CASE WHEN outcome = 'committed' THEN sha256(concat_ws('|', repository, head, new_range, committer, message,
                                                              CAST(date AS VARCHAR), metadata_text)) END AS commit_id
FROM o""", "fx_requests", "fx_refs", "fx_commits", "fx_entries", "fx_staging")

ORACLE["commit_then_commit"] = with_fixtures(f"""{COMMITS},
one AS (SELECT repository, branch, head_generation + 2 AS generation, new_range,
               sha256(concat_ws('|', repository, head, new_range, committer, message, CAST(date AS VARCHAR), metadata_text)) AS head
        FROM o WHERE outcome = 'committed'),
now AS (SELECT b.repository, b.branch, b.path, b.checksum FROM base b JOIN one USING (repository, branch)
        WHERE NOT EXISTS (SELECT 1 FROM last l WHERE l.repository = b.repository AND l.branch = b.branch AND l.path = b.path)
        UNION ALL SELECT l.repository, l.branch, l.path, l.checksum FROM last l JOIN one USING (repository, branch) WHERE l.op = 'put'),
ids AS (SELECT repository, branch, count(*) AS n_entries,
               {listing_id_sql('sum(' + lane_sql(0, 'path', 'checksum') + ')', 'sum(' + lane_sql(1, 'path', 'checksum') + ')', 'count(*)')} AS listing_id
        FROM now GROUP BY 1, 2)
SELECT one.repository, one.branch, head, 'committed' AS outcome, new_range AS meta_range_id, CAST(generation AS BIGINT) AS generation,
       sha256(concat_ws('|', one.repository, head, new_range, 'unknown', 'again', '1700000000', '')) AS commit_id, n_entries, listing_id
FROM one LEFT JOIN ids USING (repository, branch)""", "fx_requests", "fx_refs", "fx_commits", "fx_entries", "fx_staging")

# --------------------------------------------------------------- merges ------
def tw_summary_sql(triples: str = "triples") -> str:
    """CTEs tsides/tw/tw_sum: per-triple class counts and source-side lane deltas."""
    parts = []
    for side, col in (("base", "base_range"), ("source", "source_range"), ("dest", "dest_range")):
        parts.append(f"""SELECT t.repository, t.base_range, t.source_range, t.dest_range, '{side}' AS side, e.path, e.checksum
  FROM {triples} t JOIN fx_entries e ON e.repository = t.repository AND e.meta_range_id = t.{col}""")
    sides = "\n  UNION ALL ".join(parts)
    deltas = []
    for tag, cls in (("ts", "take_source"), ("cf", "conflict")):
        for i in range(2):
            deltas.append(f"sum(CASE WHEN class = '{cls}' THEN {lane_delta_sql(i, 'path', 'd', 's')} ELSE 0 END) AS {tag}_d{i}")
        deltas.append(f"sum(CASE WHEN class = '{cls}' THEN CAST(s IS NOT NULL AS INTEGER) - CAST(d IS NOT NULL AS INTEGER)"
                      f" ELSE 0 END) AS {tag}_d2")
    counts = [f"count(*) FILTER (WHERE class = '{c}') AS n_{c}"
              for c in ("unchanged", "same_change", "take_source", "keep_dest", "conflict")]
    return f"""
tsides AS ({sides}),
tw AS (SELECT repository, base_range, source_range, dest_range, path,
              max(CASE WHEN side = 'base' THEN checksum END) AS b, max(CASE WHEN side = 'source' THEN checksum END) AS s,
              max(CASE WHEN side = 'dest' THEN checksum END) AS d
       FROM tsides GROUP BY 1, 2, 3, 4, 5),
twc AS (SELECT *, {classify_sql('b', 's', 'd')} AS class FROM tw),
tw_sum AS (SELECT repository, base_range, source_range, dest_range, {', '.join(counts)}, {', '.join(deltas)}
           FROM twc GROUP BY 1, 2, 3, 4)"""


def merged_range_sql(force: str) -> str:
    def lane(i):
        return (f"coalesce(ds.d{i}, 0) + coalesce(w.ts_d{i}, 0) + CASE WHEN {force} THEN coalesce(w.cf_d{i}, 0) ELSE 0 END")
    n = "coalesce(ds.dn, 0) + coalesce(w.ts_d2, 0) + CASE WHEN " + force + " THEN coalesce(w.cf_d2, 0) ELSE 0 END"
    return listing_id_sql(lane(0), lane(1), n)


DEST_STATS = f"""
dstats AS (SELECT e.repository, e.meta_range_id AS dest_range, count(*) AS dn,
                  sum({lane_sql(0, 'e.path', 'e.checksum')}) AS d0, sum({lane_sql(1, 'e.path', 'e.checksum')}) AS d1
           FROM fx_entries e GROUP BY 1, 2)"""

NCOLS = ", ".join(f"CAST(coalesce(w.n_{c}, 0) AS BIGINT) AS n_{c}"
                  for c in ("unchanged", "same_change", "take_source", "keep_dest", "conflict"))

MERGE_Q = """
q AS (SELECT seq, repository, CASE WHEN trim(branch) = '' THEN NULL ELSE branch END AS source_ref,
             'main' AS destination_branch, concat('merge ', seq) AS message, 'unknown' AS committer,
             CAST(epoch_ms(ts) // 1000 AS BIGINT) AS date, seq % 3 = 0 AS force, seq % 4 = 0 AS allow_empty
      FROM fx_requests WHERE op = 'merge'),"""

MERGE_TAIL = f"""
v AS (SELECT q.*, CASE WHEN q.source_ref IS NULL THEN 'empty:source_ref' END AS error_code,
             coalesce(sb.commit_id, sc.commit_id) AS source_commit, d.commit_id AS dest_commit
      FROM q LEFT JOIN fx_refs sb ON sb.repository = q.repository AND sb.branch = q.source_ref
      LEFT JOIN fx_commits sc ON sc.repository = q.repository AND sc.commit_id = q.source_ref
      LEFT JOIN fx_refs d ON d.repository = q.repository AND d.branch = q.destination_branch),
v1 AS (SELECT *, error_code IS NULL AND source_commit IS NOT NULL AND dest_commit IS NOT NULL AS found FROM v),
pairs AS (SELECT DISTINCT repository, source_commit AS a, dest_commit AS b FROM v1 WHERE found),
seeds AS (SELECT repository, a AS seed FROM pairs UNION SELECT repository, b FROM pairs),
{ANCESTORS},
best AS (SELECT p.repository, p.a, p.b, first(c.commit_id ORDER BY c.generation DESC, c.commit_id) AS base_id
         FROM pairs p
         JOIN anc x ON x.repository = p.repository AND x.seed = p.a
         JOIN anc y ON y.repository = p.repository AND y.seed = p.b AND y.commit_id = x.commit_id
         JOIN fx_commits c ON c.repository = p.repository AND c.commit_id = x.commit_id
         GROUP BY 1, 2, 3),
v2 AS (SELECT v1.*, best.base_id, cs.meta_range_id AS source_range, cs.generation AS source_generation,
              cd.meta_range_id AS dest_range, cd.generation AS dest_generation,
              coalesce(cb.meta_range_id, '') AS base_range
       FROM v1 LEFT JOIN best ON best.repository = v1.repository AND best.a = v1.source_commit AND best.b = v1.dest_commit
       LEFT JOIN fx_commits cs ON cs.repository = v1.repository AND cs.commit_id = v1.source_commit
       LEFT JOIN fx_commits cd ON cd.repository = v1.repository AND cd.commit_id = v1.dest_commit
       LEFT JOIN fx_commits cb ON cb.repository = v1.repository AND cb.commit_id = best.base_id),
triples AS (SELECT DISTINCT repository, base_range, source_range, dest_range FROM v2 WHERE found),
{tw_summary_sql()},
{DEST_STATS},
v3 AS (SELECT v2.*, {NCOLS}, {merged_range_sql('v2.force')} AS merged_range
       FROM v2 LEFT JOIN tw_sum w USING (repository, base_range, source_range, dest_range)
       LEFT JOIN dstats ds USING (repository, dest_range)),
v4 AS (SELECT *, found AND (n_take_source + n_conflict > 0 OR allow_empty) AND NOT (n_conflict > 0 AND NOT force)
                 AS candidate FROM v3),
ff AS (SELECT repository, destination_branch, min(seq) AS first_seq FROM v4 WHERE candidate GROUP BY 1, 2),
mo AS (SELECT v4.*, CASE WHEN error_code IS NOT NULL THEN 'invalid' WHEN NOT found THEN 'ref_not_found'
                         WHEN n_take_source + n_conflict = 0 AND NOT allow_empty THEN 'nothing_to_merge'
                         WHEN n_conflict > 0 AND NOT force THEN 'conflict'
                         WHEN v4.seq <> ff.first_seq THEN 'retry_next_batch' ELSE 'merged' END AS outcome
       FROM v4 LEFT JOIN ff USING (repository, destination_branch))"""

MERGE_CORE = MERGE_Q + MERGE_TAIL

ORACLE["merge_refs"] = "WITH RECURSIVE " + with_fixtures(f"""
WITH {MERGE_CORE}
SELECT seq, repository, source_ref, destination_branch, outcome, outcome IN {OK_CODES} AS ok, base_id,
       n_take_source, n_conflict, n_keep_dest, n_same_change, n_unchanged,
       CASE WHEN outcome = 'merged' THEN merged_range END AS meta_range_id,
       CAST(CASE WHEN outcome = 'merged' THEN greatest(dest_generation, source_generation) + 1 END AS BIGINT) AS generation,
       CASE WHEN outcome = 'merged' THEN sha256(concat_ws('|', repository, dest_commit || ',' || source_commit,
            merged_range, committer, message, CAST(date AS VARCHAR), '')) END AS commit_id
FROM mo""", "fx_requests", "fx_refs", "fx_commits", "fx_parents", "fx_entries")[5:]

ORACLE["merge_summary"] = "WITH RECURSIVE " + with_fixtures(f"""
WITH {MERGE_CORE}
SELECT repository, outcome, CAST(count(*) AS BIGINT) AS n, CAST(sum(n_conflict) AS BIGINT) AS conflicts,
       CAST(sum(n_take_source) AS BIGINT) AS taken
FROM mo GROUP BY 1, 2""", "fx_requests", "fx_refs", "fx_commits", "fx_parents", "fx_entries")[5:]


def pick_sql(revert: bool) -> str:
    base, source = ("target_range", "parent_range") if revert else ("parent_range", "target_range")
    done, nothing = ("reverted", "nothing_to_revert") if revert else ("picked", "nothing_to_pick")
    return with_fixtures(f"""
WITH q AS (SELECT 0 AS seq, repository, branch, 'main' AS commit_ref, hidden AS force FROM fx_refs WHERE branch <> 'main'),
v AS (SELECT q.*, coalesce(tb.commit_id, tc.commit_id) AS target_commit, d.commit_id AS dest_commit,
             p.parent_id AS parent_commit
      FROM q LEFT JOIN fx_refs tb ON tb.repository = q.repository AND tb.branch = q.commit_ref
      LEFT JOIN fx_commits tc ON tc.repository = q.repository AND tc.commit_id = q.commit_ref
      LEFT JOIN fx_refs d ON d.repository = q.repository AND d.branch = q.branch
      LEFT JOIN fx_parents p ON p.repository = q.repository AND p.commit_id = coalesce(tb.commit_id, tc.commit_id)
                             AND p.pos = 0),
v1 AS (SELECT v.*, ct.meta_range_id AS target_range, cp.meta_range_id AS parent_range, cd.meta_range_id AS dest_range,
              target_commit IS NOT NULL AND dest_commit IS NOT NULL AS found, parent_commit IS NOT NULL AS has_parent
       FROM v LEFT JOIN fx_commits ct ON ct.repository = v.repository AND ct.commit_id = v.target_commit
       LEFT JOIN fx_commits cp ON cp.repository = v.repository AND cp.commit_id = v.parent_commit
       LEFT JOIN fx_commits cd ON cd.repository = v.repository AND cd.commit_id = v.dest_commit),
v2 AS (SELECT v1.*, coalesce({base}, '') AS base_range, {source} AS source_range FROM v1),
triples AS (SELECT DISTINCT repository, base_range, source_range, dest_range FROM v2 WHERE found AND has_parent),
{tw_summary_sql()},
{DEST_STATS},
v3 AS (SELECT v2.*, {NCOLS}, {merged_range_sql('v2.force')} AS merged_range
       FROM v2 LEFT JOIN tw_sum w USING (repository, base_range, source_range, dest_range)
       LEFT JOIN dstats ds USING (repository, dest_range)),
o AS (SELECT *, CASE WHEN NOT found THEN 'ref_not_found' WHEN NOT has_parent THEN 'no_parent'
                     WHEN n_take_source + n_conflict = 0 THEN '{nothing}'
                     WHEN n_conflict > 0 AND NOT force THEN 'conflict' ELSE '{done}' END AS outcome FROM v3)
SELECT repository, branch, target_commit, outcome, outcome IN {OK_CODES} AS ok, n_take_source, n_conflict, n_keep_dest,
       CASE WHEN outcome = '{done}' THEN merged_range END AS meta_range_id
FROM o""", "fx_refs", "fx_commits", "fx_parents", "fx_entries")


ORACLE["revert_commit"] = pick_sql(True)
ORACLE["cherry_pick"] = pick_sql(False)

# -------------------------------------------------------- pull requests ------
LPAD_SEQ = "concat('pr_', lpad(CAST(seq AS VARCHAR), 9, '0'))"

ORACLE["create_pull_requests"] = with_fixtures(f"""
WITH q AS (SELECT seq, repository, concat('title ', seq) AS title,
                  {blank('branch')} AS source_branch,
                  {blank("CASE WHEN seq % 7 = 0 THEN branch ELSE 'main' END")} AS destination_branch
           FROM fx_requests WHERE op = 'merge'),
q2 AS (SELECT seq, repository, title, coalesce(source_branch, 'main') AS source_branch,
              coalesce(destination_branch, 'main') AS destination_branch FROM q),
v AS (SELECT q2.*, s.branch IS NOT NULL AS src_ok, d.branch IS NOT NULL AS dst_ok
      FROM q2 LEFT JOIN fx_refs s ON s.repository = q2.repository AND s.branch = q2.source_branch
      LEFT JOIN fx_refs d ON d.repository = q2.repository AND d.branch = q2.destination_branch),
o AS (SELECT *, CASE WHEN NOT (src_ok AND dst_ok) THEN 'branch_not_found'
                     WHEN source_branch = destination_branch THEN 'same_branch' ELSE 'created' END AS outcome FROM v)
SELECT seq, repository,
       CASE WHEN outcome = 'created' THEN 'pr_' || substr(sha256(concat_ws('|', repository, CAST(seq AS VARCHAR), title)), 1, 16) END AS id,
       title, source_branch, destination_branch, CASE WHEN outcome = 'created' THEN 'open' END AS status,
       outcome, outcome IN {OK_CODES} AS ok
FROM o""", "fx_requests", "fx_refs", "fx_commits")

PR_ATTRS = f"""
pa AS (SELECT repository, id, status, title, description, author, source_branch, destination_branch, merged_commit_id,
              {RENDER_TS.format(c='creation_date')} AS creation_date,
              CASE WHEN closed_date IS NOT NULL THEN {RENDER_TS.format(c='closed_date')} END AS closed_date
       FROM fx_pull_requests)"""

ORACLE["fetch_pull_requests"] = with_fixtures(f"""
WITH {PR_ATTRS},
q AS (SELECT seq, repository, {LPAD_SEQ} AS id FROM fx_requests)
SELECT q.seq, q.repository, q.id, pa.status, pa.title, pa.description, pa.author, pa.source_branch,
       pa.destination_branch, pa.merged_commit_id, pa.creation_date, pa.closed_date,
       CASE WHEN pa.id IS NULL THEN 'not_found' ELSE 'fetched' END AS outcome, pa.id IS NOT NULL AS ok
FROM q LEFT JOIN pa ON pa.repository = q.repository AND pa.id = q.id""", "fx_requests", "fx_pull_requests")

ORACLE["list_pull_requests"] = with_fixtures(f"""
WITH q AS (SELECT seq, repository,
                  CASE seq % 3 WHEN 0 THEN '' WHEN 1 THEN 'pr_00000' ELSE 'pr_000001' END AS prefix,
                  CASE WHEN seq % 2 = 0 THEN '' ELSE {LPAD_SEQ} END AS after,
                  CAST(1 + seq % 5 AS INTEGER) AS amount,
                  CASE seq % 3 WHEN 0 THEN 'open' WHEN 1 THEN 'closed' ELSE 'all' END AS status
           FROM fx_requests WHERE op = 'fetch'),
m AS (SELECT q.seq, q.repository, q.amount, p.id,
             row_number() OVER (PARTITION BY q.seq ORDER BY p.id) AS position,
             count(*) OVER (PARTITION BY q.seq) AS total
      FROM q JOIN fx_pull_requests p ON p.repository = q.repository AND starts_with(p.id, q.prefix) AND p.id > q.after
        AND (q.status = 'all' OR (q.status = 'open' AND p.status = 'open') OR (q.status = 'closed' AND p.status <> 'open'))),
s AS (SELECT seq, max(total) > max(amount) AS has_more, max(CASE WHEN position = amount THEN id END) AS last_id
      FROM m GROUP BY seq)
SELECT q.seq, q.repository, 'fetched' AS outcome, true AS ok, m.id, CAST(m.position AS BIGINT) AS position,
       coalesce(s.has_more, false) AS has_more, CASE WHEN s.has_more THEN s.last_id END AS next_after
FROM q LEFT JOIN m ON m.seq = q.seq AND m.position <= q.amount LEFT JOIN s ON s.seq = q.seq""", "fx_requests", "fx_pull_requests")

ORACLE["merge_pull_requests"] = "WITH RECURSIVE " + with_fixtures(f"""
WITH r0 AS (SELECT seq, repository, {LPAD_SEQ} AS id, CAST(epoch_ms(ts) // 1000 AS BIGINT) AS date
            FROM fx_requests WHERE op = 'create'),
r1 AS (SELECT r0.*, p.status AS pr_status, p.source_branch, p.destination_branch, p.merged_commit_id AS pr_merged
       FROM r0 LEFT JOIN fx_pull_requests p ON p.repository = r0.repository AND p.id = r0.id),
q AS (SELECT seq, repository, source_branch AS source_ref, destination_branch, concat('merge ', id) AS message,
             'unknown' AS committer, date, false AS force, false AS allow_empty
      FROM r1 WHERE pr_status = 'open'),
{MERGE_TAIL}
SELECT r1.seq, r1.repository, r1.id,
       CASE WHEN r1.pr_status IS NULL THEN 'not_found' WHEN r1.pr_status <> 'open' THEN 'not_open'
            ELSE mo.outcome END AS outcome,
       coalesce(CASE WHEN r1.pr_status IS NULL THEN 'not_found' WHEN r1.pr_status <> 'open' THEN 'not_open'
            ELSE mo.outcome END IN {OK_CODES}, false) AS ok,
       CASE WHEN mo.outcome = 'merged' THEN 'merged' ELSE r1.pr_status END AS status,
       CASE WHEN mo.outcome = 'merged' THEN sha256(concat_ws('|', mo.repository, mo.dest_commit || ',' || mo.source_commit,
            mo.merged_range, mo.committer, mo.message, CAST(mo.date AS VARCHAR), '')) ELSE r1.pr_merged END
         AS merged_commit_id,
       mo.n_conflict
FROM r1 LEFT JOIN mo ON mo.seq = r1.seq""", "fx_requests", "fx_refs", "fx_commits", "fx_parents", "fx_entries",
                                                                 "fx_pull_requests")[5:]

ORACLE["update_pull_requests"] = with_fixtures(f"""
WITH q AS (SELECT seq, repository, {LPAD_SEQ} AS id,
                  CASE WHEN seq % 2 = 0 THEN concat('retitled ', seq) END AS title,
                  CASE seq % 3 WHEN 0 THEN 'closed' WHEN 1 THEN 'open' END AS status
           FROM fx_requests WHERE op = 'fetch'),
v AS (SELECT q.*, p.status AS old_status, p.title AS old_title, p.description AS old_description
      FROM q LEFT JOIN fx_pull_requests p ON p.repository = q.repository AND p.id = q.id),
o AS (SELECT *, CASE WHEN old_status IS NULL THEN 'not_found'
                     WHEN old_status = 'merged' AND status IS NOT NULL AND status <> 'merged' THEN 'bad_transition'
                     ELSE 'updated' END AS outcome FROM v)
SELECT seq, repository, id, outcome, outcome IN {OK_CODES} AS ok,
       CASE WHEN outcome = 'updated' THEN coalesce(status, old_status) ELSE old_status END AS status,
       CASE WHEN outcome = 'updated' THEN coalesce(title, old_title) ELSE old_title END AS title,
       old_description AS description
FROM o""", "fx_requests", "fx_pull_requests")

# -------------------------------------------------------------- objects ------
MAIN_VIEW = MAIN_LISTING + """,
view AS (SELECT repository, branch, path, checksum, size_bytes FROM committed c
         WHERE NOT EXISTS (SELECT 1 FROM last l WHERE l.repository = c.repository AND l.branch = c.branch AND l.path = c.path)
         UNION ALL SELECT repository, branch, path, checksum, size_bytes FROM last WHERE op = 'put')"""

ORACLE["put_objects"] = with_fixtures(f"""
WITH {MAIN_VIEW},
q AS (SELECT doc_id AS seq, repository, 'main' AS branch, regexp_replace(path, '/[^/]*$', '/latest.txt') AS path,
             content, doc_id % 2 = 0 AS overwrite FROM fx_objects),
v AS (SELECT q.*, b.branch IS NOT NULL AS branch_ok, w.checksum AS visible
      FROM q LEFT JOIN fx_refs b ON b.repository = q.repository AND b.branch = q.branch
      LEFT JOIN view w ON w.repository = q.repository AND w.branch = q.branch AND w.path = q.path),
f AS (SELECT repository, branch, path, min(seq) AS first_seq FROM v WHERE branch_ok GROUP BY 1, 2, 3),
o AS (SELECT v.*, CASE WHEN NOT branch_ok THEN 'branch_not_found'
                       WHEN NOT overwrite AND (visible IS NOT NULL OR f.first_seq < v.seq) THEN 'exists'
                       ELSE 'stored' END AS outcome
      FROM v LEFT JOIN f USING (repository, branch, path))
SELECT seq, repository, branch, path, sha256(content) AS checksum, CAST(octet_length(content) AS BIGINT) AS size_bytes,
       outcome, outcome IN {OK_CODES} AS ok FROM o""", "fx_objects", "fx_refs", "fx_commits", "fx_entries", "fx_staging")

ORACLE["fetch_objects"] = with_fixtures(f"""
WITH staging2 AS (SELECT repository, branch, path, op, checksum, size_bytes, seq FROM fx_staging
                  UNION ALL
                  SELECT repository, 'main', path, 'put', sha256(content), size_bytes, doc_id FROM fx_objects
                  WHERE repository IN (SELECT repository FROM fx_refs WHERE branch = 'main')),
contents AS (SELECT DISTINCT sha256(content) AS checksum, content FROM fx_objects),
q AS (SELECT doc_id AS seq, repository,
             CASE WHEN doc_id % 4 = 0 THEN md5(concat(repository, ':1')) ELSE 'main' END AS ref, path FROM fx_objects),
r AS (SELECT q.*, coalesce(rb.commit_id, rc.commit_id) AS ref_commit,
             CASE WHEN rb.commit_id IS NOT NULL THEN 'branch' WHEN rc.commit_id IS NOT NULL THEN 'commit' END AS ref_kind
      FROM q LEFT JOIN fx_refs rb ON rb.repository = q.repository AND rb.branch = q.ref
      LEFT JOIN fx_commits rc ON rc.repository = q.repository AND rc.commit_id = q.ref),
r2 AS (SELECT r.*, e.checksum AS c_ck FROM r
       LEFT JOIN fx_commits c ON c.repository = r.repository AND c.commit_id = r.ref_commit
       LEFT JOIN fx_entries e ON e.repository = r.repository AND e.meta_range_id = c.meta_range_id AND e.path = r.path),
last AS (SELECT * FROM staging2 QUALIFY row_number() OVER (PARTITION BY repository, branch, path ORDER BY seq DESC) = 1),
r3 AS (SELECT r2.*, CASE WHEN l.op IS NOT NULL THEN CASE WHEN l.op = 'put' THEN l.checksum END ELSE c_ck END AS checksum
       FROM r2 LEFT JOIN last l ON r2.ref_kind = 'branch' AND l.repository = r2.repository AND l.branch = r2.ref
                               AND l.path = r2.path),
o AS (SELECT r3.*, CASE WHEN r3.ref_commit IS NULL THEN 'ref_not_found' WHEN r3.checksum IS NULL THEN 'path_not_found'
                        ELSE 'fetched' END AS outcome, ct.content
      FROM r3 LEFT JOIN contents ct ON ct.checksum = r3.checksum)
SELECT seq, repository, ref, path, outcome, outcome = 'fetched' AS ok,
       CASE WHEN outcome = 'fetched' THEN regexp_extract(path, '([^/]*)$', 1) END AS file_name,
       CASE WHEN outcome = 'fetched' THEN CAST(octet_length(content) AS BIGINT) END AS file_length,
       sha256(content) AS content_sha
FROM o""", "fx_objects", "fx_refs", "fx_commits", "fx_entries", "fx_staging")

PATH_REQ = f"""
q AS (SELECT seq, repository, 'main' AS ref, 'main' AS branch,
             concat('orders/', CASE WHEN seq % 2 = 0 THEN 'O' ELSE 'F' END, '/', seq) AS path FROM fx_requests),
r AS (SELECT q.*, rb.commit_id AS ref_commit, CASE WHEN rb.commit_id IS NOT NULL THEN 'branch' END AS ref_kind
      FROM q LEFT JOIN fx_refs rb ON rb.repository = q.repository AND rb.branch = q.ref),
r3 AS (SELECT r.*, w.checksum, w.size_bytes FROM r
       LEFT JOIN view w ON w.repository = r.repository AND w.branch = r.ref AND w.path = r.path),
o AS (SELECT r3.*, CASE WHEN ref_commit IS NULL THEN 'ref_not_found' WHEN checksum IS NULL THEN 'path_not_found'
                        ELSE 'fetched' END AS outcome FROM r3)"""

ORACLE["stat_objects"] = with_fixtures(f"""
WITH {MAIN_VIEW}, {PATH_REQ}
SELECT seq, repository, ref, path, checksum, size_bytes, outcome, outcome = 'fetched' AS ok FROM o""",
                                       "fx_requests", "fx_refs", "fx_commits", "fx_entries", "fx_staging")

ORACLE["head_objects"] = with_fixtures(f"""
WITH {MAIN_VIEW}, {PATH_REQ}
SELECT seq, repository, path FROM o WHERE outcome = 'fetched'""",
                                       "fx_requests", "fx_refs", "fx_commits", "fx_entries", "fx_staging")

ORACLE["delete_objects"] = with_fixtures(f"""
WITH {MAIN_VIEW}, {PATH_REQ},
f AS (SELECT repository, branch, path, min(seq) AS first_seq FROM o WHERE outcome = 'fetched' GROUP BY 1, 2, 3)
SELECT o.seq, o.repository, o.branch, o.path,
       CASE WHEN ref_commit IS NULL THEN 'branch_not_found' WHEN checksum IS NULL OR f.first_seq <> o.seq
            THEN 'path_not_found' ELSE 'deleted' END AS outcome,
       ref_commit IS NOT NULL AND checksum IS NOT NULL AND f.first_seq = o.seq AS ok
FROM o LEFT JOIN f USING (repository, branch, path)""",
                                         "fx_requests", "fx_refs", "fx_commits", "fx_entries", "fx_staging")

ORACLE["copy_objects"] = with_fixtures(f"""
WITH {MAIN_VIEW}, {PATH_REQ}
SELECT seq, repository, branch, path, concat('copies/', path) AS dest_path, checksum,
       CASE WHEN ref_commit IS NULL THEN 'branch_not_found' WHEN checksum IS NULL THEN 'path_not_found'
            ELSE 'copied' END AS outcome,
       ref_commit IS NOT NULL AND checksum IS NOT NULL AS ok
FROM o""", "fx_requests", "fx_refs", "fx_commits", "fx_entries", "fx_staging")

ORACLE["reset_branch"] = with_fixtures("""
SELECT s.repository, s.branch, s.path, s.op, s.checksum, s.size_bytes FROM fx_staging s
WHERE NOT (starts_with(s.path, 'orders/O/')
           AND EXISTS (SELECT 1 FROM fx_refs r WHERE r.repository = s.repository AND r.branch = s.branch
                       AND r.branch = 'main'))""", "fx_staging", "fx_refs", "fx_commits")

ORACLE["list_objects"] = with_fixtures(f"""
WITH {MAIN_VIEW},
x AS (SELECT repository, branch, size_bytes, substr(path, length('orders/') + 1) AS rest, path FROM view
      WHERE starts_with(path, 'orders/') AND path > '')
SELECT repository, branch,
       CASE WHEN instr(rest, '/') > 0 THEN 'orders/' || substr(rest, 1, instr(rest, '/') - 1) || '/' ELSE path END AS entry,
       CASE WHEN instr(rest, '/') > 0 THEN 'prefix' ELSE 'object' END AS kind,
       CAST(count(*) AS BIGINT) AS n_objects, CAST(sum(size_bytes) AS BIGINT) AS total_bytes
FROM x GROUP BY 1, 2, 3, 4""", "fx_refs", "fx_commits", "fx_entries", "fx_staging")

ORACLE["symlink_manifest"] = with_fixtures(f"""
WITH {MAIN_VIEW}
SELECT repository, branch, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, CAST(count(*) AS BIGINT) AS n_files,
       CAST(sum(size_bytes) AS BIGINT) AS total_bytes
FROM view GROUP BY 1, 2, 3""", "fx_refs", "fx_commits", "fx_entries", "fx_staging")

# ------------------------------------------------------------------ watch ----
WAIT_SQL = """
SELECT repository, branch, seq, observed_at, commit_id FROM (
  SELECT *, lag(commit_id) OVER (PARTITION BY repository, branch ORDER BY seq) AS prev FROM fx_observations) t
WHERE commit_id IS NOT NULL AND (prev IS NULL OR prev <> commit_id)"""

ORACLE["wait_commits"] = with_fixtures(WAIT_SQL, "fx_observations")

ORACLE["poll_sample"] = with_fixtures("""
WITH s AS (SELECT repository, branch, date_trunc('hour', observed_at) AS window_start, seq, commit_id
           FROM fx_observations
           QUALIFY row_number() OVER (PARTITION BY repository, branch, date_trunc('hour', observed_at) ORDER BY seq DESC) = 1)
SELECT repository, branch, window_start, commit_id FROM (
  SELECT *, lag(commit_id) OVER (PARTITION BY repository, branch ORDER BY seq) AS prev FROM s) t
WHERE commit_id IS NOT NULL AND (prev IS NULL OR prev <> commit_id)""", "fx_observations")

ORACLE["changed_since"] = with_fixtures(f"""
WITH cnt AS (SELECT repository, count(*) AS cnt FROM fx_commits GROUP BY 1),
q AS (SELECT r.seq, r.repository, {blank('r.branch')} AS branch,
             CASE WHEN r.seq % 4 = 0 THEN md5(r.repository || ':' ||
                       CAST(1 + (TRY_CAST(substr(r.branch, 3, 20) AS BIGINT) * 37) % c.cnt AS VARCHAR))
                  ELSE md5(concat(r.repository, ':', r.seq)) END AS previous_commit_id
      FROM fx_requests r LEFT JOIN cnt c ON c.repository = r.repository WHERE r.op = 'fetch'),
v AS (SELECT q.*, h.commit_id AS head FROM q LEFT JOIN fx_refs h ON h.repository = q.repository AND h.branch = q.branch)
SELECT seq, repository, branch, previous_commit_id, head,
       CASE WHEN branch IS NULL THEN 'invalid' WHEN head IS NULL THEN 'branch_not_found'
            WHEN head IS NOT DISTINCT FROM previous_commit_id THEN 'unchanged' ELSE 'changed' END AS outcome,
       branch IS NOT NULL AND head IS NOT NULL AND head IS DISTINCT FROM previous_commit_id AS ok
FROM v""", "fx_requests", "fx_refs", "fx_commits")

ORACLE["stream_wait_commits"] = ORACLE["wait_commits"]

ORACLE["stream_new_branches"] = with_fixtures(f"""
WITH {CREATE_BASE},
last AS (SELECT repository, branch, arg_max(source_commit, seq) AS commit_id FROM cout
         WHERE outcome IN ('created', 'overwritten') GROUP BY repository, branch)
SELECT repository, branch, commit_id FROM fx_refs
UNION ALL
SELECT repository, branch, commit_id FROM last l
WHERE NOT EXISTS (SELECT 1 FROM fx_refs r WHERE r.repository = l.repository AND r.branch = l.branch)""",
                                              "fx_requests", "fx_refs", "fx_commits")

# ------------------------------------------- the forms over every ref ---------
_ON_MAIN = "'main' AS branch,\n             concat('orders/'"
_SPREAD = ("CASE WHEN l_orderkey % 3 = 0 THEN 'main' ELSE concat('b_', l_orderkey % 5 + 5 * (1 + l_orderkey % 25)) END AS branch,\n"
           "             concat('orders/'")


def over_every_ref(sql: str) -> str:
    """The SQL of a query on ``main`` without its filter, with staging on many branches."""
    return (sql.replace("WHERE r.branch = 'main'", "").replace("FROM fx_refs WHERE branch = 'main'", "FROM fx_refs")
            .replace(_ON_MAIN, _SPREAD))


# (the view of every branch has millions of rows at sf0.01: tests compare it at sf0.001)
ALL_REFS_ORACLE = {f"{name}_all": over_every_ref(ORACLE[name]) for name in ("diff_branch", "list_objects", "symlink_manifest", "log_commits")}
