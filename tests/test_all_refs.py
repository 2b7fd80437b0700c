"""The queries over every ref equal the SQL of their ``main`` form without its
filter on ``main``, with the staging rows dealt to the same branches."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from strata.plans.oracle import ORACLE
from strata.plans.queries import ALL_REFS
from strata.sources.tables import DRIVER_TABLES

SPREAD = ("CASE WHEN l_orderkey % 3 = 0 THEN 'main' "
          "ELSE concat('b_', l_orderkey % 5 + 5 * (1 + l_orderkey % 25)) END AS branch,\n       concat('orders/'")


def widened(name):
    sql = ORACLE[name]
    for old, new in (("WHERE r.branch = 'main'", ""), ("FROM fx_refs WHERE branch = 'main'", "FROM fx_refs"),
                     ("'main' AS branch,\n             concat('orders/'", SPREAD)):
        assert sql.count(old) <= 1
        sql = sql.replace(old, new)
    assert "= 'main'" not in sql and sql != ORACLE[name]
    assert "fx_staging" not in sql or SPREAD in sql
    return sql


@pytest.mark.parametrize("name", ["branch_view", "diff_branch", "list_objects", "symlink_manifest", "log_commits"])
def test_every_ref(spark, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    assert entry.queries()[name + "_all"] is ALL_REFS[name + "_all"]
    sdf = entry.queries()[name + "_all"](spark, SF_SMALL)
    got = sorted((tuple(r[c] for c in sorted(sdf.columns)) for r in sdf.collect()), key=repr)
    cur = con.execute(widened(name))
    names = [d[0] for d in cur.description]
    at = sorted(range(len(names)), key=lambda i: names[i])
    assert sorted(names) == sorted(sdf.columns)
    assert got == sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=repr)
    branch = sorted(sdf.columns).index("ref_name" if name == "log_commits" else "branch")
    assert len({r[branch] for r in got}) > 20
