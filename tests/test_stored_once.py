"""What a lookup needs is stored and moved once: no second copy of staging, no other refs and commits, no old shuffle files."""

import time

from pyspark.sql import functions as F

from strata.operators import objects as OB
from strata.plans import queries as Q
from strata.sources import fixtures
from strata.sources.tables import read_state, write_state
from tests.conftest import SF_SMALL, rows

ENTRY = "repository string, meta_range_id string, path string, physical_address string, checksum string, size_bytes long"


def test_few_refs_leave_other_refs_and_commits_in_place(spark, monkeypatch):
    refs = spark.createDataFrame([("r", f"b{i}", f"c{i % 50}", False) for i in range(200)] + [("r", "b1", "c7", False), ("r", None, "c1", False), (None, "b1", "c1", False)],
                                 "repository string, branch string, commit_id string, hidden boolean")
    commits = spark.createDataFrame([("r", f"c{i}", f"m{i}", i) for i in range(300)] + [("r", "c299", "m5", 1), ("r", None, "m1", 1), ("s", "c1", "m9", 1)],
                                    "repository string, commit_id string, meta_range_id string, generation long")
    entries = spark.createDataFrame([("r", f"m{i}", "p", None, f"k{i}", i) for i in range(300)], ENTRY)
    staging = spark.createDataFrame([("r", "b2", "p", "delete", None, None, None, 1), ("r", "b3", "p", "put", "a", "k", 9, 2)],
                                    "repository string, branch string, path string, op string, physical_address string, checksum string, size_bytes long, seq long")
    asked = [(1, "r", "b1", "p"), (2, "r", "b2", "p"), (3, "r", "b3", "p"), (4, "r", "c299", "p"), (5, "r", "no", "p"), (6, "r", None, "p"), (7, None, "b1", "p"), (8, "r", "b0", "q")]
    req = spark.createDataFrame(asked, "seq long, repository string, ref string, path string")
    seen, resolve = [], OB.resolve_refs

    def resolved(df, refs, commits, **kw):
        seen.append((refs.count(), commits.count()))
        return resolve(df, refs, commits, **kw)

    monkeypatch.setattr(OB, "resolve_refs", resolved)
    got = OB.stat_objects(req, refs, commits, entries, staging)
    want = [(1, "k1", "fetched"), (1, "k7", "fetched"), (2, None, "path_not_found"), (3, "k", "fetched"), (4, "k299", "fetched"), (4, "k5", "fetched"), (4, "k299", "fetched"),
            (4, "k5", "fetched"), (5, None, "ref_not_found"), (6, None, "invalid"), (7, None, "invalid"), (8, None, "path_not_found")]
    assert rows(got, "seq", "checksum", "outcome") == sorted(want, key=repr)
    assert seen == [(5, 7)]  # b0, b1 twice, b2, b3; their commits c0, c1, c7, c2, c3 and the two rows of c299
    monkeypatch.setattr(OB, "small_side", lambda keys: keys)  # many refs: nothing is looked up before
    assert rows(OB.stat_objects(req, refs, commits, entries, staging), "seq", "checksum", "outcome") == sorted(want, key=repr)
    assert seen[1] == (refs.count(), commits.count())


def test_a_stored_table_leaves_no_shuffle_files(spark, tmp_path):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        it, out = manager.getAllFiles().iterator(), set()
        while it.hasNext():
            out.add(it.next().getName())
        return {f for f in out if f.startswith("shuffle_") and f.endswith(".data")}

    before = files()
    df = spark.range(20_000).selectExpr("concat('r', id % 3) AS repository", "id").repartition(4, "id")
    write_state(df, str(tmp_path / "t"), cluster_by=("id",))
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before
    assert df.count() == read_state(spark, str(tmp_path / "t")).count() == 20_000


def test_staging_and_addresses_are_stored_once(spark):
    fx = fixtures.Fixtures(spark, SF_SMALL)
    staging, _ = Q._state_after_doc_puts(fx)
    stored = {name: df for (app, d, name), df in fixtures._STORED.items() if (app, d) == (spark.sparkContext.applicationId, SF_SMALL)}
    assert stored["staged_puts"].count() == fx.objects.join(fx.refs.where("branch = 'main'"), "repository").count()
    assert staging.count() == fx.staging.count() + stored["staged_puts"].count() and not staging.where("NOT physical_address <=> checksum").count()
    for name, df in (("entries", fx.entries), ("staging", fx.staging)):
        assert "physical_address" not in stored[name].columns and "physical_address" in df.columns
        assert not df.where(~F.col("physical_address").eqNullSafe(F.col("checksum"))).count()
