from tests.conftest import SF_SMALL
from strata.operators import listing as L
from strata.sources.fixtures import Fixtures


def test_diff_outcomes(spark):
    fx = Fixtures(spark, SF_SMALL)
    heads = {r.branch: r.commit_id for r in fx.refs.where("repository = 'repo_1'").collect()}
    some = next(b for b in heads if b != "main")
    reqs = [(1, "repo_1", "main", some), (2, "repo_1", "main", "main"), (3, "repo_1", "nope", "main"), (4, "repo_1", "", "main"),
            (5, "repo_1", heads["main"], some), (6, None, "main", "main")]
    df = spark.createDataFrame(reqs, "seq long, repository string, left_ref string, right_ref string")
    got = {r.seq: r for r in L.diff_refs(df, fx.refs, fx.commits, fx.entries).collect()}
    assert [got[i].outcome for i in (2, 3, 4, 6)] == ["fetched", "ref_not_found", "invalid", "invalid"]
    assert [got[i].ok for i in (1, 2, 3, 4)] == [True, True, False, False] and got[3].n_added is None
    assert got[1][-5:] == got[5][-5:] and got[2].n_added == 0
    reqs = [(1, "repo_1", "main"), (2, "repo_1", "nope"), (3, "repo_1", " "), (4, "repo_1", some), (5, "repo_1", "main")]
    df = spark.createDataFrame(reqs, "seq long, repository string, branch string")
    got = {r.seq: r for r in L.diff_branch(df, fx.refs, fx.commits, fx.entries, fx.staging).collect()}
    assert [got[i].outcome for i in range(1, 6)] == ["fetched", "branch_not_found", "invalid", "fetched", "fetched"]
    assert got[1].n_changed == got[5].n_changed > 0 and got[4].n_changed == 0
