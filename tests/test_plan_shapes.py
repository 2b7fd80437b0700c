"""Physical plan shapes that matter at scale (checked with the executed plan)."""
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from strata.operators import listing as L
from strata.operators.wait import wait_commits
from strata.sources.fixtures import Fixtures
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_request_filters_and_columns_reach_the_scan(spark):
    plan = _plan(entry.queries()["fetch_branches"](spark, SF_SMALL))
    scan = [ln for ln in plan.splitlines() if "FileScan" in ln and "events" in ln][0]
    assert "EqualTo(event_type,click)" in scan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in scan


def test_three_way_is_one_shuffle_on_path(spark):
    fx = Fixtures(spark, SF_SMALL)
    tw = L.three_way(fx.manifest.select("repository", "side", "path", "checksum"), ["repository"])
    plan = tw._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(shuffles) == 1 and "path" in shuffles[0]


def test_order_dependent_windows_are_chunked(spark):
    fx = Fixtures(spark, SF_SMALL)
    plan = _plan(wait_commits(fx.observations))
    windows = [ln for ln in plan.splitlines() if "Window [" in ln or re.search(r"\bWindow\b", ln)]
    assert windows
    assert "rangepartitioning" in plan.lower() or "_chunk" in plan
    for ln in plan.splitlines():
        m = re.search(r"windowspecdefinition\(([^,]+), ([^,]+), ", ln)
        if m and "seq" in ln and "_chunk" not in ln:
            raise AssertionError("per-branch window without chunking: " + ln[:200])


def test_listing_lookup_broadcasts_the_key_side(spark):
    fx = Fixtures(spark, SF_SMALL)
    keys = fx.refs.where(F.col("branch") == "main").join(
        fx.commits.select("repository", "commit_id", "meta_range_id"), ["repository", "commit_id"])
    plan = _plan(L.listing_rows(keys.select("repository", "meta_range_id"), fx.entries))
    assert "BroadcastHashJoin" in plan
    assert not re.search(r"Exchange hashpartitioning\(_l_repo[^)]*_l_mr", plan)


def test_object_reads_join_on_the_content_partition_key(spark):
    """Fetches join ``contents`` on (prefix, checksum): the partition column is
    a join key, which is what lets dynamic partition pruning skip content
    partitions (applied by the optimizer when it estimates a benefit)."""
    plan = _plan(entry.queries()["fetch_objects"](spark, SF_SMALL))
    joins = [ln for ln in plan.splitlines() if "Join" in ln and "substring(physical_address" in ln and "_p#" in ln]
    assert joins, "contents join does not use the partition column"
