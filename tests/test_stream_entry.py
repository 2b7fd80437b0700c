"""Streams equal their batch forms; the driver entry points are consistent."""
import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from strata.operators.wait import wait_commits
from strata.sources.fixtures import Fixtures, observations_from
from strata.streaming import watch as ST
from tests.conftest import SF_SMALL, rows


def test_wait_stream_multi_batch_and_restart(spark, tmp_path):
    fx = Fixtures(spark, SF_SMALL)
    events = fx.table("events")
    src = str(tmp_path / "events")
    # three micro-batches in arrival (= seq) order, each mixing branches
    n = events.count()
    for i in range(3):
        part = events.where((F.col("event_id") >= i * n // 3) & (F.col("event_id") < (i + 1) * n // 3))
        part.coalesce(1).write.mode("append").parquet(src)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)
    ST.run_available(ST.wait_commits_stream(observations_from(stream)), out, ck)
    first = spark.read.parquet(out).count()
    # restart on the same checkpoint: nothing new, no duplicates
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)
    ST.run_available(ST.wait_commits_stream(observations_from(stream)), out, ck)
    got = spark.read.parquet(out)
    assert got.count() == first
    want = wait_commits(fx.observations)
    cols = ("repository", "branch", "seq", "commit_id")
    assert rows(got, *cols) == rows(want, *cols)


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    from strata.plans.oracle import ORACLE
    from strata.plans.queries import QUERIES
    assert set(ORACLE) == set(QUERIES) and len(QUERIES) == 45
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_small_queries_match_oracle(spark):
    import duckdb
    from strata.sources.tables import DRIVER_TABLES
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    for name in ("three_way", "wait_commits", "list_pull_requests", "commit_branches", "apply_ref_log"):
        sdf = entry.queries()[name](spark, SF_SMALL)
        got = sorted(map(repr, (tuple(r[c] for c in sorted(sdf.columns)) for r in sdf.collect())))
        cur = con.execute(entry.oracle_sql()[name])
        names = [d[0] for d in cur.description]
        idx = sorted(range(len(names)), key=lambda i: names[i])
        want = sorted(map(repr, (tuple(r[i] for i in idx) for r in cur.fetchall())))
        assert got == want, name


def test_poll_sample_stream_equals_batch(spark, tmp_path):
    from strata.operators.wait import poll_sample
    fx = Fixtures(spark, SF_SMALL)
    events = fx.table("events")
    src = str(tmp_path / "events")
    events.coalesce(1).write.parquet(src)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    stream = spark.readStream.schema(events.schema).parquet(src)
    ST.run_available(ST.poll_sample_stream(observations_from(stream)), out, ck)
    got = spark.read.parquet(out)
    want = poll_sample(fx.observations)
    cols = ("repository", "branch", "window_start", "seq", "commit_id")
    # append mode emits a window once the watermark passes its end: all but
    # the newest window per run are final
    last = want.agg(F.max("window_start")).first()[0]
    assert rows(got, *cols) == rows(want.where(F.col("window_start") < last), *cols)


def test_wait_stream_ignores_late_looks(spark, tmp_path):
    schema = "repository string, branch string, seq long, observed_at timestamp_ntz, commit_id string"
    src = str(tmp_path / "obs")
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    first = spark.createDataFrame([("r", "a", 5, "c1"), ("r", "a", 6, "c2")],
                                  "repository string, branch string, seq long, commit_id string")
    late = spark.createDataFrame([("r", "a", 4, "c9"), ("r", "a", 7, "c2"), ("r", "a", 8, "c3")],
                                 "repository string, branch string, seq long, commit_id string")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for df in (first, late):
        df.withColumn("observed_at", ts).select("repository", "branch", "seq", "observed_at", "commit_id") \
          .coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        ST.run_available(ST.wait_commits_stream(stream), out, ck)
    assert rows(spark.read.parquet(out), "seq", "commit_id") == [(5, "c1"), (6, "c2"), (8, "c3")]
