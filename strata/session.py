"""Session helpers: settings the operators rely on, and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every strata job expects.  Timestamps in the state tables are naive
# UTC, so the session zone is pinned; AQE re-plans joins (broadcast by runtime
# size), coalesces small shuffles and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of released RDDs are removed (chunked windows and
    # graph walks checkpoint on every call)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """A session for tests and the bench (a cluster passes its own session)."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    and Spark runs in one local process (tests) a private folder is created.
    On a cluster the setting must name shared storage, so that checkpoints and
    stored tables survive the loss of an executor: without it, this fails.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if d is None and sc_dir:
        d = sc_dir
    if d is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc_dir:
        spark.sparkContext.setCheckpointDir(d)
    return d


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written here go when it ends, not when the driver
    happens to collect its garbage: the table that was written replaces them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (for written tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"
