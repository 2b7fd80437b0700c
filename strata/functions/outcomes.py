"""Typed outcome codes (instead of searching error texts) and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed outcome codes, grouped by operator.
INVALID = "invalid"
NOT_FOUND = "not_found"
BRANCH_NOT_FOUND = "branch_not_found"
SOURCE_NOT_FOUND = "source_not_found"
REF_NOT_FOUND = "ref_not_found"
PATH_NOT_FOUND = "path_not_found"
CREATED = "created"
OVERWRITTEN = "overwritten"
IGNORED = "ignored"
BRANCH_EXISTS = "branch_exists"
DELETED = "deleted"
FETCHED = "fetched"
COMMITTED = "committed"
NOTHING_TO_COMMIT = "nothing_to_commit"
HEAD_MOVED = "head_moved"
RETRY_NEXT_BATCH = "retry_next_batch"
METARANGE_NOT_FOUND = "metarange_not_found"
MERGED = "merged"
NOTHING_TO_MERGE = "nothing_to_merge"
CONFLICT = "conflict"
SAME_BRANCH = "same_branch"
NOT_OPEN = "not_open"
UPDATED = "updated"
BAD_TRANSITION = "bad_transition"
STORED = "stored"
EXISTS = "exists"
COPIED = "copied"
CHANGED = "changed"
UNCHANGED = "unchanged"
REVERTED = "reverted"
NOTHING_TO_REVERT = "nothing_to_revert"
NO_PARENT = "no_parent"
PICKED = "picked"
NOTHING_TO_PICK = "nothing_to_pick"
RESET = "reset"
NOTHING_TO_RESET = "nothing_to_reset"

SUCCESS = frozenset({CREATED, OVERWRITTEN, IGNORED, DELETED, FETCHED, COMMITTED, MERGED,
                     UPDATED, STORED, COPIED, CHANGED, REVERTED, PICKED, RESET})


def ok_col(outcome: Column | str = "outcome") -> Column:
    c = F.col(outcome) if isinstance(outcome, str) else outcome
    return c.isin(*sorted(SUCCESS))


def first_match(*cases: tuple[Column, str], default: str) -> Column:
    """Outcome by precedence: the first true condition names the code."""
    expr = None
    for cond, code in cases:
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def route(df: DataFrame, outcome: str = "outcome") -> tuple[DataFrame, DataFrame]:
    """Split outcomes into (success, failure) DataFrames; failures are kept."""
    ok = F.coalesce(ok_col(outcome), F.lit(False))   # a null outcome is a failure
    return df.where(ok), df.where(~ok)


def route_each(write_ok, write_failed, outcome: str = "outcome"):
    """``foreachBatch`` function for streams: each micro-batch is computed once
    and its two routes go to the two writers (called with rows and batch id)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            ok, failed = route(batch, outcome)
            write_ok(ok, batch_id)
            write_failed(failed, batch_id)
        finally:
            batch.unpersist()
    return run


def write_once(path: str):
    """A writer for ``route_each``: the rows of a batch replace what an earlier
    try of the same batch wrote, so a restart repeats nothing.  Read the folder
    as a table; ``batch`` is a column of it."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")
    return write


def route_counts(df: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Outcome histogram (the relation sizes of the success/failure routes)."""
    return (df.groupBy(F.col(outcome).alias("outcome"))
              .agg(F.count(F.lit(1)).cast("long").alias("n"))
              .withColumn("ok", ok_col("outcome")))
