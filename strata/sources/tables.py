"""Readers for the driver's tables and the strata state tables (parquet)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.session import shuffle_files_removed

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")


_READ: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into the
    scan.  The relation (file listing, footer schema) is built once per
    application and path."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _READ.get(key)
    if df is None:
        df = _READ[key] = spark.read.parquet(path)
    return df


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """A state table written by ``write_state`` (partition pruning on repository)."""
    return spark.read.parquet(path)


def write_state(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("repository",),
                mode: str = "overwrite", cluster_by: tuple[str, ...] = (), derive: Callable[[DataFrame], DataFrame] | None = None,
                range_by: tuple[str, ...] | None = None) -> None:
    """Write a state table partitioned by repository (the leading key of every table).

    Rows are range-partitioned on (partition columns, ``cluster_by``) and
    sorted within files, so each directory gets few files, files are sorted
    by the lookup key (row-group min/max pruning), and a huge partition
    value is still split over several writer tasks.  ``derive`` makes the table's
    columns of the rows once they are in place, so that what follows from few source
    columns is not moved; ``range_by`` names source columns that group and order them
    as the keys do (none: the rows are in place).  Shuffle files go once the table is there."""
    keys = [*partition_by, *cluster_by]
    if keys:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        by = keys if range_by is None else range_by
        df = df.repartitionByRange(n, *by) if by else df
        df = (derive(df) if derive else df).sortWithinPartitions(*keys)
    with shuffle_files_removed(df.sparkSession):
        df = df.select("*")  # planned anew: what the caller holds keeps its files
        w = df.write.mode(mode).option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
