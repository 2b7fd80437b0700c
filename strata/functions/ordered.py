"""Order-dependent window work that stays safe when one group is huge.

A plain ``Window.partitionBy(key).orderBy(seq)`` sends every row of a key to
one task.  Keys here are repositories and branches, and one of them may hold
a third of all rows (a busy ``main``).  The helpers below range-partition on
``(key, order)`` so a hot key is cut into several contiguous chunks, run the
window inside each chunk, and repair chunk borders with a per-chunk summary
(one row per key and chunk, so bounded by keys + partitions).  AQE decides at
run time whether that summary is broadcast.

Range bounds come from sampling, and the sample seed depends on the RDD, so
two plan branches that each re-run the range exchange could disagree about
chunk borders.  ``with_chunks`` therefore pins the chunked rows with a
reliable, lazy ``checkpoint()`` (written under ``spark.checkpoint.dir``):
every branch reads the same RDD, and a lost executor recomputes it from the
same partitioner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.joins import small_side
from strata.session import ensure_checkpoint_dir

CHUNK = "_chunk"


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def with_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                num_chunks: int | None = None) -> DataFrame:
    """Range-partition on (keys, order), tag each row with its chunk id, pin."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *_cols(keys), *_cols(order))
                .withColumn(CHUNK, F.spark_partition_id()))
    return tagged.checkpoint(eager=False)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                weight: Column | str, out: str, inclusive: bool = True) -> DataFrame:
    """Per key, the sum of ``weight`` over rows up to (with ``inclusive``:
    including) the current row in ``order``; ``order`` is unique per key.
    Row numbering is ``running_sum(..., F.lit(1), ...)``."""
    w_col = F.col(weight) if isinstance(weight, str) else weight
    t = with_chunks(df.withColumn("_w", w_col.cast("long")), keys, order)
    frame = (Window.partitionBy(*keys, CHUNK).orderBy(*_cols(order))
             .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    local = t.withColumn("_local", F.coalesce(F.sum("_w").over(frame), F.lit(0)))
    per_chunk = t.groupBy(*keys, CHUNK).agg(F.sum("_w").alias("_chunk_sum"))
    before = (Window.partitionBy(*keys).orderBy(CHUNK)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_chunk.select(
        *keys, CHUNK,
        F.coalesce(F.sum("_chunk_sum").over(before), F.lit(0)).alias("_offset"))
    return (local.join(offsets, [*keys, CHUNK])
                 .withColumn(out, (F.col("_local") + F.col("_offset")).cast("long"))
                 .drop("_w", "_local", "_offset", CHUNK))


# Fixed: keys are counted by this many hashes, and rows of one key that a task may number alone.
HASHES = 1 << 16
MOST_IN_TASK = 1_000_000


def small_groups(df: DataFrame, keys: Sequence[str], rows: Column | None = None) -> bool:
    """Whether no key has more than ``MOST_IN_TASK`` rows (``rows``: what each row
    stands for): rows are counted by a hash of the keys, so the counts are few."""
    n = F.count(F.lit(1)) if rows is None else F.sum(rows)
    most = df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(HASHES)).alias("_hash")).agg(n.alias("_n")).agg(F.max("_n")).first()[0]
    return (most or 0) <= MOST_IN_TASK


def row_number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                      out: str, small: bool | None = None) -> DataFrame:
    """``row_number()`` per key in ``order`` (unique per key), hot-key safe; rows
    with a null key are left out.

    Keys with few rows each (``small``; by default they are counted) are numbered by
    one window.  Else rows are range-partitioned and sorted, so that a row's place in
    its chunk is its number there, and only one row per key and chunk is summed up."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    if keys and (small_groups(df, keys) if small is None else small):
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*_cols(order))).cast("long"))
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [*_cols(keys), *_cols(order)]
    t = (df.repartitionByRange(n, *by).sortWithinPartitions(*by)
           .withColumns({CHUNK: F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).checkpoint(eager=True))
    per_chunk = t.groupBy(*keys, CHUNK).agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(*keys, CHUNK, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_from") + 1).alias("_offset"))
    return (t.join(small_side(offsets), [*keys, CHUNK])
             .withColumn(out, (F.col("_at") + F.col("_offset")).cast("long")).drop("_at", "_offset", CHUNK))


def previous_value(df: DataFrame, keys: Sequence[str], order: str,
                   value: str, out: str, ignore_nulls: bool = False,
                   first_flag: str | None = None) -> DataFrame:
    """Per key, ``value`` of the previous row in ``order`` (``lag``), or with
    ``ignore_nulls`` the last non-null value before the row.  ``first_flag``
    names a boolean column, true on the first row of each key."""
    t = with_chunks(df, keys, [order])
    w = Window.partitionBy(*keys, CHUNK).orderBy(order)
    if ignore_nulls:
        local = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        tail_order = F.when(F.col(value).isNotNull(), F.col(order))
    else:
        local = F.lag(value).over(w)
        tail_order = F.col(order)
    rows = (t.withColumn("_local_prev", F.struct(local.alias("v")))
             .withColumn("_rn", F.row_number().over(w)))
    tails = t.groupBy(*keys, CHUNK).agg(
        F.max_by(F.struct(F.col(value).alias("v")), tail_order).alias("_tail"))
    by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
    if ignore_nulls:
        carry = F.last("_tail", ignorenulls=True).over(
            by_chunk.rowsBetween(Window.unboundedPreceding, -1))
    else:
        carry = F.lag("_tail").over(by_chunk)
    carried = tails.select(*keys, CHUNK, carry.alias("_carry"))
    res = rows.join(carried, [*keys, CHUNK], "left")
    if ignore_nulls:
        prev = F.coalesce(F.col("_local_prev.v"), F.col("_carry.v"))
    else:
        prev = F.when(F.col("_rn") == 1, F.col("_carry.v")).otherwise(F.col("_local_prev.v"))
    res = res.withColumn(out, prev)
    if first_flag:
        res = res.withColumn(first_flag, (F.col("_rn") == 1) & F.col("_carry").isNull())
    return res.drop("_local_prev", "_rn", "_carry", CHUNK)


def last_values(df: DataFrame, keys: Sequence[str], order: str, values: dict[str, str]) -> DataFrame:
    """Per key, for each ``value`` -> ``out`` the last non-null ``value`` before the
    row in ``order``: all of them in one pass over one exchange."""
    t = with_chunks(df, keys, [order])
    earlier = (Window.partitionBy(*keys, CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    rows = t.withColumns({f"_local_{out}": F.last(v, ignorenulls=True).over(earlier) for v, out in values.items()})
    tails = t.groupBy(*keys, CHUNK).agg(*[F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(order))).alias(f"_tail_{out}")
                                          for v, out in values.items()])
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(*keys, CHUNK, *[F.last(f"_tail_{out}", ignorenulls=True).over(before).alias(f"_carry_{out}")
                                           for out in values.values()])
    res = rows.join(carried, [*keys, CHUNK], "left")
    res = res.withColumns({out: F.coalesce(f"_local_{out}", f"_carry_{out}") for out in values.values()})
    return res.drop(CHUNK, *[f"{pre}{out}" for pre in ("_local_", "_carry_") for out in values.values()])
