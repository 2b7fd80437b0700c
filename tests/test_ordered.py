"""Chunked (hot-key safe) windows equal plain windows."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions.ordered import previous_value, row_number_within, running_sum
from tests.conftest import rows


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 20)}"
        val = None if rnd.random() < 0.2 else f"v{rnd.randint(0, 3)}"
        data.append((key, i * 3 + rnd.randint(0, 2), val, rnd.randint(0, 1)))
    return spark.createDataFrame(data, "k string, seq long, v string, w long")


def test_row_number_matches_window(spark):
    df = _data(spark)
    got = row_number_within(df, ["k"], ["seq"], "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("seq")).cast("long"))
    assert rows(got, "k", "seq", "rn") == rows(want, "k", "seq", "rn")


def test_running_sum_exclusive(spark):
    df = _data(spark)
    got = running_sum(df, ["k"], ["seq"], "w", "s", inclusive=False)
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("s", F.coalesce(F.sum("w").over(w), F.lit(0)).cast("long"))
    assert rows(got, "k", "seq", "s") == rows(want, "k", "seq", "s")


def test_lag_and_first_flag(spark):
    df = _data(spark)
    got = previous_value(df, ["k"], "seq", "v", "p", first_flag="first")
    w = Window.partitionBy("k").orderBy("seq")
    want = (df.withColumn("p", F.lag("v").over(w))
              .withColumn("first", F.row_number().over(w) == 1))
    assert rows(got, "k", "seq", "p", "first") == rows(want, "k", "seq", "p", "first")


def test_last_non_null_before(spark):
    df = _data(spark)
    got = previous_value(df, ["k"], "seq", "v", "p", ignore_nulls=True)
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("p", F.last("v", ignorenulls=True).over(w))
    assert rows(got, "k", "seq", "p") == rows(want, "k", "seq", "p")
