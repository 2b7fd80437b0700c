from strata.operators import objects as OB


def test_empty_prefix_has_the_callers_schema(spark, tmp_path):
    a = str(tmp_path / "a")
    spark.range(3).write.parquet(a)
    view = spark.createDataFrame([("tables/t/part-0", a)], "path string, physical_address string")
    none = OB.read_at_ref(view, "tables/u/", schema="id long, more string")
    assert none.dtypes == [("id", "bigint"), ("more", "string")] and none.count() == 0
    some = OB.read_at_ref(view, "tables/t/", schema="id long, more string")
    assert some.dtypes == none.dtypes and sorted(r.id for r in some.collect()) == [0, 1, 2]
