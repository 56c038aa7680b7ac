from pyspark.sql import functions as F

from concord import schema_check, schema_diff, schema_frame
from conftest import rows


def test_schema_frame_lowercases_last_wins(spark):
    df = spark.createDataFrame([(1, "a")], "ID int, name string")
    assert rows(schema_frame(df)) == [("id", "int", True), ("name", "string", True)]


def test_schema_diff_rows(spark):
    a = spark.createDataFrame([(1, 2.0, "x")], "k bigint, p double, s string")
    b = a.withColumn("p", F.col("p").cast("decimal(10,2)")).drop("s").withColumn("extra", F.lit(1))
    b = b.withColumnRenamed("k", "K")
    assert rows(schema_diff(a, b)) == [
        ("extra", None, None, "int", False),
        ("p", "double", True, "decimal(10,2)", True),
        ("s", "string", True, None, None),
    ]
    status, text = schema_check(a, b)
    assert status == "Failed" and "p: double/true -> decimal(10,2)/true" in text


def test_schema_check_passes_on_same_schema(spark):
    a = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert schema_check(a, a) == ("Passed", "")


def test_nullability_counts(spark):
    a = spark.createDataFrame([(1,)], "k int not null")
    b = spark.createDataFrame([(1,)], "k int")
    assert schema_check(a, b)[0] == "Failed"


def test_nested_type_change_is_reported(spark):
    a = spark.createDataFrame([((1, "x"),)], "s struct<p:int,q:string>")
    b = spark.createDataFrame([((1, "x"),)], "s struct<p:bigint,q:string>")
    assert rows(schema_diff(a, b)) == [("s", "struct<p:int,q:string>", True, "struct<p:bigint,q:string>", True)]
