from pyspark.sql import functions as F

from conftest import plan_of
from peopleflow.operators.numbering import number_rows


def test_numbers_follow_the_key(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 5003).alias("k"))
    rows = number_rows(df, ["k"]).orderBy("k").collect()
    assert [r.row_number for r in rows] == list(range(1, 5001))


def test_several_keys_and_columns(spark):
    df = spark.createDataFrame([(2, "a"), (1, "b"), (1, "a"), (2, "b")], "x int, y string")
    rows = {(r.x, r.y): r.row_number for r in number_rows(df, ["x", "y"]).collect()}
    assert rows == {(1, "a"): 1, (1, "b"): 2, (2, "a"): 3, (2, "b"): 4}


def test_empty(spark):
    assert number_rows(spark.range(0), ["id"]).count() == 0


def test_presorted_rows_are_not_sorted_again(spark):
    ordered = spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id")
    numbered = number_rows(ordered, ["id"], presorted=True)
    assert numbered.where("row_number <> id + 1").count() == 0


def test_no_window_over_all_rows(spark):
    plan = plan_of(number_rows(spark.range(100), ["id"]))
    assert plan.count("Window ") <= 1 and "BroadcastHashJoin" in plan
