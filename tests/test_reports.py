from pyspark.sql import functions as F

from conftest import SF_DIR, plan_of
from peopleflow.operators import reports
from peopleflow.session import cached


def table(spark):
    rows = [("b", 1, 2.345), ("a", 2, 2.345), ("b", 3, None), ("a", None, 1.0), (None, 5, 9.0)]
    return spark.createDataFrame(rows, "k string, x int, y double")


def test_ties_are_ordered_by_key(spark):
    top = [(r.k, r.n) for r in reports.top_groups(table(spark), "k", top=2).collect()]
    assert top == [("a", 2), ("b", 2)]


def test_average_rounds_half_up_and_ignores_null(spark):
    rows = {r.k: (r.avg_y, r.n) for r in reports.average_by(table(spark), "k", "y", 2).collect()}
    assert rows == {"a": (1.67, 2), "b": (2.35, 2), None: (9.0, 1)}


def test_average_is_sorted_from_the_highest(spark):
    order = [r.k for r in reports.average_by(table(spark), "k", "y", 2).collect()]
    assert order == [None, "b", "a"]


def test_filter_counts_take_one_scan(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    counts = reports.filter_counts(
        orders, dear=F.col("o_totalprice") > 1000, open=F.col("o_orderstatus") == "O"
    )
    row = counts.first()
    assert row.dear == orders.where("o_totalprice > 1000").count()
    assert row.open == orders.where("o_orderstatus = 'O'").count()
    assert plan_of(counts).count("FileScan") == 1
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in plan_of(counts)


def test_null_condition_counts_as_unmet(spark):
    assert reports.filter_counts(table(spark), big=F.col("x") > 2).first().big == 2


def test_cardinalities_count_the_null_group(spark):
    counts = reports.group_cardinalities(table(spark), k=["k"], kx=["k", "x"], x=["x"], k2=["k"])
    assert counts.first().asDict() == {"k": 3, "kx": 5, "x": 5, "k2": 3}
    assert plan_of(counts).count("Exchange hashpartitioning") == 1
    none = reports.group_cardinalities(table(spark).limit(0), k=["k"], kx=["k", "x"])
    assert none.first().asDict() == {"k": 0, "kx": 0}


def test_schema_report(spark):
    rows = [tuple(r) for r in reports.schema_report(table(spark)).collect()]
    assert rows == [(1, "k", "string"), (2, "x", "int"), (3, "y", "double")]


def test_preview_is_a_top_n(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    preview = reports.preview(orders, ["o_orderkey"])
    assert [r.o_orderkey for r in preview.collect()] == [0, 1, 2, 3, 4]
    assert "TakeOrderedAndProject" in plan_of(preview)


def test_filters_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = "SELECT o_orderkey FROM o WHERE o_orderstatus IN ('O', 'F') AND o_totalprice > 1000"
    plan = plan_of(reports.run_sql(spark, text, o=orders))
    assert "In(o_orderstatus, [F,O])" in plan or "In(o_orderstatus, [O,F])" in plan
    assert "GreaterThan(o_totalprice,1000.0)" in plan


def test_filters_of_reports_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    wanted = F.col("o_orderstatus").isin("O") & (F.col("o_totalprice") > 1000)
    order = [F.desc("o_totalprice"), "o_orderkey"]
    top = plan_of(reports.filtered_top(orders, wanted, ["o_orderkey"], order, 3))
    groups = plan_of(reports.group_report(orders, ["o_orderstatus"], wanted, n=F.count("*")))
    assert "TakeOrderedAndProject" in top
    for plan in (top, groups):
        assert "EqualTo(o_orderstatus,O), GreaterThan(o_total" in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in groups


def test_group_report_orders_by_its_keys(spark):
    rows = reports.group_report(table(spark), ["k"], F.col("x") > 1, n=F.count("*")).collect()
    assert [tuple(r) for r in rows] == [(None, 1), ("a", 1), ("b", 1)]


def test_cache_is_released(spark):
    df = table(spark)
    with cached(df) as held:
        held.count()
        assert df.storageLevel.useMemory
    assert not df.storageLevel.useMemory
