"""Every registered query against its SQL twin."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import SF_DIR
from peopleflow.plans import catalogue

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
# Queries whose rows come in the order that their SQL twin states.
ORDERED = {
    "avg_by_key", "avg_by_occupation", "avg1_by_key", "count_by_key_topk", "filtered_top_orders",
    "group_report_lineitem", "live_count_by_group", "live_count_messages", "preview_rows", "sql_filter_topk",
    "sql_group_by_gender", "sql_group_topk", "sql_group_two_keys", "top_customers", "word_count_top",
}
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_a_twin():
    assert not set(catalogue.QUERIES) - set(ORACLES)
    assert not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = db.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    wanted = expected.select(quoted).fetchall() if columns else []
    got = [tuple(r) for r in df.select(*columns).collect()]
    if name in ORDERED:
        assert list(map(repr, got)) == list(map(repr, wanted))
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
