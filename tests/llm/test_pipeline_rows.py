"""The pipeline's stages on nulls, repeats, shared ids, empty tables and clashing names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpus_pipeline import STAGES
from peopleflow.llm.common import cut_to
from peopleflow.llm.exact_dedup import DigestIndex, buckets_for, distinct_texts
from peopleflow.llm.minhash import without_near_copies
from peopleflow.session import stage

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = [
    "__id", "__own", "__own_id", "__digest", "row_key", "__toxicity", "toxicity", "findings", "masked", "__source",
    "name", "node", "label", "pieces", "filter_bucket", "filter_place", "filter_bits", "kept", "key", "__order", "part",
]

LONG = " ".join(f"word{k}" for k in range(60))
NEAR = LONG.replace("word30", "other")


def table(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)


def left(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_near_copies_with_shared_and_null_ids_go(spark):
    rows = [(1, LONG), (5, LONG + " end"), (5, "something else entirely"), (None, NEAR), (None, "b"), (3, None), (3, " "), (3, " ")]
    expected = [(1, LONG), (5, "something else entirely"), (None, "b"), (3, None), (3, " "), (3, " ")]
    assert left(without_near_copies(table(spark, rows))) == sorted(expected, key=repr)


def test_one_of_a_group_stays_where_ids_do_not_tell(spark):
    rows = [(None, LONG), (None, NEAR), (7, "a b c d e f g"), (7, "a b c d e f g"), (7, "A b c d e f g")]
    found = left(without_near_copies(table(spark, rows)))
    assert len(found) == 2 and {d for d, _ in found} == {None, 7}


def test_copies_with_shared_and_null_ids_go(spark):
    rows = [(1, "Text"), (2, "tEXT"), (2, "tEXT"), (None, "text"), (2, "more"), (None, "lonely"), (4, None), (3, "")]
    expected = [(2, "tEXT"), (2, "more"), (None, "lonely"), (4, None)]
    assert left(distinct_texts(table(spark, rows))) == sorted(expected, key=repr)


def test_texts_are_shuffled_once(spark, tmp_path):
    table(spark, [(k, LONG * k) for k in range(5)]).write.parquet(str(tmp_path / "docs"))
    plan = distinct_texts(spark.read.parquet(str(tmp_path / "docs")))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    moved = [k for k, line in enumerate(lines) if "Exchange hashpartitioning(row_key" in line]
    assert len(moved) == 2  # whole rows, and keys that stay


@pytest.mark.parametrize("number", range(5))
def test_stage_with_odd_rows(spark, number):
    """Nulls in all columns, repeated rows and extra columns of clashing names."""
    rows = [(1, LONG), (1, LONG), (None, None), (None, "token = abcdefgh123"), (2, ""), (3, "x" * 100_000), (4, "Good day")]
    name, run = STAGES[number]
    docs = table(spark, rows).unionByName(spark.createDataFrame([(None,) * 5], SCHEMA))
    plain = run(spark, docs, FOLDER).collect()
    wide = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(EXTRA)])
    out = run(spark, wide, FOLDER)
    if number < 4:
        assert out.columns == wide.columns
        assert left(out) == sorted(((r.doc_id, r.text) for r in plain), key=repr)
        assert out.filter(" AND ".join(f"`{c}` = {k}" for k, c in enumerate(EXTRA))).count() == len(plain)
    else:
        assert out.count() == len(plain)


@pytest.mark.parametrize("number", range(5))
def test_stage_of_an_empty_table(spark, number):
    assert STAGES[number][1](spark, spark.createDataFrame([], SCHEMA), FOLDER).count() == 0


def test_cut_keeps_all_that_is_wanted(spark):
    rows = spark.range(20_000).withColumn("filter_place", F.lit(1))
    rows = rows.unionByName(spark.createDataFrame([(None, 1)], "id bigint, filter_place int"))
    wanted = stage(spark.range(0, 20_000, 40).select(F.col("id").alias("w")), "wanted")
    found = cut_to(rows, "id", wanted)
    assert found.columns == rows.columns
    assert found.join(wanted, F.col("id") == F.col("w")).count() == 500
    assert found.count() < 4000


def test_index_grows_in_buckets_and_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("peopleflow.llm.exact_dedup.BUCKET_ROWS", 2)
    assert [buckets_for(spark.range(n)) for n in (0, 128, 129, 600)] == [64, 64, 128, 512]
    index = DigestIndex(spark, str(tmp_path / "a"), buckets=4)
    first = table(spark, [(k, f"text {k}") for k in range(40)])
    second = table(spark, [(100 + k, f"TEXT {k}") for k in range(50)])
    index.add(first).count()
    index.add(second).count()
    whole = index.compacted(str(tmp_path / "b"))
    assert sorted(map(tuple, whole.read().collect())) == sorted(map(tuple, index.read().collect()))
    files = [len({f for f in x.read().inputFiles()}) for x in (index, whole)]
    assert files[0] > files[1] and files[1] <= 4
    kept = {r.doc_id: r.keep_id for r in whole.add(second).collect()}
    assert kept[100] == 0 and kept[149] == 149
