"""Exact deduplication against a persistent digest index (operator 3). DataFrame functions only."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peopleflow.llm.common import documents, lower_ascii, one_row_each, row_key
from peopleflow.session import new_path, stage

#: Buckets of an index, at least, and texts of a bucket, about.
BUCKETS, BUCKET_ROWS = 64, 1_000_000

#: Groups with at least one row in so many are hot; there can be no more of them than this.
HOT_SHARE = 200


class DigestIndex:
    """Digests of the texts kept so far, as a table bucketed and sorted by digest.

    The files are the index: a later session that names the same folder and number of buckets goes on
    with it. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets, self.id_type = spark, path, buckets, id_type
        self.name = "digests_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def compacted(self, path: str) -> DigestIndex:
        """The same index in another folder, every bucket in one file again after many appends."""
        other = DigestIndex(self.spark, path, self.id_type, self.buckets)
        other.append(self.spark.read.parquet(self.path))
        return other

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, new: DataFrame) -> None:
        """Add rows, one file a bucket."""
        rows = new.select("digest", "keep_id").repartition(self.buckets, "digest")
        rows.write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Add new documents and say, for each row, which document stays for its text.

        Texts are equal when they are the same after lower-casing A-Z; null reads as the empty text.
        A text the index already holds stays with the document it came with. Of the others, the row
        with the largest id stays (a null id is smallest), and the index gets its digest. Returns one
        row per input row: ``doc_id, keep_id, group_size`` (rows of this text in ``docs``), ``kept,
        text_sha256``. Repeated rows with the id that stays are all marked kept. Other columns of
        ``docs`` are not read.
        """
        keyed = stage(
            docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("digest")), "digests"
        )
        # A text's copies become one row in each task, so a hot group is small when it is shuffled.
        found = stage(
            keyed.groupBy("digest").agg(
                F.max("doc_id").alias("newest"), F.count(F.lit(1)).alias("group_size")
            ),
            "texts",
        )
        fresh = found.join(self.read().hint("merge"), "digest", "left_anti")
        self.append(fresh.withColumnRenamed("newest", "keep_id"))
        texts = found.drop("newest").join(self.read().hint("merge"), "digest")
        rows = keyed.count()
        # At most HOT_SHARE groups hold a share of 1 / HOT_SHARE of the rows each, whatever their number.
        is_hot = F.col("group_size") * HOT_SHARE >= F.lit(max(rows, 1))
        hot = stage(texts.filter(is_hot), "hot")
        cold = keyed.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
        out = keyed.join(F.broadcast(hot), "digest").unionByName(
            cold.join(texts.filter(~is_hot).hint("merge"), "digest")
        )
        return out.select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def buckets_for(docs: DataFrame) -> int:
    """Buckets for an index of so many rows: a power of two, BUCKETS at least."""
    rows, buckets = docs.count(), BUCKETS
    while buckets * BUCKET_ROWS < rows:
        buckets *= 2
    return buckets


def digest(text: Column) -> Column:
    """SHA-256 of a text with A-Z in lower case, as 32 bytes."""
    return F.unhex(F.sha2(lower_ascii(F.coalesce(text, F.lit(""))), 256))


def distinct_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns.

    Texts are equal as in `DigestIndex.add`, and the row with the largest id stays; a null id is
    smallest. Of rows repeated with that id and text one stays. An empty table stays empty, and any
    other columns are carried along.
    """
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType.simpleString()
    index = DigestIndex(spark, new_path(spark, "index"), id_type, buckets_for(docs))
    kept = index.add(docs, doc_id, text).filter("kept")
    kept = kept.select(row_key(F.col("doc_id"), F.upper("text_sha256")))
    return one_row_each(docs, row_key(F.col(f"`{doc_id}`"), F.hex(digest(F.col(f"`{text}`")))), kept)


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The group of equal texts of every document, against an empty index."""
    docs = documents(spark, folder)
    return DigestIndex(spark, new_path(spark, "index"), buckets=buckets_for(docs)).add(docs)


OP3_SQL = """
WITH keyed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM keyed WINDOW same AS (PARTITION BY text_sha256)
"""
