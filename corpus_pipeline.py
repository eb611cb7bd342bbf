"""From raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peopleflow.llm import toxicity
from peopleflow.llm.common import fresh
from peopleflow.llm.exact_dedup import distinct_texts
from peopleflow.llm.minhash import without_near_copies
from peopleflow.llm.packing import cut_pieces, pack
from peopleflow.llm.secret_scan import scan
from peopleflow.session import new_path


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop documents that the toxicity model rejects; it learns from the labels of the folder.

    Null and empty texts are scored like texts without letters. Repeated rows get equal scores and stay
    or go together; ids that are null or have no label are scored, not learned from. An empty table
    stays empty, and further columns, whatever their names, are carried along.
    """
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    name = fresh(docs, "toxicity")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), out=name)
    return scored.filter(F.col(name) < toxicity.THRESHOLD).select(*_names(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep the document with the largest id of equal texts.

    Null reads as the empty text, so of null and empty texts one row stays. A null id is smallest, of
    repeated rows one stays. An empty table stays empty; further columns are carried along.
    """
    return distinct_texts(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep one document, that with the smallest id, of each component of near-equal texts.

    A null id is largest. Rows that share an id are told apart by their texts; of repeated rows one
    stays. Null and blank texts are linked with nothing and stay. An empty table stays empty; further
    columns are carried along.
    """
    return without_near_copies(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replace secrets inside the texts; ``n_chars`` follows where a text has changed.

    Every row stays, repeated ones too. Null and empty texts stay as they are, and so does an empty
    table; further columns, whatever their names, are carried along.
    """
    findings, masked = fresh(docs, "findings"), fresh(docs, "masked")
    scanned = scan(docs, findings=findings, masked=masked)
    changed = {"text": F.col(masked).alias("text")}
    if "n_chars" in docs.columns:
        length = F.length(masked).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.size(findings) > 0, length).otherwise(F.col("n_chars")).alias("n_chars")
    return scanned.select(*[changed.get(c, F.col(f"`{c}`")) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Place the tokens of all remaining documents in sequences.

    Null and empty texts are one end token. Repeated rows and null ids are packed like any others. An
    empty table gives an empty one; columns besides id and text are not read.
    """
    return pack(cut_pieces(docs))


def _names(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", hide_secrets),
    ("packing", pack_sequences),
]

#: Its stages learn a model and pack; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage reads what the one before it has written."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, folder)
