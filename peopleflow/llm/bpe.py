"""Byte-level BPE encoding and decoding of a text column (operator 1)."""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peopleflow.llm.common import add_columns, as_list, documents
from peopleflow.llm.transducer import decoder, encoder

RANKS = "byte_bpe_50k.tiktoken"


def encode(
    df: DataFrame,
    text: str = "text",
    out: str = "ids",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Add the token ids of a text column, without special tokens, as ``array<int>``.

    Null and empty texts give an empty array. Rows are independent: repeated rows give equal ids,
    an empty table an empty table, and a text is never cut, however long. ``path`` is a file of
    ranks on every machine; ``pattern`` splits text before merging.
    """

    def make(columns):
        table = encoder(path or public_tokenizers.path(RANKS), pattern)
        for column in columns:
            yield [lists_of(*table.encode_all(as_list(column)))]

    return add_columns(df, text, [T.StructField(out, T.ArrayType(T.IntegerType()))], make)


def lists_of(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Ids of rows, one after another, and the rows' ends to a column of lists."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids))


def round_trip(
    df: DataFrame,
    text: str = "text",
    ids: str = "ids",
    out: str = "decoded",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """`encode` and `decode` of what it gives, in one pass: the ids need not come back to the workers."""

    def make(columns):
        file = path or public_tokenizers.path(RANKS)
        table, back = encoder(file, pattern), decoder(file)
        for column in columns:
            flat, ends = table.encode_all(as_list(column))
            texts = [back.decode(flat[a:b].tolist()) for a, b in pairwise([0, *ends.tolist()])]
            yield [lists_of(flat, ends), pa.array(texts, pa.string())]

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(out, T.StringType())]
    return add_columns(df, text, fields, make)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """Add the text of an id column. Null and empty arrays give the empty text.

    Bytes that form no character give U+FFFD, as an incremental UTF-8 decoder writes it.
    """

    def make(columns):
        table = decoder(path or public_tokenizers.path(RANKS))
        for column in columns:
            flat = column.values.to_numpy(zero_copy_only=False) if len(column) else []
            ends = column.offsets.to_pylist() if len(column) else [0]
            valid = column.is_valid().to_pylist()
            texts = [
                table.decode(flat[a:b].tolist()) if ok else "" for a, b, ok in zip(ends, ends[1:], valid)
            ]
            yield [pa.array(texts, pa.string())]

    return add_columns(df, ids, [T.StructField(out, T.StringType())], make)


def op1_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every whole text and the text they decode to, as digests."""
    docs = documents(spark, folder).select("doc_id", "text")
    return round_trip(docs).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
