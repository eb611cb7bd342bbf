"""Packing documents into sequences of a fixed length, certified by lower bounds (operator 6)."""

from __future__ import annotations

import json
import os
import zlib
from collections import deque
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peopleflow.llm.common import add_columns, as_list, documents, held_for, ship
from peopleflow.llm.pretokens import byte_alphabet
from peopleflow.llm.token_counts import MergeTable
from peopleflow.session import stage

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048

#: A packing task gets about so many tokens, and at most about so many pieces.
TASK_TOKENS = 8_000_000
TASK_PIECES = 200_000

#: Characters of a block; a text with a block of nothing but blanks is left to the tokenizers library.
BLANKS = 2048

#: Sequences of one task and round are numbered below this.
SEQUENCES = 1 << 24


@lru_cache(maxsize=1)
def library(path: str):
    """The tokenizers library itself, for the few texts that are odd and for vocabularies without ranks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def as_ranks(path: str) -> dict[bytes, int] | None:
    """The tokens of a vocabulary file by their bytes, if merging by rank gives what its merges give.

    tiktoken joins the neighbours whose joined bytes have the lowest rank, the tokenizers library
    those that its list of merges names first. Both do the same where every merge makes a token of
    its own, later tokens have higher ids, and every token's bytes by themselves merge to that token:
    before two neighbours join to a token, nothing has crossed its ends, so what lies between them has
    been merged as by itself, and its last step is the listed one. None where this, or the
    splitting, is not so.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, split = content["model"], content.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
    odd = [content.get("normalizer"), *map(model.get, ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))]
    table, byte_of, vocab = MergeTable(path), byte_alphabet(), model["vocab"]
    made = table.made_by_rank
    if not plain or any(odd) or model.get("type") != "BPE" or (np.diff(made) <= 0).any():
        return None
    single, texts = set(table.bytes.tolist()), {i: text for text, i in vocab.items()}
    if any(part not in single and part >= whole for pair, whole in table.pairs() for part in pair):
        return None
    ranks = {bytes(byte_of[c] for c in texts[i]): i for i in (*single, *made.tolist())}
    if len(ranks) < len(single) + len(made) or (table.count(list(ranks)) != 1).any():
        return None
    return ranks


class IdBytes:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, as the tokenizers library gives them."""

    def __init__(self, path: str) -> None:
        from tiktoken import Encoding

        with open(path, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file).get("added_tokens") or [] if t["content"]]
        self.path, ranks = path, as_ranks(path)
        self.merging = ranks and Encoding(
            os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.whole(t) if self.odd(t) else self.merged(t) for t in texts]

    def odd(self, text: str) -> bool:
        """Whether a text is left to the library: it holds the string of an added token, or blanks without end.

        tiktoken's splitting fails on millions of blanks in a row; twice BLANKS of them fill a whole block.
        """
        if not self.merging or any(s in text for s in self.special):
            return True
        return any(text[at : at + BLANKS].isspace() for at in range(0, len(text) - BLANKS + 1, BLANKS))

    def merged(self, text: str) -> bytes:
        return self.merging.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(library(self.path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def id_bytes(path: str) -> IdBytes:
    return held_for("packing", path, lambda: IdBytes(path))


def cut_pieces(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """The token pieces of every row: ``doc_id, piece, start, length, ids_crc32`` and perhaps ``ids``.

    A row's tokens are those of its whole text (null: empty) and ``end_id``. Rows of more than
    ``capacity`` tokens are cut into full pieces, and what is over goes into the first piece.
    ``ids`` are little-endian unsigned 32-bit numbers. Repeated rows give equal pieces each, and an
    empty table none; columns besides id and text are not read.
    """
    fields = "piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    kind = T.ArrayType(T._parse_datatype_string(f"struct<{fields.replace(' ', ':').replace(',:', ',')}>"))
    end = np.array([end_id], "<u4").tobytes()

    def make(columns):
        table = id_bytes(path or public_tokenizers.path(VOCABULARY))
        for column in columns:
            texts, rows, width = as_list(column), [], 4 * capacity
            for at in range(0, len(texts), 1000):
                for ids in table.encode(texts[at : at + 1000]):
                    ids += end
                    over = len(ids) % width
                    borders = sorted({0, *range(over, len(ids) + 1, width)})
                    found = []
                    for k, (a, b) in enumerate(zip(borders, borders[1:])):
                        own = ids[a:b]
                        row = {"piece": k, "start": a // 4, "length": (b - a) // 4, "ids_crc32": zlib.crc32(own)}
                        found.append(row | ({"ids": own} if with_ids else {}))
                    rows.append(found)
            names = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
            yield [pa.array(rows, pa.list_(pa.struct(names + [("ids", pa.binary())] * with_ids)))]

    added = add_columns(
        df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text")),
        "__text",
        [T.StructField("pieces", kind)],
        make,
    )
    return added.select("doc_id", F.inline("pieces"))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing of these lengths has fewer sequences: the best of two families of dual-feasible functions.

    The first rounds lengths above ``capacity - e`` up to a whole sequence and those below ``e``
    down to nothing. The second rounds to multiples of 1/k of a sequence, down but for exact
    multiples of 1/(k+1).
    """
    size, count = np.unique(np.asarray(lengths, np.int64), return_counts=True)
    if not len(size):
        return 0
    best = -(-int((size * count).sum()) // capacity)
    many, total = np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(size * count)]
    e = np.arange(1, capacity // 2 + 1)
    low, high = np.searchsorted(size, e, "left"), np.searchsorted(size, capacity - e, "right")
    used = (many[-1] - many[high]) * capacity + total[high] - total[low]
    best = max(best, int(-(-used // capacity).max()))
    for k in range(1, 101):
        scaled = (k + 1) * size
        exact = scaled % capacity == 0
        # In units of 1/(k (k+1)) of a sequence, so that all is whole numbers.
        units = np.where(exact, size * k * (k + 1) // capacity, scaled // capacity * (k + 1))
        best = max(best, -(-int((units * count).sum()) // (k * (k + 1))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence of each length, longest first, each into the fullest sequence that still has room."""
    order = np.argsort(-lengths, kind="stable")
    chosen = np.empty(len(lengths), np.int64)
    with_room: list[deque[int]] = [deque() for _ in range(capacity + 1)]
    rooms, opened = 0, 0  # bit r of rooms: some sequence has just r left
    for at in order.tolist():
        size = int(lengths[at])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            target = with_room[room].popleft()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, target = capacity, opened
            opened += 1
        chosen[at] = target
        left = room - size
        if left:
            with_room[left].append(target)
            rooms |= 1 << left
    return chosen


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id``, ``offset`` and ``gap`` to a table of lengths from 1 to ``capacity``.

    Rows are dealt over tasks evenly, whatever their source, and each task packs its own by
    best-fit decreasing. A lower bound tells by how many sequences a task may be off. In each
    further round the tasks that have such a gap give their unfilled sequences away; these meet
    those of other tasks and are packed anew, which counts only where it saves a sequence. So it goes on,
    with other partners each time, until a whole round has saved nothing. ``gap`` is how far the task that last
    packed a row was above its lower bound, 0 where the bound is met. Repeated rows are packed like any others; a length
    that is null or out of range is an error. An empty table stays empty. Columns named like the added ones are replaced.
    """
    rows = pieces.drop("sequence_id", "offset", "gap")
    schema = T.StructType(
        rows.schema.fields
        + [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset", "__gap", "__filled")]
    )

    def packed(frame: pd.DataFrame, key: int, turn: int) -> pd.DataFrame:
        size = frame[length].to_numpy(np.int64)
        if len(size) and not (1 <= size.min() and size.max() <= capacity):
            raise ValueError(f"lengths must be from 1 to {capacity}")
        chosen = best_fit_decreasing(size, capacity)
        base = ((turn << 28) + key) * SEQUENCES
        used = int(chosen.max()) + 1 if len(size) else 0
        bound = lower_bound(size, capacity)
        if turn and (before := frame["sequence_id"].nunique()) <= used:
            frame = frame.assign(__gap=before - bound)
        else:
            frame = frame.assign(sequence_id=base + chosen, __gap=used - bound)
        frame = frame.sort_values("sequence_id", kind="stable")
        size = frame[length].to_numpy(np.int64)
        ids = frame["sequence_id"].to_numpy(np.int64)
        before = np.cumsum(size) - size
        starts = np.r_[True, ids[1:] != ids[:-1]]
        sequence = np.cumsum(starts) - 1
        filled = np.add.reduceat(size, np.flatnonzero(starts))
        return frame.assign(offset=before - before[starts][sequence], __filled=filled[sequence])

    def grouped(df: DataFrame, tasks: int, turn: int) -> DataFrame:
        def run(key, frame):
            return packed(frame.drop(columns="__task"), int(key[0]), turn)[schema.names]

        return df.groupBy("__task").applyInPandas(run, schema)

    def tasks_for(df: DataFrame) -> int:
        tokens, n = df.agg(F.sum(length), F.count(F.lit(1))).first()
        return max(1, -(-(tokens or 0) // TASK_TOKENS), -(-n // TASK_PIECES))

    ship(rows.sparkSession)
    rows = stage(rows, "pieces")
    tasks = tasks_for(rows)
    # The place of a row in the staged table tells repeated rows apart.
    place = F.monotonically_increasing_id()
    dealt = rows.withColumn("__task", F.pmod(F.xxhash64(*rows.columns, place), F.lit(tasks)).cast("int"))
    now = stage(grouped(dealt, tasks, 0), "packed")
    done, turn, saved = [], 0, 1

    def sequences(df: DataFrame) -> int:
        return df.agg(F.count_distinct("sequence_id")).first()[0]

    # With a single task there is nobody to exchange with.
    while tasks > 1 and saved:
        turn += 1
        open_ = (F.col("__gap") > 0) & (F.col("__filled") < capacity)
        done.append(now.filter(~open_))
        given = now.filter(open_)
        held = sequences(given)
        tasks = tasks_for(given)
        dealt = given.withColumn(
            "__task", F.pmod(F.xxhash64("sequence_id", F.lit(turn)), F.lit(tasks)).cast("int")
        )
        now = stage(grouped(dealt, tasks, turn), "packed")
        saved = held - sequences(now)
    out = now
    for part in done:
        out = out.unionByName(part)
    return out.withColumnRenamed("__gap", "gap").drop("__filled")


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of at most 2048 tokens."""
    return pack(cut_pieces(documents(spark, folder)))
