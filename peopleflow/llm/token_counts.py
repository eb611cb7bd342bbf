"""Token counts by rank-synchronous merging of ragged arrays (operator 2)."""

from __future__ import annotations

import json
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peopleflow.llm.common import MEMO_ENTRIES, SHORT, add_columns, as_list, documents, held_for
from peopleflow.llm.pretokens import byte_alphabet, chunks, splitter

VOCABULARY = "byte_bpe_50k.json"

#: Texts whose new pre-tokens are merged in one go hold about so many characters.
BLOCK_CHARS = 4_000_000


class MergeTable:
    """The merges of a byte-level BPE vocabulary file as sorted arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocab = content["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.made, self.ranks = keys[order], made[order], order.astype(np.int32)
        self.none = np.int32(len(pairs))
        self.made_by_rank = made
        self.bytes = np.empty(256, np.int64)
        for char, byte in byte_alphabet().items():
            self.bytes[byte] = vocab[char]
        self.special = [t["content"] for t in content.get("added_tokens") or []]

    def pairs(self) -> list[tuple[tuple[int, int], int]]:
        """Every merge: the ids of its two parts, and of what it makes."""
        return [(divmod(key, self.size), made) for key, made in zip(self.keys.tolist(), self.made.tolist())]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``none`` where no merge joins them."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], self.none)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """How many symbols each piece has after all merges.

        All pieces lie in one array. In each round every piece applies its lowest-ranked pair, at
        all places at once; overlapping places of a pair of equal symbols are taken from the left.
        A product's own pairs rank later than the pair that made it, so this is the order of
        one-by-one merging. Finished pieces leave the array.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        counts = lengths.copy()
        piece = np.repeat(np.arange(len(pieces)), lengths)
        symbol = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full(len(symbol), self.none, np.int32)
        if len(symbol) > 1:
            rank[:-1] = np.where(piece[1:] == piece[:-1], self.rank(symbol[:-1], symbol[1:]), self.none)
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(symbol)])
            counts[piece[starts]] = sizes
            going = lowest < self.none
            if not going.all():
                stay = np.repeat(going, sizes)
                symbol, rank, piece = symbol[stay], rank[stay], piece[stay]
                lowest, sizes = lowest[going], sizes[going]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, sizes))
            # Of places in a row, every second one is free to merge.
            run = np.r_[True, np.diff(at) != 1]
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            symbol[at] = self.made_by_rank[rank[at]]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))
            symbol, rank, piece = symbol[stay], rank[stay], piece[stay]
            for near in (at, at[at > 0] - 1):
                inner = near[near + 1 < len(symbol)]
                inner = inner[piece[inner] == piece[inner + 1]]
                rank[near] = self.none
                rank[inner] = self.rank(symbol[inner], symbol[inner + 1])
        return counts


class Counter:
    """Token counts of whole texts, a block of texts at a time."""

    def __init__(self, path: str, pattern: str) -> None:
        self.table = MergeTable(path)
        self.split = splitter(pattern)
        # Strings of added tokens are one token each wherever they stand.
        alone = sorted(filter(None, self.table.special), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, alone))) if alone else None
        self.known: dict[str, int] = {}

    def parts(self, text: str) -> list[str]:
        return self.special.split(text) if self.special else [text]

    def count(self, texts: list[str]) -> list[int]:
        """Counts of a block of texts. Chunks after a cut are known by their text without the space."""
        if len(self.known) > MEMO_ENTRIES:
            self.known.clear()
        cut = [[chunks(part) for part in self.parts(text)] for text in texts]
        firsts = {part[0] for parts in cut for part in parts}
        wanted = {c for parts in cut for part in parts for c in part[1:]}.difference(self.known)
        new = [*firsts, *(" " + c for c in wanted)]
        split = [self.split(c) for c in new]
        pieces = list({p for found in split for p in found})
        size = dict(zip(pieces, self.table.count([p.encode() for p in pieces]).tolist()))
        counts = [sum(map(size.__getitem__, found)) for found in split]
        first = dict(zip(firsts, counts))
        found = dict(zip(wanted, counts[len(firsts) :]))
        self.known |= found
        totals = [
            sum(first[part[0]] + sum(map(self.known.__getitem__, part[1:])) for part in parts) + len(parts) - 1
            for parts in cut
        ]
        for long in [c for c in found if len(c) > SHORT]:
            del self.known[long]
        return totals


def counter(path: str, pattern: str) -> Counter:
    return held_for("token_counts", (path, pattern), lambda: Counter(path, pattern))


def count_tokens(
    df: DataFrame,
    text: str = "text",
    out: str = "n_tokens",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Add the number of tokens of a text column, as ``long``.

    No begin, end or other tokens are added; the string of an added token counts as one token. Null
    and empty texts have none. Rows are independent, so repeated rows count alike and an empty
    table stays empty. ``path`` is a byte-level BPE vocabulary file on every machine.
    """

    def make(columns):
        table = counter(path or public_tokenizers.path(VOCABULARY), pattern)
        for column in columns:
            counts, block, chars = [], [], 0
            for value in as_list(column):
                block.append(value)
                chars += len(value)
                if chars >= BLOCK_CHARS:
                    counts += table.count(block)
                    block, chars = [], 0
            yield [pa.array(counts + table.count(block), pa.int64())]

    return add_columns(df, text, [T.StructField(out, T.LongType())], make)


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every whole text, and whether it is longer than 1024 tokens."""
    docs = documents(spark, folder).select("doc_id", "text")
    return count_tokens(docs).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 1024).alias("over_limit"),
    )
