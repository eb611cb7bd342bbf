"""Near duplicates by SimHash fingerprints in vantage-point trees (operator 12).

A vantage-point tree splits fingerprints by their distance to one of them. By the triangle
inequality, what lies within BITS of a query is on the query's side, or on both where the query is
no further than BITS from the border. The upper levels are built on a bounded sample and cut all
fingerprints into shards. A fingerprint lives in one shard and is asked in every later shard that
its ball touches, so each pair meets in one of the two shards; there a tree of the whole shard
answers the questions of a block at once.

Only as many links leave a shard as connect what its links connect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peopleflow.llm.common import add_columns, documents, ship
from peopleflow.llm.groups import components
from peopleflow.session import stage

WORDS, SEED = 4, 42

#: Fingerprints that differ in so many bits are linked.
BITS = 4

#: Fingerprints on which the upper levels of the tree are built; drawn by a hash.
SAMPLE = 65_536

#: Shards are a power of two: this many at least, and more where one would hold over SHARD fingerprints.
SHARDS, SHARD = 32, 65_536

#: Fingerprints of a leaf, and questions that are answered in one go.
LEAF, BLOCK = 96, 100_000

#: Vantage points that are tried for a split, and fingerprints on which they are tried.
TRIED, TRIAL = 8, 512

#: Shingles whose bits are counted in one go.
SHINGLES = 100_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes) -> int:
    """64 bits; each is set where it is set in over half of the hashes of the text's shingles."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    span = min(WORDS, len(words)) - 1
    starts, ends = (ends - sizes)[: len(words) - span].tolist(), ends[span:].tolist()
    of, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES):
        places = zip(starts[at : at + SHINGLES], ends[at : at + SHINGLES])
        found = np.array([of(line[a:b], SEED) for a, b in places], "<u8")
        ones += np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def sign(docs: DataFrame, text: str = "text", out: str = "print") -> DataFrame:
    """Add the fingerprint of every row's whole text, as a signed number; null reads as the empty text."""

    def make(columns):
        for column in columns:
            found = [fingerprint(x or b"") for x in column.to_pylist()]
            yield [pa.array(np.array(found, np.uint64).view(np.int64))]

    rows = docs.withColumn("__bytes", F.col(text).cast("binary"))
    return add_columns(rows, "__bytes", [T.StructField(out, T.LongType())], make).drop("__bytes")


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point and a radius that halve the points, or none where all are equally far.

    Of some points the one whose distances spread most is taken, since its border cuts fewest balls.
    """
    step = max(1, len(points) // TRIAL)
    trial, tried = points[::step], points[:: max(1, len(points) // TRIED)]
    far = apart(tried[:, None], trial)
    vantage = tried[int(far.std(1).argmax())]
    own = np.sort(apart(vantage, points))
    middle = own[(len(own) - 1) // 2]
    # The border may be moved to the next distance, so that points equally far stay together.
    lower = own[own < middle]
    choices = [r for r in (middle, lower[-1] if len(lower) else -1) if own[0] <= r < own[-1]]
    if not choices:
        return None
    return vantage, int(min(choices, key=lambda r: abs(2 * np.searchsorted(own, r, "right") - len(own))))


class Shards:
    """The upper levels of the tree: nodes in heap order, as vantage points and radii."""

    def __init__(self, sample: np.ndarray, shards: int) -> None:
        self.depth = (shards - 1).bit_length()
        nodes = (1 << self.depth) - 1
        self.vantage, self.radius = np.zeros(nodes, np.uint64), np.zeros(nodes, np.int64)
        parts = {0: sample}
        for node in range(nodes):
            own = parts.pop(node, sample[:0])
            found = split(own) if len(own) > 1 else None
            # A node that nothing splits sends all to one side.
            self.vantage[node], self.radius[node] = found or (0, 64)
            inner = apart(self.vantage[node], own) <= self.radius[node]
            parts[2 * node + 1], parts[2 * node + 2] = own[inner], own[~inner]

    def home(self, prints: np.ndarray) -> np.ndarray:
        """The shard of each fingerprint."""
        node = np.zeros(len(prints), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 2 - (apart(self.vantage[node], prints) <= self.radius[node])
        return node - len(self.vantage)

    def touched(self, prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """All shards that hold points within ``bits`` of a fingerprint: its row, and the shard."""
        row, node = np.arange(len(prints)), np.zeros(len(prints), np.int64)
        for _ in range(self.depth):
            far = apart(self.vantage[node], prints[row])
            inner, outer = far - bits <= self.radius[node], far + bits > self.radius[node]
            row = np.r_[row[inner], row[outer]]
            node = np.r_[2 * node[inner] + 1, 2 * node[outer] + 2]
        return row, node - len(self.vantage)


class Forest:
    """Links between numbered things, of which only those are kept that connect something new."""

    def __init__(self) -> None:
        self.root = np.zeros(0, np.int64)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def resize(self, size: int) -> None:
        """Add things that stand alone, or forget the last ones; a root is the smallest of its tree."""
        self.root = np.r_[self.root[:size], np.arange(len(self.root), size)]

    def find(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.root[x]
            if (up == x).all():
                return x
            self.root[x] = self.root[up]
            x = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            high, low = self.find(a), self.find(b)
            high, low = np.maximum(high, low), np.minimum(high, low)
            open_ = np.flatnonzero(high != low)
            # Every root takes one link down in a round; the others are looked at again.
            _, first = np.unique(high[open_], return_index=True)
            chosen = open_[first]
            self.root[high[chosen]] = low[chosen]
            self.a.append(a[chosen])
            self.b.append(b[chosen])
            a, b = a[open_], b[open_]

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """The links kept since the last call."""
        none = np.zeros(0, np.int64)
        a, b = np.concatenate([none, *self.a]), np.concatenate([none, *self.b])
        self.a, self.b = [], []
        return a, b


def search(points: np.ndarray, asked: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of ``asked`` and ``points`` at most ``bits`` apart, a leaf of the tree at a time.

    The tree is walked as it is built, with all questions that reach a node.
    """
    todo = [(np.arange(len(points)), np.arange(len(asked)))]
    while todo:
        own, wanted = todo.pop()
        if not len(wanted) or not len(own):
            continue
        found = split(points[own]) if len(own) > LEAF else None
        if found is None:
            for at in range(0, len(wanted), max(1, 2_000_000 // len(own))):
                part = wanted[at : at + max(1, 2_000_000 // len(own))]
                near = np.bitwise_count(asked[part][:, None] ^ points[own]) <= bits
                row, column = np.nonzero(near)
                yield part[row], own[column]
            continue
        vantage, radius = found
        inner, far = apart(vantage, points[own]) <= radius, apart(vantage, asked[wanted])
        todo.append((own[inner], wanted[far - bits <= radius]))
        todo.append((own[~inner], wanted[far + bits > radius]))


class Tree:
    """One shard: its points, and what has been found to be connected there."""

    def __init__(self, bits: int) -> None:
        self.bits, self.points, self.forest = bits, None, Forest()

    def answer(self, points: list[np.ndarray], asked: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Links of the points among each other, which come with the first block, and to those asked."""
        none = np.zeros(0, np.uint64)
        if self.points is None:
            self.points = own = np.concatenate([none, *points])
            self.forest.resize(len(own))
            for at in range(0, len(own), BLOCK):
                for a, b in search(own, own[at : at + BLOCK], self.bits):
                    ordered = a + at > b
                    self.forest.link(a[ordered] + at, b[ordered])
        size, wanted = len(self.points), np.concatenate([none, *asked])
        self.forest.resize(size + len(wanted))
        for a, b in search(self.points, wanted, self.bits):
            self.forest.link(a + size, b)
        both = np.r_[self.points, wanted].view(np.int64)
        # What was asked comes once in a shard, and no root lies among it.
        self.forest.resize(size)
        a, b = self.forest.taken()
        yield pa.RecordBatch.from_arrays([pa.array(both[a]), pa.array(both[b])], names=["a", "b"])


def linked(prints: DataFrame, column: str = "print", bits: int = BITS) -> DataFrame:
    """Links between distinct fingerprints at most ``bits`` apart, as few as connect the same: ``a, b``."""
    spark = prints.sparkSession
    ship(spark)
    total = prints.count()
    last = min(2**63 - 1, -(2**63) + 2**64 * SAMPLE // max(total, 1))
    sample = prints.select(column).filter(F.xxhash64(column) <= F.lit(last)).toPandas()[column]
    sample = np.sort(sample.to_numpy(np.int64))
    shards = SHARDS
    while shards * SHARD < total:
        shards *= 2
    held = spark.sparkContext.broadcast(Shards(sample.view(np.uint64), shards))

    def deal(batches):
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(own), 10_000):
                part = own[at : at + 10_000].view(np.uint64)
                home = held.value.home(part)
                row, shard = held.value.touched(part, bits)
                later = shard > home[row]
                row, shard = row[later], shard[later]
                arrays = [
                    np.r_[home, shard],
                    np.r_[np.zeros(len(home), np.int32), np.ones(len(row), np.int32)],
                    np.r_[part, part[row]].view(np.int64),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(arrays[0]), pa.array(arrays[1].astype(np.int32)), pa.array(arrays[2])],
                    names=["shard", "asks", "print"],
                )

    dealt = prints.select(column).mapInArrow(deal, "shard bigint, asks int, print bigint")
    dealt = dealt.repartition(F.col("shard")).sortWithinPartitions("shard", "asks")

    def answer(batches):
        # The points of a shard come before its questions, which are answered a block at a time.
        shard, points, asked, waiting = None, [], [], 0
        for batch in batches:
            numbers, asks, own = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            borders = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1], True]) if len(own) else []
            for a, b in zip(borders, borders[1:]):
                if numbers[a] != shard:
                    if shard is not None:
                        yield from tree.answer(points, asked)
                    shard, tree, points, asked, waiting = numbers[a], Tree(bits), [], [], 0
                part = own[a:b].view(np.uint64)
                points.append(part[asks[a:b] == 0])
                asked.append(part[asks[a:b] == 1])
                waiting += len(asked[-1])
                if waiting >= BLOCK:
                    yield from tree.answer(points, asked)
                    points, asked, waiting = [], [], 0
        if shard is not None:
            yield from tree.answer(points, asked)

    return stage(dealt.mapInArrow(answer, "a bigint, b bigint"), "links")


def near_prints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """``doc_id, print, component_id`` of every row: its fingerprint and the smallest id reachable.

    A-Z is lowered; shingles are four words, repeats included, and a text of fewer is one shingle.
    Texts without words, null and empty ones, have fingerprint 0, which is linked like any other.
    Fingerprints are linked where at most ``bits`` bits differ; every link counts. Rows with equal fingerprints are one
    point, so copies and repeated rows cost nothing beyond their signing, and are marked alike. A
    null id counts as largest: it names a component only where no other id is in it. An empty table stays
    empty; other columns are not read.
    """
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed = stage(sign(docs).drop("text"), "signed")
    first = stage(signed.groupBy("print").agg(F.min("doc_id").alias("doc_id")), "prints")
    links = linked(first, bits=bits)
    labels = stage(first.select(F.col("print").alias("node"), F.col("print").alias("label")), "labels")
    if not links.isEmpty():
        labels = components(labels, links)
    named = labels.join(first.withColumnRenamed("print", "node"), "node")
    smallest = stage(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "smallest")
    named = stage(labels.join(smallest, "label").select(F.col("node").alias("print"), "component_id"), "components")
    return signed.join(named, "print").select("doc_id", "print", "component_id")


def op12_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint of every document and the component it belongs to."""
    found = near_prints(documents(spark, folder))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", digits, "component_id")
