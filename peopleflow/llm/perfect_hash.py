"""Minimal perfect hashes of vocabularies, in shards, with their keys beside them.

A hash places the keys of a shard level by level: those that fall alone on a bit of a level stay
there, the others go on to the next. A key's slot is the number of placed bits before its own. Any
other string also gets a slot, or none, so the stored key of the slot is compared.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peopleflow.llm.common import ship
from peopleflow.llm.groups import runs
from peopleflow.llm.minhash import mix
from peopleflow.session import stage

#: Keys of a shard, about.
SHARD_KEYS = 8192

#: Bits of a level for each key that comes to it, and levels; keys that are left are stored by name.
ROOM, LEVELS = 2, 24

#: Seed of the hash of keys, as in Spark's own xxhash64.
SEED = 42

#: Bytes a key takes besides its own, at most about: its end, and its bits with their ranks.
KEY_BYTES = 16


def key_hashes(keys: Iterable[bytes]) -> np.ndarray:
    """XXH64 of each key, the same as ``xxhash64`` of the string in Spark."""
    of = xxhash.xxh64_intdigest
    return np.array([of(k, SEED) for k in keys], np.uint64)


def level_places(hashes: np.ndarray, level: int, sizes) -> np.ndarray:
    """The bit of each hash on a level of ``sizes`` bits."""
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (mix(hashes ^ salt) % np.asarray(sizes, np.uint64)).astype(np.int64)


def build(hashes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The levels of a perfect hash as 64-bit words, and each key's slot.

    Keys that no level places come last, in their order.
    """
    slots = np.zeros(len(hashes), np.int64)
    left, levels, placed = np.arange(len(hashes)), [], 0
    while len(left) and len(levels) < LEVELS:
        words = -(-ROOM * len(left) // 64)
        at = level_places(hashes[left], len(levels), 64 * words)
        alone = np.bincount(at, minlength=64 * words) == 1
        rank = np.cumsum(alone) - 1
        stays = alone[at]
        slots[left[stays]] = placed + rank[at[stays]]
        placed += int(alone.sum())
        levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
        left = left[~stays]
    slots[left] = placed + np.arange(len(left))
    return levels, slots


class PerfectHash:
    """The shards of one vocabulary. Slots are numbered through all shards, in the order given."""

    def __init__(self, shards: int, parts: list[dict]) -> None:
        """``parts`` are rows of `perfect_shards`; those of ``shards`` that are missing find nothing."""
        self.shards = shards
        order = np.full(shards, -1, np.int64)
        counts = np.zeros(len(parts), np.int64)
        ends, keys, self.rest = [], [], {}
        depth = max((len(p["levels"]) for p in parts), default=0)
        self.words = [[] for _ in range(depth)]
        self.ranks = [[] for _ in range(depth)]
        self.starts = np.zeros((depth, len(parts)), np.int64)
        self.sizes = np.zeros((depth, len(parts)), np.int64)
        at = [0] * depth
        for k, part in enumerate(parts):
            order[part["shard"]] = k
            counts[k] = part["n"]
        self.order, self.offsets = order, np.r_[0, np.cumsum(counts)].astype(np.int64)
        self.numbers = np.array([p["shard"] for p in parts], np.int64)
        for k, part in enumerate(parts):
            before = self.offsets[k]
            for level, blob in enumerate(part["levels"]):
                words = np.frombuffer(blob, np.uint64)
                bits = np.bitwise_count(words).astype(np.int64)
                self.words[level].append(words)
                self.ranks[level].append(before + np.cumsum(bits) - bits)
                self.starts[level, k], self.sizes[level, k] = at[level], len(words)
                at[level] += len(words)
                before += bits.sum()
            own = np.frombuffer(part["ends"], np.int32)
            ends.append(own.astype(np.int64))
            keys.append(part["keys"])
            for slot in range(int(before), int(self.offsets[k + 1])):
                local = slot - self.offsets[k]
                self.rest[part["keys"][own[local - 1] if local else 0 : own[local]]] = slot
        self.words = [np.concatenate(x) for x in self.words]
        self.ranks = [np.concatenate(x) for x in self.ranks]
        base = np.cumsum([0, *map(len, keys)])
        ends = np.concatenate([np.zeros(1, np.int64), *(e + b for e, b in zip(ends, base))])
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(b"".join(keys))]
        self.keys = pa.Array.from_buffers(pa.large_binary(), int(self.offsets[-1]), buffers)

    def __len__(self) -> int:
        return len(self.keys)

    def slots(self, wanted: pa.Array) -> np.ndarray:
        """The slot of each string, or -1 where it is no key."""
        names = wanted.to_pylist()
        hashes = key_hashes(names)
        out = np.full(len(names), -1, np.int64)
        if not len(self.keys):
            return out
        shard = self.order[hashes.view(np.int64) % self.shards]
        left = np.flatnonzero(shard >= 0)
        for level, (words, ranks) in enumerate(zip(self.words, self.ranks)):
            size = self.sizes[level, shard[left]]
            left = left[size > 0]
            size = size[size > 0]
            place = level_places(hashes[left], level, 64 * size)
            word = self.starts[level, shard[left]] + (place >> 6)
            bit = (place & 63).astype(np.uint64)
            held = words[word]
            here = (held >> bit) & np.uint64(1) > 0
            below = held[here] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            out[left[here]] = ranks[word[here]] + np.bitwise_count(below)
            left = left[~here]
        found = np.flatnonzero(out >= 0)
        same = pc.equal(self.keys.take(pa.array(out[found])), wanted.take(pa.array(found)).cast(pa.large_binary()))
        out[found[~same.to_numpy(zero_copy_only=False)]] = -1
        if self.rest:
            for k in np.flatnonzero(out < 0).tolist():
                out[k] = self.rest.get(names[k], -1)
        return out


def perfect_shards(terms: DataFrame, group: str, term: str, head: Column) -> DataFrame:
    """A perfect hash of the distinct ``term`` of each ``group``, in shards, as a written table.

    ``group, shards, head, shard, n, levels, ends, keys``: a group's terms are dealt over ``shards``
    by their hash, apart for those where ``head`` holds and the others; ``keys`` are the strings in
    the order of their slots, ``ends`` where each ends. Both columns are strings without nulls.
    """
    rows = terms.select(F.col(group).alias("group"), F.col(term).alias("term"), head.alias("head"))
    sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("v"))
    sizes = sizes.select("group", F.ceil(F.col("v") / SHARD_KEYS).alias("shards"))
    rows = rows.join(sizes, "group").withColumn("shard", F.pmod(F.xxhash64("term"), "shards"))
    rows = rows.select("group", "shards", "head", "shard", F.col("term").cast("binary").alias("term"))
    rows = rows.repartition("group", "head", "shard").sortWithinPartitions("group", "head", "shard", "term")

    def make(batches):
        for table in runs(batches, ["group", "head", "shard"]):
            own = table["term"].to_pylist()
            levels, slots = build(key_hashes(own))
            ordered = [own[k] for k in np.argsort(slots).tolist()]
            ends = np.cumsum([len(x) for x in ordered]).astype(np.int32)
            first = {c: table[c][0].as_py() for c in ("group", "shards", "head", "shard")}
            row = first | {"n": len(own), "levels": [x.tobytes() for x in levels], "ends": ends.tobytes()}
            yield pa.RecordBatch.from_pylist([row | {"keys": b"".join(ordered)}], schema=kind)

    kind = pa.schema(
        [("group", pa.string()), ("shards", pa.int64()), ("head", pa.bool_()), ("shard", pa.int64()), ("n", pa.int64())]
        + [("levels", pa.list_(pa.binary())), ("ends", pa.binary()), ("keys", pa.binary())]
    )
    schema = "group string, shards bigint, head boolean, shard bigint, n bigint, levels array<binary>, ends binary, keys binary"
    ship(terms.sparkSession)
    return stage(rows.mapInArrow(make, schema), "shards")


def stored_keys(shards: DataFrame) -> DataFrame:
    """The keys of `perfect_shards` as rows: ``group, head, shard, slot, term``; slots count in the shard."""

    def make(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.r_[0, np.frombuffer(row["ends"], np.int32)].tolist()
                keys = [row["keys"][a:b].decode() for a, b in zip(ends, ends[1:])]
                n = len(keys)
                arrays = [[row["group"]] * n, [row["head"]] * n, [row["shard"]] * n, list(range(n)), keys]
                names = ["group", "head", "shard", "slot", "term"]
                kinds = [pa.string(), pa.bool_(), pa.int64(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds)], names=names)

    ship(shards.sparkSession)
    rows = shards.select("group", "head", "shard", "ends", "keys")
    return rows.mapInArrow(make, "group string, head boolean, shard bigint, slot int, term string")


def head_from(terms: DataFrame, frequency: str, term: str, limit: int) -> int:
    """The least frequency, a power of two, from which terms with KEY_BYTES each fit into ``limit`` bytes.

    Read from a histogram of at most 64 rows.
    """
    power = (F.length(F.bin(frequency)) - 1).alias("power")
    rows = terms.select(power, (F.octet_length(term) + KEY_BYTES).alias("bytes"))
    held = {r["power"]: r["bytes"] for r in rows.groupBy("power").agg(F.sum("bytes").alias("bytes")).collect()}
    least, used = 64, 0
    while least and used + held.get(least - 1, 0) <= limit:
        least -= 1
        used += held.get(least, 0)
    return 1 << least

