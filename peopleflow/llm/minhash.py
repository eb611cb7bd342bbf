"""Near duplicates by b-bit MinHash, confirmed on full shingle sets (operator 5)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peopleflow.llm.common import add_columns, as_list, cut_to, documents, let_go, one_row_each, row_key, ship
from peopleflow.llm.groups import components, runs
from peopleflow.session import stage

#: Words in a shingle, and the least similarity of a link in hundredths.
WORDS = 5
SIMILAR = 75

#: Two sets of similarity s share a band with chance 1 - (1 - s ** ROWS) ** BANDS: 0.99998 at 0.75.
BANDS, ROWS = 40, 5
MINIMA = BANDS * ROWS

#: Bits kept of each minimum. Two different minima agree in them with chance 2 ** -BITS.
BITS = 2

#: Candidates go on if their estimate is at most so far, in hundredths, below SIMILAR: more than five
#: standard errors of an estimate from 200 minima of two bits.
MARGIN = 20

#: Rows of a block of a large bucket or cluster, and shingles of a block of long texts.
BLOCK = 2000
SHINGLES = 1_000_000
PARTNERS = 32

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLY = _random.integers(0, 2**31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _random.integers(0, 2**32, MINIMA, dtype=np.uint32)
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first ``n`` powers of the base of the rolling hash and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; no two numbers become one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, block: int = 200_000) -> np.ndarray:
    """The sorted set of a text's shingles as 64-bit hashes; one for a text of fewer words."""
    words = text.encode().lower().split()
    parts = [np.zeros(0, np.uint64)]
    for at in range(0, max(len(words) - WORDS + 1, min(len(words), 1)), block):
        own = words[at : at + block + WORDS - 1]
        data = np.frombuffer(b" ".join(own), np.uint8)
        up, down = powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        span = min(WORDS, len(own)) - 1
        starts, ends = starts[: len(own) - span], ends[span:]
        parts.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
    return np.unique(np.concatenate(parts))


def node_of(found: np.ndarray) -> int:
    """One 64-bit number for a set of shingles."""
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def minima(found: np.ndarray) -> np.ndarray:
    """The smallest value of each of the hash functions over a set that is not empty."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        values = np.multiply.outer(_MULTIPLY, x[at : at + 1024]) + _ADD[:, None]
        np.minimum(out, values.min(1), out=out)
    return out


def signature(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the bands, and bits of all minima, mixed, packed into 64-bit numbers."""
    low = minima(found)
    key = np.arange(BANDS, dtype=np.uint64)
    for row in low.reshape(BANDS, ROWS).T:
        key = mix(key * np.uint64(_BASE) + row)
    per = 64 // BITS
    bits = np.zeros(-(-MINIMA // per) * per, np.uint64)
    # The functions are linear, so the low bits of all minima of one shingle would agree or differ together.
    bits[:MINIMA] = mix(low.astype(np.uint64)) & np.uint64(2**BITS - 1)
    shifts = np.arange(per, dtype=np.uint64) * np.uint64(BITS)
    packed = np.bitwise_or.reduce(bits.reshape(-1, per) << shifts, axis=1)
    return key.view(np.int64), packed.view(np.int64)


def sign(docs: DataFrame) -> DataFrame:
    """From ``doc_id, text``: ``doc_id, n_shingles, node, bands, sketch``, null where there are no words."""

    def make(columns):
        let_go()
        for column in columns:
            sizes, nodes, bands, sketches = [], [], [], []
            for value in as_list(column):
                found = shingles(value)
                sizes.append(len(found))
                nodes.append(node_of(found) if len(found) else None)
                keys, packed = signature(found) if len(found) else (None, None)
                bands.append(keys)
                sketches.append(packed)
            longs = pa.list_(pa.int64())
            yield [pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(bands, longs), pa.array(sketches, longs)]

    many = T.ArrayType(T.LongType())
    fields = [("n_shingles", T.LongType()), ("node", T.LongType()), ("bands", many), ("sketch", many)]
    return add_columns(docs, "text", [T.StructField(*f) for f in fields], make)


def may_link(a: Column, b: Column) -> Column:
    """Whether two signed sets can be similar enough, by their sizes and their packed bits.

    ``a`` and ``b`` are structs with ``n`` and ``sketch``. Minima that differ show in the bits with
    chance 1 - 2^-BITS, so the share that differs is divided by that to estimate 1 - similarity.
    """
    ones = (2**64 - 1) // (2**BITS - 1)
    low = F.lit(ones - 2**64 if ones >= 2**63 else ones)

    def unequal(x: Column, y: Column) -> Column:
        apart = x.bitwiseXOR(y)
        folded = apart
        for k in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(apart, k))
        return F.bit_count(folded.bitwiseAND(low))

    counts = F.zip_with(a["sketch"], b["sketch"], unequal)
    differing = F.aggregate(counts, F.lit(0), lambda s, x: s + x)
    least, most = F.least(a["n"], b["n"]), F.greatest(a["n"], b["n"])
    return (differing <= MOST_UNEQUAL) & (least * 100 >= most * SIMILAR)


#: Minima whose bits may differ between two candidates.
MOST_UNEQUAL = int(MINIMA * (1 - 2**-BITS) * (1 - (SIMILAR - MARGIN) / 100))


def forest_of(table: pa.Table, sets: list[np.ndarray] | None = None) -> tuple[list[int], list[int]]:
    """Pairs of a tile's rows with different labels, as few as connect all rows that such pairs connect.

    Without ``sets`` a pair is one that packed bits find likely; with the rows' full sets it is a
    link, and rows of one label count as connected from the start. Rows that are connected already
    are not compared again. Where a tile holds rows of several cells, pairs inside a cell belong
    to another tile. Rows come sorted by node, so tiles of the same rows give the same pairs.
    """
    role, label, cell, node, n = (table[c].to_numpy() for c in ("role", "label", "cell", "node", "n"))
    sketch = np.stack([np.asarray(x, np.int64) for x in table["sketch"].to_pylist()]).view(np.uint64)
    ones = np.uint64((2**64 - 1) // (2**BITS - 1))
    one_cell = (cell == cell[0]).all()
    root = np.arange(len(node))
    if sets is not None:
        root = np.unique(label, return_inverse=True)[1]
        values, flat = np.unique(np.concatenate(sets), return_inverse=True)
        members = np.split(flat, np.cumsum([len(x) for x in sets])[:-1])
        mark = np.zeros(len(values), bool)
    a, b = [], []
    for i in np.flatnonzero(role == 1).tolist():
        fits = (label != label[i]) & (root != root[i]) & (one_cell | (cell != cell[i]))
        fits[: i + 1] &= role[: i + 1] == 0  # both of two minor rows come here; the first has done
        fits &= np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * SIMILAR
        at = np.flatnonzero(fits)
        apart = sketch[at] ^ sketch[i]
        folded = apart.copy()
        for k in range(1, BITS):
            folded |= apart >> np.uint64(k)
        at = at[np.bitwise_count(folded & ones).sum(1) <= MOST_UNEQUAL]
        if sets is not None and len(at):
            mark[members[i]] = True
            borders = np.cumsum([0, *(len(members[j]) for j in at[:-1])])
            shared = np.add.reduceat(mark[np.concatenate([members[j] for j in at])], borders, dtype=np.int64)
            mark[members[i]] = False
            at = at[100 * shared >= SIMILAR * (n[i] + n[at] - shared)]
        if len(at):
            _, first = np.unique(root[at], return_index=True)
            a += [int(node[i])] * len(first)
            b += node[at[first]].tolist()
            root[np.isin(root, root[at])] = root[i]
    return a, b


def named_texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows``, a written table with a ``name`` each, and the texts of those names.

    Only texts that may be asked for are shuffled.
    """
    wanted = stage(rows.select("name").distinct(), "wanted")
    return cut_to(docs.select("name", "text"), "name", wanted).join(rows.hint("merge"), "name")


def confirmed(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (``a, b``; a written table) whose full sets are similar enough.

    The texts of a's partners meet a's text in blocks of some PARTNERS, so an ``a`` with any number
    of partners is spread. A text is taken for a set only if it gives that set.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("blocks"))
    sizes = stage(sizes, "sizes")
    dealt = pairs.join(sizes, "a").select(
        "a", F.pmod(F.xxhash64("b"), "blocks").cast("int").alias("block"), F.lit(1).alias("role"), F.col("b").alias("node")
    )
    heads = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    roles = dealt.unionByName(heads.select("a", "block", F.lit(0).alias("role"), F.col("a").alias("node")))
    roles = stage(roles.join(sets.select("node", "name"), "node"), "roles")
    rows = named_texts(docs, roles).select("a", "block", "role", "node", "text")
    rows = rows.repartition("a", "block").sortWithinPartitions("a", "block", "role")

    def check(batches):
        let_go()
        for table in runs(batches, ["a", "block"]):
            a, head, linked = table["a"][0].as_py(), None, set()
            # Heads come first; a row whose text does not give its node has the name of another by chance.
            for role, node, text in zip(*(table[c].to_pylist() for c in ("role", "node", "text"))):
                found = shingles(text or "")
                if not len(found) or node_of(found) != node:
                    continue
                if not role:
                    head = found
                elif head is not None:
                    shared = len(np.intersect1d(head, found, assume_unique=True))
                    if 100 * shared >= SIMILAR * (len(head) + len(found) - shared):
                        linked.add(node)
            linked = sorted(linked)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a] * len(linked), pa.int64()), pa.array(linked, pa.int64())], names=["a", "b"]
            )

    ship(docs.sparkSession)
    return stage(rows.mapInArrow(check, "a bigint, b bigint"), "links")


def tiled(rows: DataFrame, key: str, weight: Column) -> DataFrame:
    """Tiles in which all rows of a group with different labels meet; ``rows`` have the group, node and label.

    The commonest label of a group is dealt over blocks, each row once, and the rows of all other
    labels go to every block and, among themselves, to the tiles of a grid. So a large group of
    linked texts with a few strangers costs its size, not its square. A block weighs about BLOCK.
    """
    groups = rows.groupBy(key, "label").agg(F.sum(weight).alias("w"))
    groups = groups.groupBy(key).agg(
        F.count(F.lit(1)).alias("kinds"), F.max_by("label", "w").alias("major"),
        F.max("w").alias("majors"), F.sum("w").alias("all"),
    )
    open_ = groups.filter("kinds > 1").select(
        key, "major",
        F.ceil(F.col("majors") / BLOCK).cast("int").alias("wide"),
        F.greatest(F.ceil((F.col("all") - F.col("majors")) / BLOCK), F.lit(1)).cast("int").alias("grid"),
    )
    rows = rows.join(stage(open_, "open"), key)
    own = F.pmod(F.xxhash64("node"), F.col("wide")).cast("int")
    cell = F.pmod(F.xxhash64("node"), F.col("grid")).cast("int")
    kept = (key, "label", "node")
    majors = rows.filter("label = major").select(
        *kept, own.alias("x"), F.lit(-1).alias("y"), F.lit(0).alias("role"), F.lit(-1).alias("cell")
    )
    minors = rows.filter("label <> major")
    across = minors.select(
        *kept, F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("x"), F.lit(-1).alias("y"),
        F.lit(1).alias("role"), F.lit(-2).alias("cell"),
    )
    within = minors.withColumn("cell", cell).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("grid") - 1)))
    within = within.select(
        *kept, F.least("cell", "other").alias("x"), F.greatest("cell", "other").alias("y"), F.lit(1).alias("role"), "cell"
    )
    return majors.unionByName(across).unionByName(within)


def _pairs(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def untried(sets: DataFrame, crowded: DataFrame, labels: DataFrame) -> DataFrame:
    """Groups of nodes that hold all likely pairs of different labels in a bucket: ``node, cluster``.

    Of the likely pairs only so many leave a tile as connect its rows, at most one a row.
    """
    rows = stage(crowded.join(labels, "node").select("bucket", "node", "label"), "labelled")
    tiles = tiled(rows, "bucket", F.lit(1)).join(sets.select("node", F.col("n_shingles").alias("n"), "sketch"), "node")
    tiles = tiles.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "node")

    def estimate(batches):
        for table in runs(batches, ["bucket", "x", "y"]):
            yield _pairs(*forest_of(table))

    ship(sets.sparkSession)
    pairs = stage(tiles.mapInArrow(estimate, "a bigint, b bigint").distinct(), "likely")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = stage(nodes.select("node", F.col("node").alias("label")), "clusters")
    return components(nodes, pairs).select("node", F.col("label").alias("cluster"))


def links_in(docs: DataFrame, sets: DataFrame, clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between different labels in a cluster, as many as connect what they connect: ``a, b``.

    Texts meet in tiles that weigh at most about BLOCK rows or SHINGLES shingles, and full sets are
    compared there, so pairs that are likely and yet no links never become rows.
    """
    rows = clusters.join(labels, "node").join(sets.select("node", "n_shingles"), "node")
    weight = F.greatest(F.lit(1.0), F.col("n_shingles") * (BLOCK / SHINGLES))
    tiles = tiled(stage(rows, "labelled"), "cluster", weight)
    tiles = tiles.join(sets.select("node", "name", F.col("n_shingles").alias("n"), "sketch"), "node")
    tiles = stage(tiles, "tiles")
    rows = named_texts(docs, tiles).repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y", "node")

    def check(batches):
        for table in runs(batches, ["cluster", "x", "y"]):
            found = [shingles(x) for x in as_list(table["text"])]
            # A row whose text does not give its node has the name of another by chance.
            own = [k for k, node in enumerate(table["node"].to_pylist()) if len(found[k]) and node_of(found[k]) == node]
            if own:
                yield _pairs(*forest_of(table.drop_columns(["text", "name"]).take(own), [found[k] for k in own]))

    ship(docs.sparkSession)
    return stage(rows.mapInArrow(check, "a bigint, b bigint"), "links")


def near_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`near_duplicates` with ``digest``, the text's SHA-256, and ``label``, a number for each component.

    Both are for telling rows apart that share an id, or have none. ``label`` is null for texts without words.
    """
    own, value = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    digest = F.sha2(F.coalesce(value, F.lit("")), 256).alias("digest")
    docs = df.select(own.alias("doc_id"), value.alias("text"), F.xxhash64(own, value).alias("name"), digest)
    signed = stage(sign(docs).drop("text"), "signed")
    # Copies become one row in each task before they are shuffled.
    sets = signed.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min("name").alias("name"),
        *[F.any_value(c).alias(c) for c in ("n_shingles", "bands", "sketch")],
    )
    sets = stage(sets, "sets")
    first = sets.select("node", "doc_id")
    bucketed = sets.select(F.explode("bands").alias("bucket"), "node", "doc_id")
    hubs = bucketed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct("doc_id", "node")).alias("hub")
    )
    hubs = stage(hubs.filter("size > 1").select("bucket", F.col("hub.node").alias("hub")), "hubs")
    crowded = stage(bucketed.join(hubs, "bucket").select("bucket", "hub", "node"), "buckets")
    # The smallest id with which a class shares the most buckets is its star.
    stars = crowded.filter("node <> hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("n"))
    stars = stars.groupBy(F.col("node").alias("b")).agg(F.max_by("hub", F.struct("n", "hub")).alias("a"))
    one, two = (
        sets.select(F.col("node").alias(k), F.struct(F.col("n_shingles").alias("n"), "sketch").alias("s" + k))
        for k in ("a", "b")
    )
    likely = stage(stars, "stars").join(one, "a").join(two, "b").filter(may_link(F.col("sa"), F.col("sb")))
    labels = stage(first.select("node", F.col("node").alias("label")), "labels")
    links = confirmed(docs, sets, stage(likely.select("a", "b"), "pairs"))
    if not links.isEmpty():
        labels = components(labels, links)
    clusters = stage(untried(sets, crowded, labels), "clusters")
    links = links_in(docs, sets, clusters, labels)
    if not links.isEmpty():
        labels = components(labels, links)
    smallest = labels.join(first, "node")
    smallest = stage(smallest.groupBy("label").agg(F.min("doc_id").alias("component_id")), "smallest")
    named = stage(labels.join(smallest, "label").select("node", "label", "component_id"), "components")
    rows = ("doc_id", "digest", "n_shingles")
    out = signed.filter("node IS NOT NULL").select(*rows, "node").join(named, "node").drop("node")
    none = F.lit(None).cast("long").alias("label")
    alone = signed.filter("node IS NULL").select(*rows, none, F.col("doc_id").alias("component_id"))
    return out.unionByName(alone)


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The component of every row: ``doc_id, n_shingles, component_id, kept``.

    A text's set holds its distinct shingles of five words, A-Z lower-cased; a text of fewer words is
    one shingle, and null and blank texts have none and are linked with nothing. Sets are linked from a
    similarity of 0.75 on. Rows with equal sets are one class, signed and compared once. Every band
    of a class is a bucket. Every class is compared with one smallest id of its buckets. Where labels
    then still differ in a bucket, nodes that packed bits find likely form clusters, and all of a cluster are
    compared. Every comparison is estimated from packed bits and confirmed on full sets. ``component_id`` is the smallest id reachable, and
    rows with that id are kept; null ids count as largest, repeated rows are all marked alike, and so
    are several texts of a component under its id. An empty table stays empty. Other columns are not read.
    """
    out = near_groups(df, doc_id, text).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of ``docs`` with all its columns, that of the smallest id.

    A null id counts as largest; of several texts under one id that with the smaller digest stays, of repeated rows one.
    Rows with null or blank texts are linked with nothing and stay, all of them.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    groups = near_groups(docs, doc_id, text).filter("label IS NOT NULL")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    kept = groups.groupBy("label").agg(F.min(order).alias("first"))
    kept = stage(kept.select(row_key(F.col("first.doc_id"), F.col("first.digest")).alias("key")), "kept")
    has_words = value.rlike("[^ \\t\\n\\x0b\\f\\r]")
    rows = one_row_each(docs.filter(has_words), row_key(F.col(f"`{doc_id}`"), F.sha2(value, 256)), kept)
    return rows.unionByName(docs.filter(~has_words))


def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The component of near-equal texts of every document."""
    return near_duplicates(documents(spark, folder))


OP5_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
reach AS (
  SELECT doc_id, doc_id AS other FROM words
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT w.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id,
       min(other) = w.doc_id AS kept
FROM words w JOIN reach r ON r.doc_id = w.doc_id LEFT JOIN sizes s ON s.doc_id = w.doc_id GROUP BY w.doc_id
"""
