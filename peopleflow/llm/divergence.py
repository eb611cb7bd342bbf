"""How the sources of a language differ in their words, recounted through perfect hashes (operator 13).

The first pass counts in how many documents a term occurs; this is exact, and rare terms go. The
kept ones get perfect hashes in shards, whose slots are small numbers. Those of the most frequent
terms, HEAD_BYTES of them at most, are broadcast; the second pass adds up the occurrences of every
(language, source) group in a dense array of slots. Occurrences of terms outside the broadcast are
counted by their name and meet their slots in a join, so nothing is lost where a vocabulary outgrows
the bound. From there on all work is done shard by shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peopleflow.llm.common import documents, ship
from peopleflow.llm.groups import runs
from peopleflow.llm.perfect_hash import PerfectHash, head_from, perfect_shards, stored_keys
from peopleflow.llm.tokens import GAP, PART, Cut, blocks, numbered
from peopleflow.session import stage

#: Documents of its language a term must occur in.
LEAST_DOCUMENTS = 3

#: Bytes of perfect hashes and keys that are broadcast, at most.
HEAD_BYTES = 32_000_000

#: Cells of the dense arrays that a task holds before it passes them on.
CELLS = 8_000_000

#: Sources of a language that meet in one tile.
TILE = 128

#: A chance of one, in the units of all figures.
UNIT = 1_000_000_000

TOP = 200

#: ASCII letters and all bytes above ASCII are parts of terms.
KINDS = np.array([PART if chr(b).isascii() and chr(b).isalpha() or b >= 128 else GAP for b in range(256)], np.int8)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``lang, term, n``: in how many rows of ``docs`` (``lang, source, text``) each term occurs."""

    def count(batches):
        for batch in batches:
            for block in blocks(batch, 2):
                cut = Cut(block.column(2).to_pylist(), KINDS)
                code, names = cut.encoded()
                lang, langs = numbered(block.column(0))
                # A term counts once for a row.
                once = np.unique(cut.row * len(names) + code)
                row, code = np.divmod(once, max(len(names), 1))
                found, n = np.unique(lang[row] * len(names) + code, return_counts=True)
                own, code = np.divmod(found, max(len(names), 1))
                arrays = [pa.array(langs, pa.string()).take(pa.array(own)), as_text(names.take(pa.array(code))), pa.array(n)]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "term", "n"])

    ship(docs.sparkSession)
    found = docs.mapInArrow(count, "lang string, term string, n bigint")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def as_text(words: pa.Array) -> pa.Array:
    return words.cast(pa.large_string()).cast(pa.string())


class Slots:
    """Dense counts of slots, an array for each group, passed on when there are CELLS of them."""

    def __init__(self, hashes: dict[str, PerfectHash]) -> None:
        self.hashes = hashes
        self.dense: dict[tuple[str, str], np.ndarray] = {}

    def add(self, lang: str, source: str, slots: np.ndarray) -> None:
        if (lang, source) not in self.dense:
            self.dense[lang, source] = np.zeros(len(self.hashes[lang]), np.int64)
        found, n = np.unique(slots, return_counts=True)
        self.dense[lang, source][found] += n

    def full(self) -> bool:
        return sum(map(len, self.dense.values())) >= CELLS

    def flush(self) -> Iterator[pa.RecordBatch]:
        """Each group's counts above zero, a row for each shard that has some."""
        for (lang, source), counts in self.dense.items():
            own = self.hashes[lang]
            at = np.flatnonzero(counts)
            part = np.searchsorted(own.offsets, at, "right") - 1
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)])
            ends = pa.array(np.r_[first, len(at)].astype(np.int32))
            local = (at - own.offsets[part]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (local, counts[at])]
            yield found_rows(lang, source, len(first), pa.array(own.numbers[part[first]]), *lists)
        self.dense.clear()


_hashes: dict[int, tuple[object, dict[str, PerfectHash]]] = {}


def hashes_of(held) -> dict[str, PerfectHash]:
    """The perfect hash of each language, made once in a worker from broadcast shards."""
    parts = held.value
    if _hashes.get(0, (None,))[0] is not parts:
        own: dict[str, list[dict]] = {}
        for part in parts:
            own.setdefault(part["group"], []).append(part)
        _hashes[0] = parts, {k: PerfectHash(x[0]["shards"], x) for k, x in own.items()}
    return _hashes[0][1]

def found_rows(lang: str, source: str, n: int, shard=None, slots=None, counts=None, term=None, times=None):
    """``n`` rows of a group: counts of slots in shards, or of terms that have none yet."""
    arrays = [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string())]
    rest = (shard, slots, counts, term, times)
    kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.string(), pa.int64())
    arrays += [pa.nulls(n, kind) if x is None else x for x, kind in zip(rest, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "shard", "slots", "counts", "term", "times"])


def recounted(docs: DataFrame, shards: DataFrame, whole: bool) -> DataFrame:
    """Occurrences of kept terms by group: ``lang, head, shard, source, slots, counts``, several rows for each.

    ``whole`` says that the broadcast shards hold all kept terms, so that other words need no second look.
    """
    spark = docs.sparkSession
    head = shards.filter("head").drop("head").orderBy("group", "shard")
    held = spark.sparkContext.broadcast([r.asDict() for r in head.toLocalIterator()])

    def count(batches):
        own = hashes_of(held)
        slots = Slots(own)
        for batch in batches:
            for block in blocks(batch, 2):
                cut = Cut(block.column(2).to_pylist(), KINDS)
                code, names = cut.encoded()
                (lang, langs), (source, sources) = numbered(block.column(0)), numbered(block.column(1))
                group = (lang * len(sources) + source)[cut.row]
                order = np.argsort(group, kind="stable")
                group, code = group[order], code[order]
                slot, last = np.full(len(names), -1), -1
                borders = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if len(group) else group
                for a, b in zip(borders, borders[1:]):
                    k, s = divmod(int(group[a]), len(sources))
                    if k != last:  # the groups of a language follow each other
                        until = np.searchsorted(group, (k + 1) * len(sources))
                        wanted, last = np.unique(code[a:until]), k
                        slot[wanted] = own[langs[k]].slots(names.take(pa.array(wanted))) if langs[k] in own else -1
                    at = slot[code[a:b]]
                    if langs[k] in own:
                        slots.add(langs[k], sources[s], at[at >= 0])
                    if not whole:
                        rest, n = np.unique(code[a:b][at < 0], return_counts=True)
                        terms = as_text(names.take(pa.array(rest)))
                        yield found_rows(langs[k], sources[s], len(n), term=terms, times=pa.array(n))
                if slots.full():
                    yield from slots.flush()
        yield from slots.flush()

    ship(spark)
    schema = "lang string, source string, shard bigint, slots array<int>, counts array<bigint>, term string, times bigint"
    found = stage(docs.mapInArrow(count, schema), "recount")
    by_slot = ("lang", "head", "shard", "source", "slots", "counts")
    head = found.filter("shard IS NOT NULL").withColumn("head", F.lit(True)).select(*by_slot)
    if whole:
        return head
    named = found.filter("term IS NOT NULL").groupBy("lang", "source", "term").agg(F.sum("times").alias("n"))
    keys = stored_keys(shards.filter("NOT head")).withColumnRenamed("group", "lang")
    # A list holds no more than the keys of a shard.
    tail = named.join(keys, ["lang", "term"]).groupBy("lang", "head", "shard", "source")
    pairs = tail.agg(F.collect_list(F.struct("slot", "n")).alias("pairs"))
    pairs = pairs.withColumn("slots", F.col("pairs.slot")).withColumn("counts", F.col("pairs.n"))
    return head.unionByName(pairs.select(*by_slot))


def vectors(found: DataFrame) -> DataFrame:
    """One row for each shard and group, and one with a null source for the whole language.

    ``lang, head, shard, source, slots, counts, n``. A task holds two dense arrays at a time.
    """
    keys = ["lang", "head", "shard"]
    rows = found.repartition(*keys).sortWithinPartitions(*keys, "source")

    def add(batches):
        now, own, all_ = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        out: list[tuple] = []

        def close(key, source, counts):
            at = np.flatnonzero(counts)
            out.append((*key, source, at.astype(np.int32), counts[at], int(counts.sum())))

        def sent():
            columns = list(zip(*out))
            lists = []
            for k, kind in ((4, np.int32), (5, np.int64)):
                ends = np.cumsum([0, *map(len, columns[k])]).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(columns[k]).astype(kind))))
            kinds = (pa.string(), pa.bool_(), pa.int64(), pa.string())
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            names = [*keys, "source", "slots", "counts", "n"]
            out.clear()
            return pa.RecordBatch.from_arrays([*arrays, *lists, pa.array(columns[6], pa.int64())], names=names)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*keys, "source")]
            slots, counts = batch.column("slots"), batch.column("counts")
            ends, slots, counts = slots.offsets.to_pylist(), slots.values.to_numpy(), counts.values.to_numpy()
            for row, key in enumerate(zip(*columns)):
                if key != now:
                    if now:
                        close(now[:3], now[3], own)
                        all_[: len(own)] += own
                        if key[:3] != now[:3]:
                            close(now[:3], None, all_)
                            all_ = np.zeros(0, np.int64)
                    now, own = key, np.zeros(0, np.int64)
                at, n = slots[ends[row] : ends[row + 1]], counts[ends[row] : ends[row + 1]]
                if len(at) and at[-1] >= len(own):
                    own = np.r_[own, np.zeros(at.max() + 1 - len(own), np.int64)]
                if len(own) > len(all_):
                    all_ = np.r_[all_, np.zeros(len(own) - len(all_), np.int64)]
                np.add.at(own, at, n)
            if out:
                yield sent()
        if now:
            close(now[:3], now[3], own)
            all_[: len(own)] += own
            close(now[:3], None, all_)
            yield sent()

    ship(found.sparkSession)
    schema = "lang string, head boolean, shard bigint, source string, slots array<int>, counts array<bigint>, n bigint"
    return stage(rows.mapInArrow(add, schema), "vectors")


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """``1 + floor(UNIT * (count + 1) / total)`` in whole numbers, three digits at a time; total is below 2^53."""
    rest, share = counts + 1, np.zeros(len(counts), np.int64)
    for _ in range(3):
        rest = rest * 1000
        share = share * 1000 + rest // total
        rest %= total
    return share + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def compared(tile: pa.Table) -> list[tuple]:
    """The rows of a tile: sums over one shard for pairs of sources, and each source's best terms."""
    rows = tile.to_pylist()
    size = rows[0]["size"]
    same = rows[0]["x"] == rows[0]["y"]

    def dense(row):
        counts = np.zeros(size, np.int64)
        if row["slots"]:
            counts[row["slots"]] = row["counts"]
        return counts

    whole = next((r for r in rows if r["source"] is None), None)
    rows = [r for r in rows if r["source"] is not None]
    counts = [dense(r) for r in rows]
    p = np.array([shares(c, r["total"]) for c, r in zip(counts, rows)])
    block = np.array([r["block"] for r in rows])
    out = []
    for k, row in enumerate(rows):
        others = np.flatnonzero((block != block[k]) | same)
        others = others[others != k]
        sums = distance(p[k], p[others]).sum(1) if len(others) else []
        out += [(row["lang"], row["source"], "pair", rows[o]["source"], int(v)) for o, v in zip(others.tolist(), sums)]
    if whole is None:
        return out
    q = shares(dense(whole), whole["total"])
    ends = np.r_[0, np.frombuffer(whole["ends"], np.int32)].tolist()
    for k, row in enumerate(rows):
        at = np.flatnonzero((counts[k] > 0) & (p[k] > q))
        value = distance(p[k][at], q[at])
        if len(at) > TOP:
            enough = value >= np.partition(value, -TOP)[-TOP]
            at, value = at[enough], value[enough]
        best = sorted((-v, whole["keys"][ends[s] : ends[s + 1]]) for s, v in zip(at.tolist(), value.tolist()))
        out += [(row["lang"], row["source"], "term", term.decode(), -v) for v, term in best[:TOP]]
    return out


def audit_sources(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """How far sources differ from each other and in which terms from their language.

    ``lang, source, part, item, value, rank``. Terms are runs of ASCII letters and characters above
    ASCII, A-Z in lower case; a language keeps those in LEAST_DOCUMENTS of its rows at least. Every
    group, and every language, gives a kept term the chance ``1 + floor(UNIT * (count + 1) / (N + V))``.
    Part ``pair`` has for every other source of the language the sum of ``(p - q)^2 / q``, rounded down
    each, over all kept terms; part ``term`` the TOP terms that a group has more often than its language.
    Equal values rank by item. Null reads as the empty text in all three columns. Rows are documents:
    repeated ones count again. A group without terms has its pairs, with sums of 0 where its language
    keeps no term; a source alone in its language has none. An empty table gives an empty one. Other
    columns are not read.
    """
    columns = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (lang, source, text)]
    docs = df.select(columns[0].alias("lang"), columns[1].alias("source"), columns[2].cast("binary").alias("text"))
    terms = stage(document_frequencies(docs).filter(F.col("n") >= LEAST_DOCUMENTS), "terms")
    least = head_from(terms, "n", "term", HEAD_BYTES)
    whole = terms.filter(F.col("n") < least).isEmpty()
    shards = perfect_shards(terms, "lang", "term", F.col("n") >= least)
    found = vectors(recounted(docs, shards, whole))

    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    sums = found.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = stage(docs.select("lang", "source").distinct(), "groups")
    tiles = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("blocks"))
    tiles = stage(tiles.join(sizes, "lang", "left"), "languages")
    total = (F.coalesce("n", F.lit(0)) + F.col("v")).alias("total")
    groups = groups.join(sums, ["lang", "source"], "left").join(tiles, "lang")
    block = F.pmod(F.xxhash64("source"), "blocks").alias("block")
    groups = stage(groups.select("lang", "source", total, block, "blocks", "v"), "groups")

    shape = shards.select(F.col("group").alias("lang"), "head", "shard", F.col("n").alias("size"), "ends", "keys")
    cells = groups.filter("v IS NOT NULL").join(shape.drop("ends", "keys"), "lang")
    counts = found.drop("n")
    cells = cells.join(counts.filter("source IS NOT NULL"), ["lang", "head", "shard", "source"], "left")
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    fields = ("lang", "head", "shard", "x", "y", "source", "block", "total", "size", "slots", "counts", "ends", "keys")
    cells = cells.select(
        "*", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        F.lit(None).cast("binary").alias("ends"), F.lit(None).cast("binary").alias("keys"),
    ).select(*fields)
    languages = tiles.join(sums.filter("source IS NULL").drop("source"), "lang").select("lang", total, "blocks")
    rows = counts.filter("source IS NULL").join(shape, ["lang", "head", "shard"]).join(languages, "lang")
    rows = rows.withColumn("x", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    rows = rows.withColumn("y", F.col("x")).withColumn("block", F.col("x")).select(*fields)
    keys = ["lang", "head", "shard", "x", "y"]
    dealt = cells.unionByName(rows).repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches):
        for tile in runs(batches, keys):
            made = list(zip(*compared(tile))) or [()] * 5
            kinds = [pa.string()] * 4 + [pa.int64()]
            names = ["lang", "source", "part", "item", "value"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds)], names=names)

    made = stage(dealt.mapInArrow(compare, "lang string, source string, part string, item string, value bigint"), "compared")
    pairs = made.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    bare = groups.filter("v IS NULL").select("lang", "source")
    zero = bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source <> item")
    zero = zero.select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("bigint").alias("value"))
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    pairs = pairs.unionByName(zero).withColumn("rank", F.row_number().over(ranked))
    best = made.filter("part = 'term'").withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= TOP)
    return pairs.unionByName(best)


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Divergence between the sources of each language of the documents, and their typical terms."""
    return audit_sources(documents(spark, folder)).select("lang", "source", "part", "item", "value", "rank")


OP13_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
hits AS (
  SELECT lang, source, term, id, count(*) AS n FROM (SELECT lang, source, id, unnest(words) AS term FROM docs)
  GROUP BY ALL),
kept AS (SELECT lang, term FROM hits GROUP BY lang, term HAVING count(*) >= 3),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
cells AS (
  SELECT lang, source, term, coalesce(n, 0) AS n
  FROM groups JOIN kept USING (lang)
  LEFT JOIN (SELECT lang, source, term, sum(n)::BIGINT AS n FROM hits GROUP BY ALL) USING (lang, source, term)),
own AS (
  SELECT lang, source, term, n,
         1 + 1000000000 * (n + 1)::HUGEINT // (sum(n) OVER (PARTITION BY lang, source) + v) AS p
  FROM cells JOIN sizes USING (lang)),
whole AS (
  SELECT lang, term, 1 + 1000000000 * (n + 1)::HUGEINT // (sum(n) OVER (PARTITION BY lang) + v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY lang, term) JOIN sizes USING (lang)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT
  FROM own JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found)
WHERE part = 'pair' OR rank <= 200
"""
