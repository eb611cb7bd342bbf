"""Repeated byte strings by prefix-free parsing (operator 8).

Parse. The trigger of a string of LENGTH bytes is the k-gram with the smallest rolling hash in it,
the leftmost of equals; so every such string holds a trigger, and equal strings hold it at the same
place. Consecutive strings with one trigger form a phrase: the bytes from the start of the first to
the end of the last. Phrases overlap by LENGTH - 1 bytes, so no string is lost between two.

Dictionary. Equal phrases have equal strings. Of each distinct phrase only the first occurrence in
corpus order matters further; all later ones are repeats as a whole. Strings of different
phrases can only be equal if the phrases have the same trigger. So the phrases meet by trigger, in
packed rows of many; the texts are parsed once, and what is still unclear then is cut out of them.

Suffix order. The distinct phrases of a trigger are put into the order of their suffixes; suffixes
that agree in LENGTH bytes are neighbours in it, and the places of their phrases in the parse tell
which is first. That is the corpus order, as far as it is needed, made of many small ones. Highly
repetitive text has few distinct phrases, and text without repeats leaves after the first pass.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peopleflow.llm.common import add_columns, documents, ship
from peopleflow.llm.groups import runs
from peopleflow.llm.minhash import mix, powers
from peopleflow.session import session_conf, stage

LENGTH = 100
K_GRAM = 32

#: Bits of a filter for each hash, the logarithm of those of the largest filter (32 MB), and that of its segments.
BITS_EACH, FILTER_BITS, SEGMENT_BITS = 16, 28, 6

#: Bytes of phrases whose strings are put in order together, and strings that are compared at a time.
ORDERED, COMPARED = 1_000_000, 100_000

#: Bytes of text whose phrases meet in a bin, about, and bytes of rows that a Python worker gets at a time.
BIN_BYTES, BATCH_BYTES = 1 << 22, 1 << 24

#: Distinct phrases of a trigger from which their strings are dealt one by one.
HOT = 5000

#: Bytes of a text that are parsed in one go.
BLOCK = 1 << 19

#: The start of a phrase in a text is kept with its number of strings (7 bits) and a mark of its text.
STRINGS, STARTS = 7, 41

#: What tells where a phrase occurs, in the order of the corpus.
PLACE = ("doc", "digest", "place")

#: What workers are given at a time.
SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}

#: Shuffles that a written table was made of go when it is written. Not for `toLocalIterator`, whose query counts as
#: ended while its rows are still read.
CLEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

_random = np.random.default_rng(20240817)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_mark(data: bytes) -> int:
    """Tells, with ``text_digest``, texts of rows with equal ids apart; the same in SQL by crc32."""
    return zlib.crc32(data) & 0x7FFF


def text_digest(data: bytes) -> int:
    """60 bits of a text's SHA-256, from 1 on; texts whose id no other text has go by 0 instead."""
    return int(hashlib.sha256(data).hexdigest()[:15], 16) + 1


def sql_digest(data: str) -> Column:
    return F.conv(F.substring(F.sha2(data, 256), 1, 15), 16, 10).cast("long") + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rolling hashes of pieces of up to BLOCK bytes of text."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def parse(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """The phrases of a text: trigger hash, phrase hash, start, number of strings."""
    parts = []
    for at in range(0, len(data) - length + 1, BLOCK):
        own = data[at : at + BLOCK + length - 1]
        strings = len(own) - length + 1
        grams = np.arange(len(own) - K_GRAM + 1)
        found = hashes(own, grams, grams + K_GRAM)
        # The position in the low bits makes the leftmost of equals the smallest.
        key = found >> np.uint64(20) << np.uint64(20) | grams.astype(np.uint64)
        width, reach = length - K_GRAM + 1, 1
        while reach * 2 <= width:
            key = np.minimum(key[:-reach], key[reach:])
            reach *= 2
        key = np.minimum(key[:strings], key[width - reach : width - reach + strings])
        trigger = (key & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, trigger[1:] != trigger[:-1]])
        many = np.diff(np.r_[first, strings])
        whole = hashes(own, first, first + many - 1 + length)
        whole = mix(whole + (trigger[first] - first).astype(np.uint64))
        parts.append((found[trigger[first]], whole, first + at, many))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts))


def places(start: np.ndarray, many: np.ndarray, mark: int) -> np.ndarray:
    """Mark of the text, start and number of strings in one number, in the order of starts."""
    return mark << STARTS + STRINGS | start << STRINGS | (many - 1)


def place_mark() -> Column:
    return F.shiftright("place", STARTS + STRINGS)


def ranges(place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the bytes that phrases cover start and end in their text."""
    start = place >> STRINGS & (1 << STARTS) - 1
    return start, start + (place & (1 << STRINGS) - 1) + length


def place_hash(doc: np.ndarray, digest: np.ndarray, place: np.ndarray) -> np.ndarray:
    doc, digest, place = (np.asarray(x, np.int64).view(np.uint64) for x in (doc, digest, place))
    return mix(mix(mix(doc) + digest) + place)


def bit_places(mixed: np.ndarray, log: int) -> list[np.ndarray]:
    """The two bits of each hash in a filter of ``2 ** log``: with 16 bits a hash, one stranger in 70 has both."""
    return [x >> np.uint64(64 - log) for x in (mixed, mix(mixed ^ np.uint64(0x9E3779B97F4A7C15)))]


class Filter:
    """A set of 64-bit hashes as bits; it may hold more than it was given, never less.

    Of several filters that share a set, each knows the hashes of one part only.
    """

    def __init__(self, bits: np.ndarray, part: int = 0, parts: int = 1) -> None:
        self.bits, self.part, self.parts = bits, part, parts
        self.log = (8 * len(bits)).bit_length() - 1

    def holds(self, found: np.ndarray) -> np.ndarray:
        mixed = mix(found)
        held = np.ones(len(mixed), bool) if self.parts == 1 else mixed % np.uint64(self.parts) == self.part
        for at in bit_places(mixed, self.log):
            held &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return held


def make_filters(found: DataFrame, column: str, most: int | None = None) -> Iterator[Broadcast]:
    """Filters of a column of hashes, a written table, one after the other; each is released before the next.

    A filter has BITS_EACH bits or more for each of its hashes, and at most 2 ** FILTER_BITS: where more are
    needed, there are more filters, ``most`` of them; fuller ones let more strangers through. Every segment of bits is made in one task, and sent packed. Hashes are
    mixed again, since triggers are minima and so crowd among the small numbers.
    """
    needed = max(1, BITS_EACH * found.count())
    log = min(max((needed - 1).bit_length(), SEGMENT_BITS + 3), FILTER_BITS)
    parts = -(-needed // (1 << FILTER_BITS))
    parts = parts if most is None else min(parts, most)
    size = 1 << log - SEGMENT_BITS
    spark, schema = found.sparkSession, "segment bigint, bits binary"
    ship(spark)

    def one(part: int) -> Filter:
        def bits(batches):
            for batch in batches:
                mixed = mix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
                at = np.concatenate(bit_places(mixed[mixed % np.uint64(parts) == part], log))
                segments = (at >> np.uint64(log - SEGMENT_BITS)).astype(np.int64)
                for segment in np.unique(segments).tolist():
                    own = np.zeros(size, bool)
                    own[(at[segments == segment] & np.uint64(size - 1)).astype(np.int64)] = True
                    packed = zlib.compress(np.packbits(own, bitorder="little").tobytes(), 1)
                    arrays = [pa.array([segment]), pa.array([packed])]
                    yield pa.RecordBatch.from_arrays(arrays, names=["segment", "bits"])

        def join(batches):
            for table in runs(batches, ["segment"]):
                own = np.zeros(size // 8, np.uint8)
                for packed in table["bits"].to_pylist():
                    own |= np.frombuffer(zlib.decompress(packed), np.uint8)
                packed = zlib.compress(own.tobytes(), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([table["segment"][0].as_py()]), pa.array([packed])], names=["segment", "bits"]
                )

        rows = found.select(column).mapInArrow(bits, schema)
        rows = rows.repartition(1 << SEGMENT_BITS, "segment").sortWithinPartitions("segment").mapInArrow(join, schema)
        whole = np.zeros((1 << SEGMENT_BITS, size // 8), np.uint8)
        for row in rows.toLocalIterator():
            whole[row["segment"]] = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
        return Filter(whole.ravel(), part, parts)

    for part in range(parts):
        held = spark.sparkContext.broadcast(one(part))
        yield held
        held.unpersist()


def any_filter(found: DataFrame, column: str) -> Broadcast:
    """One filter of at most 2 ** FILTER_BITS, for uses where holding too much only costs time."""
    return next(make_filters(found, column, 1))


def parsed(batch: pa.RecordBatch, length: int, shared: Broadcast | None = None):
    """For each text of a batch that can hold a string: its bytes, id, digest, mark and phrases.

    The digest is 0 where ``shared``, a filter of the ids of several texts, does not hold the id.
    """
    docs = batch.column(0).to_numpy(zero_copy_only=False)
    told = np.zeros(len(docs), bool) if shared is None else shared.value.holds(docs.view(np.uint64))
    for doc, apart, data in zip(docs.tolist(), told.tolist(), batch.column(1)):
        held = data.as_buffer() if data.is_valid else b""
        if len(held) >= length:
            array = np.frombuffer(held, np.uint8)
            yield array, doc, text_digest(held) if apart else 0, text_mark(held), parse(array, length)


def behind(new: np.ndarray, *at: np.ndarray) -> np.ndarray:
    """Which rows of sorted groups, begun where ``new``, are elsewhere than the first of their group."""
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return np.any([x != x[first] for x in at], axis=0)


def packed(bins: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The rows of each bin as one value, byte by byte of the numbers, so that equal high bytes stand together."""
    order = np.argsort(bins, kind="stable")
    bins = bins[order]
    rows = np.stack([x[order].view(np.int64) for x in columns], 1).view(np.uint8)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]][: len(bins)])
    ends = [*first[1:].tolist(), len(bins)]
    return bins[first], [rows[a:b].T.tobytes() for a, b in zip(first.tolist(), ends)]


def unpacked(values: list[bytes], width: int) -> list[np.ndarray]:
    """The columns that `packed` took, those of all values one after the other."""
    parts = [np.frombuffer(x, np.uint8).reshape(8 * width, -1).T for x in values]
    rows = np.ascontiguousarray(np.concatenate([np.zeros((0, 8 * width), np.uint8), *parts])).view(np.int64)
    return [np.ascontiguousarray(x) for x in rows.T]


def stage_clean(df: DataFrame, label: str) -> DataFrame:
    with session_conf(df.sparkSession, CLEAN):
        return stage(df, label)


def met_again(found: np.ndarray) -> np.ndarray:
    """Which numbers occur more than once."""
    order = np.argsort(found)
    same = found[order[1:]] == found[order[:-1]]
    out = np.zeros(len(found), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def firsts(trigger: np.ndarray, phrase: np.ndarray, *place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each phrase the row that comes first in the corpus, by triggers, and the rows that are elsewhere."""
    order = np.lexsort((*place[::-1], phrase, trigger))
    trigger, phrase, *place = (x[order] for x in (trigger, phrase, *place))
    new = np.r_[True, (trigger[1:] != trigger[:-1]) | (phrase[1:] != phrase[:-1])][: len(order)]
    return order[new], order[behind(new, *place)]


def occurrences(texts: DataFrame, shared: Broadcast | None, bins: int, length: int) -> DataFrame:
    """The phrases of all texts as packed rows: ``bin, told, rows``, by their triggers.

    Of a phrase that a batch holds again only the first goes on; the others, told as repeats, are dealt by their places.
    """

    def find(batches):
        for batch in batches:
            rows = [(*(np.zeros(0, np.uint64),) * 2, *(np.zeros(0, np.int64),) * 3)]
            for _, doc, digest, mark, (trigger, phrase, start, many) in parsed(batch, length, shared):
                text = (np.full(len(start), x, np.int64) for x in (doc, digest))
                rows.append((trigger, phrase, *text, places(start, many, mark)))
            rows = [np.concatenate(x) for x in zip(*rows)]
            again = np.flatnonzero(met_again(mix(rows[0] + mix(rows[1]))))
            first, later = firsts(*(x[again] for x in rows))
            once = np.ones(len(rows[0]), bool)
            once[again] = False
            once[again[first]] = True
            later = again[later]
            own = [x[once] for x in rows]
            yield dealt((mix(own[0]) % np.uint64(bins)).astype(np.int64), False, own)
            own = [x[later] for x in rows[2:]]
            yield dealt((place_hash(*own) % np.uint64(bins)).astype(np.int64), True, own)

    def dealt(bins, told, columns):
        at, values = packed(bins, *columns)
        arrays = [pa.array(at), pa.array([told] * len(at), pa.bool_()), pa.array(values, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["bin", "told", "rows"])

    return texts.mapInArrow(find, "bin bigint, told boolean, rows binary")


def compared(found: DataFrame) -> DataFrame:
    """Where phrases occur that are repeats, and those that are not clear yet: ``doc, digest, place, trigger``.

    The trigger is null for repeats. Unclear is the first occurrence of a phrase whose trigger has others.
    """

    def meet(batches):
        for table in runs(batches, ["bin"]):
            told = np.array(table["told"].to_pylist(), bool)
            values = table["rows"].to_pylist()
            yield batch(unpacked([x for x, t in zip(values, told) if t], len(PLACE)))
            trigger, *rows = unpacked([x for x, t in zip(values, told) if not t], 2 + len(PLACE))
            again = met_again(trigger)
            trigger, phrase, *place = (x[again] for x in (trigger, *rows))
            first, later = firsts(trigger, phrase, *place)
            yield batch([x[later] for x in place])
            first = first[met_again(trigger[first])]
            yield batch([x[first] for x in place], trigger[first])

    def batch(place, trigger=None):
        last = pa.nulls(len(place[0]), pa.int64()) if trigger is None else pa.array(trigger)
        return pa.RecordBatch.from_arrays([*map(pa.array, place), last], names=[*PLACE, "trigger"])

    rows = found.repartition("bin").sortWithinPartitions("bin")
    return stage_clean(rows.mapInArrow(meet, "doc bigint, digest bigint, place bigint, trigger bigint"), "phrases")


def classes(data: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """A number for each string of ``length`` bytes that begins at ``begin``; equal strings have equal ones.

    By hash first; then each string is compared with the first of its class, byte by byte, and those of
    a class that are not all equal are sorted as bytes.
    """
    strings = np.lib.stride_tricks.sliding_window_view(data, length)
    _, first, kind = np.unique(hashes(data, begin, begin + length), return_index=True, return_inverse=True)
    for at in range(0, len(begin), COMPARED):
        own = slice(at, at + COMPARED)
        same = (strings[begin[own]] == strings[begin[first[kind[own]]]]).all(1)
        if not same.all():
            void = np.ascontiguousarray(strings[begin]).view(f"V{length}").ravel()
            return np.unique(void, return_inverse=True)[1]
    return kind


def suffix_repeats(
    data: np.ndarray, begin: np.ndarray, doc: np.ndarray, digest: np.ndarray, place: np.ndarray, length: int
):
    """Strings of different phrases that are no first occurrence: ids, digests and places of one string each.

    The phrases lie in ``data`` from ``begin`` on, those of whole bins together. Strings that are equal form a
    class, and its first in the order of the parse stays.
    """
    start = place >> STRINGS
    many = (place & (1 << STRINGS) - 1) + 1
    owner = np.repeat(np.arange(len(begin)), many)
    offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    kind = classes(data, begin[owner] + offset, length)
    # Only strings that are met again matter.
    again = np.flatnonzero((np.bincount(kind) > 1)[kind])
    owner, offset, kind = owner[again], offset[again], kind[again]
    own = doc[owner], digest[owner], start[owner] + offset << STRINGS
    order = np.lexsort((*own[::-1], kind))
    kind, *own = (x[order] for x in (kind, *own))
    later = behind(np.r_[True, kind[1:] != kind[:-1]][: len(kind)], *own)
    return tuple(x[later] for x in own)


def whole_bins(batches) -> Iterator[pa.Table]:
    """Tables of about ORDERED bytes of phrases from a partition sorted by ``bin``, each of whole bins."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        bins = batch.column("bin").to_numpy(zero_copy_only=False)
        ends = np.frombuffer(batch.column("phrase").buffers()[1], np.int32)[batch.column("phrase").offset :]
        borders = np.flatnonzero(bins[1:] != bins[:-1]) + 1
        if held and held[-1].column("bin")[-1].as_py() != bins[0]:
            borders = np.r_[0, borders]
        at = 0
        for border in borders.tolist():
            if size + int(ends[border] - ends[at]) >= ORDERED:
                if border > at:
                    held.append(batch.slice(at, border - at))
                if held:
                    yield pa.Table.from_batches(held)
                held, size, at = [], 0, border
        held.append(batch.slice(at))
        size += int(ends[batch.num_rows] - ends[at])
    if held:
        yield pa.Table.from_batches(held)


def joined(doc: np.ndarray, digest: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of consecutive strings as one place each, of at most 2 ** STRINGS strings."""
    doc, digest, start = np.unique(np.stack([doc, digest, place >> STRINGS]), axis=1)
    new = (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1]) | (start[1:] != start[:-1] + 1)
    new = np.r_[True, new][: len(doc)]
    first = np.flatnonzero(new)
    sizes = np.diff(np.r_[first, len(doc)])
    at = np.arange(len(doc)) - np.repeat(first, sizes)
    first = np.flatnonzero(at % (1 << STRINGS) == 0)
    sizes = np.diff(np.r_[first, len(doc)])
    return doc[first], digest[first], start[first] << STRINGS | sizes - 1


def beside(rows: DataFrame, found: DataFrame, texts: DataFrame, shared: Broadcast | None, how: str) -> DataFrame:
    """Join to ``rows`` (``doc, mark, data`` and others) what is ``found`` of their texts (``doc, digest, mark``)."""
    if shared is None:
        return rows.join(found, ["doc", "mark"], how)
    # Ids that the filter does not hold have one text each, so the id gives its digest.
    own = texts.withColumnRenamed("digest", "text")
    found = found.filter("digest = 0").join(own, "doc").unionByName(found.filter("digest <> 0").withColumn("text", F.col("digest")))
    return rows.withColumn("text", sql_digest("data")).join(found, ["doc", "text", "mark"], how).drop("text")


def dictionary(unclear: DataFrame, hot: Broadcast, length: int) -> DataFrame:
    """The bytes of phrases that must be put in order, by trigger: ``bin, doc, digest, place, phrase``.

    ``unclear`` are texts with their phrases: ``doc, digest, data, phrases``. Strings of hot triggers are dealt one by
    one, by their own hash; of those equal in a batch the first is dealt and the others, told as repeats, have no phrase.
    """

    def find(batches):
        for batch in batches:
            bins, own, phrases = [], [], []
            hot_places, hot_phrases = [], []
            docs, digests = (batch.column(k).to_pylist() for k in (0, 1))
            for doc, digest, held, listed in zip(docs, digests, batch.column(2), batch.column(3)):
                data = held.as_py()
                place, trigger = (listed.values.field(k).to_numpy() for k in (0, 1))
                often = hot.value.holds(trigger.view(np.uint64))
                rows = (x.tolist() for x in (place, trigger, often, *ranges(place, length)))
                for at, bin_, dealt, a, b in zip(*rows):
                    if not dealt:
                        bins.append(bin_)
                        own.append((doc, digest, at))
                        phrases.append(data[a:b])
                        continue
                    mark = at >> STARTS + STRINGS
                    for s in range(a, b - length + 1):
                        hot_places.append((doc, digest, mark << STARTS + STRINGS | s << STRINGS))
                        hot_phrases.append(data[s : s + length])
            seen: dict[bytes, tuple[int, int, int]] = {}
            for k in sorted(range(len(hot_places)), key=hot_places.__getitem__):
                first = seen.setdefault(hot_phrases[k], hot_places[k]) == hot_places[k]
                bins.append(int.from_bytes(zlib.crc32(hot_phrases[k]).to_bytes(4, "little") * 2, "little", signed=True))
                own.append(hot_places[k])
                phrases.append(hot_phrases[k] if first else None)
            arrays = [pa.array(x, pa.int64()) for x in (bins, *(zip(*own) if own else ((),) * 3))]
            arrays.append(pa.array(phrases, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=["bin", *PLACE, "phrase"])

    schema = "bin bigint, doc bigint, digest bigint, place bigint, phrase binary"
    return stage_clean(unclear.select("doc", "digest", "data", "phrases").mapInArrow(find, schema), "dictionary")


def repeated_places(
    rows: DataFrame, texts: DataFrame, shared: Broadcast | None, bins: int, length: int
) -> DataFrame:
    """Where ``rows`` (``doc, mark, data``) hold what earlier text holds: ``doc, digest, place``."""
    ship(rows.sparkSession)
    found = compared(occurrences(rows.select("doc", "data"), shared, bins, length))
    unclear = found.filter("trigger IS NOT NULL")
    kinds = unclear.groupBy("trigger").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("trigger")
    hot = any_filter(stage(kinds, "kinds"), "trigger")
    own = unclear.groupBy("doc", "digest", place_mark().alias("mark")).agg(
        F.collect_list(F.struct("place", "trigger")).alias("phrases")
    )
    phrases = dictionary(beside(rows.select("doc", "mark", "data"), own, texts, shared, "inner"), hot, length)

    def order(batches):
        for table in whole_bins(batches):
            own = table.combine_chunks()
            listed = own["phrase"].chunk(0)
            ends = np.frombuffer(listed.buffers()[1], np.int32)[listed.offset : listed.offset + len(listed) + 1]
            data = np.frombuffer(listed.buffers()[2], np.uint8)[ends[0] : ends[-1]]
            begin = (ends[:-1] - ends[0]).astype(np.int64)
            at = joined(*suffix_repeats(data, begin, *(own[c].to_numpy() for c in PLACE), length))
            yield pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in at], names=list(PLACE))

    dealt = phrases.filter("phrase IS NOT NULL").repartition("bin").sortWithinPartitions("bin")
    parts = dealt.mapInArrow(order, "doc bigint, digest bigint, place bigint")
    told = found.filter("trigger IS NULL").unionByName(phrases.filter("phrase IS NULL"), allowMissingColumns=True)
    return parts.unionByName(told.select(*PLACE))


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """For every row: ``doc_id, n_bytes, spans, kept``; ``kept`` are the bytes left of the UTF-8 text.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a row with a
    smaller id, or earlier in the same text; spans are the runs of such bytes. Null reads as the empty
    text, and shorter texts lose nothing. A null id is smallest. Rows repeated with the same id and
    text are one document and get equal rows; texts that share an id are told apart by 75 bits of
    hashes, in a fixed order. Removing bytes may cut a character; other columns are not read. ``length`` is from 64 to 159.
    """
    if not 2 * K_GRAM <= length <= K_GRAM - 1 + (1 << STRINGS):
        raise ValueError("length is out of range")
    doc = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)))
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = df.select(F.col(doc_id).alias("doc_id"), doc.alias("doc"), data.alias("data"))
    rows = rows.withColumn("mark", F.crc32("data").bitwiseAND(F.lit(0x7FFF)))
    with session_conf(df.sparkSession, SETTINGS):
        texts = rows.groupBy("doc", sql_digest("data").alias("digest")).agg(F.sum(F.octet_length("data")).alias("size"))
        texts = stage(texts, "texts")
        total = texts.agg(F.sum("size")).first()[0] or 0
        texts = texts.drop("size")
        several = stage(texts.groupBy("doc").count().filter("count > 1").select("doc"), "several")
        shared = None if several.isEmpty() else any_filter(several, "doc")
        found = repeated_places(rows, texts, shared, 1 + total // BIN_BYTES, length)
        found = found.groupBy("doc", "digest", place_mark().alias("mark")).agg(F.collect_list("place").alias("ranges"))
        found = stage_clean(found, "ranges")
    rows = beside(rows, found, texts, shared, "left")
    rows = rows.select("doc_id", F.struct("data", "ranges").alias("both"))

    def make(columns):
        for column in columns:
            sizes, spans, kept = [], [], []
            for data, listed in zip(column.field("data"), column.field("ranges")):
                data = data.as_py()
                mark = np.zeros(len(data) + 1, np.int64)
                if listed.is_valid and len(listed):
                    start, end = ranges(listed.values.to_numpy(), length)
                    np.add.at(mark, start, 1)
                    np.add.at(mark, end, -1)
                gone = np.cumsum(mark)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                sizes.append(len(data))
                spans.append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
                kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
            pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield [pa.array(sizes, pa.int64()), pa.array(spans, pairs), pa.array(kept, pa.binary())]

    kind = T.ArrayType(T._parse_datatype_string("struct<start:bigint,end:bigint>"))
    fields = [("n_bytes", T.LongType()), ("spans", kind), ("kept", T.BinaryType())]
    return add_columns(rows, "both", [T.StructField(*f) for f in fields], make).drop("both")


def op8_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without strings of 100 bytes that occur earlier."""
    found = remove_repeats(documents(spark, folder))
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        lost.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
