"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Entries a per-process memo may hold before it is emptied; it bounds a worker's memory, never the result.
MEMO_ENTRIES = 600_000

#: Characters of the longest text that a memo holds; longer ones are worked out each time.
SHORT = 64

#: Rows a worker turns into Python values at a time; it bounds its memory, never the result.
BATCH_ROWS = 1000

#: ASCII white space, the separators of words.
SPACES = " \t\n\x0b\x0c\r"


class Memo:
    """A dictionary of bounded size in two generations: when the young one is full it becomes the old one.

    An entry that is asked for again moves back to the young one, so what is met often stays.
    """

    def __init__(self, limit: int = MEMO_ENTRIES) -> None:
        self.half = max(1, limit // 2)
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value):
        if len(self.young) >= self.half:
            self.young, self.old = {}, self.young
        self.young[key] = value
        return value


_held: dict[str, dict] = {}


def held_for(owner: str, key, make: Callable):
    """What an operator keeps in a worker from task to task; what other operators kept there goes."""
    let_go(owner)
    own = _held.setdefault(owner, {})
    if key not in own:
        give_back()
        own[key] = make()
    return own[key]


def let_go(but: str = "") -> None:
    """Free what operators keep in this worker, so that the next one has the memory."""
    others = [owner for owner in _held if owner != but]
    for owner in others:
        del _held[owner]
    if others:
        give_back()


def give_back() -> None:
    """Return freed memory to the machine, where the C library can; it would keep it for this worker."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of all executors, once for an application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="code-"), "peopleflow.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def add_columns(
    df: DataFrame,
    source: str,
    added: list[T.StructField],
    make: Callable[[Iterable[pa.Array]], Iterator[list[pa.Array]]],
) -> DataFrame:
    """Append columns computed from one column, batch by batch, in Python workers.

    ``make`` takes the batches of ``source`` and yields, for each, the arrays of ``added``. Columns
    of ``df`` that bear an added name are replaced, as ``withColumn`` would do.
    """
    names = {field.name.lower() for field in added}
    carried = [c for c in df.columns if c.lower() not in names]
    kept = df.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{source}`").alias(fresh(df, "source")))
    schema = T.StructType([df.schema[c] for c in carried] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                made = next(make([batch.column(batch.num_columns - 1)]))
                columns = list(batch.columns[:-1]) + made
                yield pa.RecordBatch.from_arrays(columns, names=carried + [f.name for f in added])

    ship(df.sparkSession)
    return kept.mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(doc_id: Column, digest: Column) -> Column:
    """32 bytes for an id, null among them, and the digest of a text as hexadecimal digits."""
    named = F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit(""))
    return F.unhex(F.sha2(F.concat(named, F.lit(":"), digest), 256))


def one_row_each(docs: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """Of the rows with each ``key`` that the only column of ``kept`` holds, one with all its columns.

    Repeated rows shrink to one in each task, and whole rows are shuffled once.
    """
    name = fresh(docs, "row_key")
    rows = docs.withColumn(name, key).dropDuplicates([name])
    kept = kept.toDF(name).hint("merge")
    return rows.join(kept, name, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


#: Bits of a filter for each value it is made of, and in all: 64 MB, beyond which it lets more through.
FILTER_BITS, MOST_BITS = 16, 1 << 29

#: Bits of one of Spark's bitmaps.
BITMAP = 32768


def cut_to(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``column`` may be among the values of the only column of ``wanted``, a written table.

    It drops most others before they are shuffled, none that is wanted, and so is no replacement for
    the join that follows. Nulls go. The filter is a table of bitmaps by hash, broadcast.
    """
    bits = min(MOST_BITS, max(BITMAP, FILTER_BITS * wanted.count()))
    bucket, place = (fresh(rows, x) for x in ("filter_bucket", "filter_place"))
    hashed = F.pmod(F.xxhash64(wanted.columns[0]), F.lit(bits))
    bitmaps = wanted.filter(F.col(wanted.columns[0]).isNotNull()).select(
        F.floor(hashed / BITMAP).alias(bucket), (hashed % BITMAP).alias(place)
    )
    held = fresh(rows, "filter_bits")
    bitmaps = bitmaps.groupBy(bucket).agg(F.bitmap_construct_agg(place).alias(held))
    own = F.pmod(F.xxhash64(column), F.lit(bits))
    found = rows.filter(F.col(column).isNotNull()).withColumn(place, own % BITMAP)
    found = found.withColumn(bucket, F.floor(own / BITMAP)).join(F.broadcast(bitmaps), bucket)
    byte = F.conv(F.hex(F.substring(held, F.floor(F.col(place) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, (F.col(place) % 8).cast("int")) == 1
    return found.filter(bit).select(*[F.col(f"`{c}`") for c in rows.columns])


def as_list(array: pa.Array) -> list[str]:
    """The texts of a batch; null reads as the empty text."""
    return [x or "" for x in array.to_pylist()]
