"""Phrases whose words occur together more often than by chance (operator 11).

Words become numbers by perfect hashes of the frequent ones, and texts become rows of numbers, with
0 where a phrase cannot go on. Phrases grow word by word. A candidate of k words is Apriori-safe:
its first and its last k - 1 words are frequent phrases. Candidates are found where they stand in
the text, since all pairs of frequent words would be far too many. The candidates' double-array trie is broadcast in
shards of a bounded size; numpy moves the states of all text positions from one level to the next at
once and bincounts the accepting states, and the dense counts of all tasks are added up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peopleflow.llm.common import documents, give_back, ship
from peopleflow.llm.divergence import as_text
from peopleflow.llm.perfect_hash import KEY_BYTES, PerfectHash, perfect_shards, stored_keys
from peopleflow.llm.tokens import BORDER, GAP, PART, Cut, blocks, numbered
from peopleflow.operators.numbering import number_rows
from peopleflow.session import child_session, new_path, session_conf, stage, unstage

#: Words in a phrase, and the least occurrences of one.
LONGEST, LEAST = 5, 100

#: Rows of a language that are returned.
TOP = 2000

#: Bytes of words that are broadcast at a time, and phrases of a trie shard.
WORD_BYTES, TRIE = 32_000_000, 500_000

#: Text positions whose candidates a task brings together before it passes them on.
POSITIONS = 6_000_000

#: Rows that a task passes on at a time.
ROWS = 50_000

#: Phrases whose dense counts travel in one row.
SEGMENT = 8192

#: Bytes of rows that a Python worker gets at a time: texts, blocks of numbers, or counts of many tasks.
SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 22)}

#: A row of numbers is a block of texts, so few rows make a batch, here and in Spark's reader.
LINES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2", "spark.sql.parquet.columnarReaderBatchSize": "4"}

#: Parquet looks at the sizes of pages and row groups after 100 rows only, and packs a page in buffers outside the heap
#: that stay; of rows this large it must look after each.
ROW_BY_ROW = {
    "parquet.page.size.row.check.min": "1",
    "parquet.block.size.row.check.min": "1",
    "parquet.block.size": str(1 << 24),
}

#: Blanks and tabs part words; stops and line ends also part phrases.
KINDS = np.full(256, PART, np.int8)
KINDS[list(b" \t")] = GAP
KINDS[list(b".,;:!?\n\x0b\x0c\r")] = BORDER


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, term, n``: occurrences of each word in the rows of ``docs`` (``lang, text``)."""

    def count(batches):
        for batch in batches:
            for block in blocks(batch, 1):
                cut = Cut(block.column(1).to_pylist(), KINDS)
                code, names = cut.encoded()
                lang, langs = numbered(block.column(0))
                found, n = np.unique(lang[cut.row] * len(names) + code, return_counts=True)
                own, code = np.divmod(found, max(len(names), 1))
                arrays = [pa.array(langs, pa.string()).take(pa.array(own)), as_text(names.take(pa.array(code))), pa.array(n)]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "term", "n"])

    ship(docs.sparkSession)
    found = docs.mapInArrow(count, "lang string, term string, n bigint")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n"))


_hashes: dict[int, tuple[object, dict[str, tuple[PerfectHash, np.ndarray]]]] = {}


def words_of(held: Broadcast) -> dict[str, tuple[PerfectHash, np.ndarray]]:
    """For each language the hash of its broadcast words and the number of each slot, made once in a worker."""
    parts = held.value
    if _hashes.get(0, (None,))[0] is not parts:
        own: dict[str, list[dict]] = {}
        for part in parts:
            own.setdefault(part["group"], []).append(part)
        made = {}
        for lang, listed in own.items():
            numbers = [np.arange(p["n"]) + p["first"] for p in listed]
            made[lang] = PerfectHash(listed[0]["shards"], listed), np.concatenate(numbers)
        _hashes[0] = parts, made
    return _hashes[0][1]


def forget_words() -> None:
    """Free the hashes of words in this worker: what comes after the encoding reads numbers only."""
    if _hashes:
        _hashes.clear()
        give_back()


def packed(word: np.ndarray, keep: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """Arrays over text positions without those that are not to be kept; one 0 stands for a run of them."""
    keep = keep & (word > 0)
    stays = keep.copy()
    stays[1:] |= keep[:-1]
    return [np.where(keep, x, 0)[stays].astype(np.int32) for x in (word, *others)]


def encode(docs: DataFrame, held: Broadcast, last: bool) -> DataFrame:
    """Fill in the numbers of the broadcast words in ``lang, text, words``; a row for each block when ``last``.

    Until then ``words`` has a number for each word of its text, or is null. A block's row is the
    numbers of its texts one after the other, with a 0 at every border and word without a number.
    """

    def number(batches):
        known = words_of(held)
        for batch in batches:
            for block in blocks(batch, 1):
                cut = Cut(block.column(1).to_pylist(), KINDS)
                code, names = cut.encoded()
                lang, langs = numbered(block.column(0))
                before = [np.frombuffer(x, np.int32) for x in block.column(2).to_pylist() if x is not None]
                word = np.concatenate(before).astype(np.int64) if before else np.zeros(len(code), np.int64)
                order = np.argsort(lang[cut.row], kind="stable")
                own = lang[cut.row][order]
                borders = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True]) if len(own) else own
                for a, b in zip(borders, borders[1:]):
                    if (found := known.get(langs[own[a]])) is None:
                        continue
                    at = order[a:b]
                    wanted, place = np.unique(code[at], return_inverse=True)
                    slot = found[0].slots(names.take(pa.array(wanted)))
                    number = np.where(slot >= 0, found[1][slot], 0)[place]
                    word[at] = np.where(number > 0, number, word[at])
                if last:
                    # A position of its own for each border between pieces.
                    new = np.r_[True, (cut.row[1:] != cut.row[:-1]) | (cut.piece[1:] != cut.piece[:-1])][: len(word)]
                    line = np.zeros(len(word) + int(new.sum()), np.int64)
                    line[np.arange(len(word)) + np.cumsum(new)] = word
                    (line,) = packed(line, line > 0)
                    arrays, names_ = [pa.array([line.tobytes()], pa.binary())], ["words"]
                else:
                    ends = np.cumsum(np.bincount(cut.row, minlength=block.num_rows))
                    rows = [x.astype(np.int32).tobytes() for x in np.split(word, ends[:-1])]
                    arrays, names_ = [*block.columns[:2], pa.array(rows, pa.binary())], ["lang", "text", "words"]
                yield pa.RecordBatch.from_arrays(arrays, names=names_)

    ship(docs.sparkSession)
    return docs.mapInArrow(number, "words binary" if last else "lang string, text binary, words binary")


def encoded(docs: DataFrame, shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts as numbers, and the words: ``number, lang, term``. Words are broadcast WORD_BYTES at a time."""
    spark = docs.sparkSession
    firsts, first, part, size = [], 1, [], 0
    todo = docs.withColumn("words", F.lit(None).cast("binary"))
    for row in shards.orderBy("group", "shard").toLocalIterator():
        own = len(row["keys"]) + KEY_BYTES * row["n"]
        if part and size + own > WORD_BYTES:
            held = spark.sparkContext.broadcast(part)
            todo, part, size = stage(encode(todo, held, False), "numbers"), [], 0
            held.unpersist()
        part.append(row.asDict() | {"first": first})
        size += own
        firsts.append((row["group"], row["shard"], first))
        first += row["n"]
    path = new_path(spark, "lines")
    held = spark.sparkContext.broadcast(part)
    encode(todo, held, True).write.options(**ROW_BY_ROW).parquet(path)
    held.unpersist()
    lines = child_session(spark, LINES).read.parquet(path)
    firsts = spark.createDataFrame(firsts, "group string, shard bigint, first bigint")
    words = stored_keys(shards).join(firsts, ["group", "shard"])
    return lines, words.select((F.col("first") + F.col("slot")).alias("number"), F.col("group").alias("lang"), "term")


class DoubleArray:
    """Moves of a trie: from a node and a symbol to another number.

    A node's children stand in cells at its base plus their symbols, and a cell knows its node. Large
    families are placed first, all of a size at once, at random bases until each has found free
    cells; only children get what is left.
    """

    def __init__(self, node: np.ndarray, symbol: np.ndarray, number: np.ndarray) -> None:
        """Pairs must be different and sorted; nodes, symbols and numbers are positive."""
        self.low, self.high = (int(node[0]), int(node[-1])) if len(node) else (1, 0)
        self.base = np.zeros(self.high - self.low + 1, np.int32)
        width = int(symbol.max()) + 1 if len(symbol) else 1
        room = 3 * len(node) + 2 * width
        self.owner = np.zeros(room + width, np.int32)
        self.number = np.zeros(room + width, np.int32)
        if not len(node):
            return
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        sizes = np.diff(np.r_[first, len(node)])
        random = np.random.default_rng(20250101)
        order = np.frexp(sizes)[1]
        for size in sorted(set(order[sizes > 1].tolist()), reverse=True):
            left = np.flatnonzero((order == size) & (sizes > 1))
            while len(left):
                many = sizes[left]
                starts = np.cumsum(many) - many
                child = np.repeat(first[left] - starts, many) + np.arange(many.sum())
                base = random.integers(0, room, len(left))
                cell = np.repeat(base, many) + symbol[child]
                fits = self.owner[cell] == 0
                alone = np.zeros(len(cell), bool)
                alone[np.unique(cell, return_index=True)[1]] = True
                placed = np.logical_and.reduceat(fits & alone, starts)
                self.base[node[first[left[placed]]] - self.low] = base[placed]
                stays = np.repeat(placed, many)
                self.owner[cell[stays]], self.number[cell[stays]] = node[child[stays]], number[child[stays]]
                left = left[~placed]
        only = first[sizes == 1]
        cell = np.flatnonzero(self.owner[width:room] == 0)[: len(only)] + width
        self.base[node[only] - self.low] = cell - symbol[only]
        self.owner[cell], self.number[cell] = node[only], number[only]

    def step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The numbers after the moves, 0 where there is none; nodes lie between the lowest and highest."""
        cell = self.base[node - self.low] + symbol
        return np.where(self.owner[cell] == node, self.number[cell], 0)


#: Bits of a word's number that make one symbol. Of few symbols, families are small and find room.
DIGIT = 5


class Trie:
    """One level of words: from a phrase's number and a next word to the number of the longer phrase.

    A word is read symbol by symbol, from the high bits of its number down.
    """

    def __init__(self, phrase: np.ndarray, word: np.ndarray, number: np.ndarray) -> None:
        """Pairs must be different and sorted; numbers are positive."""
        self.digits = -(-int(word.max()).bit_length() // DIGIT)
        self.low, self.high = int(phrase[0]), int(phrase[-1])
        self.moves: list[DoubleArray] = []
        node = phrase
        for digit in range(self.digits - 1, -1, -1):
            key = node << 2 * DIGIT | self.symbol(word, digit)
            if digit:
                key, node = np.unique(key, return_inverse=True)
                node = node + 1
            target = np.arange(1, len(key) + 1) if digit else number
            self.moves.append(DoubleArray(key >> 2 * DIGIT, key & (1 << 2 * DIGIT) - 1, target))

    @staticmethod
    def symbol(word: np.ndarray, digit: int) -> np.ndarray:
        return (word >> DIGIT * digit & (1 << DIGIT) - 1) + 1

    def step(self, phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The numbers of all phrases, each longer by its word; 0 where the trie has none."""
        out = np.zeros(len(phrase), np.int32)
        inside = (phrase >= self.low) & (phrase <= self.high) & (word > 0) & (word >> DIGIT * self.digits == 0)
        at = np.flatnonzero(inside)
        node = phrase[at]
        for digit, moves in zip(range(self.digits - 1, -1, -1), self.moves):
            node = moves.step(node, self.symbol(word[at], digit))
            at, node = at[node > 0], node[node > 0]
        out[at] = node
        return out


def lines_of(batch: pa.RecordBatch, level: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Each row's words, its phrases of ``level`` words by the positions where they begin, and the words after them."""
    words, phrases = batch.column("words"), batch.column("phrases")
    for row in range(batch.num_rows):
        word = np.frombuffer(words[row].as_buffer(), np.int32)
        phrase = word if level == 1 else np.frombuffer(phrases[row].as_buffer(), np.int32)
        after = np.zeros(len(word), np.int32)
        after[: max(len(word) - level, 0)] = word[level:]
        yield word, phrase, after


def candidates(lines: DataFrame, level: int, least: int) -> DataFrame:
    """Apriori-safe candidates one word longer than the phrases of ``lines``: ``phrase, word``.

    They are those that stand in the text with a frequent phrase at either end, and ``least`` times so. A task
    brings its positions together before it passes a candidate on.
    """

    def find(batches):
        # One array for all keys, sorted where it lies.
        keys, size = np.empty(POSITIONS, np.int64), 0

        def flush():
            keys[:size].sort()
            at = 0
            while at < size:
                # Equal keys stay together; nothing as long as all keys is made beside them.
                end = int(np.searchsorted(keys[:size], keys[min(at + ROWS, size) - 1], "right"))
                own = keys[at:end]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                key, at = own[first], end
                arrays = [(key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32), np.diff(np.r_[first, len(own)])]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["phrase", "word", "n"])

        forget_words()
        for batch in batches:
            for _, phrase, after in lines_of(batch, level):
                # The last words of the candidate are the phrase that begins at the next position.
                safe = np.flatnonzero((phrase[:-1] > 0) & (phrase[1:] > 0) & (after[:-1] > 0))
                for at in range(0, len(safe), POSITIONS):
                    own = safe[at : at + POSITIONS]
                    if size + len(own) > POSITIONS:
                        yield from flush()
                        size = 0
                    keys[size : size + len(own)] = phrase[own].astype(np.int64) << 32 | after[own]
                    size += len(own)
        if size:
            yield from flush()

    ship(lines.sparkSession)
    found = lines.mapInArrow(find, "phrase int, word int, n bigint")
    found = found.groupBy("phrase", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return found.select("phrase", "word")


def tries(pairs: DataFrame) -> Iterator[tuple[pa.Table, Trie]]:
    """Shards of at most TRIE rows of ``phrase, word, row_number``, each with its level of the trie.

    Numbers inside a shard count from 1.
    """
    total = pairs.count()
    for at in range(0, total, TRIE):
        own = pairs.filter(F.col("row_number").between(at + 1, at + TRIE)).toArrow()
        own = own.sort_by("row_number")
        phrase, word = (own[c].to_numpy().astype(np.int64) for c in ("phrase", "word"))
        # Arrays by phrase number are no longer than a few times the shard.
        wide = np.flatnonzero(np.diff(phrase // (4 * TRIE))) + 1
        for a, b in zip([0, *wide.tolist()], [*wide.tolist(), len(phrase)]):
            yield own.slice(a, b - a), Trie(phrase[a:b], word[a:b], np.arange(1, b - a + 1))


def counted(lines: DataFrame, level: int, trie: Trie, size: int) -> np.ndarray:
    """How often each phrase of a trie shard occurs: dense counts of every task, added up segment by segment."""
    spark = lines.sparkSession
    held = spark.sparkContext.broadcast(trie)

    def count(batches):
        forget_words()
        own = np.zeros(size + 1, np.int64)
        for batch in batches:
            for _, phrase, after in lines_of(batch, level):
                own += np.bincount(held.value.step(phrase, after), minlength=size + 1)
        yield from segments((at, own[at : at + SEGMENT]) for at in range(0, size + 1, SEGMENT))

    def segments(parts):
        for at, own in parts:
            place = np.flatnonzero(own).astype(np.int32)
            if len(place):
                blobs = [pa.array([x.tobytes()], pa.binary()) for x in (place, own[place])]
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), *blobs], names=["at", "place", "n"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, place, n in zip(*batch.columns):
                own = sums.setdefault(at.as_py(), np.zeros(SEGMENT, np.int64))
                own[np.frombuffer(place.as_buffer(), np.int32)] += np.frombuffer(n.as_buffer(), np.int64)
        yield from segments(sums.items())

    ship(spark)
    schema = "at bigint, place binary, n binary"
    found = lines.mapInArrow(count, schema).repartition("at").mapInArrow(add, schema)
    out = np.zeros(size + 1, np.int64)
    for row in found.collect():  # at most as long as the trie shard
        out[row["at"] + np.frombuffer(row["place"], np.int32)] = np.frombuffer(row["n"], np.int64)
    held.unpersist()
    return out[1:]


def advanced(lines: DataFrame, level: int, trie: Trie, first: int, last: bool) -> DataFrame:
    """Move the phrases of ``lines`` on through one shard of the trie; ``first`` is the number before its own.

    After the last shard only text that longer phrases can still cover is kept.
    """
    held = lines.sparkSession.sparkContext.broadcast(trie)

    def move(batches):
        forget_words()
        for batch in batches:
            rows = []
            known = batch.column("longer").to_pylist()
            for (word, phrase, after), longer in zip(lines_of(batch, level), known):
                found = held.value.step(phrase, after)
                found = np.where(found > 0, found + np.int32(first), np.frombuffer(longer, np.int32) if longer else 0)
                found = found.astype(np.int32)
                if last:
                    covered = np.zeros(len(word) + level + 1, np.int32)
                    at = np.flatnonzero(found)
                    np.add.at(covered, at, 1)
                    np.add.at(covered, at + level + 1, -1)
                    rows.append((*packed(word, np.cumsum(covered)[: len(word)] > 0, found), None))
                else:
                    rows.append((word, phrase, found))
            columns = zip(*[[None if x is None else x.tobytes() for x in row] for row in rows])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=names)

    names = ["words", "phrases", "longer"]
    ship(lines.sparkSession)
    out = stage(lines.mapInArrow(move, "words binary, phrases binary, longer binary"), "lines", **ROW_BY_ROW)
    held.unpersist()
    return out


def frequent_phrases(lines: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """All phrases up to LONGEST words that occur ``least`` times: ``lang, words, terms, n``, single words among them."""
    spark = words.sparkSession
    found = stage(
        words.select(
            F.col("number").cast("int").alias("number"), "lang", F.array(F.col("number").cast("int")).alias("words"),
            F.array("term").alias("terms"), "n",
        ),
        "phrases",
    )
    named = found.select(F.col("number").alias("word"), F.col("terms")[0].alias("term"))
    lines = lines.withColumn("phrases", F.lit(None).cast("binary")).withColumn("longer", F.lit(None).cast("binary"))
    levels = [found]
    for level in range(1, LONGEST):
        pairs = number_rows(candidates(lines, level, least), ["phrase", "word"])
        path = new_path(spark, "frequent")
        schema = "phrase int, word int, n bigint"
        spark.createDataFrame([], schema).write.parquet(path)
        for own, trie in tries(pairs):
            n = counted(lines, level, trie, own.num_rows)
            kept = np.flatnonzero(n >= least)
            table = own.select(["phrase", "word"]).take(pa.array(kept)).append_column("n", pa.array(n[kept]))
            spark.createDataFrame(table).write.mode("append").parquet(path)
        longer = number_rows(spark.read.schema(schema).parquet(path), ["phrase", "word"])
        if longer.isEmpty():
            break
        before = levels[-1].select(F.col("number").alias("phrase"), "lang", "words", "terms")
        grown = longer.join(before, "phrase").join(named, "word").select(
            F.col("row_number").cast("int").alias("number"), "lang", F.concat("words", F.array("word")).alias("words"),
            F.concat("terms", F.array("term")).alias("terms"), "n",
        )
        levels.append(stage(grown, "phrases"))
        if level + 1 < LONGEST:
            total, done = longer.count(), 0
            for own, trie in tries(longer):
                former, done = lines, done + own.num_rows
                lines = advanced(former, level, trie, done - own.num_rows, done == total)
                unstage(former)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out.drop("number")


def mine_phrases(df: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """The phrases of 2 to LONGEST words that stand out most in each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts, A-Z in lower case, are parted at stops and line ends into pieces and at blanks and tabs
    into words. Everything is counted in a language (null: ``und``): ``n`` its words, ``a`` the
    occurrences of the phrase, overlapping ones included, ``least`` of them at least. Cut in two, a
    phrase scores ``floor(1000 * a * n / (l * r))`` by the occurrences of its parts; its lowest score
    counts, of equal ones that after the fewest words. Phrases inside a longer one that occurs as
    often are left out. Ranked by score, ``a``, and the phrase in the order of its bytes. Exact up
    to 10^15 words. Null and empty texts have no words. Rows are documents, so repeated ones count again; an empty table
    gives an empty one; other columns are not read. A block of texts is held in memory, and so is
    the longest text.
    """
    spark = df.sparkSession
    docs = df.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
    )
    with session_conf(spark, SETTINGS):
        counts = stage(word_counts(docs), "words")
        frequent = counts.filter(F.col("n") >= least)
        lines, words = encoded(docs, perfect_shards(frequent, "lang", "term", F.lit(True)))
        phrases = stage(frequent_phrases(lines, words.join(frequent, ["lang", "term"]), least), "phrases")

    longer = phrases.filter(F.size("words") > 1)
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = longer.select("words", F.col("n").alias("a"), cut).select(
        "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("left"),
        F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(phrases.select(F.col("words").alias(side), F.col("n").alias(name)), side)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    named = longer.select("words", "lang", F.array_join("terms", " ").alias("phrase")).join(totals, "lang")
    cuts = stage(cuts.select("words", "a", "k", "l", "r"), "cuts").join(named, "words")
    exact = F.expr(
        "(CAST(1000 AS DECIMAL(4,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(total AS DECIMAL(15,0))))"
        " div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))"
    )
    scored = cuts.withColumn("score", exact).groupBy("lang", "words", "phrase", "a", "total")
    scored = scored.agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # A phrase of a longer one that occurs as often also lies in one longer by a single word that does.
    inner = longer.filter(F.size("words") > 2).select(
        F.col("n").alias("whole"),
        F.explode(
            F.array(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1))
        ).alias("words"),
    )
    inner = inner.groupBy("words").agg(F.max("whole").alias("whole"))
    left = scored.join(inner, "words", "left").filter(F.col("whole").isNull() | (F.col("whole") < F.col("a")))
    rows = left.select(
        "lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"),
        F.col("total").alias("n"), F.col("best.score").alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 strongest phrases of each language of the documents."""
    found = mine_phrases(documents(spark, folder))
    return found.withColumn("rank", F.col("rank").cast("long"))


OP11_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, w[i:i + m - 1] AS g
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM words, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, g, count(*) AS n FROM grams GROUP BY lang, g HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
found AS (SELECT lang, g, n AS a FROM f WHERE len(g) > 1),
cuts AS (
  SELECT c.lang, c.g, c.a, k, x.n AS l, y.n AS r, t.n,
         (1000::HUGEINT * c.a * t.n // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM found) c
  JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:]
  JOIN totals t ON t.lang = c.lang),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ AS (
  SELECT DISTINCT p.lang, p.g
  FROM (SELECT *, unnest(range(2, len(g))) AS m FROM (SELECT lang, g, a, unnest(range(1, len(g))) AS s FROM found)) q
  JOIN found p ON p.lang = q.lang AND p.g = q.g[q.s:q.s + q.m - 1]
  WHERE q.s + q.m - 1 <= len(q.g) AND 100 * q.a >= 100 * p.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, list_aggregate(g, 'string_agg', ' ')) AS rank,
       list_aggregate(g, 'string_agg', ' ') AS phrase, a, l, r, n, score
FROM best WHERE (lang, g) NOT IN (SELECT lang, g FROM inner_)
QUALIFY rank <= 2000
"""
