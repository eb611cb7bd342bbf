"""Toxicity by class-conditional Kneser-Ney models of characters (operator 10)."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peopleflow.llm.common import add_columns, as_list, cut_to, documents, held_for, ship
from peopleflow.session import stage

#: Symbols: 0 for the border of a word, and the letters themselves below U+1000, which holds the Latin,
#: Greek, Cyrillic, Hebrew, Arabic and Indic ones; letters further up share symbols with others.
SYMBOLS = 4096

#: Symbols in an n-gram; a number of 60 bits.
ORDER = 5

#: Word scores from which a word counts as marked, for the features of a document.
MARKS = (1.5, 3.0)

#: A document's features: mean score, the three largest, share and number of marked words.
FEATURES = 2 + 2 * len(MARKS)

#: Labelled documents of each class, at most, whose features the weights of the final score are fitted on.
CALIBRATION_ROWS = 20_000

#: Parts of the rows to learn from. Each is calibrated on with the counts of the others, so that those
#: models are nearly as rich as the final one, which has the counts of all.
PARTS = 5

#: Added to the number of distinct words in shares, so that a text of few words has no large ones.
FEW_KINDS = 20

THRESHOLD = 0.7

#: Words whose scores a worker remembers; more are worked out again.
KNOWN_WORDS = 100_000

#: Texts whose new words are scored in one go.
BLOCK = 1000

_words = re.compile(r"[^\W\d_]+").findall


def words(text: str) -> list[str]:
    """The lower-cased words of a text, letters only."""
    return _words(text.lower())


def ngrams(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of words, as numbers, and where each word's begin.

    Each letter ends one and so does the border after the word; contexts are borders before it.
    """
    pad = "\0" * (ORDER - 1)
    points = np.frombuffer((pad + pad.join(found) + pad).encode("utf-32-le", "replace"), "<u4")
    symbol = np.where(points < SYMBOLS, points, 1 + points % (SYMBOLS - 1)).astype(np.int64)
    key = np.zeros(max(len(symbol) - ORDER + 1, 0), np.int64)
    for k in range(ORDER):
        key = key * SYMBOLS + symbol[k : k + len(key)]
    # Keep those that end in a letter or in the first border after one.
    ends = (symbol[ORDER - 1 :] > 0) | (symbol[ORDER - 2 : -1] > 0)
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    return key[ends], np.cumsum(sizes) - sizes


def learned_fold(doc_id):
    """0 and 2: rows to learn from, all of them counted; 1: held out. Null ids fall with the text 'null'."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")) % 3


def learned_part(doc_id):
    """The part, of PARTS, that a row to learn from falls in; independent of its fold."""
    return (F.floor(F.crc32(F.col(doc_id).cast("string").cast("binary")) / 3) % PARTS).cast("int")


def count_ngrams(rows: DataFrame, text: str, label: str, part: str) -> DataFrame:
    """Occurrences of each n-gram in each part's ordinary and toxic rows: ``ngram, part, ordinary, toxic``.

    A batch is counted in its task, tasks before the shuffle, so a shuffle holds an n-gram once for
    each task at most.
    """

    def count(batches):
        for batch in batches:
            keys, classes = [np.zeros(0, np.uint64)], batch.column(1).to_pylist()
            for value, kind in zip(as_list(batch.column(0)), classes):
                if found := words(value):
                    keys.append(ngrams(found)[0].astype(np.uint64) << np.uint64(4) | np.uint64(kind))
            found, n = np.unique(np.concatenate(keys), return_counts=True)
            kinds = (found & np.uint64(15)).astype(np.int32)
            toxic = kinds % 2 == 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((found >> np.uint64(4)).astype(np.int64)),
                    pa.array(kinds // 2),
                    pa.array(np.where(toxic, 0, n)),
                    pa.array(np.where(toxic, n, 0)),
                ],
                names=["ngram", "part", "ordinary", "toxic"],
            )

    ship(rows.sparkSession)
    kind = F.col(part) * 2 + F.when(F.col(label) > 0, 1).otherwise(0)
    counted = rows.select(text, kind.alias("kind"))
    counted = counted.mapInArrow(count, "ngram bigint, part int, ordinary bigint, toxic bigint")
    return counted.groupBy("ngram", "part").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def discount(counts: np.ndarray) -> float:
    """The absolute discount estimated from how many n-grams occur once and twice."""
    once, twice = (counts == 1).sum(), (counts == 2).sum()
    return once / (once + 2 * twice) if once and twice else 0.75


def kneser_ney(keys: np.ndarray, counts: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interpolated probabilities of sorted n-grams, and what their contexts leave to ``lower``.

    A context that was never seen leaves everything.
    """
    starts = np.flatnonzero(np.r_[True, keys[1:] // SYMBOLS != keys[:-1] // SYMBOLS])
    sizes = np.diff(np.r_[starts, len(keys)])
    d = discount(counts)
    total = np.add.reduceat(counts, starts).astype(float)
    kinds = np.add.reduceat((counts > 0).astype(np.int64), starts)
    left = np.repeat(np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0), sizes)
    seen = np.maximum(counts - d, 0) / np.maximum(np.repeat(total, sizes), 1)
    return seen + left * lower, left


class Ratios:
    """For each n-gram, the log of its last symbol's chance in toxic over that in ordinary words.

    Below the full order both classes share one model of continuation counts: in how many places of
    one symbol a shorter n-gram was seen in either class. So an n-gram seen in neither class differs
    only by what its context leaves to the shared model, and not at all after an unseen context.
    """

    def __init__(self, keys: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, ordinary, toxic = keys[order].astype(np.int64), ordinary[order], toxic[order]
        self.contexts = self.values = self.left = np.zeros(0)
        if not len(keys):
            return
        lower = self.shared(self.keys, ORDER - 1)
        models = [kneser_ney(self.keys, counts, lower) for counts in (toxic, ordinary)]
        self.values = (np.log(models[0][0]) - np.log(models[1][0])).astype(np.float32)
        self.contexts, first = np.unique(self.keys // SYMBOLS, return_index=True)
        self.left = (np.log(models[0][1]) - np.log(models[1][1])).astype(np.float32)[first]

    def shared(self, longer: np.ndarray, order: int) -> np.ndarray:
        """The shared probability of the last symbol of each of ``longer``, by its last ``order`` symbols."""
        if not order:
            return np.full(len(longer), 1 / len(np.unique(longer % SYMBOLS)))
        keys, at, places = np.unique(longer % SYMBOLS**order, return_inverse=True, return_counts=True)
        return kneser_ney(keys, places, self.shared(keys, order - 1))[0][at]

    def of(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(wanted), np.float32)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        context = wanted // SYMBOLS
        near = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        backed = np.where(self.contexts[near] == context, self.left[near], 0)
        return np.where(self.keys[at] == wanted, self.values[at], backed)

    def words(self, found: list[str]) -> np.ndarray:
        """The log-likelihood difference of each word."""
        keys, starts = ngrams(found)
        return np.add.reduceat(self.of(keys), starts)


class Reader:
    """Features of texts, with a bounded memo of word scores."""

    def __init__(self, ratios: Ratios) -> None:
        self.ratios, self.known = ratios, {}

    def features(self, texts: list[str]) -> np.ndarray:
        """A row of features for each text; texts without words give zeros."""
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        cut = [words(text) for text in texts]
        new = list({w for found in cut for w in found}.difference(self.known))
        if new:
            self.known |= zip(new, self.ratios.words(new).tolist())
        rows = np.zeros((len(texts), FEATURES))
        for k, found in enumerate(cut):
            if found:
                scores = np.fromiter(map(self.known.__getitem__, found), float, len(found))
                # A word that is repeated many times is one sign, so marks count distinct words.
                kinds = np.fromiter(map(self.known.__getitem__, set(found)), float)
                marked = [(kinds > m).sum() for m in MARKS]
                top = np.sort(kinds)[-3:].mean()
                rows[k] = [scores.mean(), top, *(n / (len(kinds) + FEW_KINDS) for n in marked), *np.log1p(marked)]
        return rows


def fit_weights(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic weights of scaled features, a bias last, by Newton steps with a small ridge.

    Rows weigh such that both classes count alike. Without both classes the score is one half.
    """
    x = np.c_[rows, np.ones(len(rows))]
    weights = np.zeros(x.shape[1])
    if len(set(labels.tolist())) < 2:
        return weights
    share = labels.mean()
    importance = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    ridge = np.diag([1e-2 * len(rows)] * rows.shape[1] + [1e-9])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (importance * (labels - chance)) - ridge @ weights
        bend = (x * (importance * chance * (1 - chance))[:, None]).T @ x + ridge
        weights += np.linalg.solve(bend, slope)
    return weights


class Scorer:
    """The fitted model: log ratios, the scale of the features, and their weights."""

    def __init__(self, ratios: Ratios, sample: np.ndarray, labels: np.ndarray) -> None:
        self.ratios = ratios
        self.scale = np.maximum(sample.std(0), 1e-9) if len(sample) else np.ones(FEATURES)
        self.weights = fit_weights(sample / self.scale, labels)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        x = rows / self.scale @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def reader(held) -> Reader:
    """The worker's reader for a broadcast model; a new model replaces the one before."""
    model = held.value
    kept = held_for("toxicity", "reader", list)
    if not kept or kept[0] is not model:
        kept[:] = model, Reader(getattr(model, "ratios", model))
    return kept[1]


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Scorer:
    """Learn from labelled rows that are not held out.

    N-grams are counted over all of these rows, in PARTS. The few final weights are fitted on rows
    of every part, CALIBRATION_ROWS of each class at most, with features by the counts of the other parts, which
    have not seen them; the model that scores has the counts of all parts. Rows without a label are
    not learned from; with an empty table, or one class alone, every score is one half; rows repeated with the same id and text weigh once in the fit; of several labels of a document the largest counts.
    """
    marks = labels.groupBy(F.col(doc_id).alias("__id")).agg(F.max("toxic").alias("__toxic"))
    marks = marks.filter("__toxic IS NOT NULL")
    marks = stage(marks, "marks")
    rows = docs.select(F.col(f"`{doc_id}`").alias(doc_id), F.col(f"`{text}`").alias(text))
    rows = cut_to(rows.filter(learned_fold(doc_id) != 1), doc_id, marks.select("__id"))
    rows = rows.join(marks.hint("merge"), F.col(doc_id) == F.col("__id"))
    order = F.xxhash64(F.col(doc_id).cast("string"), F.col(text)).alias("__order")
    rows = stage(rows.select(F.col(text).alias("text"), "__toxic", order, learned_part(doc_id).alias("part")), "labelled")
    table = count_ngrams(rows, "text", "__toxic", "part").toArrow()
    keys, at = np.unique(table["ngram"].to_numpy(), return_inverse=True)
    part, *counts = (table[c].to_numpy().astype(np.int64) for c in ("part", "ordinary", "toxic"))

    def ratios(chosen: np.ndarray) -> Ratios:
        ordinary, toxic = (np.bincount(at[chosen], c[chosen], len(keys)).astype(np.int64) for c in counts)
        seen = ordinary + toxic > 0
        return Ratios(keys[seen], ordinary[seen], toxic[seen])

    names = [f"f{k}" for k in range(FEATURES)]

    def features(held):
        def make(columns):
            for column in columns:
                found = reader(held).features(as_list(column))
                yield [pa.array(found[:, k].copy()) for k in range(len(names))]

        return make

    # The order goes by id, so copies of a text do not come in one block.
    chosen = F.lit(False)
    for own in (F.col("__toxic") > 0, F.col("__toxic") <= 0):
        first = rows.filter(own).select("__order").distinct().orderBy("__order").limit(CALIBRATION_ROWS)
        chosen = chosen | (own & (F.col("__order") <= F.lit(first.agg(F.max("__order")).first()[0])))
    sample, fields = [], [T.StructField(n, T.DoubleType()) for n in names]
    for k in range(PARTS):
        held = rows.sparkSession.sparkContext.broadcast(ratios(part != k))
        own = add_columns(rows.filter(chosen & (F.col("part") == k)), "text", fields, features(held))
        sample.append(own.select("__order", *names, "__toxic").distinct().toPandas())
        held.unpersist()
    sample = pd.concat(sample).sort_values(["__order", *names])
    marked = (sample["__toxic"].to_numpy(np.int64) > 0).astype(float)
    return Scorer(ratios(part >= 0), sample[names].to_numpy(float), marked)


def score(df: DataFrame, model: Scorer, text: str = "text", out: str = "score") -> DataFrame:
    """Add the score, from 0 to 1, of every row's whole text; null and empty texts count as no letters.

    Rows are independent, so repeated ones get equal scores, and an empty table stays empty. A column
    named like ``out`` is replaced, all others are carried along.
    """
    held = df.sparkSession.sparkContext.broadcast(model)

    def make(columns):
        for column in columns:
            texts, found = as_list(column), [np.zeros(0)]
            for at in range(0, len(texts), BLOCK):
                found.append(held.value.scores(reader(held).features(texts[at : at + BLOCK])))
            yield [pa.array(np.concatenate(found))]

    return add_columns(df, text, [T.StructField(out, T.DoubleType())], make)


def held_out(doc_id) -> bool:
    """The fold of one id, in Python."""
    return zlib.crc32(str("null" if doc_id is None else doc_id).encode()) % 3 == 1


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document."""
    docs = documents(spark, folder).select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic"))
    return score(docs, model).select(
        "doc_id",
        (learned_fold("doc_id") == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
