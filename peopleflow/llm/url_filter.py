"""URL rules, and a character language-model ratio for URLs that no rule names (operator 7)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peopleflow.llm.common import add_columns, as_list, lower_ascii, ship

#: The rules of the query: verdict and host/path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: Symbols: end 0, letters 1 to 26, any digit 27, then . - / and all others.
SYMBOLS = 32

#: Symbols in an n-gram; there are at most SYMBOLS ** ORDER = 1,048,576 of them.
ORDER = 4

#: Of the accepted URLs the method may reject so many hundredths.
FALSE_BLOCKS = 1

#: One part in so many of the examples is kept from the models when the threshold is chosen.
HELD_OUT = 5

#: Bins a unit of the score is cut into when the threshold is chosen.
BINS = 100


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as ``struct<rule, verdict>``, or null.

    A rule fits its host and all subdomains, if the path starts with the rule's path. Of equally
    long rules the first listed wins.
    """
    chosen = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda x: len(x[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, found).otherwise(chosen)
    return chosen


def subject(host: Column, path: Column) -> Column:
    """What the models read: host and path without the two last labels and the first folder.

    Those are the parts that rules name, and would only repeat the rules.
    """
    name = F.regexp_replace(host, r"(^|\.)[^.]*\.?[^.]*$", "")
    return F.concat(name, F.regexp_replace(path, r"^/[^/]*", ""))


_TABLE = np.full(256, 31, np.int64)
_TABLE[97:123] = np.arange(1, 27)
_TABLE[65:91] = np.arange(1, 27)
_TABLE[48:58] = 27
for _char, _symbol in ((".", 28), ("-", 29), ("/", 30)):
    _TABLE[ord(_char)] = _symbol


def ngrams(text: str) -> np.ndarray:
    """The n-grams that end in each symbol and in the end of a text; contexts before it are ends."""
    found = np.zeros(len(data := text.encode()) + ORDER, np.int64)
    found[ORDER - 1 : -1] = _TABLE[np.frombuffer(data, np.uint8)]
    key = np.zeros(len(data) + 1, np.int64)
    for k in range(ORDER):
        key = key * SYMBOLS + found[k : k + len(key)]
    return key


def markov(counts: np.ndarray) -> np.ndarray:
    """Log chances of a symbol after its context, for every n-gram.

    Variable order: each context trusts what it has seen as often as it was seen, and the next
    shorter context as often as it saw different symbols (Witten-Bell). A context never seen is
    left out.
    """
    full = counts.reshape([SYMBOLS] * ORDER).astype(float)
    chance = np.full((1, SYMBOLS), 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        seen = full.sum(tuple(range(ORDER - order))).reshape(-1, SYMBOLS)
        kinds = (seen > 0).sum(1, keepdims=True)
        lower = np.tile(chance, (len(seen) // len(chance), 1))
        total = seen.sum(1, keepdims=True) + kinds
        chance = np.where(total > 0, (seen + kinds * lower) / np.maximum(total, 1), lower)
    return np.log(chance).ravel()


def count_ngrams(rows: DataFrame, text: str, label: str) -> DataFrame:
    """Occurrences of n-grams in accepted (0) and rejected (1) rows: ``ngram, accepted, rejected``."""

    def count(batches):
        for batch in batches:
            keys = [np.zeros(0, np.int64)]
            for value, mark in zip(as_list(batch.column(0)), batch.column(1).to_pylist()):
                keys.append(ngrams(value) * 2 + mark)
            found, n = np.unique(np.concatenate(keys), return_counts=True)
            mark = found % 2 == 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(found // 2), pa.array(np.where(mark, 0, n)), pa.array(np.where(mark, n, 0))],
                names=["ngram", "accepted", "rejected"],
            )

    parts = rows.select(text, label).mapInArrow(count, "ngram bigint, accepted bigint, rejected bigint")
    return parts.groupBy("ngram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


def counted(examples: DataFrame) -> np.ndarray:
    """Counts of all n-grams in accepted and in rejected examples."""
    table = count_ngrams(examples, "__subject", "__mark").toPandas()
    counts = np.zeros((2, SYMBOLS**ORDER), np.int64)
    counts[0, table["ngram"]], counts[1, table["ngram"]] = table["accepted"], table["rejected"]
    return counts


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """For each n-gram the log of its chance in rejected over that in accepted URLs, 0 without both kinds."""
    if not counts.any(1).all():
        return np.zeros(SYMBOLS**ORDER, np.float32)
    return (markov(counts[1]) - markov(counts[0])).astype(np.float32)


def judge_urls(df: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Add ``host, path, rule, verdict`` to rows with a URL; columns with these names are replaced.

    URLs that a rule fits are the accepted and rejected examples; all of them are counted. The score
    of a URL is the mean, over its symbols, of the log of the symbol's chance in rejected over that
    in accepted URLs. The threshold is the smallest that rejects at most FALSE_BLOCKS hundredths of
    the accepted examples of a part of one in HELD_OUT, by a hash of what the models read, and
    is found with models of the other parts; then all are counted. A URL that no rule fits is blocked if it scores above. Without examples of
    both kinds, and for null, empty and other texts without ``://``, the verdict is allow. Repeated
    rows get equal verdicts; an empty table stays empty.
    """
    names = ("host", "path", "rule", "verdict")
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])
    rows = rows.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    rows = rows.withColumn("__rule", rule_for(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("__subject", subject(F.col("host"), F.col("path")))
    examples = rows.filter("__rule IS NOT NULL").select(
        "__subject", F.when(F.col("__rule.verdict") == "block", 1).otherwise(0).alias("__mark")
    )
    held_out = F.pmod(F.xxhash64("__subject"), F.lit(HELD_OUT)) == 0
    counts = [counted(examples.filter(own)) for own in (~held_out, held_out)]

    def scored(part: DataFrame, counts: np.ndarray) -> DataFrame:
        held = df.sparkSession.sparkContext.broadcast(log_ratios(counts))

        def make(columns):
            for column in columns:
                yield [pa.array([float(held.value[ngrams(x)].mean()) for x in as_list(column)], pa.float64())]

        return add_columns(part, "__subject", [T.StructField("__score", T.DoubleType())], make)

    both = bool(counts[0].any(1).all())
    # A histogram has at most some thousand rows, whatever the number of URLs.
    unseen = scored(examples.filter("__mark = 0").filter(held_out), counts[0])
    accepted = unseen.groupBy(F.ceil(F.col("__score") * BINS).alias("bin"))
    threshold, spent = np.inf, 0
    if both:
        bins = sorted(((r["bin"], r["count"]) for r in accepted.count().collect()), reverse=True)
        allowed = sum(n for _, n in bins) * FALSE_BLOCKS / 100
        for edge, n in bins:
            threshold, spent = edge / BINS, spent + n
            if spent > allowed:
                break
    judged = F.contains(F.coalesce(F.col(url), F.lit("")), F.lit("://")) & (F.col("__score") > F.lit(float(threshold)))
    own = F.when(judged, "block").otherwise("allow")
    return scored(rows, counts[0] + counts[1]).select(
        *rows.columns[:-2],
        F.col("__rule.rule").alias("rule"),
        F.coalesce(F.col("__rule.verdict"), own).alias("verdict"),
    )


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on the URL of every page."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")
