"""Line-first cleaning and quality rules (operator 9). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peopleflow.llm.common import SPACES, documents

WINDOW = 8
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]"
GAP = r"[\x20\x09-\x0D]+"

#: A line ends properly with one of these, perhaps followed by closing quotes or brackets.
SENTENCE_END = r"""[.!?:;…。！？]["'”’»)\]]*[\x20\x09-\x0D]*$"""

#: Lines of the interface around a text.
BOILERPLATE = (
    r"(?i)(all rights reserved|cookie policy|privacy policy|terms of (use|service)|accept (all )?cookies"
    r"|enable javascript|click here|subscribe to our|sign in|log in|lorem ipsum|follow us on|read more)"
)

#: Separators of menus and bread crumbs; a line with so many of them is navigation.
SEPARATORS = r"[|›»•·>]"
MOST_SEPARATORS = 3

#: A line with no proper end needs so many words.
LEAST_WORDS = 5

#: The share of symbols, in hundredths of a line's characters, from which the line fails.
MOST_SYMBOLS = 10

#: A document goes if failing lines hold more than so many hundredths of its characters.
MOST_LOST = 50


def count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def line_fails(line: Column) -> Column:
    """Whether a line breaks a rule on symbols, navigation, boilerplate or punctuation."""
    words = F.regexp_count(line, F.lit(WORD + "+"))
    return (
        (count_of(line, SYMBOLS) * 100 > F.length(line) * MOST_SYMBOLS)
        | (F.regexp_count(line, F.lit(SEPARATORS)) >= MOST_SEPARATORS)
        | line.rlike(BOILERPLATE)
        | (~line.rlike(SENTENCE_END) & (words < LEAST_WORDS))
    )


def repeated_words(docs: DataFrame, words: str, out: str) -> DataFrame:
    """Add the number of words that lie in a window of eight words found twice or more in the row.

    Windows are compared by 64-bit hashes within one row. Each step is a column of its own, used
    more than once by the next, so that it is worked out once for a row and not for each element.
    """
    last = F.size(words) - WINDOW
    hashes = F.when(
        last >= 1,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(F.col(words), i + 1, WINDOW))),
    )
    docs = docs.withColumn("__windows", hashes)
    again = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    docs = docs.withColumn("__sorted", F.when(again, F.array_sort(placed)))

    def twice(x: Column, k: Column) -> Column:
        before, after = F.get("__sorted", k - 1)["h"], F.get("__sorted", k + 1)["h"]
        return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

    starts = F.transform(F.filter("__sorted", twice), lambda x: x["i"])
    docs = docs.withColumn("__starts", F.array_sort(starts))
    steps = F.transform(
        "__starts",
        lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("__starts", k + 1) - s, F.lit(WINDOW))),
    )
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s)
    return docs.withColumn(out, F.coalesce(total, F.lit(0))).drop("__windows", "__sorted", "__starts")


def quality_report(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures and the verdict for every row; other columns are not read.

    Null and blank texts have no words: they fail for being short. Lines without a word count
    neither as lost nor as text. Repeated rows get equal rows, an empty table an empty result.
    """
    # U+0000 to U+001F are not white space but for the six separators of words.
    value = F.coalesce(F.col(text), F.lit(""))
    docs = df.select(F.col(doc_id).alias("doc_id"), value.alias("__text"))
    docs = docs.select(
        "doc_id",
        "__text",
        F.filter(F.split("__text", GAP), lambda w: w != "").alias("__words"),
        F.filter(F.split("__text", "\n"), lambda x: x.rlike(WORD)).alias("__lines"),
    )
    docs = repeated_words(docs, "__words", "n_repeat_words")
    add = lambda lines: F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    docs = docs.select(
        "doc_id",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.translate("__text", SPACES, "")).cast("long").alias("word_chars"),
        count_of(F.col("__text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        add("__lines").alias("line_chars"),
        add(F.filter("__lines", line_fails)).alias("lost_chars"),
    )
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return docs.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("line_chars") * MOST_LOST)
    )


def clean_lines(text: Column) -> Column:
    """A text without its failing lines; blank lines stay. Null stays null, and empty texts stay empty.

    A line is judged by itself, so repeated lines stay or go together; a row is judged by itself too.
    """
    lines = F.filter(F.split(text, "\n"), lambda x: ~x.rlike(WORD) | ~line_fails(x))
    return F.array_join(lines, "\n")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and the verdict for every document."""
    return quality_report(documents(spark, folder))


_FAILS = f"""(100 * (length(x) - length(translate(x, '{SYMBOLS}', ''))) > {MOST_SYMBOLS} * length(x)
  OR length(regexp_replace(x, '[^|›»•·>]', '', 'g')) >= {MOST_SEPARATORS}
  OR regexp_matches(x, '{BOILERPLATE}')
  OR (NOT regexp_matches(x, '{SENTENCE_END.replace("'", "''")}')
      AND len(regexp_extract_all(x, '{WORD}+')) < {LEAST_WORDS}))"""

OP9_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD}+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, list_aggregate(words[i:i + {WINDOW - 1}], 'string_agg', ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM docs)),
again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
steps AS (
  SELECT r, least({WINDOW}, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, {WINDOW})) AS s FROM again),
repeats AS (SELECT r, sum(s) AS n FROM steps GROUP BY r),
measured AS (
  SELECT doc_id, len(words) AS n_words,
         length(list_aggregate(list_concat(words, ['']), 'string_agg', '')) AS word_chars,
         length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         coalesce(list_sum(list_transform(lines, lambda x: length(x))), 0)::BIGINT AS line_chars,
         coalesce(list_sum(list_transform(list_filter(lines, lambda x: {_FAILS}), lambda x: length(x))), 0)::BIGINT AS lost_chars
  FROM docs LEFT JOIN repeats USING (r))
SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
       AND 100 * lost_chars <= {MOST_LOST} * line_chars AS kept
FROM measured
"""
