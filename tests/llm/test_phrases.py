"""Operator 11: the double array, and phrases against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from peopleflow.llm import phrases
from peopleflow.llm.phrases import Trie, mine_phrases
from peopleflow.session import new_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_trie_holds_its_pairs_and_no_others():
    random_ = np.random.default_rng(5)
    key = np.unique(np.r_[random_.integers(0, 3000 * 500, 4000), 7 * 500 + np.arange(1, 400)])
    phrase, word = key // 500 + 5, key % 500 + 1
    order = np.lexsort((word, phrase))
    phrase, word = phrase[order], word[order]
    trie = Trie(phrase, word, np.arange(1, len(key) + 1))
    assert trie.step(phrase, word).tolist() == list(range(1, len(key) + 1))
    all_ = np.arange(0, 3010 * 502)
    found = trie.step(all_ // 502, all_ % 502)
    assert (found > 0).sum() == len(key)


def test_large_families_find_room():
    """A thousand phrases that thousands of words may follow."""
    random_ = np.random.default_rng(6)
    key = np.unique(random_.integers(0, 1000, 300_000) * 100_000 + (random_.random(300_000) ** 4 * 99_999).astype(int))
    phrase, word = key // 100_000 + 1, key % 100_000 + 1
    trie = Trie(phrase, word, np.arange(1, len(key) + 1))
    assert trie.step(phrase, word).tolist() == list(range(1, len(key) + 1))


def expected(rows, least, top=2000):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                f.update((lang, tuple(words[k : k + size])) for k in range(len(words) - size + 1))
    found = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    inside = set()
    for (lang, w), a in found.items():
        for s in range(len(w)):
            for e in range(s + 1, len(w) + 1):
                if e - s < len(w) and 100 * a >= 100 * f[lang, w[s:e]]:
                    inside.add((lang, w[s:e]))
    out = {}
    for (lang, w), a in found.items():
        if (lang, w) not in inside:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((" ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    ranked = []
    for lang, listed in out.items():
        listed.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        ranked += [(lang, k + 1, *x) for k, x in enumerate(listed[:top])]
    return sorted(ranked)


def prose(seed=1, rows=300):
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(30)] + ["Ä", "ß", "a-b", "x\x00y", "of the", "THE  end", "a a a"]
    weights = [1 / (k + 1) for k in range(len(words))]
    out = []
    for k in range(rows):
        some = pick.choices(words, weights, k=pick.randint(0, 40))
        text = "".join(w + pick.choice([" "] * 8 + ["\t", ", ", ".\n", " | "]) for w in some)
        out.append((pick.choice(["en", "en", "en", "de", None]), text))
    return out + [("en", None), ("fr", ""), ("fr", "solo"), ("en", "one two three four five six\x0c" * 50)] + out[:40]


@pytest.mark.parametrize(("trie", "word_bytes", "top"), [(10**6, 10**8, 2000), (37, 300, 25)])
def test_phrases_equal_plain_python(spark, monkeypatch, trie, word_bytes, top):
    """With all words and tries in one broadcast, and dealt over many."""
    monkeypatch.setattr(phrases, "TRIE", trie)
    monkeypatch.setattr(phrases, "WORD_BYTES", word_bytes)
    monkeypatch.setattr("peopleflow.llm.perfect_hash.SHARD_KEYS", 16)
    rows = prose(rows=300 if trie > 100 else 60)
    least = 5 if trie > 100 else 4
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert sorted(map(tuple, mine_phrases(df, least=least, top=top).collect())) == expected(rows, least, top)


def test_no_phrases(spark):
    schema = "lang string, text string"
    assert mine_phrases(spark.createDataFrame([], schema)).count() == 0
    assert mine_phrases(spark.createDataFrame([("en", "a b")], schema)).count() == 0
    # Frequent words that never stand together.
    assert mine_phrases(spark.createDataFrame([("en", "a. b. ")] * 10, schema), least=5).count() == 0


def test_other_columns_and_a_long_text(spark):
    rows = [("en", "long text here " * 60_000 + "z" * 50_000), ("en", None)]
    df = spark.createDataFrame(rows, "lang string, text string")
    df = df.selectExpr("*", "1 AS words", "2 AS n", "3 AS phrase", "4 AS number", "5 AS row_number")
    assert sorted(map(tuple, mine_phrases(df).collect())) == expected(rows, 100)


def test_workers_get_few_bytes_at_a_time_and_old_lines_go(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, most, lines = spark.conf.get(key), set(), []

    def noted(df, label, stage=phrases.stage, **options):
        if label != "cuts":  # joins, without Python workers
            most.add(int(df.sparkSession.conf.get(key).removesuffix("b")))
        out = stage(df, label, **options)
        if label == "lines":
            lines.append({name.rpartition("/")[0].removeprefix("file://") for name in out.inputFiles()})
        return out

    monkeypatch.setattr(phrases, "stage", noted)
    monkeypatch.setattr(phrases, "TRIE", 37)
    rows = prose(seed=3, rows=60)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert sorted(map(tuple, mine_phrases(df, least=4).collect())) == expected(rows, 4)
    assert max(most) <= 1 << 23 and spark.conf.get(key) == before
    # Of the lines, moved on once for each part of the trie, only the last are kept.
    assert len(lines) > 3 and [any(Path(f).exists() for f in x) for x in lines] == [False] * (len(lines) - 1) + [True]


def test_workers_forget_words_when_they_are_encoded():
    class Held:
        value = []

    assert phrases.words_of(Held) == {} and phrases._hashes
    phrases.forget_words()
    assert not phrases._hashes


@pytest.mark.parametrize(("positions", "some"), [(10**4, 10**4), (100, 7), (50, 1)])
def test_candidates_of_small_tasks_equal_plain_python(spark, monkeypatch, positions, some):
    """Also when a task passes its candidates on in many steps."""
    monkeypatch.setattr(phrases, "POSITIONS", positions)
    monkeypatch.setattr(phrases, "ROWS", some)
    word = np.random.default_rng(8).integers(0, 9, (5, 300)).astype(np.int32)
    path = new_path(spark, "few")
    rows = [(bytearray(x.tobytes()), None) for x in word]
    spark.createDataFrame(rows, "words binary, phrases binary").repartition(2).write.parquet(path)
    found = phrases.candidates(spark.read.parquet(path), 1, 15).collect()
    n = Counter((a, b) for x in word.tolist() for a, b in zip(x, x[1:]) if a and b)
    assert sorted(map(tuple, found)) == sorted(k for k, v in n.items() if v >= 15)


def test_lines_are_written_in_small_pages(spark):
    """Twenty rows of a megabyte each, which would else be one page and one row group."""
    words = np.random.default_rng(9).integers(1, 1 << 30, 1 << 18).astype(np.int32)
    rows = [(bytearray(words.tobytes()), None, None)] * 20
    df = spark.createDataFrame(rows, "words binary, phrases binary, longer binary").coalesce(1)
    trie = Trie(np.array([1]), np.array([1]), np.array([1]))
    (name,) = phrases.advanced(df, 1, trie, 0, False).inputFiles()
    footer = pq.ParquetFile(name.removeprefix("file://")).metadata
    groups = [footer.row_group(k) for k in range(footer.num_row_groups)]
    assert footer.num_rows == 20 and max(g.total_byte_size for g in groups) <= 24 << 20 and len(groups) > 1
