"""Operator 13: perfect hashes, and the audit against plain Python."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from peopleflow.llm import divergence, perfect_hash
from peopleflow.llm.divergence import audit_sources

SCHEMA = "lang string, source string, text string"


def test_perfect_hash_is_minimal_and_checks_keys():
    keys = [f"key {k}".encode() for k in range(5000)]
    levels, slots = perfect_hash.build(perfect_hash.key_hashes(keys))
    assert sorted(slots) == list(range(5000))
    ordered = [keys[k] for k in np.argsort(slots)]
    part = {
        "shard": 0, "n": 5000, "levels": [x.tobytes() for x in levels], "keys": b"".join(ordered),
        "ends": np.cumsum([len(k) for k in ordered]).astype(np.int32).tobytes(),
    }
    table = perfect_hash.PerfectHash(1, [part])
    assert table.slots(pa.array(keys, pa.binary())).tolist() == slots.tolist()
    strangers = pa.array([f"other {k}".encode() for k in range(5000)], pa.binary())
    assert (table.slots(strangers) == -1).all()


def test_keys_that_no_level_places_are_found_by_name():
    same = np.full(3, 7, np.uint64)
    levels, slots = perfect_hash.build(same)
    assert slots.tolist() == [0, 1, 2] and len(levels) == perfect_hash.LEVELS


def expected(rows):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen, counts = {}, {}
    for lang, source, text in rows:
        words = term.findall((text or "").translate(lower))
        seen.setdefault(lang or "", Counter()).update(set(words))
        counts.setdefault((lang or "", source or ""), Counter()).update(words)
    out = []
    for lang, documents in seen.items():
        kept = sorted(w for w, n in documents.items() if n >= 3)
        own = {s: c for (x, s), c in counts.items() if x == lang}
        whole = sum(own.values(), Counter())

        def chances(c):
            total = sum(c[w] for w in kept) + len(kept)
            return {w: 1 + 10**9 * (c[w] + 1) // total for w in kept}

        p, q = {s: chances(c) for s, c in own.items()}, chances(whole)
        for s in own:
            pairs = [(o, sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept)) for o in own if o != s]
            terms = [(w, (p[s][w] - q[w]) ** 2 // q[w]) for w in kept if own[s][w] and p[s][w] > q[w]]
            for part, found, top in (("pair", pairs, None), ("term", terms, 200)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:top]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


ROWS = [
    ("en", "a", "The cat, the Cat and THE dog."),
    ("en", "a", "the cat sat"),
    ("en", "b", "the dog sat; cat Öl öl"),
    ("en", "b", "Öl the dog\x00the\tcat's"),
    ("en", "c", None),
    ("en", "c", "öl öl öl Öl"),
    ("en", "c", "öl öl öl Öl"),
    (None, None, "x1y x y"),
    (None, "a", "x y"),
    (None, "b", ""),
    (None, "b", "x"),
    ("de", "a", "nur einmal"),
    ("de", "b", "anders"),
    ("fr", "solo", "un un un"),
]


@pytest.mark.parametrize("limit", [divergence.HEAD_BYTES, 60, 0])
def test_audit_equals_plain_python(spark, monkeypatch, limit):
    """Whether all terms are broadcast, some, or none."""
    monkeypatch.setattr(divergence, "HEAD_BYTES", limit)
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert sorted(map(tuple, audit_sources(df).collect())) == expected(ROWS)


def test_sources_meet_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 2)
    rows = [("en", f"s{k % 7}", f"w{'abc'[k % 3]} w{'abcd'[k % 4]} common" * (k % 5)) for k in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, audit_sources(df).collect())) == expected(rows)


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert audit_sources(df).count() == 0
    df = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 AS term", "2 AS n", "3 AS shard", "4 AS v")
    assert sorted(map(tuple, audit_sources(df).collect())) == expected(ROWS)


def test_long_text(spark):
    rows = [("en", "a", "word " * 400_000 + "x" * 100_000), ("en", "b", "word other"), ("en", "b", "word other")]
    assert sorted(map(tuple, audit_sources(spark.createDataFrame(rows, SCHEMA)).collect())) == expected(rows)
