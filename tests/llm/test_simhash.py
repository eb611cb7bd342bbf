"""Operator 12: fingerprints and their links against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from peopleflow.llm import simhash
from peopleflow.llm.queries import QUERIES
from peopleflow.llm.simhash import Shards, Tree, apart, fingerprint, linked, near_prints, search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def components_of(prints, bits=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(k) for k in range(len(prints))]


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "One", "a b c", "a b c d", "A\x0bb\x0cC d e Ä f " * 40, "x" * 100_000]
)
def test_fingerprint(text):
    assert fingerprint((text or "").encode()) == plain_print(text)


def test_long_text_is_counted_in_parts(monkeypatch):
    text = " ".join(f"w{k % 17} v{k % 5}" for k in range(500))
    monkeypatch.setattr(simhash, "SHINGLES", 64)
    assert fingerprint(text.encode()) == plain_print(text)


def crowd(seed=3, centres=40, near=30, flips=3):
    """Fingerprints around some centres, and as many at random."""
    random = np.random.default_rng(seed)
    middle = random.integers(0, 2**63, centres, dtype=np.uint64) * np.uint64(2)
    out = np.repeat(middle, near)
    for _ in range(flips):
        out ^= np.uint64(1) << random.integers(0, 64, len(out), dtype=np.uint64)
    return np.unique(np.r_[out, random.integers(0, 2**63, len(out), dtype=np.uint64)])


def test_search_finds_all_pairs():
    points, asked = crowd(), crowd(4)
    asked = np.r_[asked, points[::7] ^ np.uint64(5)]
    found = {(int(a), int(b)) for x, y in search(points, asked, 4) for a, b in zip(x, y)}
    expected = {(int(a), int(b)) for a, b in zip(*np.nonzero(apart(asked[:, None], points) <= 4))}
    assert found == expected and expected


def test_shards_hold_what_a_ball_touches():
    points = crowd()
    shards = Shards(points[::3], 16)
    home = shards.home(points)
    row, shard = shards.touched(points, 4)
    asked = set(zip(row.tolist(), shard.tolist()))
    for a, b in zip(*np.nonzero(apart(points[:, None], points) <= 4)):
        assert (a, home[b]) in asked


def test_equal_distances_do_not_stop_the_tree():
    """All fingerprints of one bit: every two are two apart."""
    points = np.uint64(1) << np.arange(64, dtype=np.uint64)
    points = np.r_[points, ~points]
    assert sum(len(a) for a, _ in search(points, points, 2)) == 2 * 64 * 64


def test_tree_answers_block_by_block():
    points, tree = crowd(), Tree(4)
    parts = [np.array_split(points, 3)[k] for k in range(3)]
    rows = [*tree.answer([parts[0]], []), *tree.answer([], [parts[1]]), *tree.answer([], [parts[2]])]
    links = [(a, b) for r in rows for a, b in zip(r["a"].to_pylist(), r["b"].to_pylist())]
    assert len(links) < len(points)
    assert all((np.int64(a).view(np.uint64) ^ np.int64(b).view(np.uint64)).bit_count() <= 4 for a, b in links)


def test_links_connect_the_same(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 100)
    monkeypatch.setattr(simhash, "SAMPLE", 300)
    points = crowd()
    df = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "print bigint").repartition(6)
    rows = {int(x): k for k, x in enumerate(points.view(np.int64))}
    root = list(range(len(points)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked(df).collect():
        x, y = sorted((find(rows[a]), find(rows[b])))
        root[y] = x
    assert [find(k) for k in range(len(points))] == components_of([int(x) for x in points])


ROWS = [
    (5, "a b c d e f g h"), (3, "A B C D e f g h"), (9, None), (4, ""), (7, " \n"), (2, "word"), (8, "Word"),
    (8, "Word"), (None, "word"), (None, "lonely text of its own here"), (1, "one two three four five six"),
]


def test_rows_with_nulls_ties_and_repeats(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string").selectExpr("*", "1 AS print", "2 AS node", "3 AS component_id")
    found = sorted((str(r.doc_id), r.print, r.component_id) for r in near_prints(df).collect())
    prints = [plain_print(t) for _, t in ROWS]
    groups = components_of(prints)
    expected = []
    for k, (doc, _) in enumerate(ROWS):
        ids = [d for (d, _), g in zip(ROWS, groups) if g == groups[k] and d is not None]
        expected.append((str(doc), np.uint64(prints[k]).view(np.int64).item(), min(ids, default=None)))
    assert found == sorted(expected, key=str) or found == sorted(expected)


def test_empty_table(spark):
    assert near_prints(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = sorted(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    prints = [plain_print(t) for _, t in rows]
    groups = components_of(prints)
    expected = [(d, f"{p:016x}", rows[g][0]) for (d, _), p, g in zip(rows, prints, groups)]
    assert sorted(map(tuple, QUERIES["op12_simhash_near_dedup"](spark, folder).collect())) == expected
