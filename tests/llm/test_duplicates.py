"""Exact, near and repeated-string duplicates against brute force."""

import hashlib
import random

import numpy as np
import pytest

from peopleflow.llm import minhash, repeats
from peopleflow.llm.exact_dedup import DigestIndex, distinct_texts
from peopleflow.llm.groups import components
from peopleflow.llm.minhash import near_duplicates, shingles
from peopleflow.llm.repeats import remove_repeats
from peopleflow.session import stage
from peopleflow.session import new_path

DOCS = "doc_id long, text string, kept string"


def test_index_persists_and_dedups_later_batches(spark):
    path = new_path(spark, "index")
    first = [(1, "Ab", "x"), (5, "aB", "x"), (3, None, "x"), (2, "", "x"), (9, "É", "x")]
    out = {r.doc_id: r for r in DigestIndex(spark, path).add(spark.createDataFrame(first, DOCS)).collect()}
    assert {k: (r.keep_id, r.group_size, r.kept) for k, r in out.items()} == {
        1: (5, 2, False), 5: (5, 2, True), 3: (3, 2, True), 2: (3, 2, False), 9: (9, 1, True),
    }
    later = [(10, "ab", "x"), (11, "é", "x"), (12, "new", "x")]
    out = {r.doc_id: r for r in DigestIndex(spark, path).add(spark.createDataFrame(later, DOCS)).collect()}
    assert {k: (r.keep_id, r.kept) for k, r in out.items()} == {10: (5, False), 11: (11, True), 12: (12, True)}
    assert DigestIndex(spark, path).read().count() == 5


def test_distinct_texts_leave_one_row_and_all_columns(spark):
    rows = [(1, "a", "k"), (1, "a", "k"), (None, "n", None), (2, "A", "m"), (7, None, None)]
    out = distinct_texts(spark.createDataFrame(rows, DOCS))
    assert out.columns == ["doc_id", "text", "kept"]
    assert sorted((r.doc_id or 0, r.text) for r in out.collect() if r.text) == [(0, "n"), (2, "A")]
    assert out.count() == 3
    assert distinct_texts(spark.createDataFrame([], DOCS)).count() == 0


def brute_components(texts):
    sets = {i: set(shingles(t or "").tolist()) for i, t in texts.items()}
    root = {i: i for i in texts}
    for a in texts:
        for b in texts:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return root


def near_copies(n, seed, words=80):
    r = random.Random(seed)
    base = [f"w{r.randrange(9999)}" for _ in range(words)]
    texts = {}
    for i in range(n):
        own = list(base) if i % 4 else [f"u{r.randrange(9999)}" for _ in range(words)]
        for _ in range(r.randrange(6)):
            own[r.randrange(words)] = f"z{r.randrange(9999)}"
        texts[i] = " ".join(own)
    return texts


@pytest.mark.parametrize("block", [2, 2000])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "PARTNERS", block)
    texts = near_copies(60, 7) | {100: None, 101: " \n", 102: "One two", 103: "one  TWO", 104: "a " * 30_000}
    docs = spark.createDataFrame([(i, t, "c") for i, t in texts.items()], DOCS)
    out = {r.doc_id: r for r in near_duplicates(docs).collect()}
    wanted = brute_components(texts)
    assert {i: r.component_id for i, r in out.items()} == wanted
    assert all(r.kept == (wanted[i] == i) for i, r in out.items())
    assert out[100].n_shingles == out[101].n_shingles == 0 and out[102].n_shingles == out[104].n_shingles == 1


def test_near_duplicates_of_empty_and_repeated_rows(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, "a b c d e f", "x")] * 2 + [(None, "a b c d e f", "x")]
    assert [r.component_id for r in near_duplicates(spark.createDataFrame(rows, DOCS)).collect()] == [1, 1, 1]


def test_bits_estimate_similarity():
    r = np.random.default_rng(0)
    both, a, b = (r.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    x, y = (minhash.minima(np.unique(np.r_[both, own])) for own in (a, b))
    assert abs((x == y).mean() - 0.8) < 0.1
    mask = np.uint32(2**minhash.BITS - 1)
    assert ((x & mask) != (y & mask)).sum() <= minhash.MOST_UNEQUAL


def test_components_of_a_long_chain(spark):
    order = random.Random(1).sample(range(200), 200)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    labels = spark.range(210).selectExpr("id AS node", "id AS label")
    found = {r.node: r.label for r in components(labels, edges).collect()}
    assert all(found[i] == (0 if i < 200 else i) for i in range(210))


def brute_repeats(rows, length):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda x: x[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if data[s : s + length] in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(data[s : s + length])
        out.append((doc, bytes(b for b, g in zip(data, gone) if not g), sum(gone)))
    return out


@pytest.mark.parametrize(("hot", "filter_bits"), [(1, 28), (5000, 28), (5000, 11)])
def test_repeats_equal_brute_force(spark, monkeypatch, hot, filter_bits):
    """Also with filters so small that each is one of many, and none is full."""
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "FILTER_BITS", filter_bits)
    monkeypatch.setattr(repeats, "BLOCK", 512)
    r = random.Random(11)
    passage = "".join(r.choice("abcdeé ") for _ in range(400))
    rows = []
    for i in range(40):
        own = "".join(r.choice("abcde\x00 ") for _ in range(r.randrange(300)))
        cut = r.randrange(150)
        rows.append((i, own + passage[cut : cut + r.randrange(400)] + own[:50]))
    rows += [(50, "a" * 1500), (51, "a" * 700 + "b"), (52, "ab" * 300), (53, None), (54, ""), (55, "x" * 99), (56, rows[3][1])]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], DOCS)
    out = sorted((x.doc_id, bytes(x.kept), sum(s.end - s.start for s in x.spans)) for x in remove_repeats(docs).collect())
    assert out == brute_repeats(rows, 100)


def test_repeats_of_rows_with_the_same_or_no_id(spark):
    r = random.Random(2)
    text = "".join(r.choice("abcdef") for _ in range(300))
    rows = [(1, text, "x"), (1, text, "x"), (None, text, "x"), (2, "short", "x")]
    out = {(r.doc_id, len(r.kept)) for r in remove_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert out == {(None, 300), (1, 0), (2, 5)}
    assert remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_filters_let_few_strangers_through(spark, monkeypatch):
    monkeypatch.setattr(repeats, "FILTER_BITS", 14)
    known = np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64)
    table = stage(spark.createDataFrame([(int(x),) for x in known.view(np.int64)], "trigger bigint"), "known")
    strangers = np.random.default_rng(2).integers(0, 2**63, 20_000, dtype=np.uint64)
    held, let = np.zeros(len(known), int), np.zeros(len(strangers), int)
    filters = 0
    for wanted in repeats.make_filters(table, "trigger"):
        filters += 1
        held += wanted.value.holds(known)
        let += wanted.value.holds(strangers)
    assert filters == 5 and (held == 1).all() and let.max() <= 1 and let.mean() < 0.04


def test_small_filters_cost_no_more_passes_over_the_texts(spark, monkeypatch):
    r = random.Random(13)
    passages = ["".join(r.choice("abcdefgh ") for _ in range(150)) for _ in range(12)]
    rows = [(i, "".join(r.choice("abcdefgh ") for _ in range(60)) + r.choice(passages) * 2) for i in range(80)]
    read = []
    for filter_bits in (28, 10):
        monkeypatch.setattr(repeats, "FILTER_BITS", filter_bits)
        seen = spark.sparkContext.accumulator(0)

        def count(batches, seen=seen):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        docs = spark.createDataFrame([(i, t, "c") for i, t in rows], DOCS).mapInArrow(count, DOCS)
        out = sorted((x.doc_id, bytes(x.kept), sum(s.end - s.start for s in x.spans)) for x in remove_repeats(docs).collect())
        assert out == brute_repeats(rows, 100)
        read.append(seen.value)
    assert read[0] == read[1] <= 4 * len(rows)


def test_repeats_of_phrases_dealt_over_many_bins(spark, monkeypatch):
    """Also of phrases that a batch holds again, and of rows that come twice."""
    monkeypatch.setattr(repeats, "BIN_BYTES", 50)
    r = random.Random(17)
    passage = "".join(r.choice("abcdé ") for _ in range(500))
    rows = [(i, passage[r.randrange(200) : r.randrange(250, 500)] + str(i) * 30 + passage[: r.randrange(300)]) for i in range(30)]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows * 2], DOCS).repartition(3)
    out = {(x.doc_id, bytes(x.kept), sum(s.end - s.start for s in x.spans)) for x in remove_repeats(docs).collect()}
    assert sorted(out) == brute_repeats(rows, 100)


def test_packed_rows_come_back():
    r = np.random.default_rng(3)
    bins, columns = r.integers(0, 7, 500), r.integers(-(2**63), 2**63 - 1, (3, 500))
    at, values = repeats.packed(bins, *columns)
    assert at.tolist() == sorted(set(bins.tolist()))
    order = np.argsort(bins, kind="stable")
    assert (np.array(repeats.unpacked(values, 3)) == columns[:, order]).all()
    assert [len(x) for x in repeats.unpacked([], 3)] == [0, 0, 0]
    assert repeats.packed(bins[:0], *columns[:, :0])[1] == []
    assert repeats.met_again(np.array([5, 1, 5, 2, 5, 1])).tolist() == [True, True, True, False, True, True]


def test_equal_hashes_of_different_strings_are_told_apart(monkeypatch):
    data = np.frombuffer(random.Random(3).randbytes(400) * 2, np.uint8)
    begin = np.arange(600)
    expected = [data[b : b + 100].tobytes() for b in begin]
    for hashed in (repeats.hashes, lambda data, starts, ends: starts.astype(np.uint64) * 0):
        monkeypatch.setattr(repeats, "hashes", hashed)
        kind = repeats.classes(data, begin, 100)
        assert len(set(zip(kind.tolist(), expected))) == len(set(expected)) == len(set(kind.tolist())) == 400


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    expected = []
    for doc, kept, lost in brute_repeats(rows, 100):
        expected.append((doc, len(kept) + lost, lost, hashlib.sha256(kept).hexdigest()))
    found = repeats.op8_repeated_strings(spark, folder).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in found) == expected


def test_parse_covers_every_string():
    data = np.frombuffer(random.Random(1).randbytes(5000) + b"a" * 3000, np.uint8)
    _, _, start, many = repeats.parse(data)
    assert start[0] == 0 and (start[1:] == start[:-1] + many[:-1]).all() and start[-1] + many[-1] == len(data) - 99
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_repeats_of_texts_that_share_an_id_and_a_mark(spark):
    r = random.Random(5)

    def letters(n):
        return "".join(r.choice("abcdefgh") for _ in range(n))

    passage = letters(200)
    long = letters(500) + passage
    mark = repeats.text_mark(long.encode())
    short = next(t for t in iter(lambda: letters(150), None) if repeats.text_mark(t.encode()) == mark)
    other = next(t for t in (letters(500) + letters(200) for _ in iter(int, 1)) if repeats.text_mark(t.encode()) == mark)
    for shared in (7, None):
        # A null id comes before all others, so then the first text with the passage has no id.
        first, lost = (7, 0) if shared is None else (1, 200)
        rows = [(first, passage, "x"), *((shared, t, "x") for t in (long, short, other)), (9, passage, "x")]
        out = remove_repeats(spark.createDataFrame(rows, DOCS)).collect()
        assert sorted((x.doc_id or 0, x.n_bytes, len(x.kept)) for x in out) == sorted(
            [(first, 200, lost), (shared or 0, 700, 500 + 200 - lost), (shared or 0, 150, 150), (shared or 0, 700, 700), (9, 200, 0)]
        )


def test_equal_starts_in_texts_of_one_id_and_mark_are_repeats(spark):
    r = random.Random(6)
    passage = "".join(r.choice("abcdefgh") for _ in range(300))
    tails = ["".join(r.choice("abcdefgh") for _ in range(40)) for _ in range(400)]
    rows = [(None, passage + t, "x") for t in tails]
    out = remove_repeats(spark.createDataFrame(rows, DOCS)).collect()
    # Only one text keeps the passage.
    assert sorted(len(x.kept) for x in out)[-2:] == [max(len(x.kept) for x in out if len(x.kept) < 300), 340]


def test_links_of_short_texts_pass_the_estimate():
    r = np.random.default_rng(4)
    ones = np.uint64((2**64 - 1) // (2**minhash.BITS - 1))
    lost = 0
    for _ in range(8000):
        whole = r.integers(0, 2**63, 4).astype(np.uint64) * np.uint64(2)
        a, b = (minhash.signature(np.sort(x))[1].view(np.uint64) for x in (whole, whole[:3]))
        apart = a ^ b
        lost += int(np.bitwise_count((apart | apart >> np.uint64(1)) & ones).sum()) > minhash.MOST_UNEQUAL
    assert lost == 0


def test_filters_are_read_while_their_shuffles_stay(spark, monkeypatch):
    """A query read by an iterator counts as ended before its rows are read, so its shuffles must not go then."""
    key, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []

    def noted(found, *args, make=repeats.make_filters):
        seen.append(found.sparkSession.conf.get(key))
        return make(found, *args)

    monkeypatch.setattr(repeats, "make_filters", noted)
    rows = [(1, "ab" * 300, "x"), (1, "cd" * 300, "x")]
    assert remove_repeats(spark.createDataFrame(rows, DOCS)).count() == 2
    assert seen == ["false", "false"]
