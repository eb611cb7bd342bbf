"""Encoding, counting and packing against the public tokenizer libraries."""

import base64
import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from peopleflow.llm import packing, transducer
from peopleflow.llm.bpe import decode, encode
from peopleflow.llm.packing import best_fit_decreasing, cut_pieces, lower_bound, pack
from peopleflow.llm.pretokens import byte_alphabet, read_ranks
from peopleflow.llm.token_counts import Counter, count_tokens
from peopleflow.llm.transducer import Decoder, Encoder, MergeTransducer, merge_bytes, utf8_step

RANKS = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def random_texts(n, seed=5):
    r = random.Random(seed)
    plain = [" ", "  ", "\n", "\t", "\r", "　", "\xa0", "\x85", "\x1c", "a", "b", "'s", "'ll", "12", ".!", "é", "漢字", "🙂", "<|endoftext|>"]
    for _ in range(n):
        kind = r.random()
        if kind < 0.5:
            yield "".join(r.choice(plain) for _ in range(r.randrange(40)))
        elif kind < 0.8:
            yield "".join(r.choice("abcdeinrst") for _ in range(r.randrange(200)))
        else:
            yield "".join(chr(r.randrange(1, 0xD800)) for _ in range(40))


def test_transducer_equals_the_library_and_decodes_back():
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    own, back = Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), Decoder(RANKS)
    for text in [*random_texts(2000), "ab" * 100_000, "", " "]:
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert back.decode(ids) == text


def test_transducer_forgets_without_changing_results():
    small, large = MergeTransducer(RANKS, limit=50), MergeTransducer(RANKS)
    for text in random_texts(300, seed=9):
        assert small.encode(text.encode()) == large.encode(text.encode())


def own_words(r, n):
    parts = "the and ing er re in on an en ti st es or te of ed is it al ar to nt ou ha se".split()
    return " ".join("".join(r.choices(parts, k=r.randrange(2, 7))) for _ in range(n))


def test_rare_words_of_known_parts_take_little_more_than_the_library():
    """Words met once, as most are in a large corpus: their moves are known, so no word should cost a search of its own."""
    library, r = Tokenizer.from_file(VOCABULARY), random.Random(8)
    own = Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    own.encode_all([own_words(r, 500) for _ in range(1000)])
    texts = [own_words(r, 500) for _ in range(1000)]
    (ids, ends), took = spent(lambda: own.encode_all(texts))
    expected, most = spent(lambda: [library.encode(t, add_special_tokens=False).ids for t in texts])
    assert ends.tolist() == np.cumsum([len(x) for x in expected]).tolist()
    assert ids.tolist() == [i for x in expected for i in x]
    assert took < 1.3 * most


def test_blocks_segments_and_slices_do_not_change_ids(monkeypatch):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    r = random.Random(12)
    texts = [*random_texts(400, seed=21), "", " ", "a", " a", "a ", "a b \n", "a b\u3000", "\x1c a\x1c b", "é" * 400 + " b c", own_words(r, 300)]
    texts += ["x" * 5000 + " y " + "ab" * 200 + "\n z", "a b", "a b", " \n a  b"]
    expected = [library.encode_ordinary(t) for t in texts]
    for chars, size, abreast, limit in ((4_000_000, 1 << 18, 256, 600_000), (1, 8, 4, 40), (50, 64, 12, 500)):
        monkeypatch.setattr(transducer, "BLOCK_CHARS", chars)
        monkeypatch.setattr(transducer, "SLICE_BYTES", size)
        monkeypatch.setattr(transducer, "ABREAST", abreast)
        monkeypatch.setattr(transducer, "MEMO_ENTRIES", limit)
        ids, ends = Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).encode_all(texts)
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == expected
    ids, ends = Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).encode_all([])
    assert len(ids) == len(ends) == 0


def test_own_ranks_and_patterns_that_leave_out_characters(tmp_path):
    """``abcd`` is a token that no merges reach, so only a whole piece is it; the pattern knows lower-case letters alone."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"ab": 257, b"abcd": 258, b" ab": 259}
    (tmp_path / "own").write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for t, i in ranks.items()))
    texts = ["abcd abcde", "xabcd ab abcd", "é ab1 2 cab 3", "1 2 3", "ab abc ab", ""]
    for pattern in (r" ?[a-z]+", public_tokenizers.PATTERN):
        library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        own = Encoder(str(tmp_path / "own"), pattern)
        assert [own.encode(t) for t in texts] == [library.encode_ordinary(t) for t in texts]
        ids, ends = own.encode_all(texts)
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == [library.encode_ordinary(t) for t in texts]


def test_moves_are_found_again_in_the_table():
    table, r, known = transducer.MoveTable(2), random.Random(2), {}
    for _ in range(60):
        new = {r.randrange(1 << 40): r.randrange(1 << 50) for _ in range(r.randrange(40))}
        new = {k: v for k, v in new.items() if k not in known}
        table.put(np.array([*new], np.int64), np.array([*new.values()], np.int64))
        known |= new
        asked = [*known, *(r.randrange(1 << 40) for _ in range(50))]
        assert table.get(np.array(asked, np.int64)).tolist() == [known.get(k, -1) for k in asked]


def test_neighbours_follow_the_definition():
    table, r = MergeTransducer(RANKS), random.Random(3)
    for _ in range(2000):
        a, b = r.randrange(50_000), r.randrange(50_000)
        wanted = merge_bytes(table.bytes_of[a] + table.bytes_of[b], RANKS) == [a, b]
        assert table.may_follow(a, b) == wanted


def test_utf8_machine_equals_the_codec():
    r = random.Random(4)
    for _ in range(3000):
        data = bytes(r.choice([65, 0x80, 0xBF, 0xC2, 0xE0, 0xA0, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xFF]) for _ in range(8))
        out, pending = "", b""
        for byte in data:
            text, pending = utf8_step(pending, byte)
            out += text
        assert out + "�" * bool(pending) == data.decode(errors="replace")


def test_counts_equal_the_library():
    library = Tokenizer.from_file(VOCABULARY)
    texts = [*random_texts(2000), "<|endoftext|>", "a<|endoftext|> b", "", "aaaaaaaaaaaa" * 5000]
    wanted = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert Counter(VOCABULARY, public_tokenizers.PATTERN).count(texts) == wanted


def test_columns_null_empty_repeated_and_clashing(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "a b", "z"), (3, "a b", "z"), (None, "é", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = decode(encode(docs)).collect()
    assert [r.decoded for r in out] == ["", "", "a b", "a b", "é"]
    assert [len(r.ids) for r in out][:2] == [0, 0]
    counted = count_tokens(docs.withColumnRenamed("ids", "n_tokens")).collect()
    assert [r.n_tokens for r in counted] == [len(r.ids) for r in out]
    empty = docs.limit(0)
    assert encode(empty).count() == count_tokens(empty).count() == pack(cut_pieces(empty)).count() == 0


def test_pieces_hold_all_tokens(spark):
    texts = ["word " * 5000, "", None, "<|endoftext|> a", "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = Tokenizer.from_file(VOCABULARY)
    rows = cut_pieces(docs, with_ids=True).orderBy("doc_id", "piece").collect()
    for doc, text in enumerate(texts):
        own = [r for r in rows if r.doc_id == doc]
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert b"".join(bytes(r.ids) for r in own) == ids.tobytes()
        assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own]]).tolist()[:-1]
        assert all(r.length == 2048 for r in own[1:])
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in own)


def test_bound_and_best_fit():
    assert lower_bound(np.array([6, 6, 6, 4]), 10) == 3
    assert best_fit_decreasing(np.array([6, 4, 5, 5, 10]), 10).max() == 2
    r = np.random.default_rng(1)
    for _ in range(200):
        sizes = r.integers(1, 101, r.integers(1, 60))
        used = best_fit_decreasing(sizes, 100).max() + 1
        assert lower_bound(sizes, 100) <= used <= 1.3 * lower_bound(sizes, 100) + 1


def test_packing_is_gapless_and_near_its_bound(spark, monkeypatch):
    monkeypatch.setattr("peopleflow.llm.packing.TASK_PIECES", 300)
    sizes = np.random.default_rng(2).integers(1, 2049, 2000)
    pieces = spark.createDataFrame([(int(i), int(s), "c") for i, s in enumerate(sizes)], "doc_id long, length long, offset string")
    rows = pack(pieces).collect()
    assert sorted(r.doc_id for r in rows) == list(range(2000))
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048
    assert len(ends) <= 1.01 * lower_bound(sizes, 2048) + 1


def test_packing_goes_on_until_a_round_saves_nothing(spark, monkeypatch):
    """Many small tasks: more than three rounds save something; what is left above the bounds is told."""
    turns = []
    staged = packing.stage
    monkeypatch.setattr(packing, "stage", lambda df, label: turns.append(label) or staged(df, label))
    monkeypatch.setattr(packing, "TASK_PIECES", 30)
    sizes = np.random.default_rng(4).integers(600, 1100, 3000)
    pieces = spark.createDataFrame([(int(i), int(s), "x") for i, s in enumerate(sizes)], "doc_id long, length long, gap string")
    rows = pack(pieces).collect()
    used = len({r.sequence_id for r in rows})
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert len(rows) == 3000 and max(ends.values()) <= 2048
    assert turns.count("packed") > 4  # the first packing and more than three rounds
    assert all(r.gap >= 0 for r in rows)
    alone = pack(pieces.limit(10)).collect()  # a single task
    own = np.array([r.length for r in alone])
    assert {r.gap for r in alone} == {len({r.sequence_id for r in alone}) - lower_bound(own, 2048)}
    assert used <= 1.15 * lower_bound(sizes, 2048)


def test_repeated_rows_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_PIECES", 50)
    rows = pack(spark.range(600).selectExpr("1 AS doc_id", "CAST(700 AS bigint) AS length")).collect()
    assert 300 <= len({r.sequence_id for r in rows}) <= 306 and len({r.sequence_id // packing.SEQUENCES for r in rows}) > 6


def test_query_gives_pieces_and_places_of_the_library(spark):
    folder = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(VOCABULARY)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    expected, places = [], {}
    for doc, text in texts.items():
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [0], "<u4")
        over = len(ids) % 2048
        borders = sorted({0, *range(over, len(ids) + 1, 2048)})
        for k, (a, b) in enumerate(zip(borders, borders[1:])):
            expected.append((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    rows = packing.op6_best_fit_packing(spark, folder).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == places.get(r.sequence_id, 0)
        places[r.sequence_id] = r.offset + r.length
    assert max(places.values()) <= 2048
    assert len(places) <= 1.02 * lower_bound(np.array([x[3] for x in expected]), 2048) + 1


def test_ids_equal_the_library_on_odd_texts():
    library, own = Tokenizer.from_file(VOCABULARY), packing.IdBytes(VOCABULARY)
    r = np.random.default_rng(4)
    bits = [" ", "  ", "\n", "\t", "a", "The", "don't", "'ll", "éß", "漢字", "🎉", "123", "!!", "\u00a0", "x" * 70, "<|endoftext|>", "\x00"]
    texts = ["".join(r.choice(bits, r.integers(0, 12), p=[0.3] + [0.7 / 16] * 16)) for _ in range(3000)]
    for at in range(0, 3000, 500):
        part = texts[at : at + 500]
        expected = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in part]
        assert own.encode(part) == expected


def spent(run):
    began = time.process_time()
    return run(), time.process_time() - began


def test_ids_of_words_met_once_take_less_than_the_library():
    """Most of a large corpus' words are rare, so remembering them does not help."""
    library, r = Tokenizer.from_file(VOCABULARY), random.Random(6)
    texts = [" ".join(f"{r.getrandbits(40):x}" for _ in range(2000)) for _ in range(200)]
    own = packing.IdBytes(VOCABULARY)
    ids, took = spent(lambda: own.encode(texts))
    expected, most = spent(lambda: [library.encode(t, add_special_tokens=False).ids for t in texts])
    assert ids == [np.array(x, "<u4").tobytes() for x in expected]
    assert took < 0.6 * most


def test_ids_of_endless_blanks_equal_the_library():
    library, own = Tokenizer.from_file(VOCABULARY), packing.IdBytes(VOCABULARY)
    texts = [" " * 4094, "a" + " " * 4094 + "b", "\n" * 9000 + "x", "x" * 1500 + "\u3000" * 5000, " " * 3_000_000 + "x"]
    assert own.encode(texts) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_a_vocabulary_whose_merges_are_no_ranks_is_left_to_the_library(tmp_path):
    """``abc`` is a token, but b and c join first, and then nothing joins a to bc."""
    vocab = {c: i for i, c in enumerate(byte_alphabet())} | {"bc": 256, "ab": 257, "abc": 258}
    library = Tokenizer(models.BPE(vocab, [("b", "c"), ("a", "b"), ("ab", "c")]))
    library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    library.save(path := str(tmp_path / "own.json"))
    texts = ["abc", "aabcc ab", "", "é abc\n"]
    expected = [np.array(library.encode(t).ids, "<u4").tobytes() for t in texts]
    assert packing.as_ranks(path) is None and packing.as_ranks(VOCABULARY)
    assert packing.IdBytes(path).encode(texts) == expected


def test_lengths_out_of_range_are_an_error(spark):
    with pytest.raises(Exception, match="lengths must be"):
        pack(spark.createDataFrame([(1, 4000)], "doc_id long, length long")).collect()


def test_queries_give_the_digests_of_the_library(spark):
    from peopleflow.llm.bpe import op1_bpe_round_trip

    folder = "/root/testdata/sf0.001"
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op1_bpe_round_trip(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = " ".join(map(str, library.encode_ordinary(texts[r.doc_id])))
        assert r.ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_one_pass_equals_encode_and_decode(spark):
    from peopleflow.llm.bpe import round_trip

    texts = [*random_texts(200), None, "", "x" * 100_000, "same", "same"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    both = {r.doc_id: (r.ids, r.decoded) for r in round_trip(docs).collect()}
    apart = {r.doc_id: (r.ids, r.decoded) for r in decode(encode(docs)).collect()}
    assert both == apart and all(both[k][1] == (t or "") for k, t in enumerate(texts))
    assert round_trip(docs.limit(0)).count() == 0
