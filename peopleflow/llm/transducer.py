"""Byte-pair merges compiled into a lazily determinised transducer, and an incremental decoder.

Encoding. The merges define one encoding for every byte string. A sequence of tokens is the
encoding of its bytes exactly when every token and every two neighbours encode to themselves. That
is a nondeterministic transducer: it guesses a token, walks the token's bytes in a trie, and may
start the next token only if the two may stand side by side. Determinised, a state is the set of
guesses that are still possible, and every move knows the last token of the encoding of what was
read. When a single guess is left, the tokens up to there are certain and are written. A wrong guess
dies within the length of the longest token. States and moves are made when first met. The distinct
pre-tokens of a block of texts move through the states abreast, a byte of each at a time; their
tokens are read from the ends back, as the last token at every byte is known.

Decoding. A state is the bytes of an unfinished character, at most three. A token moves the state
and writes the characters it completes; transitions are made when first met.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from peopleflow.llm.common import MEMO_ENTRIES, Memo, held_for
from peopleflow.llm.pretokens import chunks, read_ranks, segments, splitter

ROOT = 0

#: Bytes of the longest pre-token that moves abreast with others; longer ones move by themselves.
ABREAST = 256

#: Characters of a block of texts, and bytes of the pre-tokens that move before the states' number is looked at.
BLOCK_CHARS, SLICE_BYTES = 4_000_000, 1 << 18

#: Bits of a token's number.
TOKEN = 24
LAST = (1 << TOKEN) - 1


def merge_bytes(piece: bytes, ranks: dict[bytes, int], above: int = 1 << 60) -> list[int]:
    """Byte-pair encoding of a short piece from its definition, by merges of ranks below ``above``."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], above), i) for i in range(len(parts) - 1))
        if rank >= above:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def taken(flat: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ragged rows, one after another in ``flat``, those asked for, in this order, and their ends."""
    sizes = np.diff(ends, prepend=0)[rows]
    out = np.cumsum(sizes)
    return flat[np.repeat(ends[rows] - out, sizes) + np.arange(out[-1] if len(out) else 0)], out


class MoveTable:
    """Numbers by number, none negative, in arrays with open addressing: many are looked up at a time."""

    def __init__(self, bits: int = 16, used: int = 0) -> None:
        self.bits, self.used = bits, used
        self.keys, self.values = np.full(1 << bits, -1), np.full(1 << bits, -1)

    def place(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is, or the free place where it would be."""
        at = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).view(np.int64)
        there = self.keys[at]
        off = np.flatnonzero((there != keys) & (there >= 0))
        while len(off):
            at[off] = at[off] + 1 & len(self.keys) - 1
            there = self.keys[at[off]]
            off = off[(there != keys[off]) & (there >= 0)]
        return at

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 for unknown keys."""
        return self.values[self.place(keys)]

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are not there yet, each once."""
        self.used += len(keys)
        if 2 * self.used > len(self.keys):
            known = self.keys >= 0
            keys, values = np.r_[self.keys[known], keys], np.r_[self.values[known], values]
            self.__init__((2 * len(keys)).bit_length(), len(keys))
        while len(keys):
            at = self.place(keys)
            self.keys[at] = keys
            lost = self.keys[at] != keys
            self.values[at[~lost]] = values[~lost]
            keys, values = keys[lost], values[lost]


class MergeTransducer:
    """The transducer of a table of ranks that holds all 256 single bytes."""

    def __init__(self, ranks: dict[bytes, int], limit: int = MEMO_ENTRIES) -> None:
        self.ranks, self.limit = ranks, limit
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.lengths = np.zeros(max(self.length) + 1, np.int64)
        self.lengths[[*self.length]] = [*self.length.values()]
        self.tokens, self.token_ranks = pa.array([*ranks], pa.binary()), np.array([*ranks.values(), -1])
        self.edges: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        nodes = 1
        for token, rank in ranks.items():
            node = ROOT
            for byte in token:
                below = self.edges.get(node << 8 | byte)
                if below is None:
                    below = self.edges[node << 8 | byte] = nodes
                    nodes += 1
                node = below
            self.token_at[node] = rank
        self.inner = {edge >> 8 for edge in self.edges}
        self.shift = nodes.bit_length()
        self.nodes = (1 << self.shift) - 1
        self.made_of: dict[int, tuple[int, int] | None] = {}
        self.pairs = Memo(limit)
        self.forget()

    def forget(self) -> None:
        """Drop all states made so far; they are made again when needed."""
        # A guess is the last token and a trie node in one number; token 0 stands for the start.
        self.states: list[tuple[int, ...]] = [(ROOT,)]
        self.numbers = {self.states[0]: 0}
        # A move in one number: the next state, the last token of the encoding, and whether one guess is left.
        # Those that pieces abreast have met are in the table, those of pieces by themselves in the dictionary.
        self.moves: dict[int, int] = {}
        self.table = MoveTable()

    def make_room(self) -> None:
        if len(self.moves) + self.table.used >= self.limit:
            self.forget()

    def halves(self, token: int) -> tuple[int, int] | None:
        """The last merge that makes a token; None for a byte and for a token no merges reach."""
        known = self.made_of.get(token, 0)
        if known == 0:
            text = self.bytes_of[token]
            parts = merge_bytes(text, self.ranks, above=token) if len(text) > 1 else []
            known = self.made_of[token] = tuple(parts) if len(parts) == 2 else None
        return known

    def may_follow(self, before: int, token: int) -> bool:
        """Whether two tokens, or one at the start (``before`` -1), encode to themselves.

        Undo the merges next to the border, the latest first. If the two parts that then touch
        make a token of an earlier rank, they would have merged across the border. Of equal ranks
        the left one merges first.
        """
        key = before << 32 | token
        known = self.pairs.get(key)
        if known is None:
            known = self.length[token] == 1 or self.halves(token) is not None
            left, right, limit = before, token, 1 << 60
            while known and before >= 0:
                if self.ranks.get(self.bytes_of[left] + self.bytes_of[right], 1 << 60) < limit:
                    known = False
                elif left > right and (parts := self.halves(left)):
                    left, limit = parts[1], left
                elif parts := self.halves(right):
                    right, limit = parts[0], right + 1
                elif parts := self.halves(left):
                    left, limit = parts[1], left
                else:
                    break
            self.pairs.put(key, known)
        return known

    def move(self, state: int, byte: int) -> int:
        """The next state, the last token of the encoding so far, and whether one guess is left, packed."""
        last, guesses = -1, []
        for guess in self.states[state]:
            node = guess & self.nodes
            below = self.edges.get(node << 8 | byte)
            if below is None:
                continue
            if below in self.inner:
                guesses.append(guess - node + below)
            if last < 0:
                token = self.token_at.get(below)
                if token is not None and self.may_follow((guess >> self.shift) - 1, token):
                    last = token
        guesses.append(last + 1 << self.shift)
        left = tuple(guesses)
        number = self.numbers.get(left)
        if number is None:
            number = self.numbers[left] = len(self.states)
            self.states.append(left)
        return number << TOKEN + 1 | last << 1 | (len(left) == 1)

    def encode(self, piece: bytes) -> list[int]:
        """The tokens of one pre-token. A piece that is a token itself is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        self.make_room()
        out: list[int] = []
        waiting: list[int] = []
        state, known = 0, self.moves.get
        for byte in piece:
            step = known(state << 8 | byte)
            if step is None:
                step = self.moves[state << 8 | byte] = self.move(state, byte)
            state = step >> TOKEN + 1
            waiting.append(step >> 1 & LAST)
            if step & 1:
                self.write(waiting, out)
                waiting.clear()
        self.write(waiting, out)
        return out

    def encode_many(self, pieces: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of many pre-tokens, one after another, and where each one's end."""
        # The place among the tokens, the last one if it is none of them.
        at = pc.index_in(pieces, self.tokens).fill_null(len(self.tokens))
        tokens = self.token_ranks[at.to_numpy()]
        counts, others = np.ones(len(pieces), np.int64), np.flatnonzero(tokens < 0)
        array = pieces.take(pa.array(others)).cast(pa.large_binary())
        borders = np.frombuffer(array.buffers()[1], np.int64)[: len(array) + 1]
        data = np.frombuffer(array.buffers()[2] or b"", np.uint8)
        starts, sizes = borders[:-1], np.diff(borders)
        order = np.argsort(-sizes, kind="stable")
        long, short = np.split(order, [np.count_nonzero(sizes > ABREAST)])
        alone = [(row, self.encode(data[borders[row] : borders[row + 1]].tobytes())) for row in long.tolist()]
        last = np.empty(len(data), np.int32)
        slices = np.cumsum(sizes[short]) // SLICE_BYTES
        for part in np.split(short, np.flatnonzero(np.diff(slices)) + 1):
            self.read_abreast(data, starts[part], sizes[part], last)
        # From the ends back: the last token of what was read up to a byte tells where the one before ends.
        found, at = [], starts[short] + sizes[short] - 1
        while len(short):
            token = last[at]
            found.append((short, token))
            at = at - self.lengths[token]
            left = at >= starts[short]
            short, at = short[left], at[left]
        counts[others] = 0
        for rows, _ in found:
            counts[others[rows]] += 1
        for row, ids in alone:
            counts[others[row]] = len(ids)
        ends = np.cumsum(counts)
        out = np.empty(counts.sum(), np.int32)
        out[ends[tokens >= 0] - 1] = tokens[tokens >= 0]
        for k, (rows, token) in enumerate(found):
            out[ends[others[rows]] - 1 - k] = token
        for row, ids in alone:
            out[ends[others[row]] - len(ids) : ends[others[row]]] = ids
        return out, ends

    def read_abreast(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, last: np.ndarray) -> None:
        """Write at every byte of some pieces, the longest first, the last token of what was read up to there."""
        self.make_room()
        state = np.zeros(len(starts), np.int64)
        for k in range(sizes[0] if len(sizes) else 0):
            at = starts[: np.searchsorted(-sizes, -k)] + k
            keys = state[: len(at)] << 8 | data[at]
            steps = self.table.get(keys)
            unmet = np.flatnonzero(steps < 0)
            if len(unmet):
                new, where = np.unique(keys[unmet], return_inverse=True)
                made = np.array([self.move(key >> 8, key & 255) for key in new.tolist()])
                self.table.put(new, made)
                steps[unmet] = made[where]
            last[at] = steps >> 1 & LAST
            state[: len(at)] = steps >> TOKEN + 1

    def write(self, waiting: list[int], out: list[int]) -> None:
        """Append the tokens of the bytes read since the last certain border."""
        found, end = [], len(waiting)
        while end > 0:
            found.append(waiting[end - 1])
            end -= self.length[found[-1]]
        out.extend(reversed(found))


class Encoder:
    """Whole texts to ids: chunks, pre-tokens, then the transducer, a block of texts at a time."""

    def __init__(self, path: str, pattern: str) -> None:
        self.transducer = MergeTransducer(read_ranks(path), MEMO_ENTRIES)
        self.split = splitter(pattern)

    def split_words(self, words: pa.StringArray) -> tuple[list[str], np.ndarray]:
        """The pre-tokens of chunks from between two cuts, and where each chunk's end.

        Joined by spaces they have cuts between them again, so they are split as one text.
        """
        if not len(words):
            return [], np.empty(0, np.int64)
        text = " " + pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ")[0].as_py()
        pieces = self.split(text)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        borders = np.cumsum(pc.utf8_length(words).to_numpy() + 1, dtype=np.int64)
        found = np.searchsorted(ends, borders)
        if len(ends) and ends[-1] == len(text) and (ends[found] == borders).all():
            return pieces, found + 1
        # The pattern leaves out characters, so it is not known where chunks end.
        split = [self.split(" " + word) for word in words.to_pylist()]
        return list(chain.from_iterable(split)), np.cumsum([len(found) for found in split])

    def encode_block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts, one after another, and where each one's end; equal chunks are encoded once.

        Chunks from between two cuts are numbered from 0, after them come the first and the last of every text.
        """
        cut = [chunks(text) for text in texts]
        words = pa.array(list(chain.from_iterable(parts[1:-1] for parts in cut)), pa.string()).dictionary_encode()
        pieces, ends = self.split_words(words.dictionary)
        outer = chain.from_iterable((parts[0], " " + parts[-1] if len(parts) > 1 else "") for parts in cut)
        outer = list(map(self.split, outer))
        ends = np.r_[ends, len(pieces) + np.cumsum([len(found) for found in outer])]
        known = pa.array([*pieces, *chain.from_iterable(outer)], pa.string()).dictionary_encode()
        ids, borders = taken(*self.transducer.encode_many(known.dictionary.cast(pa.binary())), known.indices.to_numpy())
        stand = np.cumsum([max(2, len(parts)) for parts in cut])
        at = np.insert(stand[:-1], 0, 0)
        inner = np.ones(stand[-1], bool)
        inner[at] = inner[stand - 1] = False
        rows = np.empty(stand[-1], np.int64)
        rows[inner] = words.indices.to_numpy()
        rows[at], rows[stand - 1] = np.arange(len(words.dictionary), len(ends)).reshape(-1, 2).T
        ids, ends = taken(ids, np.r_[0, borders][ends], rows)
        return ids, ends[stand - 1]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each one's end."""
        found, counts = [np.empty(0, np.int32)], np.zeros(len(texts), np.int64)
        block, of, chars = [], [], 0
        for row, text in enumerate(texts):
            for part in segments(text, BLOCK_CHARS):
                block.append(part)
                of.append(row)
                chars += len(part)
                if chars >= BLOCK_CHARS:
                    self.add_block(block, of, found, counts)
                    block, of, chars = [], [], 0
        self.add_block(block, of, found, counts)
        return np.concatenate(found), np.cumsum(counts)

    def add_block(self, block: list[str], of: list[int], found: list[np.ndarray], counts: np.ndarray) -> None:
        if block:
            ids, ends = self.encode_block(block)
            found.append(ids)
            np.add.at(counts, of, np.diff(ends, prepend=0))

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()


def utf8_step(pending: bytes, byte: int) -> tuple[str, bytes]:
    """Feed one byte: the characters it completes and what stays unfinished.

    Bytes that cannot continue or start a character give U+FFFD, one for each longest prefix of a
    character.
    """
    if not pending:
        if byte < 0x80:
            return chr(byte), b""
        return ("", bytes([byte])) if 0xC2 <= byte <= 0xF4 else ("�", b"")
    lead = pending[0]
    low, high = 0x80, 0xBF
    if len(pending) == 1:
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, low)
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, high)
    if not low <= byte <= high:
        text, rest = utf8_step(b"", byte)
        return "�" + text, rest
    grown = pending + bytes([byte])
    length = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
    return (grown.decode(), b"") if len(grown) == length else ("", grown)


class Decoder:
    """Ids to text by the UTF-8 state machine, one transition for a token."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.moves: dict[tuple[bytes, int], tuple[str, bytes]] = {}
        #: Text of tokens that start and end between characters.
        self.plain = {t: x for t in self.bytes_of for x, left in [self.move(b"", t)] if not left}

    def move(self, pending: bytes, token: int) -> tuple[str, bytes]:
        step = self.moves.get((pending, token))
        if step is None:
            text, rest = [], pending
            for byte in self.bytes_of[token]:
                done, rest = utf8_step(rest, byte)
                text.append(done)
            step = self.moves[pending, token] = "".join(text), rest
        return step

    def decode(self, ids: list[int]) -> str:
        pieces = list(map(self.plain.get, ids))
        if None not in pieces:
            return "".join(pieces)
        out, pending = [], b""
        for token, plain in zip(ids, pieces):
            if plain is not None and not pending:
                out.append(plain)
            else:
                text, pending = self.move(pending, token)
                out.append(text)
        return "".join(out) + "�" * bool(pending)


def encoder(path: str, pattern: str) -> Encoder:
    return held_for("bpe", (path, pattern), lambda: Encoder(path, pattern))


def decoder(path: str) -> Decoder:
    return held_for("bpe", path, lambda: Decoder(read_ranks(path)))
