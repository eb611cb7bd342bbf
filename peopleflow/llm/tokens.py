"""Cutting blocks of texts into words with numpy, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are cut in one go; a longer text makes a block of its own.
BLOCK_BYTES = 2_000_000

#: What a byte is to a word: part of it, a gap between words, or a border that phrases do not cross.
PART, GAP, BORDER = 0, 1, 2

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def blocks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about BLOCK_BYTES of a column of bytes, none of it null."""
    if not batch.num_rows:
        return
    sizes = np.diff(np.frombuffer(batch.column(column).buffers()[1], np.int32)[batch.column(column).offset :])
    total, at = 0, 0
    for row, size in enumerate(sizes[: batch.num_rows].tolist()):
        if total and total + size > BLOCK_BYTES:
            yield batch.slice(at, row - at)
            total, at = 0, row
        total += size
    if at < batch.num_rows:
        yield batch.slice(at)


class Cut:
    """The words of some texts, A-Z in lower case.

    ``words`` are the words as an Arrow array of bytes, ``row`` the text of each, and ``piece`` a
    number that two words of a text share if no border stands between them. ``kinds`` tells what
    each byte is; a line break must not be part of a word, since texts are joined by it.
    """

    def __init__(self, texts: list[bytes], kinds: np.ndarray) -> None:
        data = np.frombuffer(b"\n".join(texts).translate(LOWER), np.uint8)
        kind = kinds[data]
        part = np.zeros(len(data) + 2, np.int8)
        part[1:-1] = kind == PART
        edges = np.diff(part)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        flat = data[part[1:-1] > 0]
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))]
        self.words = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.row = np.searchsorted(np.cumsum(sizes) - 1, starts, "right")
        self.piece = np.cumsum(kind == BORDER, dtype=np.int32)[starts] if len(starts) else starts

    def encoded(self) -> tuple[np.ndarray, pa.Array]:
        """For each word its number among the distinct words, and these."""
        found = self.words.dictionary_encode()
        return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def numbered(column: pa.Array) -> tuple[np.ndarray, list]:
    """For each row its number among the distinct values of a column, and these."""
    found = column.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.to_pylist()
