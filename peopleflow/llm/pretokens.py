"""Splitting text into independent chunks before byte-pair encoding.

The split pattern never joins a space that stands between two other characters to what precedes
it. So text may be cut before such spaces, and equal chunks always give equal pre-tokens. Chunks
are what the token operators memoise.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import regex

#: A single space between two characters that are no white space.
_CUT = re.compile(r" (?=\S)(?<!\s )")


def chunks(text: str) -> list[str]:
    """Cut before single inner spaces; all chunks but the first have lost their leading space."""
    return _CUT.split(text)


def segments(text: str, chars: int) -> Iterator[str]:
    """Parts of a text of at least so many characters but the last, cut before single inner spaces."""
    at = 0
    while len(text) - at > chars and (found := _CUT.search(text, at + chars)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


@lru_cache(maxsize=8)
def splitter(pattern: str):
    return regex.compile(pattern).findall


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks from a rank file: base64, space, number."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, for the
    characters from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
