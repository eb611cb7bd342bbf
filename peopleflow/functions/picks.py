"""Reproducible draws: a value depends on (seed, id) only, never on order or partitioning.

SQL expression text rather than columns: a list of constants is then one expression to parse,
not one call per constant.
"""

from __future__ import annotations

DRAWS_PER_DIGEST = 4  # an md5 text is 32 hex digits, a draw takes 8 of them


def digest(seed: int, number: int, key: str) -> str:
    """The ``number``-th md5 text of one id."""
    return f"md5(concat('{seed}|{number}|', cast({key} AS string)))"


def draw(digest_column: str, slot: int) -> str:
    """One of the digest's four unsigned 32-bit numbers."""
    return f"cast(conv(substring({digest_column}, {8 * slot + 1}, 8), 16, 10) AS bigint)"


def choose(values: list[str], number: str) -> str:
    """The entry of a constant list that a draw falls on."""
    entries = ", ".join("'" + value.replace("'", "\\'") + "'" for value in values)
    return f"get(array({entries}), cast({number} % {len(values)} AS int))"
