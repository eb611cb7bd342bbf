"""Secrets by patterns and by assignment-aware lexing (operator 4)."""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peopleflow.llm.common import add_columns, as_list, documents

MASK = "[SECRET]"

#: Kinds in the order in which findings that start together are listed.
KINDS = ("assign", "access", "hex", "literal")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

#: An assignment: not a comparison, and not the colon of an address.
_SIGN = re.compile(r":=|=>|(?<![=!<>:])=(?![=>~])|:(?![:/=])")
_TERM = re.compile(
    r"""(?:[rRbBfFuU]{0,2}(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)')|\$?\{?([^\W\d][\w.]*)\}?|([^\s"'#,;(){}\[\]]+))"""
)
_STRING = re.compile(r"""[rRbBfFuU]{0,2}["']""")
_BARE = re.compile(r"[^\s\"'#,;(){}\[\]+]*")
_BLANKS, _LINES = re.compile(r"[ \t]*"), re.compile(r"[ \t\r\n]*")
_PART_OF_NAME, _FIRST_OF_NAME = re.compile(r"[\w.-]"), re.compile(r"[^\W\d]")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

#: Points of name parts. A literal is reported from REPORT points on, its own among them.
NAME_POINTS = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "pass": 2, "secret": 3, "secrets": 3, "token": 3,
    "apikey": 3, "credential": 3, "credentials": 3, "auth": 2, "authorization": 3, "bearer": 3, "key": 1,
    "private": 1, "access": 1, "api": 1, "client": 1, "signing": 2, "encryption": 2, "salt": 2, "session": 1,
    "url": -2, "path": -3, "file": -3, "dir": -3, "name": -2, "id": -2, "type": -3, "length": -3, "count": -3,
    "size": -3, "field": -3, "label": -3, "policy": -3, "public": -3, "prompt": -3, "error": -3, "message": -3,
    "expiry": -3, "expires": -3, "limit": -3, "max": -3, "min": -3, "tokenizer": -3,
}
REPORT = 5

#: Characters at the beginning of a value that are kept for scoring.
HEAD = 32

_DUMMY_START = re.compile(r"(?i)your[_-]|\$\{|%\(|\{\{")
_DUMMY = re.compile(
    r"(?i)\A(?:change_?me|example|placeholder|dummy|none|null|nil|true|false|undefined|redacted|todo|x+|\*+|\.+"
    r"|your[_-].*|<.*>|\$\{.*|%\(.*|\{\{.*|test|password|secret|token)\Z"
)


class Value:
    """What a name stands for: literals of its own and values it shares with others, one after the other.

    Only what scoring needs is kept of the text, so values that are built from others over and over stay small.
    """

    def __init__(self) -> None:
        self.parts: list[tuple[int, int] | Value] = []
        self.length, self.head, self.last = 0, "", ""
        self.counts: Counter[str] = Counter()

    def add(self, text: str, start: int, end: int) -> None:
        self.parts.append((start, end))
        self._follow(len(text), text[:HEAD], text[-1:], Counter(text))

    def refer(self, other: Value) -> None:
        self.parts.append(other)
        self._follow(other.length, other.head, other.last, other.counts)

    def _follow(self, length: int, head: str, last: str, counts: Counter[str]) -> None:
        self.head = (self.head + head)[:HEAD] if self.length < HEAD else self.head
        self.length, self.last = self.length + length, last or self.last
        self.counts = self.counts + counts

    def spans(self, seen: set[int]):
        """Places of all its literals, but for those of values already ``seen``."""
        todo = [self]
        while todo:
            value = todo.pop()
            if id(value) not in seen:
                seen.add(id(value))
                yield from (p for p in value.parts if not isinstance(p, Value))
                todo.extend(p for p in value.parts if isinstance(p, Value))


def name_points(name: str) -> int:
    """How sensitive a target name is; the parts of camelCase and snake_case count."""
    return sum(NAME_POINTS.get(part.lower(), 0) for part in _PARTS.findall(name))


def is_dummy(value: Value) -> bool:
    """Whether a value is a placeholder; of a long one, its beginning, its end and its characters tell."""
    if value.length <= HEAD:
        return bool(_DUMMY.match(value.head))
    if set(value.counts) <= {"x", "X"} or set(value.counts) in ({"*"}, {"."}):
        return True
    bracketed = value.head.startswith("<") and value.last == ">"
    return "\n" not in value.counts and (bracketed or bool(_DUMMY_START.match(value.head)))


def literal_points(value: Value) -> int:
    """How much a value looks like a secret: long, of mixed characters, of high entropy, no dummy."""
    if value.length < 6 or is_dummy(value):
        return -9
    shares = [n / value.length for n in value.counts.values()]
    entropy = -sum(x * math.log2(x) for x in shares if x)
    found = "".join(value.counts)
    classes = sum(bool(re.search(c, found)) for c in (r"[a-z]", r"[A-Z]", r"[0-9]", r"[^\w\s]"))
    points = (value.length >= 8) + (value.length >= 20) + (classes >= 2) + (classes >= 3) + (entropy >= 3)
    return points - 3 * bool(re.search(r"\s", found)) - 2 * value.head.startswith(("/", "./", "http"))


def name_before(text: str, end: int) -> str:
    """The target of an assignment sign at ``end``: quoted or bare, of any length, on the same line."""
    while end and text[end - 1] in " \t]":
        end -= 1
    if end and text[end - 1] in "\"'":
        start = text.rfind(text[end - 1], text.rfind("\n", 0, end) + 1, end - 1)
        return text[start + 1 : end - 1] if start >= 0 else ""
    start = end
    while start and _PART_OF_NAME.match(text[start - 1]):
        start -= 1
    first = _FIRST_OF_NAME.search(text, start, end)
    return text[first.start() : end] if first else ""


def assigned(text: str):
    """Names and what is assigned to them, in order: ``(name, value)``.

    A value is one or more terms: quoted strings, bare words as in configuration files, and names. They are
    joined by ``+``, which a line break may follow, or stand as strings next to each other in
    brackets, over any number of lines. A name that was assigned before stands for its value
    (constant propagation).
    """
    constants: dict[str, Value] = {}
    for sign in _SIGN.finditer(text):
        name = name_before(text, sign.start())
        if not name:
            continue
        value, depth, at = Value(), 0, _BLANKS.match(text, sign.end()).end()
        while True:
            while text.startswith("(", at):
                depth, at = depth + 1, _LINES.match(text, at + 1).end()
            if not (term := _TERM.match(text, at)):
                break
            at, k = term.end(), term.lastindex
            if k in (1, 2):
                value.add(term[k], term.start(k), term.end(k))
            elif k == 3 and (known := constants.get(term[3].rpartition(".")[2])):
                value.refer(known)
            else:
                # A bare word goes on to the next white space or delimiter.
                at = _BARE.match(text, at).end()
                value.add(text[term.start(k) : at], term.start(k), at)
            at = (_LINES if depth else _BLANKS).match(text, at).end()
            while depth and text.startswith(")", at):
                depth -= 1
                at = (_LINES if depth else _BLANKS).match(text, at + 1).end()
            if text.startswith("+", at):
                at = _LINES.match(text, at + 1).end()
            elif not (depth and _STRING.match(text, at)):
                break
        if value.parts:
            constants[re.split(r"[.\-]", name)[-1]] = value
            yield name, value


def find_secrets(text: str) -> list[tuple[str, int, int, int, int]]:
    """Findings of a text, by start and then kind: ``kind, start, end, secret_start, secret_end``.

    Positions count code points, ends are exclusive. The whole match of a pattern is the finding;
    the secret is the part to hide.
    """
    found = set()
    for m in _ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 6:
            found.add((0, *m.span(), *m.span(2)))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                found.add((1, *m.span(), *m.span()))
    for m in _HEX.finditer(text):
        found.add((2, *m.span(), *m.span()))
    seen: set[int] = set()
    values = []  # kept, so that no two have one identity
    for name, value in assigned(text):
        values.append(value)
        points = name_points(name)
        if points > 0 and points + literal_points(value) >= REPORT:
            found |= {(3, a, b, a, b) for a, b in value.spans(seen) if a < b}
    return [(KINDS[k], *rest) for k, *rest in sorted(found, key=lambda x: (x[1], x[0], x[2]))]


def mask(text: str, findings) -> str:
    """A text with every secret replaced; secrets that overlap or touch become one."""
    out, at = [], 0
    merged: list[list[int]] = []
    for _, _, _, start, end in sorted(findings, key=lambda x: x[3:]):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out += [text[at:start], MASK]
        at = end
    return "".join(out) + text[at:]


_FINDING = "struct<kind:string,start:bigint,end:bigint,secret_start:bigint,secret_end:bigint>"


def scan(df: DataFrame, text: str = "text", findings: str = "findings", masked: str = "masked") -> DataFrame:
    """Add the findings of every row's whole text and the text with secrets hidden.

    Null and empty texts have no findings; the masked text of a null is null. Rows are independent.
    Columns with the added names are replaced.
    """
    kind = T.ArrayType(T._parse_datatype_string(_FINDING))
    names = ["kind", "start", "end", "secret_start", "secret_end"]
    arrow = pa.list_(pa.struct([(n, pa.string() if n == "kind" else pa.int64()) for n in names]))

    def make(columns):
        for column in columns:
            rows = [find_secrets(x) for x in as_list(column)]
            hidden = [
                mask(value, found) if found else value for value, found in zip(column.to_pylist(), rows)
            ]
            structs = [[dict(zip(names, x)) for x in found] for found in rows]
            yield [pa.array(structs, arrow), pa.array(hidden, pa.string())]

    return add_columns(df, text, [T.StructField(findings, kind), T.StructField(masked, T.StringType())], make)


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers and places of the secrets of every document."""
    found = scan(documents(spark, folder).select("doc_id", "text")).select("doc_id", "findings")

    def listed(findings):
        places = F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
        return F.array_join(places, ",")

    def number(kind):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in KINDS],
        F.sha2(listed(F.filter("findings", lambda x: x["kind"] != "literal")), 256).alias("base_sha256"),
        listed(F.col("findings")).alias("spans"),
    )
