"""Secret scans by assignment-aware lexing.

Texts are read as loose source or configuration syntax. Three base patterns
(password-like assignments, access keys, long hex runs) are matched first.
The lexer then parses every ``name = literal`` / ``name: literal`` pair it
meets (quoted keys, dotted names, chained string concatenation, references
to earlier names), propagates constants from name to name, and scores each
literal by how sensitive the names are that it reaches.

Work is one pass over the UTF-8 bytes of each text inside Arrow batches; no
shuffle, no state between documents; spans of both kinds are merged in their
order, so a long dump of assignments costs in proportion to its size. Null texts
count as empty; spans are code-point offsets with exclusive ends. Repeated rows
each get a result; an empty table gives an empty one; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import map_rows, ship_package

# The base patterns and their least lengths.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ASSIGN_STARTS = (b"password", b"passwd", b"secret", b"token", b"api")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "lexed")

# How strongly a part of a target name says that its value is secret.
NAME_WEIGHTS = {
    "password": 3.0, "passwd": 3.0, "passphrase": 3.0, "pwd": 2.5, "secret": 3.0, "token": 2.5, "apikey": 3.0,
    "credential": 2.5, "credentials": 2.5, "auth": 1.5, "bearer": 2.0, "private": 1.5, "access": 1.0, "key": 1.5,
    "signing": 1.0, "encryption": 1.0, "client": 0.5, "session": 0.5, "cookie": 1.0, "salt": 1.0, "license": 0.5,
}
SCORE_NEEDED = 4.0
_PHRASE = re.compile(rb"(?i)passw(or)?d|passphrase|pwd")  # names whose values may have spaces
_BUILT = 512
_NAME_BYTES = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-$")
_OPERATOR = re.compile(rb"[=:]")
_QUOTED = re.compile(rb'"((?:[^"\\\n]|\\.)*)"|\'((?:[^\'\\\n]|\\.)*)\'|`((?:[^`\\\n]|\\.)*)`')
_BARE = re.compile(rb"[A-Za-z0-9+/_.=~!@%^*-]+")
_IDENT = re.compile(rb"[A-Za-z_][A-Za-z0-9_.]*\Z")
_PART = re.compile(rb"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_PLACEHOLDER = re.compile(rb"(?i)\A(?:x+|\*+|\.+|changeme|change_me|example.*|your[_-].*|todo|none|null|true|false|\d{1,8})\Z")


class Span(NamedTuple):
    start: int
    end: int
    kind: str


def base_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind index) byte spans of the base patterns."""
    found = []
    lowered = data.lower()
    starts = []
    for word in ASSIGN_STARTS:
        at = lowered.find(word)
        while at >= 0:
            starts.append(at)
            at = lowered.find(word, at + 1)
    end = 0
    for at in sorted(starts):
        if at >= end and (m := ASSIGN.match(data, at)):
            end = m.end()
            if m.end(2) - m.start(2) >= MIN_ASSIGN:
                found.append((at, end, 0))
    if b"AKIA" in data:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(data) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(data)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def _name_before(data: bytes, at: int) -> bytes:
    """The identifier (maybe quoted) that ends just before the operator."""
    end = at
    while end and data[end - 1] == 0x20:
        end -= 1
    if end and data[end - 1] in b"\"'`]":
        end -= 1
        if end and data[end - 1] in b"\"'`":
            end -= 1
    start = end
    while start and data[start - 1] in _NAME_BYTES:
        start -= 1
    return data[start:end].strip(b"-.$")


class _Operand(NamedTuple):
    start: int
    end: int
    quoted: bool


def _operands(data: bytes, at: int) -> tuple[list[_Operand], int]:
    """Operands of the expression at ``at``: literals (inside their quotes) and
    bare words, joined by ``+``; a literal may also follow without one. With
    the end offset of the first operand, or of the literals that ``+`` joins to
    a first literal: what comes later is read again for pairs of its own."""
    out: list[_Operand] = []
    plus, plain, stop = True, True, at
    while True:
        while at < len(data) and data[at] in b" \t":
            at += 1
        if m := _QUOTED.match(data, at):
            g = m.lastindex
            out.append(_Operand(m.start(g), m.end(g), True))
            at = m.end()
        elif plus and (m := _BARE.match(data, at)) and (word := m.group().rstrip(b"+") if _QUOTED.match(data, m.end()) else m.group()):
            out.append(_Operand(at, at + len(word), False))  # a bare word may name a constant
            at += len(word)
        else:
            return out, stop
        if plain and (len(out) == 1 or plus and out[-1].quoted):
            stop = at
        plain = plain and plus and out[-1].quoted
        while at < len(data) and data[at] in b" \t":
            at += 1
        plus = at < len(data) and data[at] == 0x2B
        if plus:
            at += 1


def name_score(name: bytes) -> float:
    parts = [p.lower().decode() for p in _PART.findall(name)]
    joined = parts + [a + b for a, b in zip(parts, parts[1:])]
    return sum(NAME_WEIGHTS.get(p, 0.0) for p in joined)


def literal_score(value: bytes, name: bytes = b"") -> float:
    """Length, character classes and entropy speak for a secret; placeholders
    and templates against it, and so does prose, unless the name says that
    the value may be a phrase."""
    if len(value) < 6 or _PLACEHOLDER.match(value) or value[:1] in b"<{$":
        return -10.0
    if b" " in value and not _PHRASE.search(name):
        return -10.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in (rb"[a-z]", rb"[A-Z]", rb"[0-9]", rb"[^A-Za-z0-9 ]"))
    return 0.5 * (max(classes, 1) - 1) + 0.5 * max(0.0, entropy - 2.0) + (0.5 if n >= 12 else 0.0)


class _Constant:
    """What a name holds: its value and, as a graph that other constants may
    share, the spans of the literals it is made of."""

    def __init__(self, spans: list[tuple[int, int]], parts: list["_Constant"], value: bytes):
        self.spans, self.parts, self.value, self.found = spans, parts, value, False

    def report(self, found: set[tuple[int, int]]) -> None:
        todo = [self]
        while todo:
            one = todo.pop()
            if not one.found:
                one.found = True
                found.update(one.spans)
                todo += one.parts


def lexed_spans(data: bytes) -> list[tuple[int, int]]:
    """Byte spans of literals that reach a sensitive name."""
    constants: dict[bytes, _Constant] = {}
    found = set()
    end = 0
    for m in _OPERATOR.finditer(data):
        at = m.start()
        if at < end:
            continue
        name = _name_before(data, at)
        if not name or name[:1].isdigit():
            continue
        after = m.end()
        while after < len(data) and data[after] in b"=:>~":
            after += 1
        operands, stop = _operands(data, after)
        if not operands:
            continue
        end = stop
        spans, parts, pieces, words = [], [], [], []
        for s, e, quoted in operands:
            piece = data[s:e]
            if quoted:
                spans.append((s, e))
            elif _IDENT.match(piece) and piece in constants:
                parts.append(constants[piece])
                piece = constants[piece].value
            else:
                words.append(_Constant([(s, e)], [], piece))  # no known name: a literal of its own
                continue
            pieces.append(piece)
        if pieces:
            value = b"".join(pieces)
            # values built from names may double with each line: their start speaks for them
            words.append(_Constant(spans, parts, value[:_BUILT] if parts and len(pieces) > 1 else value))
        constants[name] = words[-1]
        score = name_score(name)
        for one in words if score > 0 else ():
            if score + literal_score(one.value, name) >= SCORE_NEEDED:
                one.report(found)
    return sorted(found)


def outside(found: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of ``found`` that no base span covers, in one merge: both are sorted
    by start, so the furthest end of the base spans begun so far decides."""
    out, at, furthest = [], 0, -1
    for s, e in found:
        while at < len(base) and base[at][0] <= s:
            furthest = max(furthest, base[at][1])
            at += 1
        if e > furthest:
            out.append((s, e))
    return out


def scan_text(text: str | None) -> list[Span]:
    """All spans of a text, by start, then kind in the order of ``KINDS``."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    base = base_spans(data)
    extra = [(s, e, 3) for s, e in outside(lexed_spans(data), base)]
    spans = sorted(base + extra, key=lambda s: (s[0], s[2]))
    if not spans:
        return []
    if data.isascii():
        return [Span(s, e, KINDS[k]) for s, e, k in spans]
    points = {}
    last, seen = 0, 0
    for at in sorted({p for s, e, _ in spans for p in (s, e)}):
        seen += len(data[last:at].decode("utf-8", "replace"))
        points[at], last = seen, at
    return [Span(points[s], points[e], KINDS[k]) for s, e, k in spans]


def render(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def scan_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, count per base kind, digest of the base
    spans, and all spans. Other columns of ``df`` are ignored."""
    def make():
        def step(ids, texts):
            out = [[] for _ in range(6)]
            for text in texts:
                spans = scan_text(text)
                base = [s for s in spans if s.kind != "lexed"]
                counts = Counter(s.kind for s in base)
                row = (counts["assign"], counts["access"], counts["hex"],
                       hashlib.sha256(render(base).encode()).hexdigest(), render(spans), len(spans) - len(base))
                for col, v in zip(out, row):
                    col.append(v)
            return [ids, *out]
        return step

    id_type = df.schema[id_col].dataType.simpleString()
    schema = (f"{id_col} {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, "
              "spans string, n_lexed long")
    return map_rows(df, [id_col, text_col], schema, make)


def redact_text(text: str | None) -> str | None:
    """The text with every found span replaced by ``[REDACTED]``; overlapping
    spans become one."""
    spans = scan_text(text)
    if not spans:
        return text
    out, at = [], 0
    for s, e, _ in spans:
        if s >= at:
            out += [text[at:s], "[REDACTED]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(df: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """``df`` with secrets replaced in its text (all other columns stay; the
    length column, if there is one, follows the new text)."""
    @F.pandas_udf(T.StringType())
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(redact_text)

    ship_package(df.sparkSession)
    out = df.withColumn(text_col, clean(F.col(text_col)))
    if n_chars_col in df.columns:
        out = out.withColumn(n_chars_col, F.length(text_col).cast(df.schema[n_chars_col].dataType))
    return out
