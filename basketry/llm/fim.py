"""Fill-in-the-middle examples by content-defined chunk memoization.

A text's units are its words, each with the white space before it, and a
last run of white space. Two cuts at unit ends split a text into prefix,
middle and suffix.

1. Chunks: a rolling hash over the last ``WINDOW`` bytes cuts every text where
   its low bits are zero (never below ``MIN_CHUNK`` or above ``MAX_CHUNK``
   bytes), so passages that texts share come out as the same chunks.
2. Memo: a chunk's summary - unit ends inside it, code points, whether it begins
   with white space and ends inside a word - is kept by a hash of the chunk; a
   hit counts only if the kept bytes equal the chunk's. The memo of a worker is
   bounded by bytes.
3. Cuts: summaries of neighbours combine (a word that goes on into the next
   chunk ends there), their running counts name the chunk of a cut, and only
   that chunk is read again.

There is no shuffle and no state between tasks beyond the memo, whose content
never changes a result. Null texts count as empty; empty texts, texts holding a
mark and the share given by the draw stay plain; a null id draws as an empty one;
repeated rows each get the same result; an empty table gives an empty one. Very
long texts are chunked in slices, so that work and memory stay in proportion to
the text. Other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import re
from itertools import islice
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import map_rows, when_leaving

# Marks, seed and shares of the forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, FIM_SHARE, SPM_SHARE = 42, 50, 80

WINDOW, MIN_CHUNK, MAX_CHUNK, MASK = 32, 512, 16_384, (1 << 11) - 1
_SLICE = 1 << 22
_MEMO_BYTES = 32 << 20
_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_FACTOR = 0x9E3779B1
_GEAR = ((np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(29)).astype(np.uint32)


class Summary(NamedTuple):
    ends: int           # words that end inside the chunk, before its last byte's end
    chars: int
    opens_space: bool   # the first byte is white space
    in_word: bool       # the last byte belongs to a word


def rolling_candidates(data: bytes) -> np.ndarray:
    """Offsets after which the rolling hash of the last ``WINDOW`` bytes allows a cut."""
    found = []
    for lo in range(0, len(data), _SLICE):
        first = max(0, lo - WINDOW + 1)
        h = _GEAR[np.frombuffer(data, dtype=np.uint8, count=min(len(data), lo + _SLICE) - first, offset=first)]
        width, factor = 1, _FACTOR
        while width < WINDOW:  # the hash of twice the width from two halves
            wider = h.copy()
            wider[width:] += h[:-width] * np.uint32(factor)
            h, width, factor = wider, 2 * width, factor * factor & 0xFFFFFFFF
        at = np.flatnonzero((h >> np.uint32(16) & np.uint32(MASK)) == 0) + first + 1
        found.append(at[at > lo])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def chunk_ends(data: bytes) -> list[int]:
    """End offset of every chunk; the last is the end of the text."""
    ends, start = [], 0
    for at in rolling_candidates(data).tolist() if len(data) > MIN_CHUNK else ():
        while at - start > MAX_CHUNK:
            start += MAX_CHUNK
            ends.append(start)
        if at - start >= MIN_CHUNK:
            ends.append(at)
            start = at
    while len(data) - start > MAX_CHUNK:
        start += MAX_CHUNK
        ends.append(start)
    if start < len(data):
        ends.append(len(data))
    return ends


def summarize(chunk: bytes) -> Summary:
    in_word = chunk[-1] not in _SPACES
    codes = np.frombuffer(chunk, dtype=np.int8)
    return Summary(len(chunk.split()) - in_word, int((codes >= -64).sum()), chunk[0] in _SPACES, in_word)


class Memo:
    """Summaries by content: a hash finds the entry, equal bytes confirm it.
    When the kept chunks exceed ``limit`` bytes the memo starts anew."""

    def __init__(self, limit: int = _MEMO_BYTES):
        self.kept: dict[int, tuple[bytes, Summary]] = {}
        self.bytes, self.limit, self.hits = 0, limit, 0

    def clear(self) -> None:
        self.kept.clear()
        self.bytes = 0

    def summary(self, chunk: bytes) -> Summary:
        key = hash(chunk)
        entry = self.kept.get(key)
        if entry is not None and entry[0] == chunk:
            self.hits += 1
            return entry[1]
        made = summarize(chunk)
        if entry is None:
            if self.bytes + len(chunk) > self.limit:
                self.clear()
            self.kept[key] = (chunk, made)
            self.bytes += len(chunk)
        return made


class Units:
    """Unit ends of one text, held as running counts per chunk."""

    def __init__(self, data: bytes, memo: Memo):
        self.data, self.bounds = data, [0, *chunk_ends(data)]
        parts = [memo.summary(data[a:z]) for a, z in zip(self.bounds[:-1], self.bounds[1:])]
        self.counts, self.chars, inside = [0], [0], False
        self.carried = []  # the word of the chunk before ends where this one begins
        for p in parts:
            carried = inside and p.opens_space
            self.carried.append(carried)
            self.counts.append(self.counts[-1] + p.ends + carried)
            self.chars.append(self.chars[-1] + p.chars)
            inside = p.in_word
        # the last unit is a word that reaches the end, or the white space after the last word
        self.n = self.counts[-1] + bool(parts)

    def cut(self, unit: int) -> tuple[int, int]:
        """Byte and code-point offset of the end of the ``unit``-th unit."""
        if unit == 0:
            return 0, 0
        if unit == self.n:
            return len(self.data), self.chars[-1]
        i = int(np.searchsorted(self.counts, unit)) - 1
        start = self.bounds[i]
        nth = unit - self.counts[i] - self.carried[i]
        chunk = self.data[start:self.bounds[i + 1]]
        at = 0
        if nth:
            at = next(islice(_WORD.finditer(chunk), nth - 1, None)).end()
        inner = np.frombuffer(chunk, dtype=np.int8, count=at)
        return start + at, self.chars[i] + int((inner >= -64).sum())


class Example(NamedTuple):
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def make_example(data: bytes, draw: str, memo: Memo) -> Example:
    """The example of one text; ``draw`` is what the hash draws from."""
    units = Units(data, memo)
    digest = hashlib.sha256(f"{SEED}:{draw}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    if not data or h3 % 100 >= FIM_SHARE or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)):
        return Example(units.n, "plain", None, None, data)
    first, second = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    (a, a_chars), (b, b_chars) = units.cut(first), units.cut(second)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if h4 % 100 < SPM_SHARE:
        return Example(units.n, "spm", a_chars, b_chars - a_chars, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle)
    return Example(units.n, "psm", a_chars, b_chars - a_chars, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle)


def restore(output: bytes, form: str) -> bytes:
    """The text an example was made of."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE)
    if form == "spm":
        suffix, prefix = head[len(SUFFIX):].split(PREFIX)
    else:
        prefix, suffix = head[len(PREFIX):].split(SUFFIX)
    return prefix + middle + suffix


_MEMO = Memo()


def examples(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``id, n, form, prefix_chars, middle_chars, output``."""
    def make():
        when_leaving("fim", _MEMO.clear)

        def step(ids, texts):
            made = [make_example((t or "").encode("utf-8", "surrogatepass"), "" if i is None else str(i), _MEMO)
                    for i, t in zip(ids, texts)]
            return [ids, [m.n for m in made], [m.form for m in made], [m.prefix_chars for m in made],
                    [m.middle_chars for m in made], [m.output.decode("utf-8", "surrogatepass") for m in made]]
        return step

    id_type = df.schema[id_col].dataType.simpleString()
    return map_rows(df, [id_col, text_col],
                    f"{id_col} {id_type}, n long, form string, prefix_chars long, middle_chars long, output string", make,
                    rows_per_step=64, tables="fim")


def restored(made: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``examples`` read back with DataFrame functions: digests of the outputs
    and of the texts rebuilt from output and form alone."""
    out = F.col("output")

    def between(opening: bytes, closing: bytes | None = None):
        tail = F.substring_index(out, opening.decode(), -1)
        return F.substring_index(tail, closing.decode(), 1) if closing else tail

    text = (F.when(F.col("form") == "psm", F.concat(between(PREFIX, SUFFIX), between(MIDDLE), between(SUFFIX, MIDDLE)))
            .when(F.col("form") == "spm", F.concat(between(PREFIX, MIDDLE), between(MIDDLE), between(SUFFIX, PREFIX)))
            .otherwise(out))
    return made.select(id_col, "n", "form", "prefix_chars", "middle_chars", F.sha2(out.cast("binary"), 256).alias("output_sha256"),
                       F.sha2(text.cast("binary"), 256).alias("restored_sha256"))
