"""Exact substring dedup of bytes by prefix doubling over anchored suffixes.

Two suffixes are compared by (position, rank) pairs at growing lengths, ranked
again each round until a rank is unique or the length passes the threshold of
``WINDOW`` bytes. Ranking every byte position of the corpus would move many
times its size each round, so the rounds run on suffixes at anchors: every
window of ``WINDOW`` bytes keeps the leftmost least-named ``GRAM``-byte string
in it, about one position in ``WINDOW - GRAM`` / 2. Equal windows keep equal
anchors, so no repeat is lost (``basketry.llm.repeats`` has the rounds: ranks
at 73, 169, 193 and 200 bytes, with the exact window starts in the last).

Texts are UTF-8 bytes, matches never cross documents, and repeats inside one
document count. Null texts are empty. Repeated rows repeat each other: of
such, every window goes. Ids need not be unique or present.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import repeats, tokens
from basketry.llm.common import Workspace, map_rows, ship_package

WINDOW, GRAM = 200, 73
SPAN = WINDOW - GRAM + 1      # anchors a window chooses from
BLOCKS = (32, 8, 1)           # windows a row in later rounds
SEGMENT = 1 << 18             # bytes looked at together; window starts are dealt to segments
_LOW = np.uint64((1 << 20) - 1)


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window, gram names) of the runs of windows in a buffer
    of texts that end at ``ends`` (ascending); windows stay inside a text."""
    n = len(data)
    if n < WINDOW:
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),)
    sums = tokens.running(data)
    grams = tokens.mix((sums[GRAM:] - sums[:-GRAM]) * tokens._UP.upto(n - GRAM + 1))
    least = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)  # equal grams: the leftmost
    width = 1
    while width < SPAN:
        step = min(width, SPAN - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    chosen = (least & _LOW).astype(np.int64)
    inside = np.zeros(len(chosen) + 1, dtype=np.int32)
    begins = np.concatenate([[0], ends[:-1]])
    long_enough = ends - begins >= WINDOW
    np.add.at(inside, begins[long_enough], 1)
    np.add.at(inside, ends[long_enough] - WINDOW + 1, -1)
    valid = np.cumsum(inside[:-1]) > 0
    new = np.empty(len(chosen), dtype=bool)
    new[0] = True
    new[1:] = (chosen[1:] != chosen[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(chosen)]]) - 1
    ok = valid[first]
    first, last = first[ok], last[ok]
    at = chosen[first]
    return at, first, last, grams[at]


def first_rows(texts: DataFrame) -> DataFrame:
    """First-round rows of ``texts`` (``doc``, ``text``)."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                docs = part.column(0).to_pylist()
                data = [(t or "").encode("utf-8", "replace") for t in part.column(1).to_pylist()]
                for out in rows_of(docs, data):
                    yield out

    ship_package(texts.sparkSession)
    return texts.select("doc", "text").mapInArrow(run, repeats.FIRST)


def rows_of(docs: list[int], data: list[bytes]) -> Iterator[pa.RecordBatch]:
    pieces, owners, offsets, size = [], [], [], 0
    for doc, text in zip(docs, data):
        for at in range(0, max(len(text) - WINDOW + 1, 0), SEGMENT):
            piece = text[at:at + SEGMENT + WINDOW - 1]
            if pieces and size + len(piece) > SEGMENT:
                yield buffer_rows(pieces, owners, offsets)
                pieces, owners, offsets, size = [], [], [], 0
            pieces.append(piece)
            owners.append(doc)
            offsets.append(at)
            size += len(piece)
    if pieces:
        yield buffer_rows(pieces, owners, offsets)


def buffer_rows(pieces: list[bytes], owners: list[int], offsets: list[int]) -> pa.RecordBatch:
    joined = b"".join(pieces)
    ends = np.cumsum([len(p) for p in pieces])
    at, first, last, core = anchors(np.frombuffer(joined, dtype=np.uint8), ends)
    piece = np.searchsorted(ends, at, side="right")
    begin = ends - np.array([len(p) for p in pieces])
    lo, hi = at - last, at - first
    digest, view = xxhash.xxh3_64_intdigest, memoryview(joined)
    hull = [digest(view[s:e], seed) for s, e, seed in
            zip(first.tolist(), (last + WINDOW).tolist(), (1 + lo * 1024 + hi).tolist())]
    doc = np.array(owners, dtype=np.int64)[piece]
    place = at - begin[piece] + np.array(offsets, dtype=np.int64)[piece]
    return pa.RecordBatch.from_arrays(
        [pa.array(core.view(np.int64)), pa.array(repeats.signed(hull)), pa.array(doc), pa.array(np.zeros(len(doc), dtype=np.int64)),
         pa.array(place), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(np.zeros(len(doc), dtype=np.int32))],
        names=["core", "hull", "doc", "rank", "at", "lo", "hi", "tail"])


def _cut(text):
    data = text.encode("utf-8", "replace")
    return lambda s, e: data[s:e]


def repeated_bytes(df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, doc_id, text, starts, stops``: every row of ``df`` with the byte
    stretches that repeated windows cover."""
    texts = df.select(F.xxhash64(id_col, text_col).alias("doc"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    spans = repeats.repeated_spans(first_rows(texts), texts.select("doc", "text"), work, WINDOW, BLOCKS,
                                   False, _cut, lambda c: (c, 1))
    return repeats.with_spans(texts, spans)


def remove_repeats(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id, kept (binary), n_bytes, n_removed, n_spans`` per row of
    ``repeated_bytes``."""
    def make():
        def step(ids, texts, starts, stops):
            kept, n, gone, spans = [], [], [], []
            for text, ss, es in zip(texts, starts, stops):
                data = (text or "").encode("utf-8", "replace")
                runs = repeats.merged_runs(ss or [], es or [])
                out, at = [], 0
                for s, e in runs:
                    out.append(data[at:s])
                    at = e
                out.append(data[at:])
                kept.append(b"".join(out))
                n.append(len(data))
                gone.append(len(data) - len(kept[-1]))
                spans.append(len(runs))
            return [ids, kept, n, gone, spans]
        return step

    id_type = found.schema["doc_id"].dataType.simpleString()
    return map_rows(found, ["doc_id", "text", "starts", "stops"],
                    f"{id_col} {id_type}, kept binary, n_bytes long, n_removed long, n_spans long", make)
