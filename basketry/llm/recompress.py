"""Repeated word windows by recompression.

A document's words are rewritten in rounds. First runs of one symbol become
one symbol, then every pair of a left-class symbol followed by a right-class
one does; a symbol's class in a round is a bit of its name. New symbols are
named by their content (the count and symbol of a run, the two symbols of a
pair), so names agree in the whole corpus without a shared dictionary and a
round needs no shuffle; Spark runs all rounds of a text in one task. Each
symbol carries the stretch of words that settles it: inside two equal texts,
symbols whose stretch lies inside are equal.

Every window of ``WINDOW`` words takes as anchor the least-named symbol of the
highest level whose stretch lies inside the window (at the lowest every word is
its own stretch, so there always is one). Equal windows so take equal anchors;
Spark groups the symbols and their windows over the corpus, compares whole
window stretches, and ends with exact word windows (``basketry.llm.repeats``).

A window repeats if its words also start in a document with a smaller id; ties
and null ids: a null id is smaller than any other, and rows with equal ids are
one document in this respect. Null texts and texts below ``WINDOW`` words keep
all words.
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

WINDOW, ROUNDS = 50, 4
BLOCKS = (8, 1)              # windows a row in later rounds
SEGMENT = 1 << 16            # words looked at together
_LOW = np.uint64((1 << 20) - 1)
_ONE = np.uint64(1)


class Symbols:
    """Symbols of a round: name, first word, stretch [lo, hi), document."""

    def __init__(self, name, at, lo, hi, text):
        self.name, self.at, self.lo, self.hi, self.text = name, at, lo, hi, text

    def __len__(self):
        return len(self.name)


def outer(s: Symbols, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretch of each symbol's neighbours: lo of the one before, hi of the one
    after; past the edges of a text, outside of it."""
    before, after = begins[s.text] - 1, ends[s.text] + 1
    same = s.text[1:] == s.text[:-1]
    lo, hi = before.copy(), after.copy()
    lo[1:][same] = s.lo[:-1][same]
    hi[:-1][same] = s.hi[1:][same]
    return lo, hi


def merge_runs(s: Symbols, begins: np.ndarray, ends: np.ndarray) -> Symbols:
    """Runs of one symbol become one; where a run ends is settled by its
    neighbours."""
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s.name[1:] != s.name[:-1]) | (s.text[1:] != s.text[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(s)]]) - 1
    lo, hi = outer(s, begins, ends)
    count = (last - first + 1).astype(np.uint64)
    name = np.where(count > _ONE, tokens.mix(s.name[first] + count * tokens._M1), s.name[first])
    return Symbols(name, s.at[first], lo[first], hi[last], s.text[first])


def merge_pairs(s: Symbols, begins: np.ndarray, ends: np.ndarray, turn: int) -> Symbols:
    """Left-class symbols join a right-class one that follows; a symbol that
    stays single is settled by the neighbour it would have joined."""
    salt = np.uint64(turn * int(tokens._M2) % (1 << 64))
    right = (tokens.mix(s.name + salt) >> np.uint64(40)) & _ONE == _ONE
    joins = np.zeros(len(s), dtype=bool)
    joins[:-1] = ~right[:-1] & right[1:] & (s.text[1:] == s.text[:-1])
    joined = np.zeros(len(s), dtype=bool)
    joined[1:] = joins[:-1]
    lo, hi = outer(s, begins, ends)
    single = ~joins & ~joined
    new_lo, new_hi = s.lo.copy(), s.hi.copy()
    take = single & right
    new_lo[take] = lo[take]
    take = single & ~right
    new_hi[take] = hi[take]
    pair = np.flatnonzero(joins)
    name = s.name.copy()
    name[pair] = tokens.mix((s.name[pair] ^ (s.name[pair + 1] >> np.uint64(7))) * tokens._M2 + s.name[pair + 1])
    new_hi[pair] = s.hi[pair + 1]
    keep = ~joined
    return Symbols(name[keep], s.at[keep], new_lo[keep], new_hi[keep], s.text[keep])


def parse(names: np.ndarray, text: np.ndarray, begins: np.ndarray, ends: np.ndarray, rounds: int = ROUNDS) -> list[Symbols]:
    """The words, then the symbols after each merging of runs and of pairs."""
    at = np.arange(len(names), dtype=np.int64)
    now = Symbols(names, at, at, at + 1, text)
    out = [now]
    for turn in range(1, rounds + 1):
        runs = merge_runs(now, begins, ends)
        now = merge_pairs(runs, begins, ends, turn)
        out += [runs, now]
    return out


def anchors(levels: list[Symbols], begins: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(anchor word, first window, last window, stretch start, stretch end,
    level) of the runs of windows that take the same anchor."""
    n = int(ends[-1]) if len(ends) else 0
    inside = np.zeros(n + 1, dtype=np.int64)
    enough = ends - begins >= window
    np.add.at(inside, begins[enough], 1)
    np.add.at(inside, ends[enough] - window + 1, -1)
    todo = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    starts, place, lo, hi, level = [], [], [], [], []
    for turn in range(len(levels) - 1, -1, -1):
        s = levels[turn]
        if not len(todo) or not len(s):
            continue
        a = np.searchsorted(s.lo, todo)
        z = np.searchsorted(s.hi, todo + window, side="right")
        has = z > a
        w, a, z = todo[has], a[has], z[has]
        if len(w):
            table = [(tokens.mix(s.name + np.uint64(97)) & ~_LOW) | np.arange(len(s), dtype=np.uint64)]
            top = int((z - a).max())
            while (1 << len(table)) <= top:
                half = 1 << (len(table) - 1)
                table.append(np.minimum(table[-1][:-half], table[-1][half:]))
            power = np.floor(np.log2(z - a)).astype(np.int64)
            best = np.empty(len(w), dtype=np.uint64)
            for p in np.unique(power):
                m = power == p
                best[m] = np.minimum(table[p][a[m]], table[p][z[m] - (1 << int(p))])
            pick = (best & _LOW).astype(np.int64)
            starts.append(w)
            place.append(s.at[pick])
            lo.append(s.lo[pick])
            hi.append(s.hi[pick])
            level.append(np.full(len(w), turn))
        todo = todo[~has]
    if not starts:
        return (np.zeros(0, dtype=np.int64),) * 6
    starts = np.concatenate(starts)
    order = np.argsort(starts, kind="stable")
    starts, place, level = starts[order], np.concatenate(place)[order], np.concatenate(level)[order]
    lo, hi = np.concatenate(lo)[order], np.concatenate(hi)[order]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (level[1:] != level[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    return place[first], starts[first], starts[last], lo[first], hi[first], level[first]


def buffer_rows(pieces, owners, ranks, offsets) -> pa.RecordBatch:
    """First-round rows of texts given as arrays of word names."""
    names = np.concatenate(pieces)
    ends = np.cumsum([len(p) for p in pieces])
    begins = np.concatenate([[0], ends[:-1]])
    text = np.repeat(np.arange(len(pieces)), np.diff(np.concatenate([[0], ends])))
    at, first, last, from_, to, level = anchors(parse(names, text, begins, ends), begins, ends)
    # windows of one word throughout are equal: a stretch of them is one row
    change = np.concatenate([np.flatnonzero((names[1:] != names[:-1]) | (text[1:] != text[:-1])) + 1, [len(names)]])
    run_end = change[np.searchsorted(change, first, side="right")]
    flat = run_end >= first + WINDOW
    head = np.ones(len(first), dtype=bool)
    head[1:] = ~(flat[1:] & flat[:-1] & (first[1:] == last[:-1] + 1) & (at[1:] - first[1:] == at[:-1] - first[:-1]))
    tail = np.where(flat, run_end - WINDOW - first, 0)[head]
    flat, at, first, last, from_, to, level = (v[head] for v in (flat, at, first, last, from_, to, level))
    last = np.where(flat, first, last)
    lo, hi = at - last, at - first
    # the core is the anchor's whole stretch: all its windows contain it
    stretch = tokens.range_names(tokens.running(names), from_, to)
    core = tokens.mix(stretch + (level * 1024 + at - from_).astype(np.uint64) * tokens._M2)
    view, digest = memoryview(names).cast("B"), xxhash.xxh3_64_intdigest
    hull = [digest(view[8 * s:8 * e], seed) for s, e, seed in
            zip(first.tolist(), (last + WINDOW).tolist(), (1 + lo * 1024 + hi).tolist())]
    piece = np.searchsorted(ends, at, side="right")
    place = at - begins[piece] + np.array(offsets, dtype=np.int64)[piece]
    return pa.RecordBatch.from_arrays(
        [pa.array(core.view(np.int64)), pa.array(repeats.signed(hull)), pa.array(np.array(owners, dtype=np.int64)[piece]),
         pa.array(np.array(ranks, dtype=np.int64)[piece]), pa.array(place), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(tail.astype(np.int32))],
        names=["core", "hull", "doc", "rank", "at", "lo", "hi", "tail"])


def rows_of(docs: list[int], ranks: list[int], data: list[bytes]) -> Iterator[pa.RecordBatch]:
    pieces, owners, orders, offsets, size = [], [], [], [], 0
    for a, z in tokens.buffers(data):
        names, _, _, bounds = tokens.words(data[a:z])
        for i in range(a, z):
            own = names[bounds[i - a]:bounds[i - a + 1]]
            for at in range(0, max(len(own) - WINDOW + 1, 0), SEGMENT):
                piece = own[at:at + SEGMENT + WINDOW - 1]
                if pieces and size + len(piece) > SEGMENT:
                    yield buffer_rows(pieces, owners, orders, offsets)
                    pieces, owners, orders, offsets, size = [], [], [], [], 0
                pieces.append(piece)
                owners.append(docs[i])
                orders.append(ranks[i])
                offsets.append(at)
                size += len(piece)
    if pieces:
        yield buffer_rows(pieces, owners, orders, offsets)


def first_rows(texts: DataFrame) -> DataFrame:
    """First-round rows of ``texts`` (``doc``, ``rank``, ``text``)."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                data = [(t or "").encode("utf-8", "replace") for t in part.column(2).to_pylist()]
                yield from rows_of(part.column(0).to_pylist(), part.column(1).to_pylist(), data)

    ship_package(texts.sparkSession)
    return texts.select("doc", "rank", "text").mapInArrow(run, repeats.FIRST)


def _cut(text):
    own = text.encode("utf-8", "replace").split()
    return lambda s, e: b" ".join(own[s:e])


def _units(contexts: list[bytes]) -> tuple[list[bytes], int]:
    """Stretches of words as the bytes of their names, eight a word."""
    out = []
    for a, z in tokens.buffers(contexts):
        names, _, _, bounds = tokens.words(contexts[a:z])
        raw, cuts = names.tobytes(), (8 * bounds).tolist()
        out += [raw[s:e] for s, e in zip(cuts, cuts[1:])]
    return out, 8


def repeated_words(df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, doc_id, text, starts, stops``: every row of ``df`` with the word
    stretches that repeated windows cover. ``id_col`` is an integer column."""
    texts = df.select(F.xxhash64(id_col, text_col).alias("doc"), F.col(id_col).alias("doc_id"),
                      F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("rank"), F.col(text_col).alias("text"))
    spans = repeats.repeated_spans(first_rows(texts), texts.select("doc", "text"), work, WINDOW, BLOCKS, True, _cut, _units)
    return repeats.with_spans(texts, spans)


def remove_repeats(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id, kept (words joined by a space), n_words, n_removed`` per row of
    ``repeated_words``."""
    def make():
        def step(ids, texts, starts, stops):
            kept, n, gone = [], [], []
            for text, ss, es in zip(texts, starts, stops):
                own = (text or "").encode("utf-8", "replace").split()
                out, at = [], 0
                for s, e in repeats.merged_runs(ss or [], es or []):
                    out += own[at:s]
                    at = e
                out += own[at:]
                kept.append(b" ".join(out).decode("utf-8", "replace"))
                n.append(len(own))
                gone.append(len(own) - len(out))
            return [ids, kept, n, gone]
        return step

    id_type = found.schema["doc_id"].dataType.simpleString()
    return map_rows(found, ["doc_id", "text", "starts", "stops"],
                    f"{id_col} {id_type}, kept string, n_words long, n_removed long", make)
