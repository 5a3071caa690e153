"""Byte-level BPE encoding and decoding from a public vocabulary file.

Encoding splits a text by the vocabulary's pattern and merges each piece with
a priority queue of (merge rank, position) over a doubly linked symbol list;
an entry whose symbols have changed since it was queued is stale and skipped.
Decoding concatenates the vocabulary's byte strings. Encoded ids travel as one
binary column of little-endian unsigned 32-bit integers.

One pass over Arrow batches, no shuffle. Each Python worker keeps the ids of
recent short pieces in bounded tables (``CHUNK_ENTRIES``, and two generations
of ``WORD_ENTRIES``; dropping old entries only costs time). Null texts encode as
empty ones, texts are never cut, and repeated rows each get a result.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import map_rows, when_leaving

# Fixed value: the split pattern of this family of vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK_ENTRIES, WORD_ENTRIES = 200_000, 130_000
LONGEST_KEPT = 40  # longer pieces are encoded each time, so the tables stay small
_SPACE_THEN_SPACE = re.compile(r" [\s\x1c-\x1f\x85]")


def byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in the vocabulary file: printable
    Latin-1 characters stand for themselves, the rest follow from U+0100."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Chunks(dict):
    """Packed ids of chunks that followed a space (``lead`` a space) or began a
    text (``lead`` empty); a new chunk is split into pattern matches."""

    def __init__(self, owner: PieceCache, lead: str):
        super().__init__()
        self.owner, self.lead = owner, lead

    def __missing__(self, chunk: str) -> bytes:
        word = self.owner.word
        if chunk.isalpha():
            ids = word(self.lead + chunk)
        elif chunk[:-1].isalpha() and chunk[-1] in ".,;:!?":
            ids = word(self.lead + chunk[:-1]) + word(chunk[-1])
        else:
            ids = b"".join(map(word, self.owner.split(self.lead + chunk)))
        if len(chunk) <= LONGEST_KEPT:
            if len(self) >= self.owner.chunk_entries:
                self.clear()
            self[chunk] = ids
        return ids


class PieceCache:
    """Ids of texts, joined from the ids of their pieces.

    Texts in which no space is followed by white space split at spaces: every
    pattern match then ends before the next space, so each word with the space
    before it encodes alone. Other texts split by the pattern itself."""

    def __init__(self, chunk_entries: int = CHUNK_ENTRIES, word_entries: int = WORD_ENTRIES):
        self.chunk_entries, self.word_entries = chunk_entries, word_entries
        self.first, self.rest = _Chunks(self, ""), _Chunks(self, " ")
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.split = regex.compile(PATTERN).findall

    def encode_word(self, word: str) -> bytes:
        """Packed ids of a pattern match that is in no table."""
        raise NotImplementedError

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                ids = self.encode_word(word)
            if len(word) <= LONGEST_KEPT:
                if len(self.words) >= self.word_entries:
                    self.older, self.words = self.words, {}
                self.words[word] = ids
        return ids

    def encode_text(self, text: str) -> bytes:
        if not text:
            return b""
        if _SPACE_THEN_SPACE.search(text):
            return b"".join(map(self.word, self.split(text)))
        chunks = text.split(" ")
        head = self.first[chunks[0]] if chunks[0] else b""
        return head + b"".join(map(self.rest.__getitem__, chunks[1:]))

    def encode_marked(self, texts: list[str], added: dict[str, int]) -> list[bytes]:
        """Packed ids of each text, where added tokens keep their own ids."""
        if not any(a in t for t in texts for a in added):
            return list(map(self.encode_text, texts))
        cut = re.compile("(" + "|".join(map(re.escape, added)) + ")").split
        out = []
        for t in texts:
            parts = cut(t)
            marks = [array("I", [added[p]]).tobytes() for p in parts[1::2]] + [b""]
            out.append(b"".join(x for part, mark in zip(parts[::2], marks) for x in (self.encode_text(part), mark)))
        return out


class ByteBPE(PieceCache):
    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of.update({i: t.encode() for t, i in self.added.items()})
        by_byte = {b: vocab[c] for c, b in letters.items()}
        self.symbol = [by_byte[b] for b in range(256)]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: always the lowest-ranked pair next, leftmost first."""
        ids = [self.symbol[b] for b in piece]
        n = len(ids)
        if n < 2:
            return ids
        merges = self.merges.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            if m := merges((ids[i], ids[i + 1])):
                queue.append((m[0], i, ids[i], ids[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, made = heapq.heappop(queue)
            if ids[i] != left:
                continue  # stale: the left symbol was merged away or grew
            j = after[i]
            if j >= n or ids[j] != right:
                continue  # stale: the right symbol did
            ids[i], ids[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges((made, ids[k])):
                    heapq.heappush(queue, (m[0], i, made, ids[k], m[1]))
            h = before[i]
            if h >= 0 and (m := merges((ids[h], made))):
                heapq.heappush(queue, (m[0], h, ids[h], made, m[1]))
        return [x for x in ids if x >= 0]

    def encode_word(self, word: str) -> bytes:
        return array("I", self.merge(word.encode())).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_marked(texts, self.added)

    def rest_after_task(self) -> None:
        """Drop the chunk tables, which the word tables refill quickly."""
        for table in (self.first, self.rest):
            table.clear()

    def forget(self) -> None:
        for table in (self.first, self.rest, self.words, self.older):
            table.clear()

    def decode(self, packed: bytes) -> str:
        ids = array("I")
        ids.frombytes(packed)
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> ByteBPE:
    """The vocabulary, read once per Python worker; its tables go when the
    worker turns to another operator."""
    bpe = ByteBPE(path)
    when_leaving("bpe", bpe.forget, bpe.rest_after_task)
    return bpe


def encode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (packed binary) for every row of ``df``."""
    def make():
        bpe = load(vocabulary)
        return lambda ids, texts: [ids, bpe.encode([t or "" for t in texts])]

    id_type = df.schema[id_col].dataType.simpleString()
    return map_rows(df, [id_col, text_col], f"{id_col} {id_type}, ids binary", make, rows_per_step=256, tables="bpe")


def decode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``text`` for every row of packed ids (null ids: empty)."""
    def make():
        bpe = load(vocabulary)
        return lambda ids, packed: [ids, [bpe.decode(p or b"") for p in packed]]

    id_type = df.schema[id_col].dataType.simpleString()
    return map_rows(df, [id_col, ids_col], f"{id_col} {id_type}, text string", make, rows_per_step=256, tables="bpe")


def round_trip(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: ``id_col``, ``ids``, ``decoded``."""
    def make():
        bpe = load(vocabulary)

        def step(ids, texts):
            packed = bpe.encode([t or "" for t in texts])
            return [ids, packed, [bpe.decode(p) for p in packed]]
        return step

    id_type = df.schema[id_col].dataType.simpleString()
    return map_rows(df, [id_col, text_col], f"{id_col} {id_type}, ids binary, decoded string", make, rows_per_step=256, tables="bpe")


def digests(coded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token count and digests of ``round_trip`` rows."""
    return coded.select(
        id_col, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
