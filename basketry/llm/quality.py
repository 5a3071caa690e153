"""Quality rules and line labelling by a linear-chain conditional random field.

Every line with a word gets a feature vector (table bars, symbols per word,
capitals, shouting, immediate word repeats, repeats of an earlier line, line
shape). A two-state linear-chain CRF (content, boilerplate) labels the lines
of a document together by Viterbi decoding; the share of words in content
lines decides whether the document stays.

The CRF is fitted on at most ``TRAIN_DOCS`` labelled documents (those with the
smallest hash of their id, so the choice does not depend on partitioning);
lines take their document's label, and sequences joined from documents of both
labels teach the transitions between the states. Features are computed in Spark
tasks (of at most ``TRAIN_LINES`` lines a document, evenly spread segments of a longer
one), the bounded sample is fitted by gradient ascent on the driver and its few
weights travel with the scoring function. Without labels of both classes the weights
``PRIOR`` are used. Scoring is one pass without shuffle over all lines of all texts.

Null and empty texts have no words: all counts are zero and the base rule
rejects them. Repeated rows each get a result; an empty table gives an empty one;
very long texts are labelled line by line in memory in proportion to the text;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from operator import eq
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import WORD, map_rows, ship_package

SYMBOLS = "#*$%&|<>"  # fixed value
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
TRAIN_DOCS, TRAIN_LINES, SEGMENT, STEPS = 2_000, 1_024, 64, 200
MIN_CONTENT = 0.5

FEATURES = ("bias", "bars", "symbols", "capitals", "shouting", "word_repeats", "line_repeat", "few_words", "sentence_end")


class Crf(NamedTuple):
    emit: np.ndarray   # 2 x features
    move: np.ndarray   # 2 x 2
    first: np.ndarray  # 2


#: Weights when there is nothing to fit on: each junk trait alone outweighs the bias.
PRIOR = Crf(np.array([[0.0] * len(FEATURES), [-2.5, 6.0, 6.0, 4.0, 6.0, 8.0, 2.0, 0.3, -0.5]]),
            np.array([[0.7, -0.7], [-0.7, 0.7]]), np.array([0.5, -0.5]))

_MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(WINDOW)], dtype=np.uint64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def repeated_words(words: list[str], width: int = WINDOW) -> int:
    """Words covered by ``width``-word windows that occur at least twice."""
    n = len(words)
    if n <= width:
        return 0
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    if len(numbers) == n:
        return 0
    m = n - width + 1
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX
    names = np.zeros(m, dtype=np.uint64)
    for k in range(width):
        names += mixed[k:k + m] * _MULTIPLIERS[k % WINDOW]
    ordered = np.sort(names)
    if not (ordered[1:] == ordered[:-1]).any():  # equal windows have equal names
        return 0
    rank, length = ids, 1
    while length < width:  # exact ranks of ever longer windows
        step = min(length, width - length)
        left, right = rank[:len(rank) - step], rank[step:]
        _, rank = np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)
        length += step
    counts = np.bincount(rank)
    change = np.zeros(n + 1, dtype=np.int64)
    starts = np.flatnonzero(counts[rank] > 1)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


class Lines(NamedTuple):
    words: list[str]
    sizes: list[int]
    features: list[tuple]
    n_dup_lines: int


def read_lines(text: str | None) -> Lines:
    """Words, and per line with a word its size and features."""
    words, sizes, feats, seen, dups = [], [], [], set(), 0
    for line in (text or "").split("\n"):
        own = WORD.findall(line)
        if not own:
            continue
        n = len(own)
        again = line in seen
        dups += again
        seen.add(line)
        symbols = sum(map(line.count, "#*$%&<>"))
        upper = sum(map(str.isupper, own)) if n > 2 else 0
        feats.append((1.0, min(1.0, line.count("|") / n), min(1.0, symbols / n), upper / n,
                      min(1.0, line.count("!!") / n), sum(map(eq, own, own[1:])) / n, float(again),
                      float(n < 4), float(own[-1][-1] in ".!?")))
        words += own
        sizes.append(n)
    return Lines(words, sizes, feats, dups)


def viterbi(crf: Crf, features: np.ndarray) -> np.ndarray:
    """Best state sequence of the lines (0 content, 1 boilerplate)."""
    emit = (features @ crf.emit.T).tolist()
    (m00, m01), (m10, m11) = crf.move.tolist()
    a, b = crf.first[0] + emit[0][0], crf.first[1] + emit[0][1]
    back = []
    for e0, e1 in emit[1:]:
        from_a, from_b = a + m00 >= b + m10, a + m01 >= b + m11
        back.append((0 if from_a else 1, 0 if from_b else 1))
        a, b = (a + m00 if from_a else b + m10) + e0, (a + m01 if from_b else b + m11) + e1
    state = 0 if a >= b else 1
    path = [state]
    for step in reversed(back):
        state = step[state]
        path.append(state)
    return np.array(path[::-1])


def joined(documents: list[tuple[np.ndarray, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sequences with a boundary: the end of each document, up to half a segment,
    followed by the beginning of one of the other label, in turn."""
    by = [[x for x, y in documents if y == s and len(x)] for s in (0, 1)]
    half, out = SEGMENT // 2, []
    for i in range(max(map(len, by)) if all(by) else 0):
        pair = [by[s][i % len(by[s])] for s in (0, 1)]
        for a, b in ((0, 1), (1, 0)):
            head, tail = pair[a][-half:], pair[b][:half]
            out.append((np.concatenate([head, tail]), np.repeat([a, b], [len(head), len(tail)])))
    return out


def fit(documents: list[tuple[np.ndarray, int]]) -> Crf:
    """Maximum likelihood (with a small L2 penalty) of line states: documents
    whose lines all have their label, and joined ones that show the way from one
    state to the other; each of the three kinds weighs a third. Long documents
    train as several segments."""
    if len({y for _, y in documents}) < 2:
        return PRIOR
    parts = [(x[i:i + SEGMENT], np.full(len(x[i:i + SEGMENT]), y), y) for x, y in documents for i in range(0, len(x), SEGMENT)]
    parts += [(x, states, 2) for x, states in joined(documents)]
    n, k = len(parts), len(FEATURES)
    xs, on, y = np.zeros((n, SEGMENT, k)), np.zeros((n, SEGMENT), dtype=bool), np.zeros((n, SEGMENT), dtype=int)
    for i, (x, states, _) in enumerate(parts):
        xs[i, :len(x)], on[i, :len(x)], y[i, :len(x)] = x, True, states
    kind = np.array([p[2] for p in parts])
    weight = (1.0 / 3) / np.maximum(1, np.bincount(kind, minlength=3))[kind]
    emit, move, first = (p.copy() for p in PRIOR)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (emit, move, first)]
    for step in range(1, STEPS + 1):
        score = xs @ emit.T
        alpha, beta = np.zeros((n, SEGMENT, 2)), np.zeros((n, SEGMENT, 2))
        alpha[:, 0] = first + score[:, 0]
        for t in range(1, SEGMENT):
            nxt = np.logaddexp(alpha[:, t - 1, 0, None] + move[0], alpha[:, t - 1, 1, None] + move[1]) + score[:, t]
            alpha[:, t] = np.where(on[:, t, None], nxt, alpha[:, t - 1])
        for t in range(SEGMENT - 2, -1, -1):
            ahead = score[:, t + 1] + beta[:, t + 1]
            nxt = np.logaddexp(move[:, 0] + ahead[:, :1], move[:, 1] + ahead[:, 1:])
            beta[:, t] = np.where(on[:, t + 1, None], nxt, 0.0)
        total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        prob = np.exp(alpha + beta - total[:, None, None]) * on[:, :, None]
        gold = np.zeros_like(prob)
        gold[np.arange(n)[:, None], np.arange(SEGMENT), y] = on
        diff = (gold - prob) * weight[:, None, None]
        g_emit = np.einsum("nts,ntk->sk", diff, xs)
        g_first = diff[:, 0].sum(axis=0)
        both = on[:, 1:]
        pair = alpha[:, :-1, :, None] + move + (score[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
        expected = (np.exp(np.where(both[:, :, None, None], pair, -np.inf)) * weight[:, None, None, None]).sum(axis=(0, 1))
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), np.broadcast_to(weight[:, None], both.shape)[both])
        grads = (g_emit - 1e-3 * emit, (seen - expected) / SEGMENT - 1e-3 * move, g_first - 1e-3 * first)
        for p, g, (m, v) in zip((emit, move, first), grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Crf(emit, move, first)


def some_segments(features: np.ndarray) -> np.ndarray:
    """All lines of a training document, or evenly spread segments of a very long one."""
    if len(features) <= TRAIN_LINES:
        return features
    starts = np.linspace(0, len(features) - SEGMENT, TRAIN_LINES // SEGMENT).astype(int)
    return np.concatenate([features[s:s + SEGMENT] for s in starts])


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_docs: int = TRAIN_DOCS) -> Crf:
    """Fit on at most ``max_docs`` labelled documents; the chosen ids are a
    bounded table, so the join that fetches their texts broadcasts them."""
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(id_col).agg(F.min(label_col).alias("_label"))
              .orderBy(F.xxhash64(id_col), id_col).limit(max_docs))
    texts = documents.select(id_col, text_col).join(F.broadcast(chosen), id_col)

    def make():
        def step(ys, docs):
            return [ys, [some_segments(np.array(read_lines(t).features, dtype="<f4")).tobytes() for t in docs]]
        return step

    rows = map_rows(texts, ["_label", text_col], "label int, features binary", make).collect()
    seqs = sorted((r.features, r.label) for r in rows if r.features)  # partitioning doesn't show in the fit
    return fit([(np.frombuffer(f, "<f4").reshape(-1, len(FEATURES)).astype(float), int(y == 0)) for f, y in seqs])


def judge(df: DataFrame, crf: Crf, id_col: str = "doc_id", text_col: str = "text",
          min_content: float = MIN_CONTENT) -> DataFrame:
    """One row per row of ``df``: the base counts, ``content_share`` (words in
    content lines over all words, null without words) and ``kept``."""
    def make():
        def step(ids, texts):
            out = [[] for _ in range(9)]
            for text in texts:
                lines = read_lines(text)
                n = len(lines.words)
                repeats = repeated_words(lines.words)
                failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
                share, n_boiler = None, 0
                if n:
                    states = viterbi(crf, np.array(lines.features))
                    share = float(np.dot(lines.sizes, states == 0)) / n
                    n_boiler = int(states.sum())
                row = (n, sum(map(len, lines.words)), sum(map((text or "").count, SYMBOLS)), lines.n_dup_lines, repeats,
                       failed, not failed and share >= min_content, share, n_boiler)
                for col, v in zip(out, row):
                    col.append(v)
            return [ids, *out]
        return step

    id_type = df.schema[id_col].dataType.simpleString()
    return map_rows(df, [id_col, text_col], f"{id_col} {id_type}, n_words long, word_chars long, n_symbols long, "
                    "n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, "
                    "n_boilerplate_lines long", make)


def keep_good(df: DataFrame, crf: Crf, text_col: str = "text", min_content: float = MIN_CONTENT) -> DataFrame:
    """Rows of ``df`` whose text is kept, with all their columns."""
    def good(text):
        lines = read_lines(text)
        n = len(lines.words)
        if n < MIN_WORDS or 100 * repeated_words(lines.words) > MAX_REPEAT_PERCENT * n:
            return False
        return float(np.dot(lines.sizes, viterbi(crf, np.array(lines.features)) == 0)) / n >= min_content

    @F.pandas_udf(T.BooleanType())
    def kept(texts: pd.Series) -> pd.Series:
        return texts.map(good).astype(bool)

    ship_package(df.sparkSession)
    return df.where(kept(F.col(text_col)))
