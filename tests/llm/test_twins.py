"""Whole results of the mix, the edits and the toxicity fit against plain versions."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from basketry.llm import mixing, simhash, toxicity
from basketry.llm.common import Workspace
from tests.conftest import SF_SMALL
from tests.llm import brute

WORD64 = (1 << 64) - 1


def placed_texts(spark, texts):
    """(id, text, source, place) in the operators' order: id, null first, then a hash of the text."""
    df = spark.createDataFrame([(k, t or "") for k, (_, t, _) in enumerate(texts)], "k long, text string")
    place = {r.k: r.place for r in df.select("k", F.xxhash64("text").alias("place")).collect()}
    rows = [(i, t or "", s, place[k]) for k, (i, t, s) in enumerate(texts)]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[3]))


def plain_permute(i, n, key):
    bits = max(math.ceil(math.log2(max(n, 2))), 2)
    half = (bits + 1) // 2
    mask = (1 << half) - 1
    while True:
        left, right = i >> half, i & mask
        for r in range(4):
            f = (right + key + r + 1) * 0x9E3779B97F4A7C15 & WORD64
            f = (f ^ f >> 31) * 0xBF58476D1CE4E5B9 & WORD64
            left, right = right, left ^ ((f ^ f >> 29) & mask)
        i = left << half | right
        if i < n:
            return i


def test_taken_words_against_brute_force(spark, messy, texts, work):
    block, seed = 16, 11
    placed, pieces, slots = mixing.mix(messy, work, block=block, shards=8, seed=seed)
    got = [(r.doc_id, r.place, r.size, r.taken) for r in mixing.taken_words(placed, pieces).collect()]
    n_slots = {r.source_no: r.n for r in slots.groupBy("source_no").agg(F.count("*").alias("n")).collect()}
    by_source = defaultdict(list)
    for i, t, s, place in placed_texts(spark, texts):
        by_source[s].append((i, place, len(brute.words(t))))
    want = []
    for no, source in enumerate(sorted(by_source, key=lambda s: (s is None, s or ""))):
        docs = by_source[source]
        owner = [k for k, (_, _, size) in enumerate(docs) for _ in range(size)]  # document of every word
        n_blocks = -(-len(owner) // block)
        taken = Counter()
        for slot in range(n_slots.get(no, 0)):
            at = plain_permute(slot % n_blocks, n_blocks, (no * 1_000_003 + slot // n_blocks) * 7_919 + seed) * block
            taken.update(owner[at:at + block])
        want += [(*d, taken[k]) for k, d in enumerate(docs)]
    assert Counter(got) == Counter(want)


def test_edits_and_likeness_against_brute_force(spark, messy, texts, work):
    rows = placed_texts(spark, texts)
    pairs = []
    for k, (i, t, _, _) in enumerate(rows):
        follow = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        pairs.append((k, i, t, t[:len(t) - q] + follow[:q], follow))
    df = spark.createDataFrame(pairs, "k long, doc_id long, own string, edited string, follow string").repartition(8, "k")
    prints = simhash.fingerprints(df, ["k"], {"own": "a", "edited": "b", "follow": "c"}).collect()

    def like(a, b):
        return round(1 - (int(a, 16) ^ int(b, 16)).bit_count() / simhash.BITS, 12)

    want = Counter()
    for r in prints:
        _, i, own, edited, _ = pairs[r.k]
        want[i, len(own), hashlib.sha256(edited.encode()).hexdigest(), r.a, r.b, like(r.a, r.b), like(r.a, r.c)] += 1
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 12), round(r.near_next, 12))
                  for r in simhash.compare_with_edits(messy, work).collect())
    assert got == want


def plain_features(text):
    def spread(x, salt):
        x = (x + salt) * 0x9E3779B97F4A7C15 & WORD64
        return ((x ^ x >> 32) * 0xC2B2AE3D27D4EB4F & WORD64) >> (64 - toxicity.BITS)

    h = [crc32(w.encode()) for w in re.findall(r"\w+", (text or "").lower())]
    pair = lambda a, b: (a * 0xC2B2AE3D27D4EB4F + b) & WORD64
    return ({toxicity.BIAS} | {spread(x, 1) for x in h} | {spread(pair(a, b), 2) for a, b in zip(h, h[1:])}
            | {spread(pair(a, b), 3) for a, b in zip(h, h[2:])})


def test_toxicity_fit_against_plain_updates(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels, Workspace(spark, "twin"))
    assert len(model.index) > 5
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(toxicity.SHARDS)).alias("shard")
    rows = docs.join(labels, "doc_id").select(shard, F.xxhash64("doc_id", "text").alias("place"), "toxic", "text").collect()
    assert len(rows) == labels.count()
    shards = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.place):
        shards[r.shard].append((plain_features(r.text), r.toxic))

    def weight(z, n):
        if abs(z) <= toxicity.L1:
            return 0.0
        return -(z - math.copysign(toxicity.L1, z)) / ((toxicity.BETA + math.sqrt(n)) / toxicity.ALPHA + toxicity.L2)

    state = {}
    for _ in range(toxicity.EPOCHS):
        total = defaultdict(lambda: [0.0, 0.0])
        for own in shards.values():
            mine = dict(state)
            for coords, y in own:
                ws = {c: weight(*mine.get(c, (0.0, 0.0))) for c in coords}
                g = (1 / (1 + math.exp(-max(-35.0, min(35.0, math.fsum(ws.values()))))) - y) * (toxicity.TOXIC_WEIGHT if y else 1.0)
                for c, w in ws.items():
                    z, n = mine.get(c, (0.0, 0.0))
                    mine[c] = (z + g - (math.sqrt(n + g * g) - math.sqrt(n)) / toxicity.ALPHA * w, n + g * g)
            for c, (z, n) in mine.items():
                total[c][0] += z
                total[c][1] += n
        state = {c: (z / toxicity.SHARDS, n / toxicity.SHARDS) for c, (z, n) in total.items()}
    want = {c: w for c, s in state.items() if (w := weight(*s))}
    got = dict(zip(model.index.tolist(), model.weight.tolist()))
    assert got.keys() == want.keys() and got == pytest.approx(want, rel=1e-6)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for r in docs.collect():
        total = math.fsum(got.get(c, 0.0) for c in plain_features(r.text))
        assert scores[r.doc_id] == pytest.approx(1 / (1 + math.exp(-max(-35.0, min(35.0, total)))), rel=1e-6)
