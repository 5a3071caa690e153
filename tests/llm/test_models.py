"""Operators with targets, fingerprints or fitted models."""

import hashlib
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import mixing, quality, simhash, toxicity
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import frame


def mixed(docs, work, **kw):
    placed, pieces, slots = mixing.mix(docs, work, **kw)
    return mixing.taken_words(placed, pieces), slots


def test_water_fill():
    sizes, weights = np.array([10.0, 100.0, 1000.0]), np.array([3.0, 1.0, 2.0])
    target = mixing.water_fill(sizes, weights, 1.5 * sizes.sum(), 2)
    assert target.sum() == pytest.approx(1665) and target[0] == 20 and target[1] == 200
    assert mixing.water_fill(sizes, weights, 3 * sizes.sum(), 2) == pytest.approx(2 * sizes)


def test_mix_reaches_targets(messy, texts, work):
    got, slots = mixed(messy, work, block=16, shards=8)
    rows = got.collect()
    assert len(rows) == len(texts)
    assert sorted(r.size for r in rows) == sorted(len(brute.words(t)) for _, t, _ in texts)
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    by = {}
    for r in rows:
        own = by.setdefault(r.source, [0, 0, r.source_size, r.target])
        own[0] += r.taken
        own[1] += r.size
    for taken, size, source_size, target in by.values():
        assert size == source_size and abs(taken - target) <= 3 * 16 + 0.01 * target
    assert sum(v[3] for v in by.values()) == pytest.approx(1.5 * sum(v[1] for v in by.values()))
    assert slots.count() == slots.select("source_no", "slot").distinct().count()


def test_mix_reruns_agree(messy, work, spark):
    from basketry.llm.common import Workspace
    a, _ = mixed(messy, work, block=16)
    b, _ = mixed(messy.repartition(3), Workspace(spark, "again"), block=16)
    cols = ["doc_id", "place", "size", "taken"]
    total = lambda d: sorted(map(tuple, d.groupBy("place", "size").agg(F.sum("taken").alias("t")).collect()))
    assert total(a.select(cols)) == total(b.select(cols))


def test_mix_of_nothing(nothing, spark, work):
    got, slots = mixed(nothing, work)
    assert got.count() == 0 and slots.count() == 0
    from basketry.llm.common import Workspace
    blank, _ = mixed(frame(spark, [(1, None, "a"), (2, " ", None)]), Workspace(spark, "blank"))
    assert [r.taken for r in blank.collect()] == [0, 0]


def test_permutation_is_one_to_one():
    for n in (1, 2, 3, 17, 64, 1000):
        out = mixing.permute(np.arange(n), np.full(n, n), np.full(n, 12345))
        assert sorted(out) == list(range(n))
    assert list(mixing.permute(np.arange(50), np.full(50, 50), np.full(50, 1))) != list(range(50))


def test_simhash_edits(messy, texts, work):
    rows = simhash.compare_with_edits(messy, work).collect()
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(rows) == len(texts)
    prints = {}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == simhash.BITS // 4
    ids = [r[0] for r in order]
    for k, (i, t, _) in enumerate(order):
        if i is None or ids.count(i) > 1:
            continue
        (row,) = [r for r in rows if r.doc_id == i]
        text = t or ""
        follow = [o for o in order[k + 1:]][:1] or order[:1]
        if ids.count(follow[0][0]) == 1 and follow[0][0] is not None:
            q = len(text) // 4
            edited = text[:len(text) - q] + (follow[0][1] or "")[:q]
            assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and row.n_chars == len(text)
        assert prints.setdefault(tuple(brute.words(text)), row.fingerprint) == row.fingerprint


def test_simhash_of_nothing(nothing, work):
    assert simhash.compare_with_edits(nothing, work).count() == 0


def test_simhash_votes(spark):
    """Against a plain count of votes."""
    text = "the cat sat on the cat"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id long, text string")
    got = {r.id: r.fp for r in simhash.fingerprints(df, ["id"], {"text": "fp"}).collect()}
    ws = text.split()
    one = spark.createDataFrame([(w,) for w in ws], "w string").select("w", F.xxhash64("w").alias("h")).distinct()
    h = {r.w: r.h for r in one.collect()}
    votes = np.zeros(128)
    terms = [(h[w], None, 1) for w in ws] + [(h[a], h[b], 2) for a, b in zip(ws, ws[1:])]
    for k, seed in enumerate(simhash.SEEDS):
        for a, b, weight in terms:
            cols = [F.lit(a)] + ([F.lit(b)] if b is not None else []) + [F.lit(seed)]
            v = spark.range(1).select(F.xxhash64(*[c.cast("long") for c in cols[:-1]], cols[-1]).alias("v")).first().v
            for bit in range(64):
                votes[64 * k + bit] += weight if (v >> bit) & 1 else -weight
    want = "".join(f"{sum(1 << b for b in range(64) if votes[64 * k + b] > 0):016x}" for k in range(2))
    assert got[1] == want and got[2] == got[3] == "0" * 32


def test_within_radius(spark):
    rng = np.random.default_rng(0)
    base = [int.from_bytes(rng.bytes(16), "big") for _ in range(60)]
    near = [b ^ sum(1 << int(x) for x in rng.choice(128, k % 6, replace=False)) for k, b in enumerate(base)]
    hexes = [f"{v:032x}" for v in base + near] + [None]
    df = spark.createDataFrame([(x,) for x in hexes], "fingerprint string")
    got = {(r.fingerprint, r.match, r.distance) for r in simhash.within_radius(df, df, 3).collect()}
    vals = {x: int(x, 16) for x in hexes if x}
    want = {(a, b, (x ^ y).bit_count()) for a, x in vals.items() for b, y in vals.items() if (x ^ y).bit_count() <= 3}
    assert got == want


def test_neighbour_counts(spark, messy, work):
    prints = work.save(simhash.compare_with_edits(messy, work), "prints")
    got = simhash.with_neighbours(prints, F.col("doc_id") % 20 == 0, 3).collect()
    assert len(got) == prints.count()
    vals = [int(r.fingerprint, 16) for r in got]
    for r in got:
        want = sum((int(r.fingerprint, 16) ^ v).bit_count() <= 3 for v in vals)
        assert r.n_within == (want if r.doc_id is not None and r.doc_id % 20 == 0 else None)


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_toxicity_held_out(spark, work):
    docs, labels = (spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    from basketry.llm.queries import held_out
    model = toxicity.train(docs, labels.where(~held_out()), work)
    assert 0 < len(model.index) < 20_000  # sparse
    pdf = toxicity.score(docs, model).join(labels.where(held_out()), "doc_id").toPandas()
    assert all(crc32(str(i).encode()) % 5 == 0 for i in pdf["doc_id"])
    assert auc(pdf["score"].to_numpy(), pdf["toxic"].to_numpy()) > 0.95
    called = pdf["score"] >= 0.5
    assert pdf["toxic"][called].mean() > 0.9


def test_toxicity_edges(messy, texts, nothing, spark, work):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    empty = toxicity.train(messy, none, work)
    assert len(empty.index) == 0
    rows = toxicity.score(messy, empty).collect()
    assert len(rows) == len(texts) and {r.score for r in rows} == {0.5}
    assert toxicity.score(nothing, empty).count() == 0


def test_quality_model_separates(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    crf = quality.train(docs, labels)
    pdf = quality.judge(docs, crf).join(labels, "doc_id").where("not base_failed").toPandas()
    assert pdf["kept"][pdf["quality"] == 1].mean() > 0.99
    assert pdf["kept"][pdf["quality"] == 0].mean() < 0.1
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(docs, none) is quality.PRIOR
