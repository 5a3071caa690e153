"""What long texts and texts that share passages cost op6 and op9, the recall of
the signatures, and boundaries inside a text for op3."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import minhash, quality, secrets
from tests.llm import brute


@pytest.fixture()
def set_bytes(monkeypatch):
    """(bytes of sets that enter the confirming units, of these the copies) per call."""
    seen = []
    real = minhash.in_units

    def watched(rows, order, payload):
        if "shingles" in payload:
            one = rows.agg(F.coalesce(F.sum(F.length("shingles")), F.lit(0)).alias("own"),
                           F.coalesce(F.sum(F.length("shingles") * F.col("blocks")), F.lit(0)).alias("sent")).first()
            seen.append((one.own, one.sent))
        return real(rows, order, payload)

    monkeypatch.setattr(minhash, "in_units", watched)
    return seen


def _frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)


def test_two_very_long_near_copies_are_written_twice(spark, work, set_bytes):
    rnd = random.Random(1)
    words = [f"w{rnd.randrange(1_000_000)}" for _ in range(400_000)]
    other = list(words)
    for k in range(0, len(other), 400):
        other[k] = "changed"
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(_frame(spark, [" ".join(words), " ".join(other), "a b c d e f"]), work).collect()}
    assert got == {0: 0, 1: 0, 2: 2}
    ((own, sent),) = set_bytes
    assert own > 5_000_000 and sent <= 2 * own


def test_shared_passages_send_few_sets(spark, work, set_bytes):
    rnd = random.Random(2)
    fresh = lambda n: " ".join(f"x{rnd.randrange(10**9)}" for _ in range(n))
    passages = [fresh(50) for _ in range(60)]
    texts = [" ".join([fresh(150), *rnd.sample(passages, 3)]) for _ in range(2_500)]
    rows = minhash.near_duplicates(_frame(spark, texts), work).collect()
    assert all(r.component_id == r.doc_id and r.kept for r in rows)
    ((own, sent),) = set_bytes
    all_sets = sum(r.n_shingles * 8 for r in rows)
    assert sent < 0.2 * all_sets  # before: all of them, forty times


def test_lists_longer_than_a_block_lose_no_link(spark, work, monkeypatch):
    monkeypatch.setattr(minhash, "LIST_NODES", 4)
    monkeypatch.setattr(minhash, "BLOCK_NODES", 3)
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    texts = []
    for k in range(40):
        own = list(base)
        for _ in range(k % 8):
            own[rnd.randrange(len(own))] = f"y{rnd.randrange(10**6)}"
        texts.append(" ".join(own))
    rows = [(i, t, None) for i, t in enumerate(texts)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(_frame(spark, texts), work).collect())
    assert got == sorted(brute.near_duplicates(rows))


def test_agreeing_spans_what_it_connects():
    rng = np.random.default_rng(5)
    for n, two_sided in ((2, False), (30, False), (30, True), (150, False)):
        tags = rng.integers(0, 3, (n, 64)).astype(np.uint8)
        tags[n // 2:] = tags[:n - n // 2] ^ (rng.random((n - n // 2, 64)) < 0.3)
        side = (np.arange(n) >= n // 2).astype(int) if two_sided else np.zeros(n, dtype=int)
        pairs = {(i, j) for i in range(n) for j in range(i) if (tags[i] == tags[j]).sum() >= 30 and (not two_sided or side[i] != side[j])}
        assert _parts(n, minhash.agreeing(tags, side, 30)) == _parts(n, pairs)


def _parts(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_recall_of_signatures_at_the_threshold():
    """20,000 pairs of sets of similarity exactly 0.75: the fewest agreements that any has."""
    rng = np.random.default_rng(6)
    least = minhash.COORDS
    for _ in range(2_000):
        both = rng.integers(0, 2**64, 60, dtype=np.uint64)
        a = minhash.signature(both)
        for _ in range(10):
            ends = rng.integers(0, 2**64, 20, dtype=np.uint64)
            pair = [np.minimum(a, minhash.signature(ends[:10])), np.minimum(a, minhash.signature(ends[10:]))]  # 60 of 80 shared
            least = min(least, int((pair[0] == pair[1]).sum()))
    assert least >= minhash.MATCHES + 2


def test_secrets_in_a_large_dump_take_linear_time():
    line = 'password = "hunter2-Hunter2-{0}"\napi_key: AKIA{0:016d}ABCD\nvalue_{0} = "plain words {0}"\n'
    small = "".join(line.format(i) for i in range(3_000))
    large = "".join(line.format(i) for i in range(30_000))
    times = []
    for text in (small, large):
        t0 = time.process_time()
        spans = secrets.scan_text(text)
        times.append(time.process_time() - t0)
    assert sum(s.kind == "access" for s in spans) == 30_000 and sum(s.kind == "assign" for s in spans) == 60_000
    assert times[1] < 25 * max(times[0], 0.05)


def test_outside_is_the_plain_rule():
    rnd = random.Random(8)
    for _ in range(300):
        base = sorted((s, s + rnd.randrange(1, 12), k) for s, k in ((rnd.randrange(60), rnd.randrange(3)) for _ in range(rnd.randrange(8))))
        found = sorted({(s, s + rnd.randrange(1, 9)) for s in (rnd.randrange(60) for _ in range(rnd.randrange(8)))})
        plain = [(s, e) for s, e in found if not any(a <= s and e <= b for a, b, _ in base)]
        assert secrets.outside(found, sorted(base, key=lambda b: (b[0], b[2]))) == plain


def test_a_good_half_is_told_from_a_junk_half(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    crf = quality.train(docs, labels)
    texts = docs.join(labels.where("quality is not null"), "doc_id").select("quality", "text").collect()
    lines = {q: [x for x in (quality.read_lines(r.text) for r in texts if r.quality == q) if 4 <= len(x.sizes) <= 60] for q in (0, 1)}
    rnd, wrong, split = random.Random(4), [], 0
    for k in range(200):
        good, junk = rnd.choice(lines[1]).features, rnd.choice(lines[0]).features
        n = min(len(good), len(junk))
        parts = [(good[:n], 0), (junk[:n], 1)][::1 if k % 2 else -1]
        states = quality.viterbi(crf, np.array(parts[0][0] + parts[1][0]))
        wrong.append((states != np.repeat([parts[0][1], parts[1][1]], n)).mean())
        split += 0 < states.mean() < 1
    assert split > 190 and np.mean(wrong) < 0.08
