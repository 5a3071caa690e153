"""The five stages on a small table, each held against what it promises."""

from collections import Counter

import corpus_pipeline as C
from basketry.llm.common import Workspace, documents
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_stages(spark):
    work = Workspace(spark, "test-pipeline")
    docs = documents(spark, SF_SMALL)
    columns, seen = docs.columns, {}
    before = docs.collect()
    names = [n for n, _ in C.STAGES]
    assert names == ["quality_rules", "near_duplicates", "secret_scan", "source_mix", "bpe_tokens"]
    for name, stage in C.STAGES:
        out = work.save(stage(spark, docs, SF_SMALL), name)
        after = out.collect()
        seen[name] = (before, after)
        if name != names[-1]:
            assert out.columns == columns
        docs, before = out, after
    before, after = seen["quality_rules"]
    kept = {r.doc_id for r in after}
    for r in before:
        if brute.quality(r.text)[-1]:
            assert r.doc_id not in kept
    good = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1").collect()}
    fine = [r for r in before if r.doc_id in good and not brute.quality(r.text)[-1]]
    assert sum(r.doc_id in kept for r in fine) >= 0.98 * len(fine)
    before, after = seen["near_duplicates"]
    want = [r[0] for r in brute.near_duplicates([(r.doc_id, r.text, None) for r in before]) if r[3]]
    assert sorted(r.doc_id for r in after) == sorted(want)
    before, after = seen["secret_scan"]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
    assert all(brute.secrets(r.text)[:3] == (0, 0, 0) for r in after)
    before, after = seen["source_mix"]
    times = Counter(r.doc_id for r in after)
    assert set(times) <= {r.doc_id for r in before} and max(times.values()) <= 2
    total = lambda rows: sum(len(brute.words(r.text)) for r in rows)
    assert 1.2 < total(after) / total(before) < 1.8
    before, after = seen["bpe_tokens"]
    assert len(after) == len(before)


def test_run(spark):
    out = C.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100


def test_stages_on_odd_rows(spark, messy, texts):
    """Nulls, blanks, repeated rows, long texts and columns named like the
    stages' own go through every stage."""
    work = Workspace(spark, "odd")
    docs, n = messy, len(texts)
    for name, stage in C.STAGES:
        out = work.save(stage(spark, docs, SF_SMALL), name)
        if name == "bpe_tokens":
            assert out.count() == n
            break
        assert out.columns == messy.columns
        n = out.count()
        docs = out
    for name in ("near_duplicates", "secret_scan", "source_mix"):  # blank texts reach these only alone
        out = dict(C.STAGES)[name](spark, messy, SF_SMALL)
        blank = sum(not brute.words(t) for _, t, _ in texts)
        got = sum(not brute.words(r.text) for r in out.collect())
        assert got == (0 if name == "source_mix" else blank)


def test_stages_on_an_empty_table(spark, nothing):
    for name, stage in C.STAGES:
        out = stage(spark, nothing, SF_SMALL)
        assert out.count() == 0
        if name != "bpe_tokens":
            assert out.columns == nothing.columns
