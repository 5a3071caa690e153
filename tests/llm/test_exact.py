"""Operators whose results are fixed, against plain versions."""

import hashlib
import io
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm import bpe, minhash, quality, recompress, secrets, suffix, tokenfile
from tests.llm import brute
from tests.llm.conftest import frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


def rows_of(df, *cols):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=key)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_substring_dedup(messy, texts, work):
    found = suffix.remove_repeats(suffix.repeated_bytes(messy, work)).withColumn("sha", F.sha2("kept", 256))
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == ordered(brute.substring_dedup(texts))


def test_substring_dedup_of_nothing(nothing, work):
    assert suffix.remove_repeats(suffix.repeated_bytes(nothing, work)).count() == 0


def test_word_window_dedup(messy, texts, work):
    found = recompress.remove_repeats(recompress.repeated_words(messy, work)).withColumn("sha", F.sha2(F.col("kept").cast("binary"), 256))
    assert rows_of(found, "doc_id", "n_words", "n_removed", "sha") == ordered(brute.word_window_dedup(texts))


def test_word_window_dedup_of_nothing(nothing, work):
    assert recompress.remove_repeats(recompress.repeated_words(nothing, work)).count() == 0


@pytest.mark.parametrize("operator", ["bytes", "words"])
def test_equal_rows_fetch_their_stretches_once(spark, operator):
    """Equal rows (null ids, one text) whose passage has other surroundings
    elsewhere: contexts grow with the rows, not with their square."""
    from basketry.llm.common import Workspace

    class Counting(Workspace):
        copies = 0

        def save(self, df, name, partition_by=()):
            out = super().save(df, name, partition_by)
            if name == "contexts":
                self.copies = out.groupBy("doc", "at", "lo", "hi").count().agg(F.max("count")).first()[0]
            return out

    def words(tag, n):
        return " ".join(f"{tag}{k * 7919 % 1009}" for k in range(n))

    passage, n = words("p", 120), 30
    text = words("a", 40) + " " + passage + " " + words("b", 40)
    rows = [(None, text, "s")] * n + [(i, f"{words(f'c{i}', 40)} {passage} {words(f'd{i}', 40)}", "s") for i in range(3)]
    work = Counting(spark, "equal")
    if operator == "bytes":
        found = suffix.remove_repeats(suffix.repeated_bytes(frame(spark, rows), work)).withColumn("sha", F.sha2("kept", 256))
        got, want = rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "sha"), brute.substring_dedup(rows)
    else:
        found = recompress.remove_repeats(recompress.repeated_words(frame(spark, rows), work)).withColumn(
            "sha", F.sha2(F.col("kept").cast("binary"), 256))
        got, want = rows_of(found, "doc_id", "n_words", "n_removed", "sha"), brute.word_window_dedup(rows)
    assert got == ordered(want)
    assert 1 <= work.copies <= n


def test_recompression_is_consistent():
    """Equal stretches get equal symbols where their settling stretch is inside."""
    rng = np.random.default_rng(3)
    shared = rng.integers(1, 40, 120, dtype=np.uint64)
    parses = []
    for k in range(2):
        pre, post = (rng.integers(1, 40, 30 + 9 * k, dtype=np.uint64) for _ in range(2))
        names = np.concatenate([pre, shared, post])
        n = len(names)
        levels = recompress.parse(names, np.zeros(n, dtype=np.int64), np.array([0]), np.array([n]))
        a = len(pre)
        parses.append([{(int(s.at[i] - a), int(s.name[i])) for i in range(len(s)) if s.lo[i] >= a and s.hi[i] <= a + 120} for s in levels])
    assert all(x == y and x for x, y in zip(*parses))


def test_near_duplicates(messy, texts, work):
    found = minhash.near_duplicates(messy, work)
    assert rows_of(found, "doc_id", "n_shingles", "component_id", "kept") == ordered(brute.near_duplicates(texts))


def test_near_duplicates_of_nothing(nothing, work):
    assert minhash.near_duplicates(nothing, work).count() == 0
    assert minhash.keep_one(nothing, work).columns == nothing.columns


def test_keep_one_keeps_columns_and_one_of_each(messy, texts, work):
    kept = minhash.keep_one(messy, work)
    assert kept.columns == messy.columns
    got = [r.text for r in kept.collect()]
    blank = sum(not brute.words(t) for _, t, _ in texts)
    parts = brute.near_duplicates(texts)
    named = {p[2] for p, (_, t, _) in zip(parts, texts) if brute.words(t) and p[2] is not None}
    assert sum(not brute.words(t) for t in got) == blank
    assert len(got) - blank >= len(named)


def test_bounded_units_agree_with_all_pairs():
    """A group cut into several blocks gives the same components as one."""
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(1, 1 << 62, 200, dtype=np.uint64))
    sets = []
    for i in range(60):
        s = base.copy()
        s[rng.choice(len(s), i // 2, replace=False)] = rng.integers(1, 1 << 62, i // 2, dtype=np.uint64)
        sets.append(np.unique(s))
    sigs = np.array([minhash.signature(s) for s in sets])
    one = minhash.count_and_confirm(sigs, sets, np.zeros(60, dtype=int), 32, 75)
    left, right = list(range(0, 60, 2)), list(range(1, 60, 2))
    cut = []
    for ids, side in ((left, [0] * 30), (right, [0] * 30), (left + right, [0] * 30 + [1] * 30)):
        found = minhash.count_and_confirm(sigs[ids], [sets[i] for i in ids], np.array(side), 32, 75)
        cut += [(ids[a], ids[b]) for a, b in found]

    def parts(links):
        name = list(range(60))
        for a, b in links:
            lo, hi = sorted((name[a], name[b]))
            name = [lo if x == hi else x for x in name]
        return name

    assert parts(one) == parts(cut)


def test_long_near_copies_leave_blocks_empty(spark, monkeypatch):
    """Groups of few but long texts have more blocks than nodes in some, so
    units with an empty side are met."""
    from basketry.llm.common import Workspace
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 200)
    rows = []
    for g in range(12):
        words = [f"w{g}x{k}" for k in range(250)]
        for c in range(2 + g % 3):
            rows.append((10 * g + c, " ".join(words[:-1] + [f"end{c}"]), "s"))
    got = minhash.near_duplicates(frame(spark, rows), Workspace(spark, "long"))
    assert ordered(map(tuple, got.collect())) == ordered(brute.near_duplicates(rows))


def test_pair_at_the_threshold_with_few_agreements(spark):
    """Two texts of similarity 0.75 exactly whose own ends hold the least
    value of so many coordinates that fewer than half of them agree."""
    from basketry.llm.common import Workspace
    rnd = np.random.default_rng(3)
    common = [f"c{k}" for k in range(28)]  # 24 shingles; each end adds 4

    def sketches(tails):
        return np.array([minhash.signature(x) for x in minhash.shingle_sets([" ".join(common + t) for t in tails])])

    def away(target, least):
        """An end, word by word, with few agreements (at least ``least``)."""
        end = []
        for _ in range(4):
            tails = [end + [f"e{x}"] for x in rnd.integers(0, 1 << 40, 2000)]
            agree = (sketches(tails) == target).sum(axis=1)
            end = tails[int(np.argmin(np.where(agree < least, 99, agree)))]
        return end

    first = away(sketches([[]])[0], 0)
    second = away(sketches([first])[0], 27)
    assert 26 <= (sketches([first]) == sketches([second])).sum() < 32
    rows = [(1, " ".join(common + first), "s"), (2, " ".join(common + second), "s")]
    got = minhash.near_duplicates(frame(spark, rows), Workspace(spark, "few"))
    want = brute.near_duplicates(rows)
    assert [w[2] for w in want] == [1, 1]
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == ordered(want)


def test_secret_base(messy, texts):
    got = secrets.scan_documents(messy)
    want = [(i, *brute.secrets(t)) for i, t, _ in texts]
    want = [(i, a, b, c, hashlib.sha256(s.encode()).hexdigest()) for i, a, b, c, s in want]
    assert rows_of(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == ordered(want)


def test_secret_lexer_follows_constants():
    text = "const v = 'Zx81-kkQ9-vv20-TTea';\nauth_token = v\n{\"clientCredential\": \"q8Jd72hsKKd0\"}\nname = 'plainvalue'"
    found = [text[s.start:s.end] for s in secrets.scan_text(text) if s.kind == "lexed"]
    assert found == ["Zx81-kkQ9-vv20-TTea", "q8Jd72hsKKd0"]
    assert secrets.scan_text("db_password: 'changeme'") == []
    assert secrets.redact_text("x password=abcdefabcdef12 y") == "x [REDACTED] y"
    assert secrets.redact_text(None) is None and secrets.redact_text("") == ""


def lexed(text):
    return [text[s.start:s.end] for s in secrets.scan_text(text) if s.kind == "lexed"]


def test_secret_lexer_joins_names_and_adjacent_literals():
    assert lexed('api_secret = prefix + "q8Jd72hsKKd0Zx81"') == ["q8Jd72hsKKd0Zx81"]
    assert lexed('api_secret = prefix+"q8Jd72hsKKd0Zx81"') == ["q8Jd72hsKKd0Zx81"]
    assert lexed("p = 'Zx81-kkQ9'\nauth_token = p + '-vv20-TTea'") == ["Zx81-kkQ9", "-vv20-TTea"]
    assert lexed("p = 'TTea'\nauth_token = 'Zx81-kkQ9-' + p") == ["TTea", "Zx81-kkQ9-"]
    assert lexed("auth_token = 'Zx81-' 'kkQ9-' 'vv20'") == ["Zx81-", "kkQ9-", "vv20"]
    assert lexed("auth_token = f'Zx81-kkQ9-vv20'") == ["Zx81-kkQ9-vv20"]
    # what stood alone before, and pairs inside a literal that follows, are still found
    assert lexed("clientCredential: q8Jd72hsKKd0 'note'") == ["q8Jd72hsKKd0"]
    assert lexed("note: see 'clientCredential = Zx81-kkQ9-vv20'") == ["Zx81-kkQ9-vv20"]


def test_secret_lexer_scores_phrases():
    assert lexed('passphrase = "correct horse battery staple"') == ["correct horse battery staple"]
    assert lexed('{"db_password": "p@ss w0rd"}') == ["p@ss w0rd"]
    assert lexed('auth_token = "correct horse battery staple"') == []


def test_secret_lexer_bounds_built_values():
    assert lexed("a = 'Zx81-kkQ9'\n" + "a = a + a\n" * 300 + "auth_token = a") == ["Zx81-kkQ9"]
    steps = "".join(f"a = a + 'k{i}'\n" for i in range(3000))
    assert len(lexed("a = 'Zx81-kkQ9'\n" + steps + "auth_token = a\nauth_token = a")) == 3001


def test_redact_keeps_rows_and_columns(messy, texts, nothing):
    out = secrets.redact(messy)
    assert out.columns == messy.columns and out.count() == len(texts)
    assert out.where("text is not null and n_chars <> length(text)").count() == 0
    assert secrets.redact(nothing).count() == 0
    assert secrets.scan_documents(nothing).count() == 0


def test_quality_base(messy, texts, nothing):
    got = quality.judge(messy, quality.PRIOR)
    want = [(i, *brute.quality(t)) for i, t, _ in texts]
    assert rows_of(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == ordered(want)
    assert got.where("base_failed and kept").count() == 0
    assert quality.judge(nothing, quality.PRIOR).count() == 0
    kept = quality.keep_good(messy, quality.PRIOR)
    assert kept.columns == messy.columns
    assert kept.count() == got.where("kept").count()


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(5)
    x = rng.random((7, len(quality.FEATURES)))
    crf = quality.Crf(rng.normal(size=(2, x.shape[1])), rng.normal(size=(2, 2)), rng.normal(size=2))

    def score(path):
        s = crf.first[path[0]] + sum(float(crf.emit[p] @ f) for p, f in zip(path, x))
        return s + sum(crf.move[a, b] for a, b in zip(path, path[1:]))

    paths = [tuple((k >> i) & 1 for i in range(7)) for k in range(128)]
    assert tuple(quality.viterbi(crf, x)) == max(paths, key=score)


def test_bpe_round_trip(messy, texts, nothing, library):
    got = bpe.digests(bpe.round_trip(messy, PATH))
    want = []
    for i, t, _ in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == ordered(want)
    assert bpe.round_trip(nothing, PATH).count() == 0
    coded = bpe.encode(messy, PATH)
    back = {(r.doc_id, r.text) for r in bpe.decode(coded, PATH).collect()}
    assert back == {(i, t or "") for i, t, _ in texts}


def test_bpe_matches_library_on_odd_texts(library):
    odd = ["", " ", "  ", " a", "a  b   c \n\n d\t e ", "x  y\u0085z \x1c q", "I'll 's 'S don't", "日本語 текст 𝔘𝔫𝔦 🙂🙂",
           "\0 \0a", "a" * 3000, "1234567890" * 40, "<|endoftext|><|endoftext|> x"]
    own = bpe.load(PATH)
    for t in odd:
        ids = library.encode(t, add_special_tokens=False).ids
        packed = own.encode([t])[0]
        assert np.frombuffer(packed, "<u4").tolist() == ids, repr(t[:40])
        assert own.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_token_files(messy, texts, nothing, work, library):
    manifest = tokenfile.write(messy, PATH, 2, work)
    got = tokenfile.read(manifest).collect()
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start = [], 0
    for i, t, _ in order:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        want.append((start, i, zlib.crc32(ids)))
        start += len(ids) // 4
    assert sorted((r.start, r.doc_id, zlib.crc32(bytes(r.ids))) for r in got) == want
    some = tokenfile.read(manifest, wanted={5, 71}).collect()
    assert {r.doc_id for r in some} == {5, 71}
    path = manifest.orderBy("file_no").first().path.removeprefix("file:")
    data = open(path, "rb").read()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    n = manifest.orderBy("file_no").first().n_tokens
    assert len(plain) == 2 * n  # any zstandard reader can read the whole file


def test_token_files_of_nothing(nothing, work):
    manifest = tokenfile.write(nothing, PATH, 2, work)
    assert manifest.count() == 0 and tokenfile.read(manifest).count() == 0


def test_token_file_reads_only_wanted_frames_and_checks_them():
    out = io.BytesIO()
    w = tokenfile.FrameWriter(out, 4, frame_ids=10)
    docs = {k: np.arange(k, k + 7, dtype="<u4").tobytes() for k in range(20)}
    for k, packed in docs.items():
        w.add(k, packed)
    w.add(99, b"")
    w.close()
    reader = tokenfile.read_stream(out.getvalue())
    read = []
    frame = reader.frame
    reader.frame = lambda k: (read.append(k), frame(k))[1]
    assert [(i, p) for _, i, _, p in reader.documents(wanted={13})] == [(13, docs[13])] and len(read) == 1
    assert [p for *_, p in reader.documents()] == [*docs.values(), b""]
    broken = bytearray(out.getvalue())
    broken[6] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(tokenfile.read_stream(bytes(broken)).documents())
    assert struct.unpack("<I", out.getvalue()[-4:])[0] == tokenfile.SEEKABLE_MAGIC
