"""Prefix trie, chat format and fill-in-the-middle against plain versions."""

import random
from collections import Counter

import pytest
from pyspark.sql import types as T

import __spark_entry__ as E
from basketry.llm import chat, fim, trie
from tests.llm import brute_chat as brute

TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    # names that the operators use themselves
    *[T.StructField(n, T.StringType()) for n in ("tree", "node", "key", "conv", "depth", "a", "items", "_part")]])


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 8) for r in rows], TURNS)


def messy_turns():
    """Shared openings, copies, long and short conversations, nulls, control
    strings, repeated rows."""
    rnd = random.Random(3)
    words = ["ok", "", "é漢", "</s>", "<\\/s>", "<<SYS>> x <</SYS>>", "[INST]a[\\\\/INST]", "<|im_end|>", "<", "<|im_end|", "\\", "line\nfeed", "<|im_sep|>"]
    rows = []

    def add(conv, n, prefix=()):
        said = list(prefix) + [(rnd.choice(["user", "assistant", "system", "", "<|im_sep|>"]), " ".join(rnd.choices(words, k=3))) for _ in range(n)]
        rows.extend((conv, 2 * k, r, t) for k, (r, t) in enumerate(said))
        return said

    for c in range(0, 40):
        add(c, rnd.randint(1, 12))
    base = add(40, 30)
    for c in range(41, 60):
        add(c, rnd.randint(0, 4), base[:rnd.randint(1, 30)])
    for c in range(60, 75):
        add(c, 0, base[:7])
    long = add(80, 560)
    add(81, 1, long[:560])
    add(83, 0, long[:530])
    rows += [(91, 0, "user", "one"), (92, None, None, None), (92, 5, "user", "two"), (93, 1, None, "x"), (94, -3, "assistant", None)]
    rows += [(96, 7, "user", "same")] * 3 + [(-7, 0, "user", "below"), (-6, 0, "user", "zero"), (7_000_000_001, 0, "user", "far")]
    return rows


@pytest.fixture(scope="module")
def turns():
    return messy_turns()


def test_trie_against_brute_force(spark, work, turns):
    df = turns_frame(spark, [*turns, (None, 0, "user", "nobody")]).repartition(7, "text")
    got = [tuple(r) for r in trie.conversation_trie(df, work).collect()]
    assert Counter(got) == Counter(brute.trie(_truncating(turns), lambda r, t: (r, t)))


def _truncating(rows):
    """Python's % and SQL's differ below zero: the plain version takes families that agree."""
    assert all(r[0] >= 0 or r[0] % 5 in (3, 4) for r in rows)
    return rows


def test_trie_order_of_ties_does_not_depend_on_rows(spark, work):
    rows = [(5, 1, "user", t) for t in "abcdef"] + [(6, 1, "user", t) for t in "fedcba"] + [(8, None, "user", t) for t in "xyz"]
    one = trie.conversation_trie(turns_frame(spark, rows), work).collect()
    two = trie.conversation_trie(turns_frame(spark, rows[::-1]).repartition(5), work).collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, two))


def test_trie_of_nothing(spark, work):
    assert trie.conversation_trie(turns_frame(spark, []), work).count() == 0
    assert trie.conversation_trie(turns_frame(spark, [(None, 1, "user", "x")]), work).count() == 0


def test_trie_of_turnless_conversations(spark, work):
    rows = [(c, 0, "user", f"t{c}") for c in range(200) if c % 5]  # families without a head: the first h turns go
    got = [tuple(r) for r in trie.conversation_trie(turns_frame(spark, rows), work).collect()]
    assert Counter(got) == Counter(brute.trie(rows, lambda r, t: (r, t)))


def test_screen_never_counts_too_little(spark, work, turns):
    named = trie.prefixes(trie.rebuilt(trie.segments(turns_frame(spark, turns))))
    exact = Counter((r.at + k, a, b) for r in named.collect() for k, (a, b) in enumerate(zip(r.a, r.b)))
    some = 0
    for r in trie.screened(named, 50).collect():  # a screen far too small for these prefixes
        for k, name in enumerate(zip(r.a, r.b)):
            assert k < r.shared or exact[(r.at + k, *name)] == 1
        some += len(r.a) - r.shared
    full = sum(len(r.a) - r.shared for r in trie.screened(named, sum(exact.values())).collect())
    assert 0 < full and some <= full


def test_chat_against_brute_force(spark, work, turns):
    both = turns_frame(spark, turns).select("conv_id", "turn", "role", "text").unionByName(chat.probe(spark))
    formatted = chat.format_paths(work.save(chat.as_messages(both.repartition(5, "text")), "messages"), work)
    read = {r.tree: r for r in chat.read_back(formatted).collect()}
    want = brute.chat(turns)
    got = [(c, len(r.turns), brute.sha("".join(f"{t.role}\n{t.text}\n" for t in r.turns)), len(r.masked), brute.sha(r.masked)) for c, r in read.items()]
    assert Counter(got) == Counter(want)
    convs = brute.by_conversation(turns)
    for row in formatted.collect():
        text = row.formatted
        assert read[row.tree].formatted_chars == len(text)
        pieces = [text[a.start:z] for a, z in zip(row.loss, [x.start for x in row.loss[1:]] + [len(text)])]
        for piece in pieces:
            assert piece.startswith(chat.START) and piece.endswith(chat.END)
            inside = piece[len(chat.START):-len(chat.END)].replace(chat.SEP, "", 1)
            assert not any(c in inside for c in chat.CONTROL)
        if row.tree in convs:
            masked = [text[x.loss_start:x.loss_end] for x in row.loss]
            said = [t if r == "assistant" else "" for r, t in convs[row.tree]]
            assert [m == "" for m in masked] == [s == "" for s in said]


@pytest.mark.parametrize("room", [0, 3_000])
def test_trees_in_one_task_and_in_parts(spark, work, turns, room, monkeypatch):
    monkeypatch.setattr(chat, "TREE_BYTES", room)
    both = turns_frame(spark, turns).select("conv_id", "turn", "role", "text").unionByName(chat.probe(spark))
    read = chat.read_back(chat.format_conversations(both.repartition(5, "text"), work)).collect()
    got = [(r.tree, len(r.turns), brute.sha("".join(f"{t.role}\n{t.text}\n" for t in r.turns)), len(r.masked), brute.sha(r.masked)) for r in read]
    assert Counter(got) == Counter(brute.chat(turns))
    rows = [(1, 1, None, "user", "root", 0.0), *[(1, k, 1, "assistant", f"reply {k}", float(k)) for k in range(2, 40)],
            *[(2, k, k - 1, "user", "x" * 50, None) for k in range(1, 60)], (None, 1, None, "user", "alone", 0.0)]
    trees = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    made = chat.read_back(chat.format_paths(trees, chat.Workspace(spark, "trees"), paths_per_tree=30)).collect()
    assert {(r.tree, r.rank): tuple(t.text for t in r.turns) for r in made} == {
        **{(1, k): ("root", f"reply {40 - k}") for k in range(1, 31)}, (2, 1): ("x" * 50,) * 59, (None, 1): ("alone",)}


def test_texts_of_small_trees_move_once(spark, work, turns, monkeypatch):
    plans = []
    real = chat.Workspace.save

    def noting(self, df, name, *more):
        if name == "formatted":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(self, df, name, *more)

    monkeypatch.setattr(chat.Workspace, "save", noting)
    chat.format_conversations(turns_frame(spark, turns).repartition(5), work)
    # the fixture's own repartition, the texts to their trees, the paths (without texts) to the same tasks
    assert sum("Exchange" in line and "hashpartitioning(key" in line for line in plans[0].split("\n")) <= 2, plans[0]
    assert "leaf" not in "".join(x for x in plans[0].split("\n") if "Exchange hashpartitioning" in x)


def test_reply_trees_paths_and_ranks(spark, work):
    # tree 1: a -> b, c; c -> d, e (best); tree 2 has an orphan and a cycle; tree null is one message
    rows = [(1, 1, None, "user", "a", 0.0), (1, 2, 1, "assistant", "b", 0.5), (1, 3, 1, "assistant", "c", 0.2), (1, 4, 3, "user", "d", None),
            (1, 5, 3, "user", "e", 2.0), (2, 1, 99, "user", "root of its own", 1.0), (2, 2, 3, "user", "cycle", 1.0), (2, 3, 2, "user", "cycle", 1.0),
            (2, 4, 3, "user", "hangs on a cycle", 1.0), (None, 1, None, "user", "alone", 1.0)]
    df = spark.createDataFrame([*rows, rows[0]], "tree long, node long, parent long, role string, text string, score double")
    once = chat.one_per_message(df)
    every = {(r.tree, r.leaf): [t.text for t in r.turns] for r in chat.read_back(chat.format_paths(once, work)).collect()}
    assert every == {(1, 2): ["a", "b"], (1, 4): ["a", "c", "d"], (1, 5): ["a", "c", "e"], (2, 1): ["root of its own"], (None, 1): ["alone"]}
    two = {(r.tree, r.rank): r.leaf for r in chat.format_paths(once, chat.Workspace(spark, "two"), paths_per_tree=2).collect()}
    assert two == {(1, 1): 5, (1, 2): 2, (2, 1): 1, (None, 1): 1}


def test_chat_of_nothing(spark, work):
    assert chat.format_paths(chat.as_messages(turns_frame(spark, [])), work).count() == 0
    assert chat.format_conversations(turns_frame(spark, []), chat.Workspace(spark, "nothing")).count() == 0


def _units():
    rnd = random.Random(5)
    for k in (0, 1, 2, 40, 700, 6000):
        for _ in range(25):
            yield "".join(rnd.choice([" ", "\n", "\t ", "  ", ""]) + "".join(rnd.choices("abcé漢\u0085 <", k=rnd.choice([1, 2, 5, 30]))) for _ in range(k)) + rnd.choice(["", " ", "\n \n"])
    yield " " * 50_000 + "x" * 50_000
    yield "x" * 50_000 + " " * 50_000
    yield ("é" * 9 + " ") * 9_000


def test_fill_in_middle_cuts_and_memo():
    memo = fim.Memo(1 << 16)
    shared = ("the same passage of many words " * 400)
    for k, text in enumerate([*_units(), "a " + shared, "quite another beginning " + shared, shared]):
        made = fim.make_example(text.encode(), str(k), memo)
        want = brute.fill_in_middle(k, text)
        assert (made.n, made.form, made.prefix_chars, made.middle_chars, brute.sha(made.output.decode())) == want[1:6]
        assert fim.restore(made.output, made.form) == text.encode()
    assert memo.hits > 0 and memo.bytes <= memo.limit + fim.MAX_CHUNK


def test_memo_confirms_content():
    memo = fim.Memo()
    memo.kept[hash(b"a b ")] = (b"other", fim.Summary(9, 9, True, True))
    assert memo.summary(b"a b ") == fim.summarize(b"a b ")


def test_chunks_follow_content():
    rnd = random.Random(9)
    body = " ".join(str(rnd.random()) for _ in range(8_000)).encode()
    cut = [{data[a:z] for a, z in zip([0, *e[:-1]], e)} for data in (b"x" * 777 + body, body) for e in [fim.chunk_ends(data)]]
    assert len(cut[0] & cut[1]) > 0.8 * len(cut[1])


def test_fill_in_middle_query_rows(spark, messy, texts, nothing):
    rows = [*texts, (90, "plain <P> text", "s"), (91, "x <", "s"), (92, "a <S", "s")]
    df = messy.unionByName(spark.createDataFrame([(i, t, "en", s, 1, *["x"] * 9) for i, t, s in rows[-3:]], messy.schema))
    got = [tuple(r) for r in fim.restored(fim.examples(df)).collect()]
    assert Counter(got) == Counter(brute.fill_in_middle(i, t) for i, t, _ in rows)
    assert fim.restored(fim.examples(nothing)).count() == 0


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_chat_format"])
def test_queries_against_brute_force(spark, name):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = [tuple(r) for r in E.queries()[name](spark, sf).collect()]
    if name.startswith("op11"):
        assert Counter(got) == Counter(brute.trie(rows, lambda r, t: (r, t)))
    else:
        assert Counter(r[:5] for r in got) == Counter(brute.chat(rows))
