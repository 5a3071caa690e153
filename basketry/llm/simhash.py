"""Document fingerprints by SimHash, with permuted block tables for search.

A text's terms are its words and its pairs of adjacent words; pairs weigh more
because they tell texts apart. Every occurrence of a term votes with its weight
on each of ``BITS`` signed bits of the term's hash, and a bit of the
fingerprint is set where its votes are positive.

Everything runs on DataFrame functions. Words become arrays of hashes that are
exploded (two longs a row) and summed again in the same task; the votes of two
bits travel in one long as 32-bit counters, which no text that fits in a
string can overflow. A text without words has no votes and the all-zero
fingerprint, so all such texts are equal.

``with_next`` finds each row's successor in a global order: rows are bucketed
on quantiles of the id, a window inside each bucket finds the next row, and the
last row of a bucket gets the first of the next one (after the last: the very
first). That is the only shuffle of texts; votes and fingerprints are summed in
the same buckets.

``within_radius`` finds fingerprints within a Hamming radius: the digits are cut
into radius + 1 blocks, and two fingerprints within the radius agree on at
least one whole block, so a table per block (the fingerprint permuted to lead
with that block) holds every partner under an equal key. Equal fingerprints
are merged before and carry their count; a pair is reported by the first block
on which it agrees.

Null texts count as empty, null ids come first, equal ids are ordered by the
hash of their text. Repeated rows each get a result. A single row is its own
successor; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import SPACE_CLASS, Workspace, partitions, text_or_empty

BITS = 128
PAIR_WEIGHT, WORD_WEIGHT = 2, 1
SEEDS = (17, 91)               # one 64-bit hash per half of the fingerprint
LANE_MASK = 0x0000000100000001  # bits j and j + 32


def word_hashes(text: Column) -> Column:
    """Hashes of a text's words in order."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def fingerprints(df: DataFrame, keys: list[str], texts: dict[str, str]) -> DataFrame:
    """``keys`` and, for every ``text column: name`` of ``texts``, a string of
    ``BITS / 4`` hex digits. ``keys`` tell the rows of ``df`` apart; where
    ``df`` is already partitioned by some of them nothing is shuffled."""
    which = F.array(*[F.struct(F.lit(i).alias("i"), word_hashes(F.col(c)).alias("h")) for i, c in enumerate(texts)])
    each = df.select(*keys, F.explode(which).alias("_t")).select(*keys, F.col("_t.i").alias("_i"), F.col("_t.h").alias("_h"))
    # one row per word: it votes for itself and for the pair that ends there
    terms = F.transform(F.col("_h"), lambda h, i: F.struct(F.get(F.col("_h"), i - 1).alias("before"), h.alias("word")))
    rows = (each.select(*keys, "_i", F.explode_outer(terms).alias("_t"))
            .select(*keys, "_i", F.col("_t.before").alias("_before"), F.col("_t.word").alias("_word")))
    one = F.lit(0).cast("long")
    votes = rows.select(
        *keys, "_i",
        (F.when(F.col("_word").isNull(), 0).otherwise(WORD_WEIGHT)
         + F.when(F.col("_before").isNull(), 0).otherwise(PAIR_WEIGHT)).cast("long").alias("_weight"),
        *[F.when(F.col("_word").isNull(), one).otherwise(F.xxhash64("_word", F.lit(s))).alias(f"_w{s}") for s in SEEDS],
        *[F.when(F.col("_before").isNull(), one).otherwise(F.xxhash64("_before", "_word", F.lit(s))).alias(f"_p{s}")
          for s in SEEDS])

    def lanes(name: str, j: int) -> Column:
        return F.shiftrightunsigned(F.col(name), j).bitwiseAND(F.lit(LANE_MASK))

    sums = [F.sum(lanes(f"_w{s}", j) * WORD_WEIGHT + lanes(f"_p{s}", j) * PAIR_WEIGHT).alias(f"_v{s}_{j}")
            for s in SEEDS for j in range(32)]
    counted = votes.groupBy(*keys, "_i").agg(F.sum("_weight").alias("_total"), *sums)

    def half(s: int) -> Column:
        bits = []
        for j in range(32):
            packed = F.col(f"_v{s}_{j}")
            for at, count in ((j, packed.bitwiseAND(F.lit(0xFFFFFFFF))), (j + 32, F.shiftrightunsigned(packed, 32))):
                bits.append(F.when(2 * count > F.col("_total"), F.shiftleft(F.lit(1).cast("long"), at)).otherwise(one))
        return F.lpad(F.hex(reduce(lambda a, b: a.bitwiseOR(b), bits)), 16, "0")

    done = counted.select(*keys, "_i", F.lower(F.concat(*[half(s) for s in SEEDS])).alias("_fp"))
    return done.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.col("_fp"))).alias(name)
                                     for i, name in enumerate(texts.values())])


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two hex fingerprints."""
    out = F.lit(0)
    for i in range(1, BITS // 4, 8):
        x, y = (F.conv(F.substring(c, i, 8), 16, 10).cast("long") for c in (a, b))
        out = out + F.bit_count(x.bitwiseXOR(y))
    return out


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - hamming(a, b) / F.lit(float(BITS))


def with_buckets(df: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """``bucket, doc_id, text, place`` with buckets on quantiles of the id."""
    key = F.col(id_col).cast("double")
    edges = df.agg(F.percentile_approx(key, [i / buckets for i in range(1, buckets)], 100 * buckets)).first()[0] if buckets > 1 else None
    edges = sorted(set(edges or []))
    array = F.array(*[F.lit(float(e)) for e in edges]) if edges else F.array().cast("array<double>")
    bucket = F.when(F.col(id_col).isNull(), -1).otherwise(
        F.aggregate(array, F.lit(0), lambda n, e: n + F.when(e < key, 1).otherwise(0)))
    return df.select(bucket.alias("bucket"), F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"),
                     F.xxhash64(text_or_empty(text_col)).alias("place"))


def with_next(df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text",
              buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, heads): ``rows`` has ``bucket, pos, doc_id, text, next_text`` for
    each row of ``df``; ``heads`` has, per bucket, the first text after it."""
    placed = with_buckets(df, id_col, text_col, buckets or partitions(df.sparkSession))
    least = placed.groupBy("bucket").agg(F.min(F.struct("doc_id", "place")).alias("_least"))
    # the order of buckets is a table of one row per bucket; a null id is below all in a struct as well
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = (least.withColumn("before", F.lag("bucket").over(Window.orderBy("bucket")))
             .withColumn("before", F.coalesce("before", F.last("bucket").over(everything)))
             .select(F.col("bucket").alias("_b"), F.col("_least.doc_id").alias("_d"), F.col("_least.place").alias("_p"), "before"))
    heads = work.save(
        placed.join(after, (F.col("bucket") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("_d"))
                    & (F.col("place") == F.col("_p")))
        .groupBy(F.col("before").alias("bucket")).agg(F.first("text").alias("head")), "heads")
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").asc_nulls_first(), "place")
    rows = (placed.withColumn("pos", F.row_number().over(order)).withColumn("_lead", F.lead("text").over(order))
            .join(heads, "bucket").withColumn("next_text", F.coalesce("_lead", "head"))
            .select("bucket", "pos", "doc_id", "text", "next_text"))
    return rows, heads


def compare_with_edits(df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text (the last quarter of the code
    points replaced by the first as many of the next row's text), and compare
    it with the edited text's and the next row's fingerprint."""
    rows, heads = with_next(df, work, id_col, text_col)
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - quarter), F.col("next_text").substr(F.lit(1), quarter))
    rows = rows.select("bucket", "pos", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    keys = ["bucket", "pos", "doc_id", "n_chars", "edited_sha256"]
    done = fingerprints(rows, keys, {"text": "fingerprint", "edited": "edited_fingerprint"})
    head_prints = fingerprints(heads, ["bucket"], {"head": "_head"})
    follow = Window.partitionBy("bucket").orderBy("pos")
    return (done.withColumn("_lead", F.lead("fingerprint").over(follow)).join(head_prints, "bucket")
            .withColumn("_next", F.coalesce("_lead", "_head"))
            .select(F.col("doc_id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("_next")).alias("near_next")))


def with_neighbours(prints: DataFrame, queries, radius: int = 3) -> DataFrame:
    """``prints`` (a table with ``fingerprint``) and ``n_within``: for rows where
    the condition ``queries`` holds, the rows of the whole table within
    ``radius`` bits of theirs, themselves included; null for other rows."""
    found = within_radius(prints.where(queries), prints, radius)
    counts = found.groupBy(F.col("fingerprint").alias("_fp")).agg(F.sum("n_rows").alias("_n"))
    return (prints.join(counts, prints["fingerprint"] == counts["_fp"], "left")
            .withColumn("n_within", F.when(queries, F.col("_n"))).drop("_fp", "_n"))


def block_table(prints: DataFrame, radius: int, col: str = "fingerprint") -> DataFrame:
    """``col`` once per block of its digits: ``block, key``, and the row."""
    digits = BITS // 4
    cuts = [digits * i // (radius + 1) for i in range(radius + 2)]
    keys = [F.struct(F.lit(i).alias("block"), F.col(col).substr(a + 1, b - a).alias("key"))
            for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return prints.withColumn("_k", F.explode(F.array(*keys))).select("*", "_k.block", "_k.key").drop("_k")


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3, col: str = "fingerprint") -> DataFrame:
    """``fingerprint, match, distance, n_rows`` for every distinct fingerprint
    of ``queries`` and every distinct one of ``index`` (with its row count)
    within ``radius`` bits. Null fingerprints match nothing."""
    if not 0 <= radius < BITS // 4:
        raise ValueError(f"radius must be between 0 and {BITS // 4 - 1}")
    q = queries.where(F.col(col).isNotNull()).select(F.col(col).alias("fingerprint")).distinct()
    x = index.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("match")).agg(F.count(F.lit(1)).alias("n_rows"))
    pairs = block_table(q, radius).join(block_table(x, radius, "match"), ["block", "key"])
    digits = BITS // 4
    cuts = [digits * i // (radius + 1) for i in range(radius + 2)]
    first = F.coalesce(*[F.when(F.col("fingerprint").substr(a + 1, b - a) == F.col("match").substr(a + 1, b - a), i)
                         for i, (a, b) in enumerate(zip(cuts, cuts[1:]))])
    distance = hamming(F.col("fingerprint"), F.col("match"))
    return (pairs.where(F.col("block") == first).withColumn("distance", distance).where(F.col("distance") <= radius)
            .select("fingerprint", "match", "distance", "n_rows"))
