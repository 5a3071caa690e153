"""Repeated windows of fixed length, found through anchors.

A sequence (bytes or words) has a window at every place; every window chooses
an anchor inside itself from its own content alone, so equal windows choose
equal anchors at equal distances. A run of windows with the same anchor is one
row: the anchor's place, the least and greatest distance from window start to
anchor, and two names: ``core``, what all windows of the row contain, and
``hull``, the whole stretch they cover. Then in rounds of ever longer cores:

* rows whose core is shared by no other row are unique and leave;
* rows with equal cores and hulls repeat wholly: they are past the threshold
  and marked; one of them stays as witness where the core has other hulls;
* what is left is cut into canonical blocks of fewer windows, whose cores are
  longer, and ranked again; in the last round a row is a single window.

Rows are grouped by name with map-side combination and marked through a join
that adaptive execution can split, so a name that very many rows share is
never gathered in one task. Each round's rows are a written table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Workspace, ship_package

#: a row of the first round; ``at`` is the anchor's place in its document, and
#: ``tail`` the number of equal windows that follow a row's only one.
FIRST = "core long, hull long, doc long, rank long, at long, lo int, hi int, tail int"
LATER = FIRST + ", rep long"


def signed(names) -> np.ndarray:
    return np.asarray(names, dtype=np.uint64).view(np.int64)


def rank_round(rows: DataFrame, work: Workspace, name: str, before_only: bool) -> tuple[DataFrame, DataFrame]:
    """(marked, left) of a table of rows. ``before_only``: a row repeats if an
    equal one has a smaller ``rank``; otherwise if there is any other."""
    classes = rows.groupBy("core", "hull").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("least"),
                                               F.max("rank").alias("most"),
                                               F.min(F.struct("doc", "at", "lo")).alias("witness"))
    several = (classes.groupBy("core").agg(F.min("hull").alias("h0"), F.max("hull").alias("h1"))
               .where("h0 <> h1").select(F.col("core").alias("_c")))
    repeat = F.col("least") < F.col("most") if before_only else F.col("n") > 1
    classes = work.save(classes.join(several, F.col("core") == F.col("_c"), "left")
                        .withColumn("several", F.col("_c").isNotNull()).where(repeat | F.col("several"))
                        .select("core", "hull", "n", "least", "witness", "several"), f"{name}-classes")
    found = work.save(rows.join(classes, ["core", "hull"]).select(
        *[c for c in rows.columns if c not in ("core", "hull")], "several",
        ((F.col("rank") > F.col("least")) if before_only else (F.col("n") > 1)).alias("repeats"),
        ((F.col("rank") == F.col("least")) if before_only else
         (F.struct("doc", "at", "lo") == F.col("witness"))).alias("stays")), f"{name}-found")
    work.drop(f"{name}-classes")
    return found.where("repeats").select("doc", "at", "lo", "hi", "tail"), found.where("several and stays").drop("several", "repeats", "stays")


def split_blocks(reps: DataFrame, window: int, block: int, units: Callable[[list[bytes]], tuple[list[bytes], int]]) -> DataFrame:
    """Rows of the next round: every row of ``reps`` (``rep, doc, rank, at, lo,
    hi`` and ``context``, the bytes of its hull) in canonical blocks of
    ``block`` distances. ``units`` reads contexts as (unit strings, bytes a unit)."""
    def run(batches: Iterator[pa.RecordBatch]):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                rep, doc, rank, at, lo, hi, tail, chi, context = (part.column(i).to_pylist() for i in range(9))
                core, hull, src, los, his = [], [], [], [], []
                strings, size = units(context)
                for r, data in enumerate(strings):
                    base = chi[r]  # the context begins at distance chi before the anchor
                    for b in range(lo[r] // block, hi[r] // block + 1):
                        x0, x1 = max(lo[r], b * block), min(hi[r], b * block + block - 1)
                        s, e = base - b * block, base - (b + 1) * block + 1 + window
                        core.append(digest(data[s * size:e * size], b))
                        hull.append(digest(data[(base - x1) * size:(base - x0 + window) * size], 1 + x0 * 1024 + x1))
                        src.append(r)
                        los.append(x0)
                        his.append(x1)
                pick = lambda v, t: pa.array([v[i] for i in src], t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(core)), pa.array(signed(hull)), pick(doc, pa.int64()), pick(rank, pa.int64()),
                     pick(at, pa.int64()), pa.array(los, pa.int32()), pa.array(his, pa.int32()), pick(tail, pa.int32()), pick(rep, pa.int64())],
                    names=["core", "hull", "doc", "rank", "at", "lo", "hi", "tail", "rep"])

    ship_package(reps.sparkSession)
    return reps.select("rep", "doc", "rank", "at", "lo", "hi", "tail", "chi", "context").mapInArrow(run, LATER)


def repeated_spans(rows: DataFrame, texts: DataFrame, work: Workspace, window: int, blocks: tuple[int, ...],
                   before_only: bool, cut: Callable[[str], Callable[[int, int], bytes]],
                   units: Callable[[list[bytes]], tuple[list[bytes], int]]) -> DataFrame:
    """``doc, start, stop``: stretches of ``doc`` that windows which repeat
    cover (they may overlap). ``rows`` are first-round rows, ``texts`` has
    ``doc, text``; ``cut(text)(start, stop)`` gives the bytes of a stretch."""
    rows = work.save(rows, "round-0")
    marked, left = rank_round(rows, work, "round-0", before_only)
    work.drop("round-0")
    marks = [marked]

    # the stretches of what is left, each fetched once from a text; equal rows
    # are one doc: their witnesses are one stretch, and a task that meets several
    # of them in turn (the join sorts by doc) reads the first
    wanted = left.groupBy("doc").agg(F.collect_set(F.struct("rank", "at", "lo", "hi", "tail")).alias("rows"))
    fetch_from = texts.join(wanted, "doc").select("doc", "text", "rows")

    def fetch(batches: Iterator[pa.RecordBatch]):
        before = None
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                out = [[] for _ in range(7)]
                part = batch.slice(start, 256)
                for doc, text, own in zip(*(part.column(i).to_pylist() for i in range(3))):
                    if doc == before:
                        continue
                    before, stretch = doc, cut(text)
                    for w in own:
                        row = (doc, w["rank"], w["at"], w["lo"], w["hi"], w["tail"],
                               stretch(w["at"] - w["hi"], w["at"] - w["lo"] + window))
                        for col, v in zip(out, row):
                            col.append(v)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)],
                                                 names=["doc", "rank", "at", "lo", "hi", "tail", "context"])

    reps = work.save(fetch_from.mapInArrow(fetch, "doc long, rank long, at long, lo int, hi int, tail int, context binary")
                     .withColumn("rep", F.monotonically_increasing_id()), "contexts")
    own = reps.withColumnRenamed("hi", "chi").select("rep", "chi", "context")
    now = reps.withColumn("chi", F.col("hi"))
    for k, block in enumerate(blocks, 1):
        rows = work.save(split_blocks(now, window, block, units), f"round-{k}")
        marked, left = rank_round(rows, work, f"round-{k}", before_only)
        work.drop(f"round-{k}")
        marks.append(marked)
        now = left.join(own, "rep")
    spans = marks[0]
    for m in marks[1:]:
        spans = spans.unionAll(m)
    return spans.select("doc", (F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + F.col("tail") + window).alias("stop"))


def merged_runs(starts: list[int], stops: list[int]) -> list[tuple[int, int]]:
    """Maximal covered runs of stretches."""
    out: list[list[int]] = []
    for s, e in sorted(zip(starts, stops)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``texts`` rows (``doc`` and more) with arrays ``starts``, ``stops`` of
    their stretches, sorted (null where there are none)."""
    per = (spans.groupBy("doc").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("_s"))
           .select("doc", F.col("_s.start").alias("starts"), F.col("_s.stop").alias("stops")))
    return texts.join(per, "doc", "left")
