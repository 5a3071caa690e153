"""Many small fits in few scans.

* ``fold_gram`` - one scan gives the sufficient statistics of least squares for
  every fold (count, sums, products of all columns); every feature subset is then
  solved from its rows and columns, and ``trial_errors`` scores all trials of all
  folds in one more scan. The number of scans does not depend on the number of
  groups that a wrapper tries.
* ``batch_logistic`` - Newton steps (IRLS) of all (candidate, fold) pairs together:
  a scan sums their gradients and Hessians, the small systems are solved on the
  driver, converged pairs drop out. The objective is MLlib's: mean weighted log loss
  plus a ridge penalty on standardised coefficients.
* ``bin_cells`` - trees only see bins of columns, so rows are counted by the bins of
  every (set of columns, fold) in one scan and trees are fitted and scored on cells.
* ``run_trials`` - a bounded pool for fits that have to be jobs of their own; the
  first failure cancels the jobs of the others.

Tasks return one row of sums per pair, so what is shuffled and collected depends on
the number of pairs and columns, never on the number of rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import cut_lineage


def task_sums(df: DataFrame, start: Callable[[], object], add: Callable[[object, pa.RecordBatch], None],
              sums: Callable[[object], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Sums of arrays over all rows: every task keeps a state (``start``), takes in
    its batches (``add``) and returns named arrays (``sums``); equal names are added
    up by position. ``{}`` for an empty table."""
    def run(batches: Iterator[pa.RecordBatch]):
        state, rows = start(), 0
        for batch in batches:
            if batch.num_rows:
                rows += batch.num_rows
                add(state, batch)
        if rows:
            parts = sums(state)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(parts), pa.string()), pa.array([np.asarray(v, dtype=float).ravel() for v in parts.values()], pa.list_(pa.float64()))],
                names=["name", "sums"])

    parts = df.mapInArrow(run, "name string, sums array<double>").select("name", F.posexplode("sums").alias("place", "value"))
    total = parts.groupBy("name", "place").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = {}
    for name, values in total.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v")).select("name", "v.value").collect():
        out[name] = np.array(values)
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Equal-length arrays of doubles as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


# ---------------------------------------------------------------- least squares

@dataclass
class FoldGram:
    """Per fold ``[1, x..., y]`` products over its train rows."""
    features: list[str]
    products: dict[int, np.ndarray]

    def solve(self, fold: int, features: list[str], alpha: float) -> np.ndarray:
        """Coefficients over ``[1, all features]`` (0 for those left out) of a ridge
        fit with an unpenalised intercept."""
        out = np.zeros(len(self.features) + 1)
        m = self.products[fold]
        if not m[0, 0]:
            return out
        place = [1 + self.features.index(f) for f in features]
        mean, mean_y = m[0, place] / m[0, 0], m[0, -1] / m[0, 0]
        a = m[np.ix_(place, place)] - m[0, 0] * np.outer(mean, mean) + alpha * np.eye(len(place))
        b = m[place, -1] - m[0, 0] * mean * mean_y
        scale = 1.0 / np.sqrt(np.maximum(np.diag(a), 1e-300))  # columns of equal size solve well
        out[place] = scale * np.linalg.lstsq(a * np.outer(scale, scale), scale * b, rcond=None)[0]
        out[0] = mean_y - mean @ out[place]
        return out


@dataclass(frozen=True)
class Fold:
    """Train rows lie before ``origin``, test rows from it to ``test_end``."""
    fold: int
    origin: object
    test_end: object


def fold_list(folds: DataFrame) -> list[Fold]:
    return [Fold(r["fold"], r["origin"], r["test_end"]) for r in folds.select("fold", "origin", "test_end").orderBy("fold").collect()]


def complete_rows(df: DataFrame, date_col: str, features: list[str], target: str) -> DataFrame:
    """``day`` and ``x = [1, features, target]`` of the rows that have them all, so
    that all trials are fitted and scored on the same rows."""
    cols = [F.col(c).cast("double") for c in (*features, target)]
    kept = df.filter(F.col(date_col).isNotNull())
    for c in cols:
        kept = kept.filter(c.isNotNull())
    return kept.select(F.unix_date(F.col(date_col).cast("date")).alias("day"), F.array(F.lit(1.0), *cols).alias("x"))


def _day(value) -> int:
    import datetime
    return (value - datetime.date(1970, 1, 1)).days


def fold_gram(rows: DataFrame, features: list[str], folds: list[Fold]) -> FoldGram:
    """One scan of ``complete_rows``."""
    width = len(features) + 2
    origins = {f.fold: _day(f.origin) for f in folds}

    def add(state, batch):
        day, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
        for fold, origin in origins.items():
            part = x[day < origin]
            state[fold] += part.T @ part

    sums = task_sums(rows.select("day", "x"), lambda: {f: np.zeros((width, width)) for f in origins}, add,
                     lambda state: {str(f): v for f, v in state.items()})
    return FoldGram(features, {f: sums.get(str(f), np.zeros(width * width)).reshape(width, width) for f in origins})


def trial_errors(rows: DataFrame, folds: list[Fold], coefficients: dict[tuple[str, int], np.ndarray]) -> dict[tuple[str, int], tuple[float, float]]:
    """(sum of absolute errors, sum of absolute values) of every (trial, fold) on
    the fold's test rows, in one scan."""
    spans = {f.fold: (_day(f.origin), _day(f.test_end)) for f in folds}
    by_fold = {f: [t for t, g in coefficients if g == f] for f in spans}
    stacked = {f: np.stack([coefficients[t, f] for t in trials], axis=1) for f, trials in by_fold.items() if trials}

    def add(state, batch):
        day, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
        for fold, coef in stacked.items():
            lo, hi = spans[fold]
            part = x[(day >= lo) & (day <= hi)]
            state[fold][0] += np.abs(part[:, :-1] @ coef - part[:, -1:]).sum(axis=0)
            state[fold][1] += np.abs(part[:, -1]).sum()

    sums = task_sums(rows.select("day", "x"), lambda: {f: [np.zeros(c.shape[1]), np.zeros(1)] for f, c in stacked.items()}, add,
                     lambda state: {str(f): np.concatenate(v) for f, v in state.items()})
    return {(t, f): (float(sums[str(f)][i]), float(sums[str(f)][-1])) for f, trials in by_fold.items() if str(f) in sums for i, t in enumerate(trials)}


class SubsetTrials:
    """Mean rolling-origin WAPE of ridge fits on any feature subsets: one scan for
    the Gram table, one for every batch of subsets that is asked for."""

    def __init__(self, df: DataFrame, date_col: str, target: str, features: list[str], folds: DataFrame, alpha: float = 10.0):
        self.folds, self.alpha = fold_list(folds), alpha
        self.features = list(dict.fromkeys(features))
        self.rows = complete_rows(df, date_col, self.features, target)
        self.gram = fold_gram(self.rows, self.features, self.folds)
        self.scans = 1

    def wape(self, subsets: dict[str, list[str]]) -> dict[str, float]:
        coef = {(name, f.fold): self.gram.solve(f.fold, list(dict.fromkeys(subset)), self.alpha)
                for name, subset in subsets.items() for f in self.folds}
        errors = trial_errors(self.rows, self.folds, coef)
        self.scans += 1
        out = {}
        for name in subsets:
            ratios = [e / y for f in self.folds for e, y in [errors.get((name, f.fold), (0.0, 0.0))] if y]
            out[name] = sum(ratios) / len(ratios) if ratios else float("nan")
        return out


# ------------------------------------------------------------ logistic regression

@dataclass
class LogisticFit:
    features: list[str]
    coefficients: np.ndarray
    intercept: float
    iterations: int
    converged: bool


def long_folds(folds: list[tuple], label: str, weight: str | None, role: str = "train") -> tuple[DataFrame, dict[int, list[str]]]:
    """Frames of prepared folds ``(fold, train, validation, columns)`` as one:
    ``fold, label, weight, x`` (all columns of the fold), and the columns per fold."""
    parts = []
    for fold, train, valid, columns in folds:
        frame = train if role == "train" else valid
        w = F.col(weight).cast("double") if weight and role == "train" else F.lit(1.0)
        x = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
        parts.append(frame.filter(F.col(label).isNotNull()).select(F.lit(int(fold)).alias("fold"), F.col(label).cast("double").alias("label"), w.alias("weight"), x.alias("x")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, {int(f): list(columns) for f, _, _, columns in folds}


def _by_fold(batch: pa.RecordBatch):
    fold = batch.column(0).to_numpy()
    for f in np.unique(fold):
        part = batch.filter(pa.array(fold == f))
        yield int(f), part.column(1).to_numpy(), part.column(2).to_numpy(), _matrix(part.column(3))


def _moments(rows: DataFrame, width: dict[int, int]) -> dict[int, np.ndarray]:
    """Per fold: weight sum, sum of squared weights, weighted sums of x and x^2."""
    def add(state, batch):
        for f, _, w, x in _by_fold(batch):
            state[f] += np.concatenate([[w.sum(), (w * w).sum()], w @ x, w @ (x * x)])

    sums = task_sums(rows, lambda: {f: np.zeros(2 + 2 * k) for f, k in width.items()}, add, lambda s: {str(f): v for f, v in s.items()})
    return {int(f): v for f, v in sums.items()}


def _deviation(moments: np.ndarray) -> np.ndarray:
    """Standard deviations as MLlib's summarizer has them (unbiased for weights)."""
    w, w2 = moments[:2]
    k = (len(moments) - 2) // 2
    mean, square = moments[2:2 + k] / w, moments[2 + k:] / w
    spread = np.maximum(square - mean * mean, 0.0) * w / max(w - w2 / w, 1e-300)
    spread[spread < 1e-14 * np.maximum(square, 1e-300)] = 0.0
    return np.sqrt(spread)


def equal_rows(df: DataFrame, columns: list[str], weight: str) -> DataFrame:
    """``df`` with one row per distinct values of ``columns`` and ``weight``, which
    becomes the sum of the weights: the same rows for every weighted loss, in a
    checkpoint that each step of a fit reads."""
    groups = df.groupBy(*[F.col(f"`{c}`") for c in columns], F.col(f"`{weight}`")).agg(F.count(F.lit(1)).alias("_n"))
    return cut_lineage(groups.withColumn(weight, F.col(f"`{weight}`") * F.col("_n")).drop("_n"))


def batch_logistic(rows: DataFrame, columns: dict[int, list[str]], candidates: list[dict], max_iter: int = 50,
                   tol: float = 1e-10, merge_equal: bool = False, first_rows: dict[int, "FoldRows"] | None = None) -> dict[tuple[int, int], LogisticFit]:
    """Fits of every candidate (``regParam``, optional ``features``: a subset of the
    fold's columns) on every fold of ``rows`` (``long_folds``). One scan for the
    moments, one per Newton step; a step that raises the objective is halved.
    ``merge_equal``: the steps read a table of distinct rows with summed weights (for
    few columns; its rows are shuffled once). ``first_rows`` (``fold_rows``) only say
    where the steps begin; all rows decide where they end."""
    moments = _moments(rows, {f: len(c) for f, c in columns.items()})
    if merge_equal:
        rows = equal_rows(rows, ["fold", "label", "x"], "weight").select("fold", "label", "weight", "x")
    pairs = {}
    for ci, candidate in enumerate(candidates):
        for f, names in columns.items():
            if f not in moments:
                continue
            deviation = _deviation(moments[f])
            wanted = set(candidate.get("features") or names)
            use = [i for i, n in enumerate(names) if n in wanted and deviation[i] > 0]  # constant columns keep 0
            pairs[ci, f] = {"use": use, "penalty": float(candidate.get("regParam", 0.0)) * np.concatenate([[0.0], deviation[use] ** 2]),
                            "beta": np.zeros(len(use) + 1), "step": None, "loss": np.inf, "w": moments[f][0], "iterations": 0, "done": False}
            if first_rows and f in first_rows:
                pairs[ci, f]["beta"] = _begin(pairs[ci, f], first_rows[f], tol)

    for _ in range(max_iter):
        active = {k: (p["use"], p["beta"]) for k, p in pairs.items() if not p["done"]}
        if not active:
            break
        for key, sums in _newton_sums(rows, active).items():
            _advance(pairs[key], sums, tol)
    out = {}
    for (ci, f), p in pairs.items():
        coef = np.zeros(len(columns[f]))
        coef[p["use"]] = p["beta"][1:]
        out[ci, f] = LogisticFit(columns[f], coef, float(p["beta"][0]), p["iterations"], p["done"])
    return out


def _loss_sums(y: np.ndarray, w: np.ndarray, x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Loss, gradient and Hessian of these rows."""
    xs = np.column_stack([np.ones(len(y)), x])
    z = xs @ beta
    p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
    loss = (w * (np.logaddexp(0.0, z) - y * z)).sum()
    hessian = xs.T @ (xs * (w * p * (1.0 - p))[:, None])
    return np.concatenate([[loss], xs.T @ (w * (p - y)), hessian.ravel()])


def _begin(pair: dict, rows: "FoldRows", tol: float) -> np.ndarray:
    """Coefficients fitted on a few rows of the fold, zeros if that does not converge."""
    trial = {**pair, "w": rows.weight.sum(), "beta": pair["beta"].copy()}
    x = rows.x[:, pair["use"]]
    for _ in range(20):
        if not trial["w"] > 0 or not np.isfinite(trial["beta"]).all():
            break
        _advance(trial, _loss_sums(rows.label, rows.weight, x, trial["beta"]), tol)
        if trial["done"]:
            return trial["beta"]
    return pair["beta"]


def _newton_sums(rows: DataFrame, active: dict) -> dict[tuple[int, int], np.ndarray]:
    """Per pair: loss, gradient and Hessian at its coefficients."""
    def add(state, batch):
        for f, y, w, x in _by_fold(batch):
            for (ci, g), (use, beta) in active.items():
                if g == f:
                    state[ci, g] += _loss_sums(y, w, x[:, use], beta)

    sums = task_sums(rows, lambda: {k: np.zeros(1 + len(b) + len(b) ** 2) for k, (_, b) in active.items()}, add,
                     lambda s: {f"{ci}|{f}": v for (ci, f), v in s.items()})
    return {tuple(int(n) for n in k.split("|")): v for k, v in sums.items()}


def _advance(pair: dict, sums: np.ndarray, tol: float) -> None:
    """One Newton step of a pair, or half of the last one if it overshot."""
    k, w, penalty, beta = len(pair["beta"]), pair["w"], pair["penalty"], pair["beta"]
    loss = sums[0] / w + 0.5 * (penalty * beta * beta).sum()
    pair["iterations"] += 1
    if loss > pair["loss"] + 1e-12 * max(1.0, abs(pair["loss"])) and np.abs(pair["step"]).max() > tol:
        pair["step"] = pair["step"] / 2
        pair["beta"] = pair["from"] + pair["step"]
        return
    gradient = sums[1:1 + k] / w + penalty * beta
    hessian = sums[1 + k:].reshape(k, k) / w + np.diag(penalty)
    step = -np.linalg.lstsq(hessian, gradient, rcond=None)[0]
    pair["from"], pair["step"], pair["loss"], pair["beta"] = beta, step, loss, beta + step
    pair["done"] = bool(np.abs(step).max() <= tol * max(1.0, np.abs(beta).max()))


def batch_scores(rows: DataFrame, fits: dict[tuple[int, int], LogisticFit]) -> DataFrame:
    """``candidate, fold, label, score`` of every validation row under every fit."""
    tables = {k: (fit.coefficients, fit.intercept) for k, fit in fits.items()}

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for f, y, _, x in _by_fold(batch):
                for (ci, g), (coef, intercept) in tables.items():
                    if g == f:
                        score = 1.0 / (1.0 + np.exp(-np.clip(x @ coef + intercept, -700, 700)))
                        n = len(y)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, ci), pa.int32()), pa.array(np.full(n, f), pa.int32()),
                                                          pa.array(y.astype(np.int32)), pa.array(score)], names=["candidate", "fold", "label", "score"])

    return rows.mapInArrow(run, "candidate int, fold int, label int, score double")


# ------------------------------------------------------------- cells of binned rows

@dataclass
class FoldRows:
    """Rows of a fold on the driver, the share of the fold that they are and its size."""
    label: np.ndarray
    weight: np.ndarray
    x: np.ndarray
    share: float
    n: int


def fold_rows(rows: DataFrame, at_most: int = 10_000, seed: int = 42) -> dict[int, FoldRows]:
    """About ``at_most`` rows of every fold (all of a smaller one). They propose split
    points and where Newton steps begin, nothing else: sums are over all rows."""
    sizes = {r["fold"]: r["n"] for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    share = {f: min(1.0, at_most / n) for f, n in sizes.items()}
    wanted = F.element_at(F.create_map(*[F.lit(v) for f in sizes for v in (f, share[f])]), F.col("fold"))
    picked = rows.filter((wanted >= 1.0) | (F.rand(seed) < wanted)).select("fold", "label", "weight", "x").toArrow()
    return {f: FoldRows(y, w, x, share[f], sizes[f]) for batch in picked.combine_chunks().to_batches() for f, y, w, x in _by_fold(batch)}


def split_points(sample: FoldRows, max_bins: int = 32) -> list[np.ndarray]:
    """Per column the thresholds that MLlib's trees choose from: midpoints of all its
    values, or of every ``max_bins``-th part of the weight where it has more values.
    MLlib takes them from as many rows."""
    most = min(max_bins, sample.n) - 1
    return [_split_points(x, sample.weight, most) for x in sample.x.T]


def _split_points(x: np.ndarray, weight: np.ndarray, most: int) -> np.ndarray:
    values, place = np.unique(x, return_inverse=True)
    sums = np.bincount(place, weights=weight)
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) > most:
        stride, cum, taken = sums.sum() / (most + 1), np.cumsum(sums), []
        for i in range(1, len(values)):
            target = stride * (len(taken) + 1)
            if abs(cum[i - 1] - target) < abs(cum[i] - target):
                taken.append(i - 1)
        middle = middle[taken]
    return middle[~np.isnan(middle)]


def bin_cells(rows: DataFrame, points: dict[int, list[np.ndarray]], sets: list[list[int]]) -> DataFrame:
    """``fold, candidate, bins, label, weight, n``: all rows of ``long_folds`` counted by
    the bins of each set of columns (NaN: the last bin), with their weights summed."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for f, y, w, x in _by_fold(batch):
                if f in points:
                    bins = np.column_stack([np.searchsorted(p, x[:, i]) for i, p in enumerate(points[f])])
                    for ci, use in enumerate(sets):
                        yield _cells(f, ci, bins[:, use], y, w)

    cells = rows.mapInArrow(run, "fold int, candidate int, bins array<double>, label double, weight double, n long")
    return cells.groupBy("fold", "candidate", "bins", "label").agg(F.sum("weight").alias("weight"), F.sum("n").alias("n"))


def _cells(fold: int, candidate: int, bins: np.ndarray, y: np.ndarray, w: np.ndarray) -> pa.RecordBatch:
    keys = np.column_stack([bins, y])
    order = np.lexsort(keys.T)
    starts = np.flatnonzero(np.r_[True, (np.diff(keys[order], axis=0) != 0).any(axis=1)])
    found, k = keys[order][starts], bins.shape[1]
    offsets = pa.array(np.arange(len(found) + 1) * k, pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(found), fold), pa.int32()), pa.array(np.full(len(found), candidate), pa.int32()),
         pa.ListArray.from_arrays(offsets, pa.array(found[:, :k].astype(float).ravel())), pa.array(found[:, k]),
         pa.array(np.add.reduceat(w[order], starts)), pa.array(np.diff(np.r_[starts, len(y)]), pa.int64())],
        names=["fold", "candidate", "bins", "label", "weight", "n"])


# ------------------------------------------------------------------------ trials

def run_trials(spark: SparkSession, trials: dict, max_parallel: int = 4) -> dict:
    """Results of ``trials`` (name -> function without arguments), at most
    ``max_parallel`` at a time. Spark jobs of the trials inherit the caller's
    properties and carry a tag; the first failure cancels the tagged jobs and
    the trials that have not begun, and is raised."""
    sc, tag = spark.sparkContext, f"trials-{uuid.uuid4().hex}"

    def tagged(fn):
        def run():
            sc.addJobTag(tag)
            try:
                return fn()
            finally:
                sc.removeJobTag(tag)
        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(max_parallel) as pool:
        futures = {name: pool.submit(tagged(fn)) for name, fn in trials.items()}
        done, _ = wait(futures.values(), return_when=FIRST_EXCEPTION)
        failed = next((f for f in done if not f.cancelled() and f.exception()), None)
        if failed is not None:
            for f in futures.values():
                f.cancel()
            sc.cancelJobsWithTag(tag)
            raise failed.exception()
        return {name: f.result() for name, f in futures.items()}
