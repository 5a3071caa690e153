"""Batch fits against numpy and MLlib, concurrent trials, the wrappers' rule."""

import datetime
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import batchfit, evaluate, govern, models, preprocess, splits


@pytest.fixture(scope="module")
def daily(spark):
    """Four years of days with a weekly and a monthly signal, noise and one NULL."""
    rng = np.random.default_rng(4)
    n = 1500
    x = rng.normal(size=(n, 4))
    y = 50 + 3 * x[:, 0] - 2 * x[:, 1] + 0.01 * x[:, 2] + rng.normal(scale=0.5, size=n)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double, d double, y double").withColumn(
        "day", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i"))).withColumn("a", F.when(F.col("i") != 77, F.col("a")))
    return df.repartition(7), x, y


def _plain_wape(x, y, cols, origins, alpha):
    keep = np.arange(len(y)) != 77
    out = []
    for o in origins:
        train = keep & (np.arange(len(y)) < o)
        test = keep & (np.arange(len(y)) >= o) & (np.arange(len(y)) <= o + 29)
        a = np.column_stack([np.ones(train.sum()), x[train][:, cols]])
        pen = alpha * np.diag([0.0] + [1.0] * len(cols))
        beta = np.linalg.solve(a.T @ a + pen, a.T @ y[train])
        p = np.column_stack([np.ones(test.sum()), x[test][:, cols]]) @ beta
        out.append(np.abs(p - y[test]).sum() / np.abs(y[test]).sum())
    return float(np.mean(out))


def _origins(folds):
    import datetime
    return [(f.origin - datetime.date(2020, 1, 1)).days for f in folds]


def test_subset_trials_match_numpy_in_two_scans(daily):
    df, x, y = daily
    folds = splits.rolling_origin(df, "day", last_n=3)
    trials = batchfit.SubsetTrials(df, "day", "y", ["a", "b", "c", "d"], folds, alpha=10.0)
    names = {"none": [], "a": ["a"], "ab": ["a", "b"], "all": ["d", "c", "b", "a"]}
    got = trials.wape(names)
    for name, cols in names.items():
        assert got[name] == pytest.approx(_plain_wape(x, y, ["abcd".index(c) for c in cols], _origins(trials.folds), 10.0), rel=1e-9)
    assert trials.scans == 2


def test_wrappers_do_not_scan_per_group(daily, monkeypatch):
    df, x, y = daily
    folds = splits.rolling_origin(df, "day", last_n=3)
    scans = []
    real = batchfit.task_sums
    monkeypatch.setattr(batchfit, "task_sums", lambda *a: scans.append(1) or real(*a))
    groups = {n: [n] for n in "abcd"}
    inc = {r.feature_group: r for r in govern.incremental_group_wrapper(df, "day", "y", groups, folds, min_gain=0.0005).collect()}
    assert len(scans) == 3  # Gram table, baseline, all continuations of four groups
    assert [inc[g].kept for g in "abcd"] == [True, True, False, False]
    origins = _origins(batchfit.fold_list(folds))
    assert inc["b"].wape_with == pytest.approx(_plain_wape(x, y, [0, 1], origins, 10.0), rel=1e-9)
    assert inc["d"].wape_with == pytest.approx(_plain_wape(x, y, [0, 1, 3], origins, 10.0), rel=1e-9)
    short = [tuple(r) for r in govern.incremental_group_wrapper(df, "day", "y", groups, folds, min_gain=0.0005, lookahead=1).collect()]
    assert np.allclose([r[1:4] for r in short], [tuple(inc[g])[1:4] for g in "abcd"])
    scans.clear()
    govern.family_wrapper(df, "day", "y", ["a"], {n: [n] for n in "bcd"}, folds)
    assert len(scans) == 2


def _labelled(spark, n=3000, seed=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.1] + [0, 3, 0]
    p = 1 / (1 + np.exp(-(0.8 * x[:, 0] - 0.3 * x[:, 1] + 4 * x[:, 2])))
    label = (rng.random(n) < p).astype(int)
    w = rng.uniform(0.5, 2.0, n)
    rows = [(i, *map(float, r), int(t), float(v)) for i, (r, t, v) in enumerate(zip(x, label, w))]
    return spark.createDataFrame(rows, "i int, a double, b double, c double, label int, weight double").repartition(5).withColumn("zero", F.lit(3.0))


@pytest.mark.parametrize("reg", [0.0, 0.05])
def test_batch_logistic_matches_mllib(spark, reg):
    df = _labelled(spark)
    cols = ["a", "b", "c", "zero"]
    one, two = df.filter("i < 2000"), df.filter("i >= 500")
    rows, columns = batchfit.long_folds([(1, one, two, cols), (2, two, one, cols[:3])], "label", "weight")
    fits = batchfit.batch_logistic(rows, columns, [{"regParam": reg}, {"regParam": reg, "features": ["b"]}])
    assert set(fits) == {(0, 1), (0, 2), (1, 1), (1, 2)} and all(f.converged for f in fits.values())
    for fold, frame, names in ((1, one, cols), (2, two, cols[:3])):
        ref = models.logistic_regression(frame, names, "label", "weight", regParam=reg, maxIter=300, tol=1e-13)
        assert np.allclose(fits[0, fold].coefficients, ref.coefficients.toArray(), atol=2e-5)
        assert fits[0, fold].intercept == pytest.approx(ref.intercept, abs=2e-5)
        assert [c != 0 for c in fits[1, fold].coefficients] == [n == "b" for n in names]


def test_batch_logistic_takes_few_scans(spark, monkeypatch):
    df = _labelled(spark)
    rows, columns = batchfit.long_folds([(f, df.filter(F.col("i") < 1000 * f), df, ["a", "b", "c"]) for f in (1, 2, 3)], "label", None)
    scans = []
    real = batchfit.task_sums
    monkeypatch.setattr(batchfit, "task_sums", lambda *a: scans.append(1) or real(*a))
    fits = batchfit.batch_logistic(rows, columns, [{"regParam": r} for r in (0.0, 0.01, 0.1, 1.0)])
    assert len(fits) == 12 and len(scans) <= 12  # moments and about eight steps for all of them


def test_ranking_metrics_of_many_groups(spark):
    rng = np.random.default_rng(2)
    rows = [(g, int(rng.random() < 0.3), round(float(rng.random()), 1)) for g in range(3) for _ in range(200)] + [(3, 1, None), (3, None, 0.5)]
    df = spark.createDataFrame(rows, "g int, label int, score double")
    got = {r.g: r for r in evaluate.ranking_metrics(df, "label", "score", "g").collect()}
    for g in range(3):
        part = df.filter(F.col("g") == g)
        assert got[g].pr_auc == pytest.approx(evaluate.average_precision(part, "label", "score").first()[0])
        assert got[g].roc_auc == pytest.approx(evaluate.roc_auc(part, "label", "score").first()[0])
    assert 3 not in got


def test_trials_run_together_and_a_failure_cancels_the_rest(spark):
    at_once, most, lock = [0], [0], threading.Lock()

    def busy():
        with lock:
            at_once[0] += 1
            most[0] = max(most[0], at_once[0])
        spark.range(1000).count()
        time.sleep(0.3)
        with lock:
            at_once[0] -= 1
        return 7

    assert batchfit.run_trials(spark, {i: busy for i in range(6)}, max_parallel=3) == dict.fromkeys(range(6), 7)
    assert most[0] == 3

    started, late = threading.Event(), []

    def slow():
        started.set()
        from pyspark.sql.types import LongType
        spark.range(0, 8, 1, 8).select(F.udf(lambda v: time.sleep(60) or v, LongType())("id")).collect()

    def fails():
        started.wait(20)
        time.sleep(1)
        raise ValueError("this trial fails")

    t0 = time.time()
    with pytest.raises(ValueError, match="this trial fails"):
        batchfit.run_trials(spark, {"slow": slow, "fails": fails, "late": lambda: late.append(1)}, max_parallel=2)
    assert time.time() - t0 < 40 and spark.range(10).count() == 10


def test_search_batches_and_pool_agree(spark):
    df = _labelled(spark)
    folds = [(f, df.filter(F.col("i") < 1000 * f), df.filter((F.col("i") >= 1000 * f) & (F.col("i") < 1000 * f + 1000)), ["a", "b", "c"]) for f in (1, 2)]
    plain = models.temporal_search(folds, "label", "logistic", [{"regParam": 0.0}, {"regParam": 0.1}], "weight").collect()
    for r in plain:
        _, tr, va, cols = folds[r.fold - 1]
        m = models.logistic_regression(tr, cols, "label", "weight", regParam=[0.0, 0.1][r.candidate], maxIter=200, tol=1e-12)
        p = models.positive_probability(m.transform(models.assemble(va, cols)))
        assert r.pr_auc == pytest.approx(evaluate.average_precision(p, "label", "probability_1").first()[0], abs=1e-6)
    assert min(r.pr_auc for r in plain) > 0.55  # a planted signal, prior about 0.4


def test_early_stopping_refits_with_the_best_number(spark):
    rng = np.random.default_rng(8)
    rows = [(i, float(v), float(np.sin(v) * 5 + rng.normal(scale=2.0))) for i, v in enumerate(rng.uniform(0, 6, 900))]
    df = spark.createDataFrame(rows, "i int, x double, y double").withColumn("day", F.date_add(F.lit("2021-01-01").cast("date"), F.col("i")))
    fit = models.gbt_early_stopping(df, "day", ["x"], "y", max_trees=15, stepSize=0.4, maxDepth=4)
    assert fit.best_trees == models.best_iteration(fit.curve, 50) == int(np.argmin(fit.curve)) + 1
    assert fit.model.getNumTrees == fit.best_trees and len(fit.curve) == 15
    assert (fit.n_core, fit.n_eval) == (765, 135)
    assert models.best_iteration([5, 4, 3, 3, 6, 7, 1], patience=3) == 3
    tiny = models.gbt_early_stopping(df.limit(1), "day", ["x"], "y", max_trees=3, maxDepth=1)
    assert tiny.curve == [] and tiny.best_trees == 3


def _deltas(spark, rows):
    return spark.createDataFrame([(m, f, i, d, d) for m, f, ds in rows for i, d in enumerate(ds)],
                                 "model string, feature string, fold int, delta_pr_auc double, delta_roc_auc double")


def test_wrapper_rule_asks_each_model(spark):
    d = _deltas(spark, [("logistic", "both", [-0.002, -0.003, -0.001]), ("gbt", "both", [-0.002, -0.002, -0.002]),
                        ("logistic", "one", [-0.0004, -0.0005, -0.0006]), ("gbt", "one", [-0.002, -0.002, -0.002]),
                        ("logistic", "fold", [-0.02, -0.02, 0.001]), ("gbt", "fold", [-0.02, -0.02, -0.02]),
                        ("gbt", "alone", [-0.02, -0.02, -0.02])])
    s = govern.wrapper_summary(d)
    one = s.filter("feature = 'fold' and model = 'logistic'").first()
    assert (one.negative_pr_folds, one.n_folds, one.model_consistent_harm) == (2, 3, False)
    assert one.min_delta_pr_auc == -0.02 and one.max_delta_pr_auc == 0.001 and one.negative_roc_folds == 2
    got = {r.feature: r.decision for r in govern.wrapper_consensus(s).collect()}
    assert got == {"both": "DROP_CONSISTENT_HARM", "one": "KEEP_OR_WATCH", "fold": "KEEP_OR_WATCH", "alone": "KEEP_OR_WATCH"}


def test_wrapper_drops_a_planted_harmful_feature(spark):
    """A feature that is the label in every train part and its opposite afterwards."""
    rng = np.random.default_rng(12)
    rows = [(i, float(rng.normal()), int(rng.random() < 0.4)) for i in range(1600)]
    df = spark.createDataFrame(rows, "i int, noise double, label int").withColumn("base", F.col("label") + F.col("noise"))
    folds = []
    for f, cut in enumerate((700, 1000, 1300), start=1):
        trap = F.when(F.col("i") < cut, F.col("label")).otherwise(1 - F.col("label")).cast("double")
        frame = df.withColumn("trap", trap).withColumn("weight", F.lit(1.0))
        folds.append((f, frame.filter(F.col("i") < cut), frame.filter((F.col("i") >= cut) & (F.col("i") < cut + 300))))
    summary = govern.wrapper_summary(govern.dual_model_wrapper(folds, ["base"], ["trap", "noise"], "label", "weight"))
    got = {r.feature: r.decision for r in govern.wrapper_consensus(summary).collect()}
    assert got == {"trap": "DROP_CONSISTENT_HARM", "noise": "KEEP_OR_WATCH"}


def test_feature_importance_off_the_main_thread(spark):
    from concurrent.futures import ThreadPoolExecutor
    df = _labelled(spark, 200)
    model = models.logistic_regression(df, ["a", "b"], "label")
    with ThreadPoolExecutor(1) as pool:
        rows = pool.submit(lambda: models.feature_importance(spark, model, ["a", "b"]).collect()).result()
    assert {r.feature for r in rows} == {"a", "b"}


def test_hundred_thousand_levels(spark):
    from pyspark.ml.functions import vector_to_array  # noqa: F401
    df = spark.range(120_000).select(F.col("id"), F.concat(F.lit("level "), (F.col("id") % 100_000).cast("string")).alias("c"), F.lit(1.0).alias("x"))
    train = df.filter("id < 110000")
    pre = preprocess.Preprocessor(numeric=["x"], categorical=["c"]).fit(train)
    assert preprocess.level_counts(pre.level_table) == {"c": 100_000}
    probe = df.limit(50).unionByName(spark.createDataFrame([(-1, "never seen", 1.0), (-2, None, 1.0)], df.schema))
    out = {r.id: r.features for r in pre.assemble(probe, keep=["id"]).collect()}
    ids = {r.level: r.level_id for r in pre.level_table.filter("level_id < 3").collect()}
    assert ids == {"level 0": 0, "level 1": 1, "level 10": 2}
    assert all(v.size == 100_001 and len(v.indices) <= 2 for v in out.values())
    assert out[10].indices.tolist() == [3] and out[-1].indices.tolist() == []
    assert out[-2].indices.tolist() == [1]  # NULL is the mode, the least of equal counts


def test_preprocessor_saved_and_loaded(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "b", 5.0), (3.0, "a", 6.0), (None, None, 7.0)], "x double, c string, q double")
    pre = preprocess.Preprocessor(numeric=["x"], categorical=["c"], quantile=["q"]).fit(df)
    pre.save(spark, str(tmp_path / "pre"))
    again = preprocess.Preprocessor.load(spark, str(tmp_path / "pre"))
    assert sorted(map(tuple, again.transform(df).collect())) == sorted(map(tuple, pre.transform(df).collect()))


def test_median_stage_is_saved_with_its_pipeline(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from basketry.operators.imputer import MedianImputer
    df = spark.createDataFrame([(1.0, None), (2.0, float("nan")), (4.0, None), (None, None)], "x double, nothing double")
    model = Pipeline(stages=[MedianImputer(inputCols=["x", "nothing"], outputCols=["xi", "ni"])]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        assert [(r.xi, r.ni) for r in m.transform(df).orderBy(F.asc_nulls_last("x")).collect()] == [(1.0, 0.0), (2.0, 0.0), (4.0, 0.0), (2.0, 0.0)]


def test_components_are_orthogonal_and_sign_stable(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(500, 2))
    x = np.column_stack([base[:, 0], base[:, 0] * 2 + base[:, 1] * 0.1, base[:, 1], rng.normal(size=500)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    fit = preprocess.principal_components(df.repartition(6), list("abcd"))
    again = preprocess.principal_components(df.repartition(2), list("abcd"))
    assert np.allclose(fit.components, again.components)
    m = np.array(fit.components)
    assert np.allclose(m @ m.T, np.eye(len(m)), atol=1e-10) and all(r[np.argmax(np.abs(r))] > 0 for r in m)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
    assert np.allclose(fit.explained, (values / values.sum())[:len(m)]) and sum(fit.explained) >= 0.95 > sum(fit.explained[:-1])
    projected = np.array([[r[f"pc{i + 1}"] for i in range(len(m))] for r in fit.project(df).collect()])
    assert np.allclose(np.cov(projected.T, bias=True), np.diag(values[:len(m)]), atol=1e-9)


def test_entry_leaves_the_corpus_out_when_a_package_is_missing(monkeypatch):
    import importlib
    import __spark_entry__ as E
    real = importlib.import_module

    def blocked(name, *a):
        if name.startswith("basketry.llm"):
            raise ImportError("No module named 'zstandard'")
        return real(name, *a)

    monkeypatch.setattr(E.importlib, "import_module", blocked)
    names = set(E.queries())
    assert len(names) > 200 and not any(n.startswith("op") and n[2:3].isdigit() for n in names) and "pipeline" not in names
    assert set(E.oracle_sql()) <= names


def test_sources_keep_what_is_known_too_late_out(spark):
    from basketry.plans.daily_sources import DailySource, build_daily_model, join_report
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    target = spark.range(10).select(day(F.col("id").cast("int")).alias("d"), (F.col("id") * 10.0).alias("y"))
    events = spark.createDataFrame([(0, 1, 5.0), (0, 1, 6.0), (0, 2, None), (3, 1, 1.0)], "n int, who int, v double").select(day(F.col("n")).alias("when"), "who", "v")
    states = spark.createDataFrame([(-9, 1.0), (-2, 2.0), (4, 3.0), (99, 4.0)], "n int, v double").select(day(F.col("n")).alias("when"), "v")
    plans = spark.createDataFrame([(2, 4, 0.5), (4, 5, 1.0), (7, 6, 9.0)], "a int, z int, m double").select(day(F.col("a")).alias("a"), day(F.col("z")).alias("z"), "m")
    sources = [DailySource("visits", "event", "after_day", events, "when", {"visits": F.count(F.lit(1)), "spent": F.sum("v")}, {"people": "who"}),
               DailySource("stock", "snapshot", "after_day", states, "when", {"stock": F.max("v")}),
               DailySource("plan", "interval", "known_now", plans, "a", end="z", measure="m")]
    model = build_daily_model(target, "d", ["y"], sources, lags=(1,), windows=(2,))
    assert {"visits", "spent", "people", "stock"}.isdisjoint(model.table.columns)  # no same-day value of a late source
    rows = {str(r.d): r for r in model.table.collect()}
    assert len(rows) == 10
    first, fifth = rows["2024-01-02"], rows["2024-01-06"]
    assert (first.visits_lag_1d, first.people_lag_1d, first.spent_lag_1d, first.stock_lag_1d) == (3, 2, 11.0, 2.0)
    assert (fifth.stock_lag_1d, fifth.stock_rolling_2d_mean, fifth.y_lag_1d) == (3.0, 2.5, 40.0)
    assert (rows["2024-01-05"].plan_count_active, rows["2024-01-05"].plan_mean, rows["2024-01-05"].plan_max) == (2, 0.75, 1.0)
    assert (rows["2024-01-08"].plan_count_active, rows["2024-01-08"].is_plan_active) == (0, 0)
    report = {r.source: r for r in join_report(model, target, "d").collect()}
    assert {n: (r.rows_before, r.rows_after, r.unmatched_days) for n, r in report.items()} == {"visits": (10, 10, 8), "stock": (10, 10, 0), "plan": (10, 10, 6)}
    assert {r.column_name: r.n_model_columns for r in model.catalogue(spark).collect()}["spent"] == 2
    with pytest.raises(ValueError, match="before the day is over"):
        DailySource("visits", "event", "known_now", events, "when", {"visits": F.count(F.lit(1))})
    with pytest.raises(ValueError, match="different columns"):
        build_daily_model(target, "d", ["y"], [sources[0], sources[0]])


def test_level_vectors_keep_level_names_off_the_schema(spark):
    """A column with many levels: vectors of that size, no attribute a level."""
    from basketry.operators import preprocess
    d = spark.range(50_000).select("id", F.col("id").cast("string").alias("c"))
    levels = preprocess.fit_level_table(d.filter("id < 40000"), ["c"])
    out = preprocess.apply_level_vectors(d, ["c"], levels)
    assert len(out.schema.json()) < 2000
    ones = preprocess.vector_nonzeros(out, "c_vec", ["id"])
    assert ones.filter((F.col("id") < 40_000) != (F.col("n_nonzero") == 1)).count() == 0 and ones.count() == 50_000
    assert out.first()["c_vec"].size == 40_000


def test_level_vectors_without_any_level_are_zero(spark):
    from basketry.operators import preprocess
    d = spark.createDataFrame([(1, None), (2, "a")], "id int, c string")
    out = preprocess.apply_level_vectors(d, ["c"], preprocess.fit_level_table(d.filter("id = 1"), ["c"]))
    assert [r["n_nonzero"] for r in preprocess.vector_nonzeros(out, "c_vec", ["id"]).collect()] == [0, 0]


def test_merged_equal_rows_give_the_same_fits(spark):
    """Distinct rows with summed weights: same coefficients and trees, few rows."""
    rng = np.random.default_rng(5)
    rows = [(int(a), float(rng.integers(0, 4)), int(rng.random() < 0.3 + 0.3 * a), 1.0) for a in rng.integers(0, 2, 900)]
    df = spark.createDataFrame(rows, "a int, b double, label int, weight double").withColumn("weight", F.when(F.col("label") == 1, 1.7).otherwise(0.8))
    merged = batchfit.equal_rows(df, ["a", "b", "label"], "weight")
    assert merged.count() <= 16
    total = df.agg(F.sum("weight")).first()[0]
    assert abs(merged.agg(F.sum("weight")).first()[0] - total) < 1e-9
    long, columns = batchfit.long_folds([(1, df, df, ["a", "b"])], "label", "weight")
    plain, few = (batchfit.batch_logistic(long, columns, [{}], merge_equal=m)[0, 1] for m in (False, True))
    assert np.allclose(plain.coefficients, few.coefficients, atol=1e-9) and abs(plain.intercept - few.intercept) < 1e-9
    p, m = (models.gbt_classifier(x, ["a", "b"], "label", "weight", maxIter=5, maxDepth=3) for x in (df, merged))
    probe = models.assemble(df.select("a", "b").distinct(), ["a", "b"])
    both = models.positive_probability(p.transform(probe)).select("a", "b", F.col("probability_1").alias("p")).join(
        models.positive_probability(m.transform(probe)).select("a", "b", F.col("probability_1").alias("m")), ["a", "b"])
    assert both.filter(F.abs(F.col("p") - F.col("m")) > 1e-9).count() == 0


def test_wrapper_steps_read_distinct_rows(spark, monkeypatch):
    """The Newton scans of the wrapper see a row per distinct values, not per order."""
    seen = []
    real = batchfit._newton_sums
    monkeypatch.setattr(batchfit, "_newton_sums", lambda rows, active: (seen.append(rows.count()), real(rows, active))[1])
    df = spark.range(400).select(F.col("id").alias("i"), (F.col("id") % 2).cast("double").alias("base"), (F.col("id") % 3 == 0).cast("double").alias("c"),
                                 (F.col("id") % 5 < 2).cast("int").alias("label"), F.lit(1.0).alias("weight"))
    govern.dual_model_wrapper([(1, df.filter("i < 300"), df.filter("i >= 300"))], ["base"], ["c"], "label", "weight", merge_equal=True).count()
    assert seen and max(seen) <= 8


def test_boosted_fits_of_the_wrapper_read_cells(spark, monkeypatch):
    """Features without equal values: trees are fitted on at most bins x labels rows and
    score as trees fitted on all rows; Newton steps begin near their end."""
    rng = np.random.default_rng(21)
    rows = [(i, float(b), float(c), int(rng.random() < 1 / (1 + np.exp(-c)))) for i, (b, c) in enumerate(zip(rng.integers(0, 2, 4000), rng.normal(size=4000)))]
    df = spark.createDataFrame(rows, "i int, base double, c double, label int").withColumn("weight", F.when(F.col("label") == 1, 1.3).otherwise(0.8))
    train, valid = df.filter("i < 3000"), df.filter("i >= 3000")
    fitted, steps, fit, step = [], [], models.gbt_classifier, batchfit._newton_sums
    monkeypatch.setattr(models, "gbt_classifier", lambda d, *a, **k: (fitted.append(d.count()), fit(d, *a, **k))[1])
    monkeypatch.setattr(batchfit, "_newton_sums", lambda *a: (steps.append(1), step(*a))[1])
    got = {(r.model, r.feature): r for r in govern.dual_model_wrapper([(1, train, valid)], ["base"], ["c"], "label", "weight").collect()}
    assert len(fitted) == 2 and max(fitted) <= 2 * 32 * 2 and len(steps) <= 2
    for features, name in ((["base"], "baseline_pr_auc"), (["base", "c"], "pr_auc")):
        scored = models.positive_probability(fit(train, features, "label", "weight", maxIter=10, maxDepth=3).transform(models.assemble(valid, features)))
        assert got["gbt", "c"][name] == pytest.approx(evaluate.average_precision(scored, "label", "probability_1").first()[0], abs=1e-6)


def test_split_points_are_those_of_mllib():
    x = np.array([0.0, 0.0, 1.0, 3.0, np.nan])
    sample = batchfit.FoldRows(np.zeros(5), np.ones(5), x[:, None], 1.0, 5)
    assert batchfit.split_points(sample)[0].tolist() == [0.5, 2.0]  # a split beside NaN parts nothing
    many = batchfit.FoldRows(np.zeros(1000), np.ones(1000), np.arange(1000.0)[:, None], 1.0, 1000)
    cuts = batchfit.split_points(many, max_bins=4)[0]
    assert cuts.tolist() == [249.5, 499.5, 749.5]


def test_column_medians_are_exact_in_two_scans(spark):
    from basketry.functions.primitives import column_medians
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=5000), rng.integers(0, 3, 5001).astype(float)
    rows = [(float(a[i]) if i < 5000 else None, float(b[i]), None) for i in range(5001)]
    df = spark.createDataFrame(rows, "a double, b double, none double")
    assert column_medians(df, ["a", "b", "none"]) == {"a": float(np.median(a)), "b": float(np.median(b)), "none": None}
    assert column_medians(df.limit(0), ["a"]) == {"a": None} and column_medians(df, []) == {}
    two = spark.createDataFrame([(1.0,), (4.0,)], "a double")
    assert column_medians(two, ["a"]) == {"a": 2.5}


def test_serving_features_hash_item_rows(spark):
    """Item rows are never sorted for an order's texts; conflicting texts take the least."""
    from basketry.plans import features as ft
    cols = "order_id int, customer_id int, order_date date, order_status string, payment_value double, priority string, segment string"
    day = datetime.date(2024, 1, 2)
    orders = spark.createDataFrame([(1, 7, day, "returned", 5.0, "b", "x"), (1, 7, day, "returned", 5.0, "a", "y"), (2, 7, day, "delivered", 6.0, None, None)], cols)
    items = spark.createDataFrame([(1, 10, 2.0, 3.0, 1.0, "A"), (1, 11, 1.0, 4.0, 0.0, "B")],
                                  "order_id int, product_id int, quantity double, unit_price double, discount_amount double, category string")
    spec = ft.OrderFeatureSpec(cash_col="priority", cash_value="a", categorical=["priority", "segment"], multihot={"category": ["A", "B"]})
    out = ft.serving_features(orders.join(items, "order_id", "left"), spec)
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [line for line in plan if "SortAggregate" in line and "sum(" in line]
    got = {r.order_id: r for r in out.collect()}
    assert (got[1].priority, got[1].segment, got[1].unique_product_count, got[1].total_quantity, got[1].category_a) == ("a", "x", 2, 6.0, 1)
    assert (got[2].priority, got[2].unique_product_count, got[2].total_quantity, got[2].label) == ("unknown", 0, None, 0)


def test_unpenalised_candidates_are_fitted_together():
    batched = [models._batchable("logistic", [{"regParam": r, "elasticNetParam": 0.5, "maxIter": 30}]) for r in (0.0, 0.1)]
    assert batched == [True, False]
