"""Operators on hand-made frames: ties, gaps, duplicates, orphans,
intervals, nested payloads, dirty input, score edge cases, empty / one row."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketry.operators import binning, clean, evaluate, joins, profile, rollup, rules, splits, stats
from basketry.operators import timeseries as ts
from basketry.plans import scoring
from basketry.sources import io

D = dt.date


# ---------- ties -------------------------------------------------------------
def test_qcut_matches_pandas_with_ties(spark):
    vals = [1, 1, 1, 2, 2, 3, 4, 5, 5, 5, 6, 7, 8]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id int, x double")
    got = binning.qcut(df, "x", 4, "b").orderBy("id").toPandas()["b"].tolist()
    ref = pd.qcut(pd.Series(vals, dtype=float), 4, labels=False, duplicates="drop").tolist()
    assert got == ref


def test_qcut_on_rank_is_near_equal(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(13)], "id int, x double")
    sizes = binning.qcut_on_rank(df, "x", 5, ["id"], "b").groupBy("b").count().orderBy("b").toPandas()["count"].tolist()
    ref = pd.qcut(pd.Series(range(1, 14)), 5, labels=False).value_counts().sort_index().tolist()
    assert sizes == ref == [3, 2, 3, 2, 3]


def test_cut_fixed_edges(spark):
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 0.01, 0.05, 0.3, 2.0, None]], "r double")
    got = [r[0] for r in df.select(binning.cut_fixed("r", binning.DISCOUNT_EDGES, binning.DISCOUNT_LABELS)).collect()]
    assert got == [None, "0%", "0-5%", "0-5%", "20-50%", ">50%", None]


def test_tenure_presets(spark):
    df = spark.createDataFrame([(d,) for d in [-3, 0, 29, 30, 179, 180, 364, 365]], "d int")
    serve = [r[0] for r in df.select(binning.tenure_group("d", "serve")).collect()]
    train = [r[0] for r in df.select(binning.tenure_group("d", "train")).collect()]
    assert serve == [None, "new_lt_30d", "new_lt_30d", "30_179d", "30_179d", "180_364d", "180_364d", "loyal_365d_plus"]
    assert train == [None, "new_lt_30d", "new_lt_30d", "30_179d", "30_179d", "180_364d", "180_364d", "loyal_365d_plus"]


# ---------- gaps ---------------------------------------------------------------
@pytest.fixture()
def gaps(spark):
    rows = [(D(2024, 1, 1), 1.0), (D(2024, 1, 2), 2.0), (D(2024, 1, 5), None), (D(2024, 1, 6), 6.0), (D(2024, 1, 6), 7.0)]
    return spark.createDataFrame(rows, "d date, v double")


def test_date_continuity_finds_missing_days(spark, gaps):
    r = profile.date_continuity(gaps, "d").first()
    assert (r["expected_days"], r["actual_days"], r["missing_days"]) == (6, 4, 2)
    assert (r["first_missing"], r["last_missing"]) == (D(2024, 1, 3), D(2024, 1, 4))


def test_lag_on_dense_spine_means_days(spark, gaps):
    d = clean.dedupe_by_order(gaps.withColumn("o", F.coalesce("v", F.lit(0.0))), "d", "o", keep="last").drop("o")
    dense = ts.densify(d, "d")
    out = ts.lag_features(dense, "d", ["v"], [1]).orderBy("d").toPandas()
    assert len(out) == 6
    assert out["v_lag_1d"].tolist()[1:3] == [1.0, 2.0]
    assert math.isnan(out["v_lag_1d"].tolist()[3])  # day 4 is a gap day → lag of the 3rd (missing) day is NULL


def test_rolling_min_periods(spark, gaps):
    dense = ts.densify(clean.dedupe_by_order(gaps, "d", "d"), "d")
    r = dense.select("d", ts.rolling_col("v", 3, "d", stat="mean", min_periods=2).alias("m")).orderBy("d").toPandas()["m"].tolist()
    assert math.isnan(r[0]) and math.isnan(r[1]) and r[2] == 1.5


# ---------- duplicates ----------------------------------------------------------
@pytest.fixture()
def dups(spark):
    rows = [(1, 10, 2.0, 5.0, "P1"), (1, 10, 2.0, 5.0, "P1"), (1, 11, 1.0, 3.0, None), (2, 10, 1.0, 5.0, None),
            (2, 10, 3.0, 7.0, "P2")]
    return spark.createDataFrame(rows, "order_id int, product_id int, quantity double, unit_price double, promo string")


def test_duplicate_decisions(spark, dups):
    d = {(r["order_id"], r["product_id"]): r["decision"] for r in clean.duplicate_line_decision(dups, ["order_id", "product_id"]).collect()}
    assert d == {(1, 10): "review_exact_duplicate", (2, 10): "aggregate_valid_multiple_lines"}


def test_aggregate_duplicate_keys_conserves(spark, dups):
    a = clean.aggregate_duplicate_keys(dups, ["order_id", "product_id"], sums=["quantity"], means=["unit_price"], firsts=["promo"])
    rep = {r["measure"]: r["difference"] for r in rules.aggregation_conservation(dups, a, ["quantity"], "n_merged_lines").collect()}
    assert rep == {"rows": 0.0, "quantity": 0.0}
    row = a.filter("order_id = 2").first()
    assert (row["quantity"], row["unit_price"], row["promo"]) == (4.0, 6.0, "P2")


def test_duplicate_report_null_safe(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    r = profile.duplicate_report(df, ["k"]).first()
    assert (r["duplicate_full_rows"], r["duplicate_key_rows"]) == (1, 1)


# ---------- orphans / null keys -------------------------------------------------
def test_foreign_key_and_null_safe_join(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,)], "k int")
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, name string")
    fk = rules.foreign_key_check(child, parent, "k").first()
    assert (fk["checked_rows"], fk["orphan_rows"]) == (3, 1)
    sql = joins.keyed_join(child, parent, "k", "left").filter(F.col("name").isNotNull()).count()
    safe = joins.keyed_join(child, parent, "k", "left", null_safe=True).filter(F.col("name").isNotNull()).count()
    assert (sql, safe) == (2, 3)


def test_assert_unique_key_raises(spark, dups):
    with pytest.raises(rules.UniqueKeyError):
        rules.assert_unique_key(dups, ["order_id", "product_id"])


# ---------- intervals ------------------------------------------------------------
def test_interval_active_matches_brute_force(spark):
    iv = [(D(2024, 1, 1), D(2024, 1, 3), 10.0), (D(2024, 1, 2), D(2024, 1, 2), 5.0), (D(2024, 1, 5), D(2024, 1, 4), 99.0),
          (D(2024, 1, 3), None, 7.0), (D(2024, 1, 2), D(2024, 1, 6), None)]
    idf = spark.createDataFrame(iv, "s date, e date, m double")
    spine = spark.createDataFrame([(D(2024, 1, d),) for d in range(1, 8)], "date date")
    got = {r["date"]: (r["active_count"], r["active_sum"], r["active_mean"], r["active_max"])
           for r in joins.interval_active(spine, idf, "s", "e", "m").collect()}
    for d in range(1, 8):
        day = D(2024, 1, d)
        act = [m for s, e, m in iv if s and e and s <= e and s <= day <= e]
        vals = [m for m in act if m is not None]
        c, sm, mean, mx = got[day]
        assert c == len(act)
        assert sm == pytest.approx(sum(vals))
        assert (mean is None and not vals) or mean == pytest.approx(sum(vals) / len(vals))
        assert (mx is None and not vals) or mx == max(vals)


def test_asof_ffill(spark):
    snaps = spark.createDataFrame([(D(2024, 1, 1), 5.0), (D(2024, 1, 4), 8.0)], "d date, stock double")
    spine = spark.createDataFrame([(D(2023, 12, 31),)] + [(D(2024, 1, d),) for d in range(1, 7)], "d date")
    got = [r["stock"] for r in joins.asof_ffill_join(spine, snaps, "d", ["stock"]).orderBy("d").collect()]
    assert got == [None, 5.0, 5.0, 5.0, 8.0, 8.0, 8.0]


# ---------- nested payloads -------------------------------------------------------
def test_request_shapes_and_rejects(spark):
    item = '{"product_id": "609.0", "quantity": 2, "unit_price": 10.0, "discount_amount": 1.0}'
    obj = '{"order_id": 1, "order_date": "2024-01-05", "items": [' + item + ']}'
    rows = [(1, obj), (2, "[" + obj.replace('"order_id": 1', '"order_id": 2') + "]"),
            (3, '{"records": [' + obj.replace('"order_id": 1', '"order_id": 3') + "]}"),
            (4, '{"orders": []}'), (5, '{"order_date": "2024-01-01"}'), (6, "not json")]
    raw = spark.createDataFrame(rows, "request_id long, payload string")
    got = {r["request_id"]: r["reject_reason"] for r in scoring.parse_requests(raw).collect()}
    assert got == {1: None, 2: None, 3: None, 4: "empty_request", 5: "missing_order_id", 6: "unparseable"}


def test_lookup_enrich_normalises_keys(spark):
    items = spark.createDataFrame([("609.0", None), ("610", "given")], "product_key string, category string")
    lk = spark.createDataFrame([("609", "Casual"), ("610", "GenZ")], "product_key string, category string")
    got = {r[0]: r[1] for r in joins.lookup_enrich(items, lk, "product_key", ["category"]).collect()}
    assert got == {"609.0": "Casual", "610": "given"}


# ---------- dirty input -----------------------------------------------------------
def test_dirty_csv_and_coercions(spark, tmp_path):
    p = tmp_path / "dirty.csv"
    p.write_text("﻿ Date ,Revenue , Note\n2024-01-01,10.5, \n2024-02-30,abc,x\n ,inf,\n", encoding="utf-8")
    df = io.read_csv(spark, str(p), schema=None)
    assert df.columns == ["Date", "Revenue", "Note"]
    d, rep = clean.convert_columns_date(df, ["Date", "Missing"])
    d, rep2 = clean.convert_columns_numeric(d, ["Revenue"])
    r = {x["column_name"]: (x["status"], x["newly_invalid"]) for x in rep.collect()}
    assert r["Missing"][0] == "missing_column" and r["Date"][1] == 2  # "2024-02-30" and the blank " "
    assert rep2.first()["newly_invalid"] == 1
    e = clean.empty_string_to_null(d, ["Note"])
    assert e.filter(F.col("Note").isNull()).count() == 2
    z = clean.inf_to_null_zero(d.select("Revenue"), ["Revenue"])
    assert sorted(r[0] for r in z.collect()) == [0.0, 0.0, 10.5]


# ---------- scores ----------------------------------------------------------------
@pytest.mark.parametrize("y,s,ap,auc", [
    ([1, 1, 1], [0.2, 0.5, 0.5], 1.0, None),          # all positive: AUC undefined
    ([0, 1, 0, 1], [0.3, 0.3, 0.3, 0.3], 0.5, 0.5),   # constant score
    ([0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8], 0.8333333333333333, 0.75),
])
def test_ap_and_auc_edge_cases(spark, y, s, ap, auc):
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double")
    got_ap = evaluate.average_precision(df, "y", "s").first()[0]
    got_auc = evaluate.roc_auc(df, "y", "s").first()[0]
    assert got_ap == pytest.approx(ap)
    assert (got_auc is None and auc is None) or got_auc == pytest.approx(auc)


def test_threshold_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, s double")
    r = evaluate.threshold_metrics(df, "y", "s", 0.5).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)


def test_spearman_matches_pandas(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 5, 60).astype(float)
    y = x + rng.integers(0, 3, 60)
    x[3] = np.nan
    df = spark.createDataFrame([(None if np.isnan(a) else float(a), float(b)) for a, b in zip(x, y)], "a double, b double")
    got = stats.spearman(df, "a", "b").first()["spearman"]
    ref = pd.DataFrame({"a": x, "b": y}).corr(method="spearman").loc["a", "b"]
    assert got == pytest.approx(ref, abs=1e-12)


def test_cramers_v_two_levels(spark):
    rows = [("a", 1)] * 30 + [("a", 0)] * 10 + [("b", 0)] * 30 + [("b", 1)] * 10
    df = spark.createDataFrame(rows, "c string, y int")
    v = stats.cramers_v(df, "c", "y").first()["cramers_v"]
    n, chi2 = 80, 20.0
    phi2c = max(0.0, chi2 / n - 1 / (n - 1))
    den = min(2 - 1 / (n - 1), 2 - 1 / (n - 1)) - 1
    assert v == pytest.approx(math.sqrt(phi2c / den))


# ---------- splits -------------------------------------------------------------------
def test_positional_cut_dates(spark):
    rows = [(i, D(2024, 1, 1 + i // 3)) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, d date")
    sp = splits.positional_cutoff_split(df, "d")
    pdf = pd.DataFrame(rows, columns=["id", "d"]).sort_values(["d", "id"])
    c1, c2 = pdf.iloc[int(30 * 0.7)]["d"], pdf.iloc[int(30 * 0.85)]["d"]
    got = {r["id"]: r["data_split"] for r in sp.collect()}
    for i, d in rows:
        assert got[i] == ("train" if d < c1 else "validation" if d < c2 else "test")


# ---------- empty and one row -----------------------------------------------------------
def test_empty_and_one_row(spark):
    empty = spark.createDataFrame([], "k int, x double, d date")
    one = spark.createDataFrame([(1, 2.0, D(2024, 1, 1))], "k int, x double, d date")
    for df in (empty, one):
        assert profile.missing_report(df).count() == 3
        assert profile.numeric_summary(df, ["x"]).count() == 1
        assert rollup.group_target_rate(df, "k", "x").count() == df.count()
        assert ts.cumulative_share(df, "k", "x")[0].count() == df.count()
    assert evaluate.regression_metrics(one, "x", "x").first()["mae"] == 0.0
