"""Cases that the test tables do not reach."""

import json

import pytest
from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.functions.expr import normalised_key
from basketry.functions.primitives import average_rank, column_quantiles, distinct_counts, group_quantiles, prefix_sum, rank_first
from basketry.operators import govern, joins, rollup, stats
from basketry.plans.scoring import parse_requests


def test_open_ended_interval_keeps_its_max(spark):
    days = spark.createDataFrame([("2400-01-01",), ("5000-01-01",), ("9000-01-01",), ("2019-01-01",)], "d string").select(F.to_date("d").alias("date"))
    iv = spark.createDataFrame([("2020-01-01", "9999-12-31", 5.0), ("4999-01-01", "5001-01-01", 9.0)], "s string, e string, m double") \
        .select(F.to_date("s").alias("s"), F.to_date("e").alias("e"), "m")
    rows = {str(r.date): (r.active_count, r.active_max) for r in joins.interval_active(days, iv, "s", "e", "m").collect()}
    assert rows == {"2400-01-01": (1, 5.0), "5000-01-01": (2, 9.0), "9000-01-01": (1, 5.0), "2019-01-01": (0, None)}


def test_wrapper_key_anywhere_in_a_request(spark):
    order = {"order_id": 7}
    payloads = [json.dumps({"source": "web", "orders": [order, {"order_id": 8}]}), json.dumps({"orders": order}), json.dumps([order]),
                json.dumps({"records": {}, "data": [order]}), json.dumps(order), "{broken", "[]", None, '{"orders": []}']
    raw = spark.createDataFrame(list(enumerate(payloads)), "request_id int, payload string")
    got = {}
    for r in parse_requests(raw).collect():
        got.setdefault(r.request_id, []).append((r.order.order_id if r.order else None, r.reject_reason))
    assert sorted(got[0]) == [(7, None), (8, None)]
    assert got[1] == [(None, "missing_order_id")] and got[2] == [(7, None)] and got[3] == [(7, None)] and got[4] == [(7, None)]
    assert got[5] == [(None, "unparseable")] and got[6] == [(None, "empty_request")] and got[7] == [(None, "unparseable")]
    assert got[8] == [(None, "empty_request")]


def test_large_ids_match_in_any_notation(spark):
    df = spark.createDataFrame([("1.0E7",), ("12345678.0",), ("1.2345678E7",), (" 609.0 ",), ("007",), ("A1E5",), ("609.5",), (None,)], "k string")
    assert [r.k for r in df.select(normalised_key("k").alias("k")).collect()] == [
        "10000000", "12345678", "12345678", "609", "007", "A1E5", "609.5", None]
    items = spark.createDataFrame([(12345678.0,)], "k double").select(F.col("k").cast("string").alias("k"))
    lookup = spark.createDataFrame([("12345678", "x")], "k string, v string")
    assert joins.lookup_enrich(items, lookup, "k", ["v"]).first().v == "x"


def test_null_partition_is_a_partition(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5), (None, 2)], "g string, v int")
    ranks = sorted(((r.g or "", r.v, r.rank) for r in average_rank(df, "v", ["g"]).collect()))
    assert ranks == [("", 1, 1.0), ("", 2, 2.5), ("", 2, 2.5), ("a", 5, 1.0)]
    sums = sorted(((r.g or "", r.cum_v) for r in prefix_sum(df.distinct(), "v", ["v"], partition_by=["g"]).collect()))
    assert sums == [("", 1), ("", 3), ("a", 5)]
    rel = stats.temporal_relation(df.withColumn("y", F.col("v")), ["v"], "y", F.col("g")).collect()
    assert {r.period: r.spearman for r in rel} == {None: pytest.approx(1.0), "a": None}


def test_text_tiebreak_and_long_keys(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (0, "é"), (1, "ab"), (0, "")], "v int, id string")
    assert {r.id: r.rank for r in rank_first(df, "v", "id").collect()} == {"": 1, "é": 2, "a": 3, "ab": 4, "b": 5}
    big = 2 ** 53
    d = spark.createDataFrame([(big + i, 1) for i in range(6)], "k long, one int")
    assert sorted((r.k - big, r.cum_one) for r in prefix_sum(d, "k", ["one"]).collect()) == [(i, i + 1) for i in range(6)]


def test_long_chain_is_one_group(spark):
    pairs = spark.createDataFrame([(f"f{i:03d}", f"f{i + 1:03d}", 0.95) for i in range(200)], "feature_a string, feature_b string, corr double")
    groups = govern.redundancy_groups(pairs, 0.9).collect()
    assert len(groups) == 201 and {r.group_id for r in groups} == {"f000"} and sum(r.is_representative for r in groups) == 1


def test_spearman_pairs_rank_the_values(spark):
    rows = [(float(i), float(i ** 3), float((i * 7) % 11) if i % 5 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.feature_a, r.feature_b): r.spearman for r in stats.spearman_pairs(df, ["a", "b", "c"]).collect()}
    want = df.toPandas().corr("spearman")
    assert got[("a", "b")] == pytest.approx(1.0)
    for (x, y), v in got.items():
        assert v == pytest.approx(want.loc[x, y])


def test_redundancy_rule(spark):
    pairs = spark.createDataFrame([("a", "b", 0.99), ("a", "c", 0.95), ("c", "d", -0.97), ("e", "f", 0.92)],
                                  "feature_a string, feature_b string, spearman double")
    scores = spark.createDataFrame([("a", 0.2, 0.0), ("b", 0.5, 0.1), ("c", 0.3, 0.3), ("d", 0.3, 0.1), ("e", None, 0.0)],
                                   "feature string, score double, missing_share double")
    got = [(r.kept, r.dropped) for r in govern.redundancy_greedy(pairs, scores).orderBy(F.desc("association_value")).collect()]
    assert got == [("b", "a"), ("d", "c"), ("e", "f")]


def test_exact_quantiles_per_group(spark):
    rows = [("x" if i % 3 else None, float(i * i % 17), i if i % 4 else None) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    pdf = df.toPandas()
    pdf["g"] = pdf["g"].fillna("none")
    for r in group_quantiles(df, ["v", "w"], [0.1, 0.5, 0.9], ["g"]).collect():
        own = pdf[pdf["g"] == (r.g or "none")][r.column_name]
        assert r.q == pytest.approx(own.quantile([0.1, 0.5, 0.9]).tolist())
    assert column_quantiles(df.where("false"), ["v"], [0.5]) == {"v": [None]}
    assert {r.column_name: r.nunique for r in distinct_counts(df, ["g", "v", "w"]).collect()} == {
        "g": 1, "v": pdf["v"].nunique(), "w": pdf["w"].nunique()}


def test_chi2_and_t_tails(spark):
    df = spark.createDataFrame([("a", 0)] * 12 + [("a", 1)] * 5 + [("b", 0)] * 3 + [("b", 1)] * 9, "x string, y int")
    res = stats.chi2_test(df, "x", "y")
    n, det = 29, 12 * 9 - 5 * 3
    assert res["yates"] and res["chi2"] == pytest.approx(n * (abs(det) - n / 2) ** 2 / (17 * 12 * 15 * 14))
    assert stats.t_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-9)
    assert stats.t_two_sided(1.0, 1) == pytest.approx(0.5)


def test_moving_holidays(spark):
    assert all(cal.lunar_date(y, 1, 1) == d for y, d in cal.VN_TET_FIRST_DAY.items())
    assert all(cal.lunar_date(y, 3, 10) == d for y, d in cal.VN_HUNG_KINGS.items())
    days = {str(r[0]) for r in cal.fixed_holiday_table(spark, 2007, 2007).collect()}
    assert "2007-02-17" in days and "2007-04-26" in days


def test_crosstab_needs_a_list(spark):
    df = spark.createDataFrame([(1, "a")], "k int, c string")
    with pytest.raises(ValueError):
        rollup.crosstab_counts(df, "k", "c")


def test_checkpoint_folder_of_the_application_stays(spark):
    from basketry.session import ensure_checkpoint_dir
    first = ensure_checkpoint_dir(spark)
    before = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == before and first


def test_history_names_are_not_suspect(spark):
    names = spark.createDataFrame([("revenue_diff_7d",), ("revenue_pct_change_7d",), ("revenue",), ("target",)], "feature string")
    got = {r.feature: r.target_like_no_history for r in govern.leakage_name_review(names).collect()}
    assert got == {"revenue_diff_7d": False, "revenue_pct_change_7d": False, "revenue": True, "target": True}


def test_fold_state_ignores_validation_rows(spark):
    from basketry.operators.models import prepare
    from basketry.operators.preprocess import Preprocessor
    rows = [(i, float(i), "ab"[i % 2], i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, x double, c string, label int")
    train, valid = df.filter("id < 30"), df.filter("id >= 30")
    other = valid.withColumn("x", F.col("x") * 1000).withColumn("c", F.lit("z"))
    states = []
    for v in (valid, other):
        pre = Preprocessor(numeric=["x"], categorical=["c"])
        out, _, columns = prepare(train, [v], pre, "label", ["id", "label"])
        states.append((pre.state, columns, sorted(map(tuple, out.collect()))))
    assert states[0] == states[1]
