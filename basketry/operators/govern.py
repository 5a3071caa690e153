"""Feature governance and selection (§2.12).

Statistics that decide a feature's fate (missing share, constancy,
duplicates, correlations) are Spark aggregates; the walks over the
resulting *small* tables (one row per feature or per feature pair) run on
the driver, as in any Spark feature-selection job.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions.expr import family_of, select_ladder
from basketry.functions.primitives import distinct_counts
from basketry.session import cut_lineage

# Target-history columns that must never reach a model.
BANNED_FEATURES = [
    "mean_product_return_rate",
    "max_product_return_rate",
    "high_risk_product_count",
    "has_return_record",
]

# Calendar / known-now feature names.
CALENDAR_NAMES = {"dayofweek", "is_weekend", "month", "quarter", "year", "dayofmonth", "dayofyear", "weekofyear",
                  "is_month_start", "is_month_end", "is_holiday", "days_to_year_end", "dow_sin", "dow_cos",
                  "month_sin", "month_cos"}

KIND_RULES = [(r"_lag_\d+d?$", "lag"), (r"_rolling_\d+d?_(mean|sum|std|min|max)$", "rolling"),
              (r"_diff_\d+d?$", "diff"), (r"_pct_change_\d+d?$", "change")]


class LeakageError(ValueError):
    pass


def feature_kind(name: str, known_now: set | None = None) -> str:
    if name in CALENDAR_NAMES:
        return "calendar"
    if known_now and name in known_now:
        return "known_now"
    for pat, kind in KIND_RULES:
        if re.search(pat, name):
            return kind
    return "aggregate"


def feature_catalog(spark: SparkSession, names: list[str], known_now: set | None = None) -> DataFrame:
    """Feature, source (family), kind and leakage risk. Same-day
    aggregates of outcome sources are high risk; lagged / calendar / known-
    now features are low."""
    rows = []
    for n in names:
        kind = feature_kind(n, known_now)
        risk = "high" if kind == "aggregate" else "low"
        rows.append((n, family_of(n), kind, risk))
    return spark.createDataFrame(rows, "feature string, source string, kind string, leakage_risk string")


def leakage_gate(spark: SparkSession, columns: list[str], id_cols=(), meta_cols=(), target_cols=(),
                 representation_cols=(), banned=BANNED_FEATURES, raise_on_breach: bool = True,
                 model_features: list[str] | None = None) -> DataFrame:
    """Role and action per column; raises when a banned column is
    among the model features."""
    rows = []
    for c in columns:
        if c in id_cols:
            role, action = "id", "EXCLUDE_ID"
        elif c in target_cols:
            role, action = "target", "EXCLUDE_TARGET"
        elif c in meta_cols:
            role, action = "metadata", "EXCLUDE_METADATA"
        elif c in banned:
            role, action = "target_history", "BAN_LEAKAGE"
        elif c in representation_cols:
            role, action = "raw_representation", "EXCLUDE_REPRESENTATION"
        else:
            role, action = "feature", "PASS"
        rows.append((c, role, action))
    gate = spark.createDataFrame(rows, "column_name string, role string, action string")
    if raise_on_breach and model_features is not None:
        breach = sorted(set(model_features) & set(banned))
        if breach:
            raise LeakageError(f"banned target-history columns in model features: {breach}")
    return gate


def banned_column_guard(df: DataFrame, banned=BANNED_FEATURES) -> DataFrame:
    """Refuse a table carrying banned columns (analysis time, no job)."""
    hit = [c for c in df.columns if c in banned]
    if hit:
        raise LeakageError(f"banned columns present: {hit}")
    return df


def quality_filter(df: DataFrame, features: list[str], max_missing: float = 0.5) -> DataFrame:
    """Per feature missing share, distinct count (≤ 1 → constant) and
    infinite count; action and reason per feature."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(features):
        x = F.col(f"`{c}`")
        aggs += [F.count_if(x.isNull()).alias(f"m{i}"),
                 F.count_if(x.cast("double").isin(float("inf"), float("-inf"))).alias(f"f{i}")]
    distinct = {r["column_name"]: r["nunique"] for r in distinct_counts(df, features).collect()}  # one row a feature
    one = df.agg(*aggs).withColumns({f"u{i}": F.lit(distinct.get(c, 0)).cast("long") for i, c in enumerate(features)})
    rows = []
    for i, c in enumerate(features):
        miss = F.col(f"m{i}") / F.col("_n")
        action = select_ladder([(F.col(f"u{i}") <= 1, "drop"), (miss > max_missing, "drop"), (F.col(f"f{i}") > 0, "drop")], "keep")
        reason = select_ladder([(F.col(f"u{i}") <= 1, "constant"), (miss > max_missing, "missing_above_threshold"),
                                (F.col(f"f{i}") > 0, "infinite_values")], "ok")
        rows.append(F.struct(F.lit(c).alias("feature"), miss.alias("missing_share"), F.col(f"u{i}").alias("nunique"),
                             F.col(f"f{i}").alias("n_infinite"), action.alias("action"), reason.alias("reason")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def duplicate_columns(df: DataFrame, features: list[str], key: str) -> DataFrame:
    """Exact duplicate columns. Content signature per column =
    Σ xxhash64(row key, value) (order-free, one scan); columns with equal
    signatures are confirmed with ``count_if(NOT a <=> b) = 0``. First kept."""
    sig = df.agg(*[F.sum(F.xxhash64(F.col(key), F.col(f"`{c}`").cast("string")).cast("decimal(38,0)")).cast("string").alias(c)
                   for c in features]).first()
    groups: dict = {}
    for c in features:
        groups.setdefault(sig[c], []).append(c)
    suspects = [(other, cols[0]) for cols in groups.values() for other in cols[1:]]
    if suspects:
        differ = df.agg(*[F.count_if(~F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`"))).alias(f"d{i}") for i, (a, b) in enumerate(suspects)]).first()
        suspects = [pair for i, pair in enumerate(suspects) if differ[f"d{i}"] == 0]
    return df.sparkSession.createDataFrame(suspects, "feature string, duplicate_of string")


def redundancy_greedy(pairs: DataFrame, scores: DataFrame, threshold: float = 0.90, corr_col: str = "spearman") -> DataFrame:
    """Walk the pairs with |``corr_col``| of at least ``threshold``,
    strongest first, and drop the weaker feature unless one of the two is
    already dropped: the kept one has the higher score (where both have one
    and they differ), else less missing, else stands first in the pair.
    Pairs and scores have a row per pair and per feature."""
    known = {r["feature"]: (r["score"], r["missing_share"]) for r in scores.collect()}
    hot = (pairs.filter(F.abs(corr_col) >= threshold).select("feature_a", "feature_b", F.abs(corr_col).alias("v"))
           .orderBy(F.desc("v"), "feature_a", "feature_b").collect())
    dropped, rows = set(), []
    for a, b, value in hot:
        if a in dropped or b in dropped:
            continue
        (score_a, miss_a), (score_b, miss_b) = (known.get(f, (None, None)) for f in (a, b))
        miss_a, miss_b = (float("inf") if m is None else m for m in (miss_a, miss_b))
        if score_a is not None and score_b is not None and score_a != score_b:
            kept = a if score_a > score_b else b
        else:
            kept = a if miss_a <= miss_b else b
        dropped.add(b if kept == a else a)
        rows.append((a, b, f"absolute_{corr_col}", float(value), kept, b if kept == a else a))
    return pairs.sparkSession.createDataFrame(
        rows, "feature_a string, feature_b string, association_type string, association_value double, kept string, dropped string")


def family_cap(table: DataFrame, feature: str = "feature", score: str = "score", missing: str = "missing_share",
               cap: int = 4) -> DataFrame:
    """Rank features within their lag/rolling family by score desc,
    missing asc, name; keep ``cap``."""
    fam = F.regexp_replace(F.col(feature), r"(_lag_\d+d?|_rolling_\d+d?_(mean|sum|std|min|max)|_diff_\d+d?|_pct_change_\d+d?)$", "")
    w = Window.partitionBy("family").orderBy(F.desc_nulls_last(score), F.asc_nulls_last(missing), F.asc(feature))
    r = table.withColumn("family", fam).withColumn("family_rank", F.row_number().over(w))
    return r.withColumn("keep", F.col("family_rank") <= cap)


def section_review(relations: DataFrame, quality: DataFrame, min_corr: float = 0.05) -> DataFrame:
    """Per feature keep / review / not_selected from quality and
    relation strength."""
    j = relations.join(quality.select("feature", "action", "reason"), "feature", "left")
    dec = select_ladder([(F.col("action") == "drop", "not_selected"), (F.col("max_abs_corr") >= min_corr, "keep")], "review")
    return j.withColumn("section_decision", dec)


def group_cap_selection(relations: DataFrame, group_col: str, cap: int, preselected=()) -> DataFrame:
    """Preselected features plus the top ``cap`` per group by |corr|
    (name tie-break), with a reason text."""
    w = Window.partitionBy(group_col).orderBy(F.desc_nulls_last(F.abs("max_abs_corr")), F.asc("feature"))
    r = relations.withColumn("group_rank", F.row_number().over(w))
    pre = F.col("feature").isin(list(preselected)) if preselected else F.lit(False)
    sel = pre | (F.col("group_rank") <= cap)
    reason = F.when(pre, "preselected").when(F.col("group_rank") <= cap,
                                             F.concat(F.lit("top "), F.lit(str(cap)), F.lit(" in "), F.col(group_col))).otherwise("below cap")
    return r.withColumn("selected", sel).withColumn("reason", reason)


def incremental_group_wrapper(df: DataFrame, date_col: str, target: str, groups: dict[str, list[str]],
                              folds: DataFrame, min_gain: float = 0.001, base: list[str] | None = None,
                              lookahead: int = 5) -> DataFrame:
    """Add feature groups in order; keep a group when it lowers the
    rolling-origin WAPE by more than ``min_gain``. Fits come from one Gram table,
    on the rows that have all features; a scan scores what the next ``lookahead``
    groups can lead to, whichever of them are kept."""
    from basketry.operators.batchfit import SubsetTrials
    names, kept = list(groups), list(base or [])
    trials = SubsetTrials(cut_lineage(df), date_col, target, kept + [c for cols in groups.values() for c in cols], folds)
    known, rows, taken = trials.wape({"": kept}), [], ""
    cur = known[""]
    for i, name in enumerate(names):
        key = f"{taken}|{i}"
        if key not in known:
            known |= trials.wape(_continuations(groups, names, i, taken, kept, lookahead))
        gain = cur - known[key]
        keep = gain > min_gain
        rows.append((name, float(cur), float(known[key]), float(gain), bool(keep)))
        if keep:
            kept, cur, taken = kept + groups[name], known[key], key
    return df.sparkSession.createDataFrame(rows, "feature_group string, wape_before double, wape_with double, gain double, kept boolean")


def _continuations(groups, names, start, taken, kept, lookahead) -> dict[str, list[str]]:
    """Feature subsets that the next groups can lead to, named by the groups taken."""
    states, out = [(taken, kept)], {}
    for i in range(start, min(len(names), start + lookahead)):
        more = [(f"{t}|{i}", k + groups[names[i]]) for t, k in states]
        out |= dict(more)
        states += more
    return out


def family_wrapper(df: DataFrame, date_col: str, target: str, base: list[str], families: dict[str, list[str]],
                   folds: DataFrame, min_gain: float = 0.0005) -> DataFrame:
    """Baseline + one family at a time, all scored in one scan; keep
    families with gain above ``min_gain``."""
    from basketry.operators.batchfit import SubsetTrials
    trials = SubsetTrials(cut_lineage(df), date_col, target, base + [c for cols in families.values() for c in cols], folds)
    found = trials.wape({"base": base} | {f"+{n}": base + cols for n, cols in families.items()})
    b = found["base"]
    rows = [(n, float(b), float(found[f"+{n}"]), float(b - found[f"+{n}"]), bool(b - found[f"+{n}"] > min_gain)) for n in families]
    return df.sparkSession.createDataFrame(rows, "family string, baseline_wape double, wape_with double, gain double, kept boolean")


def dual_model_wrapper(folds, base: list[str], candidates: list[str], label: str, weight: str | None = None,
                       max_parallel: int = 4, merge_equal: bool = False) -> DataFrame:
    """Per model (logistic, boosted trees), candidate and fold the PR-AUC and
    ROC-AUC of the baseline features and of the baseline with the candidate.
    ``folds`` are ``(fold, train, validation)`` with all features and the weight.
    All logistic fits are made together, the boosted ones ``max_parallel`` at a time on
    the cells of all rows: a tree only sees the bins of its columns.
    ``merge_equal`` (for features of few values each): the logistic steps read rows
    that agree in all features and label as one row with their weights summed."""
    from basketry.operators.batchfit import batch_logistic, batch_scores, bin_cells, fold_rows, long_folds, run_trials, split_points
    from basketry.operators.evaluate import ranking_metrics
    from basketry.operators.models import assemble, gbt_classifier, positive_probability
    columns = list(dict.fromkeys([*base, *candidates]))
    sets = [base] + [list(dict.fromkeys([*base, c])) for c in candidates]
    prepared = [(fold, train, valid, columns) for fold, train, valid, *_ in folds]
    rows, by_fold = long_folds(prepared, label, weight)
    valid, _ = long_folds(prepared, label, None, role="validation")
    rows, valid = cut_lineage(rows), cut_lineage(valid)  # read by every step
    few = fold_rows(rows)
    fits = batch_logistic(rows, by_fold, [{"features": s} for s in sets], merge_equal=merge_equal, first_rows=few)
    metrics = ranking_metrics(batch_scores(valid, fits), "label", "score", ["candidate", "fold"], once=True)
    found = {("logistic", r["candidate"], r["fold"]): (r["pr_auc"], r["roc_auc"]) for r in metrics.collect()}

    points = {fold: split_points(sample) for fold, sample in few.items()}
    places = [[columns.index(c) for c in s] for s in sets]
    train_cells, valid_cells = (cut_lineage(bin_cells(d, points, places)) for d in (rows, valid))

    def of(cells, i, fold):
        part = cells.filter((F.col("candidate") == i) & (F.col("fold") == fold))
        return part.select("candidate", "fold", "label", "weight", "n", *[F.col("bins")[k].alias(f"_bin_{k}") for k in range(len(sets[i]))])

    def boosted(i, fold):
        bins = [f"_bin_{k}" for k in range(len(sets[i]))]
        def run():
            model = gbt_classifier(of(train_cells, i, fold), bins, "label", "weight", maxIter=10, maxDepth=3)
            scored = positive_probability(model.transform(assemble(of(valid_cells, i, fold), bins)))
            return scored.select("candidate", "fold", "label", "n", "probability_1")
        return run

    spark = folds[0][1].sparkSession
    scored = run_trials(spark, {(i, fold): boosted(i, fold) for i in range(len(sets)) for fold in by_fold}, max_parallel)
    metrics = ranking_metrics(reduce(DataFrame.unionByName, scored.values()), "label", "probability_1", ["candidate", "fold"], n="n", once=True)
    found |= {("gbt", r["candidate"], r["fold"]): (r["pr_auc"], r["roc_auc"]) for r in metrics.collect()}
    out = []
    for model in ("logistic", "gbt"):
        for i, c in enumerate(candidates, start=1):
            for fold, *_ in prepared:
                (ap, roc), (ap0, roc0) = found[model, i, int(fold)], found[model, 0, int(fold)]
                out.append((model, c, int(fold), ap, ap0, ap - ap0, roc, roc0, roc - roc0))
    return spark.createDataFrame(out, "model string, feature string, fold int, pr_auc double, baseline_pr_auc double, delta_pr_auc double, "
                                      "roc_auc double, baseline_roc_auc double, delta_roc_auc double")


def wrapper_summary(deltas: DataFrame, max_mean_delta: float = -0.001) -> DataFrame:
    """L12 per model and feature: mean, least and greatest PR-AUC delta, folds that
    lose, the same for ROC-AUC. A model finds consistent harm when its mean delta is at
    most ``max_mean_delta`` and every fold loses."""
    d = F.col("delta_pr_auc")
    s = deltas.groupBy("model", "feature").agg(
        F.count(F.lit(1)).alias("n_folds"), F.avg(d).alias("mean_delta_pr_auc"), F.count_if(d < 0).alias("negative_pr_folds"),
        F.min(d).alias("min_delta_pr_auc"), F.max(d).alias("max_delta_pr_auc"), F.avg("delta_roc_auc").alias("mean_delta_roc_auc"),
        F.count_if(F.col("delta_roc_auc") < 0).alias("negative_roc_folds"))
    return s.withColumn("model_consistent_harm", (F.col("mean_delta_pr_auc") <= max_mean_delta) & (F.col("negative_pr_folds") == F.col("n_folds")))


def wrapper_consensus(summary: DataFrame, models=("logistic", "gbt")) -> DataFrame:
    """L12 decision per feature: dropped only if every model by itself finds
    consistent harm (a model without a row finds none)."""
    harm = [F.coalesce(F.bool_or(F.when(F.col("model") == m, F.col("model_consistent_harm"))), F.lit(False)).alias(f"{m}_harm") for m in models]
    out = summary.groupBy("feature").agg(*harm)
    both = reduce(lambda a, b: a & b, [F.col(f"{m}_harm") for m in models])
    return out.withColumn("consistent_harm_consensus", both).withColumn(
        "decision", F.when(F.col("consistent_harm_consensus"), "DROP_CONSISTENT_HARM").otherwise("KEEP_OR_WATCH"))


def selection_report(candidates: DataFrame, stages: dict[str, DataFrame], feature: str = "feature") -> DataFrame:
    """One row per candidate with each gate's decision joined in, the
    final decision (first failing gate) and reason."""
    out = candidates
    for name, st in stages.items():
        out = out.join(st.select(feature, F.col("passed").alias(f"{name}_passed")), feature, "left")
    failing = [F.when(F.col(f"{n}_passed") == False, F.lit(n)) for n in stages]  # noqa: E712
    first_fail = F.coalesce(*failing) if failing else F.lit(None)
    return out.withColumn("failed_stage", first_fail).withColumn(
        "decision", F.when(F.col("failed_stage").isNull(), "selected").otherwise("rejected"))


def selection_funnel(report: DataFrame) -> DataFrame:
    return report.groupBy("decision", "failed_stage").agg(F.count(F.lit(1)).alias("n_features"))


HISTORY_TOKENS = r"(lag|rolling|prior|past|before|history|prev|diff|pct_change)"
TARGET_TOKENS = r"(return|revenue|cogs|label|target)"
META_TOKENS = r"(_id$|^id$|date|split|timestamp)"


def leakage_name_review(names_df: DataFrame, name_col: str = "feature", model_cols=None) -> DataFrame:
    """Target-like names without a history token, metadata-like names,
    and names absent from the model table → needs_review."""
    n = F.lower(F.col(name_col))
    tgt = n.rlike(TARGET_TOKENS) & ~n.rlike(HISTORY_TOKENS)
    meta = n.rlike(META_TOKENS)
    absent = ~F.col(name_col).isin(list(model_cols)) if model_cols is not None else F.lit(False)
    return names_df.withColumn("target_like_no_history", tgt).withColumn("metadata_risk", meta) \
        .withColumn("not_in_model_table", absent).withColumn("needs_review", tgt | meta | absent)


def readiness_checklist(spark: SparkSession, checks: list[tuple[str, bool]], raise_on_fail: bool = True) -> DataFrame:
    """Named boolean checks (each computed by a Spark action upstream);
    raises when any fails."""
    df = spark.createDataFrame([(n, bool(v)) for n, v in checks], "check_name string, passed boolean")
    failed = [n for n, v in checks if not v]
    if failed and raise_on_fail:
        raise AssertionError(f"readiness checks failed: {failed}")
    return df


def modeling_schema(df: DataFrame, roles: dict[str, str] | None = None) -> DataFrame:
    """Column, role, dtype (schema metadata only)."""
    roles = roles or {}
    rows = [(f.name, roles.get(f.name, "feature"), f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, role string, dtype string")


def family_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """Features per (source, kind) before and after selection; absent
    after → 0."""
    b = before.groupBy("source", "kind").agg(F.count(F.lit(1)).alias("n_before"))
    a = after.groupBy("source", "kind").agg(F.count(F.lit(1)).alias("n_after"))
    return b.join(a, ["source", "kind"], "left").na.fill(0, subset=["n_after"])


def feature_score_table(base: DataFrame, tables: list[DataFrame], feature: str = "feature") -> DataFrame:
    """Chain of 1:1 left joins of per-feature results."""
    return reduce(lambda acc, t: acc.join(t, feature, "left"), tables, base)


def forward_group_selection(df: DataFrame, date_col: str, target: str, groups: dict[str, list[str]],
                            folds: DataFrame, base: list[str] | None = None, min_gain: float = 0.0) -> DataFrame:
    """Greedy forward selection - at each step every remaining group is
    tried (all in one scan, fits from one Gram table), the best mean-WAPE gain is
    kept, and it stops when nothing gains."""
    from basketry.operators.batchfit import SubsetTrials
    kept, remaining, step, rows = list(base or []), dict(groups), 0, []
    trials = SubsetTrials(cut_lineage(df), date_col, target, kept + [c for cols in groups.values() for c in cols], folds)
    cur = None
    while remaining:
        step += 1
        tried = trials.wape(({} if cur is not None else {"": kept}) | {f"+{g}": kept + cols for g, cols in remaining.items()})
        cur = tried.pop("") if cur is None else cur
        best = min(remaining, key=lambda g: (tried[f"+{g}"], g))
        after = tried[f"+{best}"]
        gain = cur - after
        rows.append((step, best, float(cur), float(after), float(gain), bool(gain > min_gain)))
        if not gain > min_gain:
            break
        kept += remaining.pop(best)
        cur = after
    return df.sparkSession.createDataFrame(rows, "step int, feature_group string, wape_before double, wape_after double, gain double, accepted boolean")


def redundancy_groups(pairs: DataFrame, threshold: float = 0.9, corr_col: str = "corr") -> DataFrame:
    """Features linked by |corr| ≥ threshold share a group id (the
    smallest member name). Each round a feature takes the least label among
    its neighbours, then the label of its label (pointer jumping), so a chain
    of n links settles in about log n rounds; the loop ends at the fixed
    point, lineage cut each round. Returns (feature, group_id,
    is_representative)."""
    e = pairs.filter(F.abs(corr_col) >= threshold).select(F.col("feature_a").alias("src"), F.col("feature_b").alias("dst"))
    edges = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    nodes = pairs.select(F.col("feature_a").alias("node")).unionByName(pairs.select(F.col("feature_b").alias("node"))).distinct()
    labels = nodes.withColumn("label", F.col("node"))
    while True:
        prop = edges.join(labels, edges["src"] == labels["node"]).select(F.col("dst").alias("node"), F.col("label").alias("cand"))
        new = labels.join(prop.groupBy("node").agg(F.min("cand").alias("cand")), "node", "left") \
            .select("node", F.least("label", F.coalesce("cand", "label")).alias("label"))
        # hook: the neighbours' best label also reaches the feature that carried the old label
        hooked = (prop.join(labels, "node").select(F.col("label").alias("node"), F.col("cand"))
                  .groupBy("node").agg(F.min("cand").alias("hook")))
        new = new.join(hooked, "node", "left").select("node", F.least("label", F.coalesce("hook", "label")).alias("label"))
        jump = new.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = cut_lineage(new.join(jump, "label", "left").select("node", F.least("label", F.coalesce("far", "label")).alias("label")))
        changed = new.join(labels.withColumnRenamed("label", "old"), "node").filter(F.col("label") != F.col("old")).limit(1).count()
        labels = new
        if changed == 0:
            break
    return labels.select(F.col("node").alias("feature"), F.col("label").alias("group_id"),
                         (F.col("node") == F.col("label")).alias("is_representative"))
