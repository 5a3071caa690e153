"""End-to-end feature tables (§2.13).

Order features are built from *pre-aggregated blocks* joined on the order
key (one shuffle key), never from the order × item fan-out joined first.
Daily tables are one row per day, so their windows are small.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.calendar import calendar_columns
from basketry.functions.expr import clip, flag, ieq, log1p_clip, normalised_key, slugify
from basketry.functions.primitives import null_safe_join
from basketry.operators.binning import tenure_group
from basketry.operators.govern import banned_column_guard
from basketry.operators.joins import left_join_chain, lookup_enrich
from basketry.operators.rules import join_rowcount_check
from basketry.operators.timeseries import feature_name_compiler, lag_features, rolling_mean_past, densify
from basketry.session import Workspace, cut_lineage


def daily_sales(items: DataFrame, products: DataFrame, date_col: str = "ship_date",
                out_date: str = "sale_date") -> DataFrame:
    """Daily target table: Revenue = Σ(gross − discount), COGS = Σ(quantity
    × product cost) per day. Items are joined to the product price
    (m:1, shuffle or runtime broadcast chosen by AQE) then aggregated
    with a partial aggregate per task."""
    j = items.select(date_col, "product_id", "quantity", "gross", "discount_amount").join(
        products.select("product_id", "price"), "product_id", "left")
    return j.filter(F.col(date_col).isNotNull()).groupBy(F.col(date_col).alias(out_date)).agg(
        F.sum(F.col("gross") - F.col("discount_amount")).alias("revenue"),
        F.sum(F.col("quantity") * F.col("price")).alias("cogs"))


@dataclass
class OrderFeatureSpec:
    """Column roles of an order × item master table and the feature contract."""
    order: str = "order_id"
    customer: str = "customer_id"
    date: str = "order_date"
    product: str = "product_id"
    qty: str = "quantity"
    unit_price: str = "unit_price"
    discount: str = "discount_amount"
    payment: str = "payment_value"
    status: str = "order_status"
    cash_col: str | None = None
    cash_value: str = "cod"
    categorical: list = field(default_factory=list)
    multihot: dict = field(default_factory=dict)
    label_map: dict = field(default_factory=lambda: {"returned": 1, "delivered": 0})
    tenure_preset: str = "serve"

    def multihot_names(self) -> list[str]:
        return [f"{c}_{slugify(v)}" for c, vals in self.multihot.items() for v in vals]

    def numeric(self) -> list[str]:
        return ["customer_tenure_days", "total_quantity", "unique_product_count", "discount_ratio", "log_payment_value"]

    def categorical_all(self) -> list[str]:
        return list(self.categorical) + ["tenure_group"]

    def binary(self) -> list[str]:
        return (["is_cash"] if self.cash_col else []) + ["is_discounted"] + self.multihot_names()

    def feature_columns(self) -> list[str]:
        return self.numeric() + self.categorical_all() + self.binary() + [self.payment]


def serving_features(master: DataFrame, spec: OrderFeatureSpec, history: DataFrame | None = None,
                     tables: Workspace | None = None) -> DataFrame:
    """Order × item master → one row per order: label, numeric,
    categorical, binary and quantile inputs. Banned (target-history)
    columns are refused; a missing required column raises. Item rows are
    reduced to the order in one aggregate (sums, distinct products, multi-hot
    max), order attributes in another (min — deterministic value per order).
    With ``tables`` the former is a table of that workspace ("order_items"), so that
    the shuffled item rows are gone before orders are joined and shuffled."""
    banned_column_guard(master)
    need = [spec.order, spec.customer, spec.date, spec.product, spec.qty, spec.unit_price, spec.discount, spec.payment,
            *spec.categorical, *spec.multihot]
    missing = [c for c in need if c not in master.columns]
    if missing:
        raise ValueError(f"master table lacks columns {missing}")
    attrs = [spec.customer, spec.date, spec.payment, *spec.categorical] + ([spec.status] if spec.status in master.columns else [])
    attrs += [spec.cash_col] if spec.cash_col and spec.cash_col not in attrs else []
    mh = [F.max(F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))).alias(f"{c}_{slugify(v)}")
          for c, vals in spec.multihot.items() for v in vals]
    # Order attributes are taken as min() per order: deterministic even if a
    # master table carries conflicting values for one order (grouping by
    # them would split the order instead). They are a block of their own: text
    # in an aggregate makes Spark sort the item rows instead of hashing them, and
    # min() alone needs no item rows where the master table left-joins them.
    own = master.groupBy(spec.order).agg(*[F.min(a).alias(a) for a in attrs])
    block = master.groupBy(spec.order).agg(
        F.sum(spec.qty).alias("total_quantity"), F.count_distinct(spec.product).alias("unique_product_count"),
        F.sum(spec.discount).alias("_disc"), F.sum(F.col(spec.qty) * F.col(spec.unit_price)).alias("_gross"), *mh)
    block = tables.save(block, "order_items") if tables else block
    o = null_safe_join(own, block, spec.order)
    hist = history if history is not None else o.select(spec.customer, spec.date)
    first = hist.groupBy(spec.customer).agg(F.min(spec.date).alias("_first"))
    o = o.join(first, spec.customer, "left")
    tenure = F.datediff(F.col(spec.date), F.col("_first"))
    ratio = F.when(F.col("_gross") > 0, F.col("_disc") / F.col("_gross")).otherwise(F.lit(0.0))
    label = None
    if spec.status in o.columns:
        label = reduce(lambda acc, kv: acc.when(F.col(spec.status) == F.lit(kv[0]), F.lit(kv[1])),
                       list(spec.label_map.items())[1:],
                       F.when(F.col(spec.status) == F.lit(list(spec.label_map)[0]), F.lit(list(spec.label_map.values())[0])))
    from basketry.operators.clean import coalesce_default_clean
    cols = [spec.order, (label if label is not None else F.lit(None)).cast("int").alias("label"),
            tenure.alias("customer_tenure_days"), "total_quantity", "unique_product_count", ratio.alias("discount_ratio"),
            log1p_clip(spec.payment).alias("log_payment_value"),
            # serving contract: categorical text trimmed, lower-cased, 'unknown' default
            *[coalesce_default_clean(c).alias(c) for c in spec.categorical],
            tenure_group(tenure, spec.tenure_preset).alias("tenure_group")]
    if spec.cash_col:
        cols.append(flag(ieq(spec.cash_col, spec.cash_value)).alias("is_cash"))
    cols += [flag(ratio > 0).alias("is_discounted"), *spec.multihot_names(), spec.payment]
    return o.select(*cols)


def order_feature_table(orders: DataFrame, items: DataFrame, customers: DataFrame, products: DataFrame,
                        multihot: dict, label_col: str = "returned", date_col: str = "order_date") -> DataFrame:
    """One row per labelled order: item block (F14 + label + multi-hot, one
    aggregate to the order), customer block, payment and calendar blocks,
    joined on order_id. The target-history block (G12) is audit-only and not here."""
    from basketry.operators.rollup import order_item_summary
    it = items.join(products.select("product_id", *multihot.keys()), "product_id", "left")
    blk_items = order_item_summary(it, "order_id", "product_id", "quantity", "gross", "discount_amount",
                                   extra=[F.max((F.col("return_flag") == "R").cast("int")).alias(label_col),
                                          *[F.max(F.when(F.col(c) == F.lit(v), 1).otherwise(0)).alias(f"{c}_{slugify(v)}")
                                            for c, vals in multihot.items() for v in vals]])
    first = orders.groupBy("customer_id").agg(F.min(date_col).alias("_first"))
    base = orders.join(first, "customer_id", "left").join(customers, "customer_id", "left")
    base = base.withColumn("customer_tenure_days", F.datediff(date_col, "_first")).drop("_first")
    base = base.withColumn("tenure_group", tenure_group("customer_tenure_days", "train"))
    base = base.withColumn("log_payment_value", log1p_clip("payment_value"))
    base = base.withColumns({k: v for k, v in calendar_columns(date_col).items() if k in ("dayofweek", "month", "is_weekend")})
    base = base.withColumn("is_q4", flag(F.quarter(date_col) == 4))
    return base.join(blk_items, "order_id", "inner").filter(F.col(label_col).isNotNull())


# Nested order request (one JSON object per order).
ITEM_SCHEMA = T.StructType([T.StructField("product_id", T.StringType()), T.StructField("quantity", T.DoubleType()),
                            T.StructField("unit_price", T.DoubleType()), T.StructField("discount_amount", T.DoubleType())])
ORDER_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("order_date", T.StringType()),
    T.StructField("customer_id", T.LongType()), T.StructField("first_order_date", T.StringType()),
    T.StructField("payment_method", T.StringType()), T.StructField("device_type", T.StringType()),
    T.StructField("payment_value", T.DoubleType()),
    T.StructField("customer", T.StructType([T.StructField("customer_id", T.LongType()),
                                            T.StructField("segment", T.StringType())])),
    T.StructField("payment", T.StructType([T.StructField("payment_method", T.StringType()),
                                           T.StructField("payment_value", T.DoubleType())])),
    T.StructField("items", T.ArrayType(ITEM_SCHEMA))])


def nested_order_features(orders: DataFrame, products: DataFrame, multihot: dict, cash_value: str = "cod",
                          tables: Workspace | None = None) -> DataFrame:
    """M03 (+ I14, B17, E09): parsed nested orders → features with
    higher-order functions; nested alternatives flattened by precedence
    (top-level field, then ``customer`` / ``payment`` struct); text trimmed /
    lower-cased with an ``unknown`` default; quantities clamped at 0; payment
    falls back to gross − discount; ratio clamped to [0, 1]. Item product
    keys are normalised and categories looked up (explode + join + one
    aggregate back to the order). Orders and their item keys are checkpointed before
    that, so that what makes them (joins, parsing) runs once, not once per branch.
    With ``tables`` they are a table of that workspace, which the caller closes
    once the features are read; a checkpoint stays for the whole session."""
    from basketry.operators.clean import coalesce_default_clean, coalesce_nonneg
    o = orders.select(
        "order_id", F.to_date(F.col("order_date")).alias("order_date"),
        F.coalesce("customer_id", "customer.customer_id").alias("customer_id"),
        F.to_date(F.col("first_order_date")).alias("first_order_date"),
        coalesce_default_clean(F.coalesce("payment_method", "payment.payment_method")).alias("payment_method"),
        coalesce_default_clean("device_type").alias("device_type"),
        coalesce_default_clean("customer.segment").alias("segment"),
        F.coalesce("payment_value", "payment.payment_value").alias("_pay"),
        F.coalesce("items", F.array().cast(T.ArrayType(ITEM_SCHEMA))).alias("items"))
    q = lambda x: F.greatest(F.coalesce(x["quantity"], F.lit(0.0)), F.lit(0.0))
    gross = F.aggregate("items", F.lit(0.0), lambda acc, x: acc + q(x) * F.greatest(F.coalesce(x["unit_price"], F.lit(0.0)), F.lit(0.0)))
    disc = F.aggregate("items", F.lit(0.0), lambda acc, x: acc + coalesce_nonneg(x["discount_amount"]))
    o = o.select("*", gross.alias("_gross"), disc.alias("_disc"),
                 F.aggregate("items", F.lit(0.0), lambda acc, x: acc + q(x)).alias("total_quantity"),
                 F.size(F.array_distinct(F.transform("items", lambda x: normalised_key(x["product_id"])))).alias("unique_product_count"))
    pay = F.coalesce(F.col("_pay"), F.greatest(F.col("_gross") - F.col("_disc"), F.lit(0.0)))
    ratio = clip(F.when(F.col("_gross") > 0, F.col("_disc") / F.col("_gross")).otherwise(F.lit(0.0)), 0.0, 1.0)
    start = F.least("first_order_date", "order_date")
    tenure = F.datediff("order_date", start)
    feats = o.select("order_id", tenure.alias("customer_tenure_days"), "total_quantity", "unique_product_count",
                     ratio.alias("discount_ratio"), log1p_clip(pay).alias("log_payment_value"), "payment_method", "device_type",
                     "segment", tenure_group(tenure, "serve").alias("tenure_group"),
                     flag(ieq("payment_method", cash_value)).alias("is_cash"), flag(ratio > 0).alias("is_discounted"),
                     pay.alias("payment_value"), F.transform("items", lambda x: x["product_id"]).alias("_keys"))
    cut = tables.save(feats, "orders") if tables else cut_lineage(feats)
    feats = cut.drop("_keys")
    # categories of the items: explode + lookup + back to the order
    ex = cut.select("order_id", F.explode("_keys").alias("product_key"))
    lk = products.select(F.col("product_id").cast("string").alias("product_key"), *multihot.keys())
    en = lookup_enrich(ex, lk, "product_key", list(multihot.keys()))
    mh = en.groupBy("order_id").agg(*[F.max(F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))).alias(f"{c}_{slugify(v)}")
                                      for c, vals in multihot.items() for v in vals])
    names = [f"{c}_{slugify(v)}" for c, vals in multihot.items() for v in vals]
    return feats.join(mh, "order_id", "left").na.fill(0, subset=names)


def daily_target_table(daily: DataFrame, date_col: str, target: str, cogs: str, lags=(1, 7), windows=(7, 28)) -> DataFrame:
    """Dense daily target with profit, margin, lags and past means."""
    d = densify(daily, date_col)
    d = d.withColumn("profit", F.col(target) - F.col(cogs)).withColumn(
        "margin", F.when(F.col(target) == 0, F.lit(0.0)).otherwise((F.col(target) - F.col(cogs)) / F.col(target)))
    d = lag_features(d, date_col, [target], lags)
    return rolling_mean_past(d, date_col, [target], windows)


def daily_candidate_table(target: DataFrame, sources: dict[str, DataFrame], date_col: str,
                          calendar: bool = True) -> tuple[DataFrame, DataFrame]:
    """Target ⟕ each daily source (1:1 on the date, validated) ⟕
    calendar; returns (table, row-count check)."""
    out = left_join_chain(target, list(sources.values()), date_col, validate=True)
    if calendar:
        out = out.withColumns(calendar_columns(date_col))
    return out, join_rowcount_check(target, out)


def recreate_selected_features(daily: DataFrame, date_col: str, names: list[str], rule: str = "full"):
    """Rebuild a saved feature list from clean daily data (G29), keep
    only the contract (B18) and drop incomplete rows (B19). Returns
    (table, unknown names, drop report)."""
    from basketry.operators.clean import drop_null_feature_rows
    d = densify(daily, date_col)
    out, unknown = feature_name_compiler(d, names, date_col, rule=rule)
    kept, report = drop_null_feature_rows(out, [n for n in names if n not in unknown])
    return kept, unknown, report


def target_driver_table(target: DataFrame, drivers: DataFrame, date_col: str, lags=(1, 7)) -> DataFrame:
    """Target + daily drivers with lag 1 and 7 (for relation tests)."""
    d = densify(target, date_col).join(drivers, date_col, "left")
    vals = [c for c in drivers.columns if c != date_col]
    return lag_features(d, date_col, vals, lags)
