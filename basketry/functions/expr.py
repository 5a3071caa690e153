"""Scalar column expressions (§2.9). All return ``Column`` objects built
from Spark built-ins so they stay inside whole-stage codegen."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(a, b) -> Column:
    """A / b, NULL when b is 0 or NULL (never an ANSI error)."""
    return F.try_divide(_c(a), _c(b))


def line_measures(qty="quantity", price="unit_price", discount="discount_amount",
                  refund=None, cost=None) -> dict[str, Column]:
    """gross = qty*price, net = gross - discount - refund, cost,
    profit, margin, discount rate. Missing discount/refund count as 0."""
    gross = _c(qty) * _c(price)
    disc = F.coalesce(_c(discount), F.lit(0.0))
    ref = F.coalesce(_c(refund), F.lit(0.0)) if refund else F.lit(0.0)
    net = gross - disc - ref
    out = {"gross": gross, "net": net, "discount_rate": safe_div(disc, gross)}
    if cost is not None:
        total_cost = _c(qty) * _c(cost)
        out["cost"] = total_cost
        out["profit"] = net - total_cost
        out["margin"] = safe_div(net - total_cost, net)
    return out


def log1p_clip(x) -> Column:
    """log(1 + max(x, 0)); NULL stays NULL."""
    return F.log1p(F.greatest(_c(x), F.lit(0.0)))


def clip(x, lo=None, hi=None) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL (greatest/least skip nulls,
    so the guard is explicit)."""
    c = _c(x)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 int; NULL condition → 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def ieq(x, value: str) -> Column:
    """Case-insensitive, trimmed string equality (the cash-flag trap)."""
    return F.lower(F.trim(_c(x))) == F.lit(value.strip().lower())


def concat_interaction(a, b, unknown="Unknown", sep="_") -> Column:
    """coalesce(a,'Unknown') || '_' || coalesce(b,'Unknown')."""
    return F.concat_ws(sep, F.coalesce(_c(a).cast("string"), F.lit(unknown)),
                       F.coalesce(_c(b).cast("string"), F.lit(unknown)))


def slugify(value: str) -> str:
    """I07 (driver-side, for column names): lower, trim, non-alnum → '_'."""
    s = re.sub(r"[^0-9a-z]+", "_", str(value).strip().lower())
    return s.strip("_") or "blank"


def slugify_col(x) -> Column:
    """I07 as a column expression."""
    s = F.regexp_replace(F.lower(F.trim(_c(x))), r"[^0-9a-z]+", "_")
    return F.regexp_replace(s, r"^_+|_+$", "")


def format_percent(x, digits=2) -> Column:
    """0.1234 → '12.34%'."""
    return F.concat(F.format_number(_c(x) * 100, digits), F.lit("%"))


def format_pp(x, digits=1) -> Column:
    """Signed percentage points, 0.012 → '+1.2 pp'."""
    v = _c(x) * 100
    return F.concat(F.when(v >= 0, F.lit("+")).otherwise(F.lit("")),
                    F.format_string(f"%.{digits}f", v), F.lit(" pp"))


def format_money(x, digits=1) -> Column:
    """1234 → '1.2K', 2.5e6 → '2.5M', 3e9 → '3.0B'."""
    c = _c(x)
    a = F.abs(c)
    fmt = f"%.{digits}f"
    return (F.when(a >= 1e9, F.concat(F.format_string(fmt, c / 1e9), F.lit("B")))
            .when(a >= 1e6, F.concat(F.format_string(fmt, c / 1e6), F.lit("M")))
            .when(a >= 1e3, F.concat(F.format_string(fmt, c / 1e3), F.lit("K")))
            .otherwise(F.format_string(fmt, c)))


# Relation-strength thresholds on |r| (strong, medium, weak).
RELATION_LEVELS = [(0.60, "strong"), (0.30, "medium"), (0.10, "weak")]


def relation_label(r) -> Column:
    """|r| ≥ .60 strong, ≥ .30 medium, ≥ .10 weak, else unclear."""
    a = F.abs(_c(r))
    out = None
    for thr, name in RELATION_LEVELS:
        out = F.when(a >= thr, F.lit(name)) if out is None else out.when(a >= thr, F.lit(name))
    return out.otherwise(F.lit("unclear"))


def date_parts(d) -> dict[str, Column]:
    """Year, month, day, day of year, 'yyyy-MM' period, day name."""
    c = _c(d)
    return {
        "year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c),
        "day_of_year": F.dayofyear(c), "period": F.date_format(c, "yyyy-MM"),
        "day_name": F.date_format(c, "EEEE"),
    }


# Time-series suffixes stripped to find a feature family.
FAMILY_SUFFIX = r"(_lag_\d+d?|_rolling_\d+d?_(mean|sum|std|min|max)|_diff_\d+d?|_pct_change_\d+d?)$"


def regex_family(name) -> Column:
    """Strip the lag/rolling/diff/pct-change suffix."""
    return F.regexp_replace(_c(name), FAMILY_SUFFIX, "")


def family_of(name: str) -> str:
    return re.sub(FAMILY_SUFFIX, "", name)


def rowwise_min(*cols) -> Column:
    """Row-wise minimum skipping nulls (pandas min(axis=1))."""
    return F.least(*[_c(c) for c in cols])


def any_null(*cols) -> Column:
    return F.exists(F.array(*[_c(c).isNull() for c in cols]), lambda x: x)


def all_null(*cols) -> Column:
    return F.forall(F.array(*[_c(c).isNull() for c in cols]), lambda x: x)


def rowwise_mean(*cols) -> Column:
    """Mean of the non-null values of the row, NULL when all are null."""
    cs = [_c(c).cast("double") for c in cols]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cs), F.lit(0.0))
    n = sum((c.isNotNull().cast("int") for c in cs), F.lit(0))
    return F.try_divide(total, n.cast("double"))


def select_ladder(cases: list[tuple[Column, object]], default=None) -> Column:
    """First matching condition wins, else default."""
    out = None
    for cond, val in cases:
        v = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if out is None else out.otherwise(d)


def is_finite(x) -> Column:
    c = _c(x)
    return c.isNotNull() & ~F.isnan(c) & (c != float("inf")) & (c != float("-inf"))


def pi() -> Column:
    return F.lit(math.pi)


def normalised_key(x) -> Column:
    """Text key normalisation: trim, drop a trailing '.0…' ("609.0" → "609"),
    write whole numbers in E notation as digits ("1.2345678E7" → "12345678")."""
    text = F.trim(_c(x).cast("string"))
    digits = text.try_cast("decimal(38,0)").cast("string")
    whole = text.try_cast("decimal(38,10)") == text.try_cast("decimal(38,0)")
    return F.when(text.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?[eE][+]?[0-9]+$") & whole, digits).otherwise(F.regexp_replace(text, r"\.0+$", ""))


def nested_item_totals(items) -> dict[str, Column]:
    """Totals of an ``array<struct<product_id, quantity, unit_price,
    …>>`` column with higher-order functions (no explode, no shuffle)."""
    it = _c(items)
    return {
        "n_items": F.size(it),
        "total_quantity": F.aggregate(it, F.lit(0.0), lambda acc, x: acc + F.coalesce(x["quantity"], F.lit(0.0))),
        "gross": F.aggregate(it, F.lit(0.0), lambda acc, x: acc + F.coalesce(x["quantity"] * x["unit_price"], F.lit(0.0))),
        "n_products": F.size(F.array_distinct(F.transform(it, lambda x: normalised_key(x["product_id"])))),
    }
