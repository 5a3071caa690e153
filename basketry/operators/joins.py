"""Joins (§2.5).

Physical strategy is left to Catalyst + AQE: a side is broadcast only when
its *measured* size is under ``spark.sql.autoBroadcastJoinThreshold``
(AQE re-plans at runtime with real sizes), otherwise sort-merge with
skew-split. Explicit ``broadcast`` hints appear only on tables whose size is
bounded by construction (one-row totals, fixed rule tables).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.expr import normalised_key
from basketry.operators.rules import assert_unique_key


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def keyed_join(left: DataFrame, right: DataFrame, on, how: str = "left",
               null_safe: bool = False) -> DataFrame:
    """Equi-join on same-named keys. ``null_safe=True`` matches NULL
    keys to each other (pandas merge semantics) via ``<=>``; the default is
    SQL semantics. Key columns appear once in the output."""
    keys = _keys(on)
    if not null_safe:
        return left.join(right, keys, how)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys])
    j = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return j
    if how in ("right", "full", "outer", "full_outer"):
        for k in keys:
            j = j.withColumn(k, F.coalesce(left[k], F.col(f"_r_{k}")))
    return j.drop(*[f"_r_{k}" for k in keys])


def left_join_m1(fact: DataFrame, dim: DataFrame, on, validate: bool = True,
                 null_safe: bool = False) -> DataFrame:
    """Many-to-one left join; ``validate`` raises first when the
    dimension key is not unique (pandas ``validate="m:1"``)."""
    if validate:
        assert_unique_key(dim, _keys(on))
    return keyed_join(fact, dim, on, "left", null_safe)


def left_join_chain(base: DataFrame, others: list[DataFrame], on="date",
                    validate: bool = False) -> DataFrame:
    """Chain of 1:1 left joins on one key. Sort-merge joins on the
    same key reuse the first join's hash partitioning, so only the new side
    is shuffled at each step."""
    out = base
    for o in others:
        if validate:
            assert_unique_key(o, _keys(on))
        out = out.join(o, _keys(on), "left")
    return out


def suffix_clashes(df: DataFrame, keep: list[str], existing: list[str], suffix: str) -> DataFrame:
    """Rename columns of ``df`` that clash with ``existing`` (except join
    keys in ``keep``) by appending ``suffix``."""
    return df.select(*[F.col(c).alias(c + suffix) if (c in existing and c not in keep) else F.col(c)
                       for c in df.columns])


def master_table_join(orders: DataFrame, customers: DataFrame, items: DataFrame,
                      products: DataFrame, payments: DataFrame | None = None,
                      order_key="order_id", customer_key="customer_id", product_key="product_id"):
    """Orders ⟕ customers ⟕ items ⟕ products ⟕ payments; clashing
    names get ``_customer`` / ``_item`` / ``_product`` / ``_payment``. Grain
    becomes order × item (orders without items keep one row)."""
    out = orders
    c = suffix_clashes(customers, [customer_key], out.columns, "_customer")
    out = out.join(c, customer_key, "left")
    i = suffix_clashes(items, [order_key], out.columns, "_item")
    out = out.join(i, order_key, "left")
    p = suffix_clashes(products, [product_key], out.columns, "_product")
    out = out.join(p, product_key, "left")
    if payments is not None:
        pay = suffix_clashes(payments, [order_key], out.columns, "_payment")
        out = out.join(pay, order_key, "left")
    return out


def inner_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """E04."""
    return left.join(right, _keys(on), "inner")


def semi_join(left: DataFrame, keys_df: DataFrame, on) -> DataFrame:
    """Key membership filter (``isin(set)`` at scale)."""
    return left.join(keys_df.select(*_keys(on)), _keys(on), "left_semi")


def anti_join(left: DataFrame, keys_df: DataFrame, on) -> DataFrame:
    """Rows of ``left`` whose key is absent on the right."""
    return left.join(keys_df.select(*_keys(on)), _keys(on), "left_anti")


def asof_ffill_join(spine: DataFrame, snapshots: DataFrame, date_col: str, values,
                    keys=(), spine_date: str | None = None) -> DataFrame:
    """Forward-fill periodic snapshots onto a daily spine.

    Each snapshot is valid on [its date, next snapshot date − 1] (the last
    one up to the spine's last day); validity ranges are expanded with
    ``sequence`` per snapshot row and equi-joined to the spine, so no global
    ordered window is needed. Days before the first snapshot get NULL."""
    from pyspark.sql import Window
    keys = list(keys)
    spine_date = spine_date or date_col
    last_day = spine.select(F.max(spine_date)).scalar()
    w = Window.partitionBy(*keys).orderBy(date_col)
    nxt = F.lead(date_col).over(w)
    ranges = snapshots.select(*keys, F.col(date_col).alias("_from"),
                              F.coalesce(F.date_sub(nxt, 1), last_day).alias("_to"), *values)
    ranges = ranges.filter(F.col("_from") <= F.col("_to"))
    days = ranges.select(*keys, F.explode(F.sequence("_from", "_to")).alias(spine_date), *values)
    return spine.join(days, [*keys, spine_date], "left")


def interval_active(spine: DataFrame, intervals: DataFrame, start: str, end: str,
                    measure: str | None = None, day_col: str = "date",
                    with_max: bool = True, decimal_scale: int | None = None) -> DataFrame:
    """For each spine day, the intervals [start, end] covering it:
    active count, and mean / sum / max of ``measure``.

    count and sum use a sweep (+v at start, −v at end+1, running sum over the
    day axis), linear in the number of intervals. max is not invertible, so
    it uses a dyadic (segment-tree) cover: each interval emits at most two
    aligned blocks per level, block maxima are aggregated, and each day
    takes the max over its ancestor blocks — O(n·log L) rows instead of one
    row per covered day. Intervals with NULL bounds or start > end are
    ignored. Never a day × interval cross join. With ``decimal_scale`` the
    sweep runs on exact decimals (money: 2), so adding and removing values
    over a long calendar accumulates no rounding error."""
    from pyspark.sql import Window
    iv = intervals.filter(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))
    m = F.col(measure).cast("double") if measure else F.lit(0.0)
    v = iv.select(F.col(start).alias("_s"), F.col(end).alias("_e"), m.alias("_m"))
    sweep_t = f"decimal(38,{decimal_scale})" if decimal_scale is not None else "double"
    zero = F.lit(0).cast(sweep_t)
    mv = F.col("_m").cast(sweep_t)
    deltas = v.select(F.col("_s").alias(day_col), F.lit(1).alias("_dn"),
                      mv.alias("_dv"), F.col("_m").isNotNull().cast("int").alias("_dc")).unionByName(
        v.select(F.date_add("_e", 1).alias(day_col), F.lit(-1).alias("_dn"),
                 (-mv).alias("_dv"), (-(F.col("_m").isNotNull().cast("int"))).alias("_dc")))
    # Pre-aggregated to one row per distinct day before the (small) day-axis window.
    daily = deltas.groupBy(day_col).agg(F.sum("_dn").alias("_dn"), F.sum(F.coalesce("_dv", zero)).alias("_dv"),
                                        F.sum("_dc").alias("_dc"))
    both = spine.select(day_col).distinct().join(daily, day_col, "full")
    w = Window.orderBy(day_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = both.select(day_col, F.sum(F.coalesce("_dn", F.lit(0))).over(w).alias("active_count"),
                      F.sum(F.coalesce("_dv", zero)).over(w).alias("_sum"),
                      F.sum(F.coalesce("_dc", F.lit(0))).over(w).alias("_cnt"))
    out = spine.join(run, day_col, "left").withColumn(
        "active_count", F.coalesce("active_count", F.lit(0)).cast("long"))
    if measure:
        out = (out.withColumn("active_sum", F.when(F.col("_cnt") > 0, F.col("_sum").cast("double")).otherwise(F.lit(0.0)))
               .withColumn("active_mean", F.when(F.col("_cnt") > 0, F.col("_sum").cast("double") / F.col("_cnt"))))
        if with_max:
            out = out.join(_dyadic_interval_max(spine.select(day_col).distinct(), v, day_col), day_col, "left")
    return out.drop("_sum", "_cnt")


def _dyadic_interval_max(days: DataFrame, iv: DataFrame, day_col: str) -> DataFrame:
    """Max of ``_m`` over intervals [_s, _e] covering each day.

    Intervals are clipped to the first and last spine day, and the number of
    levels follows from that span, so open-ended intervals cost no more.

    Day numbers d = days since epoch. At level k an aligned block j covers
    [j·2^k, (j+1)·2^k − 1]. The canonical cover of [s, e] uses, per level,
    only the first and last blocks fully inside whose parent block is not
    fully inside; every covered day has exactly one ancestor block in the
    cover, so max over ancestors = max over covering intervals."""
    epoch = F.lit("1970-01-01").cast("date")
    first, last = days.agg(F.min(F.datediff(day_col, epoch)), F.max(F.datediff(day_col, epoch))).first()
    first, last = first or 0, last if last is not None else -1
    levels = max(1, (last - first + 1).bit_length())
    d = iv.filter(F.col("_m").isNotNull()).select(
        F.greatest(F.datediff("_s", epoch), F.lit(first)).cast("long").alias("_a"),
        F.least(F.datediff("_e", epoch), F.lit(last)).cast("long").alias("_b"), "_m").filter(F.col("_a") <= F.col("_b"))
    # one row per (interval, level), then at most two candidate blocks
    lv = d.select("*", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("k"))
    size = F.expr("shiftleft(CAST(1 AS BIGINT), k)")
    lv = lv.select("*", F.ceil(F.col("_a") / size).cast("long").alias("_lo"),
                   (F.floor((F.col("_b") + 1) / size) - 1).cast("long").alias("_hi")).filter(F.col("_lo") <= F.col("_hi"))
    cand = lv.select("_a", "_b", "_m", "k", F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("j"))
    psize = F.expr("shiftleft(CAST(2 AS BIGINT), k)")
    parent = F.floor(F.col("j") / 2)
    p_inside = (parent * psize >= F.col("_a")) & ((parent + 1) * psize - 1 <= F.col("_b"))
    cover = cand.filter(~p_inside | (F.col("k") == levels - 1))
    bmax = cover.groupBy("k", "j").agg(F.max("_m").alias("_bm"))
    dn = F.datediff(F.col(day_col), epoch).cast("long")
    anc = days.select(day_col, F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("k"))
    anc = anc.select(day_col, "k", F.floor(dn / F.expr("shiftleft(CAST(1 AS BIGINT), k)")).cast("long").alias("j"))
    return anc.join(bmax, ["k", "j"], "inner").groupBy(day_col).agg(F.max("_bm").alias("active_max"))


def lookup_enrich(items: DataFrame, lookup: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Fill item attributes from a lookup when absent on the item; the
    key is normalised on both sides first."""
    lk = lookup.select(normalised_key(key).alias("_lk_key"),
                       *[F.col(c).alias(f"_lk_{c}") for c in cols])
    base = items.withColumn("_lk_key", normalised_key(key))
    j = base.join(lk, "_lk_key", "left")
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(c), F.col(f"_lk_{c}")) if c in items.columns else F.col(f"_lk_{c}"))
    return j.drop("_lk_key", *[f"_lk_{c}" for c in cols])


def date_offset_join(df: DataFrame, date_col: str, value_col: str, days: int = 7,
                     keys=(), out: str | None = None) -> DataFrame:
    """Value on date − ``days`` looked up by calendar date (not a row
    lag): a self equi-join on ``date_add(date, days)``."""
    out = out or f"{value_col}_same_day_{days}d_ago"
    hist = df.select(*keys, F.date_add(F.col(date_col), days).alias(date_col), F.col(value_col).alias(out))
    return df.join(hist, [*keys, date_col], "left")
