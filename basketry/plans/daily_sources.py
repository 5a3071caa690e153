"""The daily model table from a catalogue of sources with availability.

A source says what its rows are (``kind``) and when a value of day d is known
(``available``). The builder reduces every source to one row per day before any
join, and its availability alone decides which columns reach the model table:

* ``known_now`` - fixed before the day begins (calendar, planned intervals): the
  day's own value is a feature;
* ``after_day`` - known once the day is over (counts and sums of events, forward
  filled snapshots): only lags and past rolling means are, never the day's own value.

Kinds: ``event`` (rows with a date, aggregated), ``snapshot`` (periodic states,
aggregated and carried forward, E07) and ``interval`` (rows valid from a first to a
last day, swept over the day axis, E08). Events are outcomes, so a catalogue that
declares them known beforehand is refused.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.calendar import calendar_columns, days_to_year_end, holiday_flag, us_federal_holidays
from basketry.operators.joins import asof_ffill_join, interval_active
from basketry.operators.timeseries import daily_spine, lag_features, rolling_mean_past
from basketry.session import cut_lineage

KINDS = ("event", "snapshot", "interval")
AVAILABLE = ("known_now", "after_day")
CALENDAR = ("dayofweek", "month", "quarter", "year", "is_weekend")


@dataclass(frozen=True)
class DailySource:
    """One source of daily columns. ``values`` are aggregates per date and
    ``distinct`` columns whose distinct values are counted per date; an interval has
    ``end`` and a ``measure`` instead, its columns begin with ``name``."""
    name: str
    kind: str
    available: str
    frame: DataFrame
    date: str
    values: dict[str, Column] = field(default_factory=dict)
    distinct: dict[str, str] = field(default_factory=dict)
    end: str | None = None
    measure: str | None = None
    decimal_scale: int | None = None  # exact sweeps of money-like measures

    def __post_init__(self):
        if self.kind not in KINDS or self.available not in AVAILABLE:
            raise ValueError(f"{self.name}: kind must be one of {KINDS} and available one of {AVAILABLE}")
        if self.kind == "event" and self.available == "known_now":
            raise ValueError(f"{self.name}: events of a day are not known before the day is over")
        if self.kind == "interval" and not self.end:
            raise ValueError(f"{self.name}: an interval needs its last day")

    def columns(self) -> list[str]:
        if self.kind == "interval":
            return [f"{self.name}_count_active", *([f"{self.name}_{s}" for s in ("mean", "max")] if self.measure else []), f"is_{self.name}_active"]
        return [*self.values, *self.distinct]


def _per_date(source: DailySource) -> DataFrame:
    """One row per date of an event or snapshot source."""
    rows = source.frame.filter(F.col(source.date).isNotNull())
    aggs = [c.alias(n) for n, c in source.values.items()] or [F.count(F.lit(1)).alias("_rows")]
    out = rows.groupBy(F.col(source.date).alias("_date")).agg(*aggs)
    for name, col in source.distinct.items():  # one grouping per counted column, nothing is multiplied
        pairs = rows.filter(F.col(col).isNotNull()).select(F.col(source.date).alias("_date"), F.col(col).alias("_of")).distinct()
        counted = pairs.groupBy("_date").agg(F.count(F.lit(1)).alias(name))
        out = out.join(counted, "_date", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out.select("_date", *source.columns())


def on_days(source: DailySource, spine: DataFrame, date_col: str) -> DataFrame:
    """``date_col`` and the source's columns, one row per day of ``spine`` (days
    without data: NULL, for intervals 0 active and NULL measures as 0)."""
    if source.kind == "interval":
        swept = interval_active(spine.select(date_col), source.frame, source.date, source.end, source.measure, day_col=date_col, decimal_scale=source.decimal_scale)
        out = {f"{source.name}_count_active": F.col("active_count")}
        if source.measure:
            out |= {f"{source.name}_mean": F.coalesce("active_mean", F.lit(0.0)), f"{source.name}_max": F.coalesce("active_max", F.lit(0.0))}
        out[f"is_{source.name}_active"] = (F.col("active_count") > 0).cast("int")
        return swept.select(date_col, *[c.alias(n) for n, c in out.items()])
    daily = _per_date(source).withColumnRenamed("_date", date_col)
    if source.kind == "snapshot":
        # earlier states reach the first days too: the spine's start takes the last one before it
        start, end = spine.agg(F.min(date_col), F.max(date_col)).first()
        before = daily.filter(F.col(date_col) <= F.lit(start)).agg(F.max(date_col)).first()[0]
        if before is not None:
            daily = daily.filter(F.col(date_col) >= F.lit(before)).withColumn(date_col, F.greatest(date_col, F.lit(start)))
        return asof_ffill_join(spine.select(date_col), daily.filter(F.col(date_col) <= F.lit(end)), date_col, source.columns())
    return spine.select(date_col).join(daily, date_col, "left")


@dataclass
class DailyModel:
    table: DataFrame
    known_now: list[str]
    lagged: list[str]
    sources: list[DailySource]

    def catalogue(self, spark: SparkSession) -> DataFrame:
        """One row per source column: its source, kind and availability, and how
        many model columns are made of it."""
        made = {c: 1 if s.available == "known_now" else sum(x.startswith(f"{c}_lag_") or x.startswith(f"{c}_rolling_") for x in self.lagged)
                for s in self.sources for c in s.columns()}
        rows = [(s.name, s.kind, s.available, c, made[c]) for s in self.sources for c in s.columns()]
        return spark.createDataFrame(rows, "source string, kind string, available string, column_name string, n_model_columns int")


def build_daily_model(target: DataFrame, date_col: str, targets: list[str], sources: list[DailySource],
                      lags=(1, 7), windows=(7,)) -> DailyModel:
    """The model table: date, targets, what is known on the day, and lags and past
    rolling means of targets and of all that is only known afterwards."""
    names = [c for s in sources for c in s.columns()]
    if len(names) != len(set(names)) or set(names) & {date_col, *targets}:
        raise ValueError("sources must give different columns")
    spine = cut_lineage(daily_spine(target, date_col))
    out = spine.join(target.select(date_col, *targets), date_col, "left")
    bounds = spine.agg(F.min(date_col).alias("a"), F.max(date_col).alias("z")).first()
    calendar = calendar_columns(date_col)
    out = out.withColumns({c: calendar[c] for c in CALENDAR} | {"days_to_year_end": days_to_year_end(date_col)})
    known = [*CALENDAR, "days_to_year_end"]
    if bounds["a"] is not None:
        out = holiday_flag(out, date_col, us_federal_holidays(target.sparkSession, str(bounds["a"]), str(bounds["z"])))
        known.append("is_holiday")
    late = list(targets)
    for source in sources:
        out = out.join(on_days(source, spine, date_col), date_col, "left")  # one row per day on both sides
        (known if source.available == "known_now" else late).extend(source.columns())
    out = cut_lineage(out)  # one row per day: its windows run on a small table
    out = rolling_mean_past(lag_features(out, date_col, late, lags), date_col, late, windows)
    made = [f"{c}_lag_{k}d" for c in late for k in lags] + [f"{c}_rolling_{w}d_mean" for c in late for w in windows]
    return DailyModel(out.select(date_col, *targets, *known, *made), known, made, sources)


def join_report(model: DailyModel, target: DataFrame, date_col: str) -> DataFrame:
    """Per source the rows before and after its join to the days of ``target``,
    its own days and the days it has nothing for."""
    spine = cut_lineage(daily_spine(target, date_col))
    days = spine.count()
    parts = []
    for s in model.sources:
        daily = on_days(s, spine, date_col)
        has = F.lit(False)
        for c in s.columns():
            has = has | (F.col(c) > 0 if s.kind == "interval" else F.col(c).isNotNull())
        parts.append(daily.agg(F.lit(s.name).alias("source"), F.lit(days).cast("long").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"),
                               F.count_if(~has).alias("unmatched_days")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
