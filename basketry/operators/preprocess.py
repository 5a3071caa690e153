"""Preprocessing fitted on train, applied anywhere (§2.15).

Each ``fit_*`` returns a one-row *state* DataFrame computed from the train
split only; ``apply_*`` fetches that single row once (one value per
column, like MLlib's Imputer/StandardScaler models) and applies it as
literals, so statistics never change when validation or test rows change,
no join or cross product is needed and downstream plans stay small.
``Preprocessor`` chains the steps per column group (O09) and can write its
state as parquet.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.binning import train_fitted_edges, with_edges


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def fit_median(train: DataFrame, cols: list[str]) -> dict:
    """Exact train medians (pandas ``median``) of all columns in two
    scans — one value per column."""
    from basketry.functions.primitives import column_medians
    return column_medians(train, cols)


def _state_row(state) -> dict:
    return state if isinstance(state, dict) else state.first().asDict()


def apply_fill(df: DataFrame, state, cols: list[str]) -> DataFrame:
    """NULL → fitted value (the one-row state is fetched once)."""
    row = _state_row(state)
    return df.withColumns({c: F.coalesce(_q(c), F.lit(row[c])) for c in cols})


def fit_mode(train: DataFrame, cols: list[str]) -> DataFrame:
    """Most frequent non-null value per column, ties → smallest value.
    Text columns share one (column, value, count) aggregate — map-side combined;
    others have one each, which keeps their type."""
    text = [c for c in cols if isinstance(train.schema[c].dataType, T.StringType)]
    out = None
    if text:
        long = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _q(c).alias("v")) for c in text])).alias("r")).select("r.*")
        g = long.filter(F.col("v").isNotNull()).groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
        m = g.groupBy("column_name").agg(F.min_by("v", F.struct((-F.col("n")).alias("nn"), F.col("v").alias("vv"))).alias("v"))
        out = m.agg(*[F.max(F.when(F.col("column_name") == c, F.col("v"))).alias(c) for c in text])
    for c in cols:
        if c in text:
            continue
        g = train.filter(_q(c).isNotNull()).groupBy(_q(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        # max_by on (count, -rank of value): highest count, then smallest value
        m = g.agg(F.min_by("v", F.struct((-F.col("n")).alias("nn"), F.col("v").alias("vv"))).alias(c))
        out = m if out is None else out.unionByName(m, allowMissingColumns=True)
    return out.agg(*[F.max(_q(c)).alias(c) for c in cols])


def apply_constant(df: DataFrame, cols: list[str], value=0) -> DataFrame:
    """NULL → constant."""
    return df.withColumns({c: F.coalesce(_q(c), F.lit(value)) for c in cols})


# Name tokens of count-like columns (filled with 0).
COUNT_TOKENS = {"count", "n", "num", "qty", "quantity", "units", "orders", "sessions", "lines"}


def is_count_like(name: str) -> bool:
    return bool(set(name.lower().split("_")) & COUNT_TOKENS)


def token_impute(train: DataFrame, df: DataFrame, cols: list[str]):
    """Count-like names → 0, other columns → train median. Returns
    (df, audit) with NULL counts before and after."""
    counts = [c for c in cols if is_count_like(c)]
    others = [c for c in cols if c not in counts]
    out = apply_constant(df, counts, 0)
    if others:
        out = apply_fill(out, fit_median(train, others), others)
    before = df.agg(*[F.count_if(_q(c).isNull()).alias(c) for c in cols])
    after = out.agg(*[F.count_if(_q(c).isNull()).alias(c) for c in cols])
    structs = [F.struct(F.lit(c).alias("column_name"), F.lit("zero" if c in counts else "median").alias("rule"),
                        before.select(_q(c)).scalar().alias("nulls_before"), _q(c).alias("nulls_after")) for c in cols]
    audit = after.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
    return out, audit


def fit_scaler(train: DataFrame, cols: list[str], ddof: int = 0) -> DataFrame:
    """Mean and std (``ddof=0`` population like sklearn, 1 sample like
    pandas); zero or NULL std → 1."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    aggs = []
    for c in cols:
        x = _q(c).cast("double")
        s = sd(x)
        aggs += [F.avg(x).alias(f"{c}__mean"), F.when((s.isNull()) | (s == 0), F.lit(1.0)).otherwise(s).alias(f"{c}__std")]
    return train.agg(*aggs)


def apply_scaler(df: DataFrame, state, cols: list[str]) -> DataFrame:
    row = _state_row(state)
    return df.withColumns({c: (_q(c).cast("double") - F.lit(row[f"{c}__mean"])) / F.lit(row[f"{c}__std"]) for c in cols})


def fit_level_table(train: DataFrame, cols: list[str]) -> DataFrame:
    """``column_name, level, level_id``: the train levels of every column
    with ids from 0 in text order. A table: any number of levels, none on the driver."""
    from basketry.functions.primitives import prefix_sum
    from basketry.session import cut_lineage
    long = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _q(c).cast("string").alias("level")) for c in cols])).alias("r"))
    levels = long.select("r.*").filter(F.col("level").isNotNull()).distinct().withColumn("_one", F.lit(1).cast("long"))
    ranked = prefix_sum(levels, "level", "_one", partition_by=["column_name"], inclusive=False, few_groups=True)
    return cut_lineage(ranked.select("column_name", "level", F.col("cum__one").cast("long").alias("level_id")))


def level_counts(table: DataFrame) -> dict[str, int]:
    """Levels per column (one number a column)."""
    return {r["column_name"]: r["n"] for r in table.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}


def _with_level_ids(df: DataFrame, cols: list[str], table: DataFrame) -> DataFrame:
    """``{c}_id`` per column: the id of the row's level, NULL for unseen levels and NULL.
    Rows are joined to the level table by their text (a table of few levels is
    broadcast at run time, one of many is shuffled and its hot levels split)."""
    out = df
    for c in cols:
        ids = table.filter(F.col("column_name") == c).select(F.col("level").alias("_level"), F.col("level_id").cast("int").alias(f"{c}_id"))
        out = out.withColumn("_level", _q(c).cast("string")).join(ids, "_level", "left").drop("_level")
    return out


def _sparse(size: int, entries: Column) -> Column:
    """The fields of a sparse vector from an array of (place, value) structs in order."""
    return F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).cast("int").alias("size"),
                    F.transform(entries, lambda e: e["place"]).alias("indices"), F.transform(entries, lambda e: e["value"]).alias("values"))


def _ones(ids: Column, offset: int = 0) -> Column:
    one = F.array(F.struct((ids + F.lit(offset)).alias("place"), F.lit(1.0).alias("value")))
    return F.when(ids.isNotNull(), one).otherwise(F.array().cast("array<struct<place:int,value:double>>"))


def _as_vectors(df: DataFrame, names) -> DataFrame:
    """Columns made by ``_sparse`` as vectors. Their type knows no level names: the
    encoders of MLlib write an attribute per level into the schema, on the driver."""
    from pyspark.ml.linalg import VectorUDT
    schema = T.StructType([T.StructField(f.name, VectorUDT() if f.name in names else f.dataType) for f in df.schema.fields])

    def same(batches):
        yield from batches

    return df.mapInArrow(same, schema)


def apply_level_vectors(df: DataFrame, cols: list[str], table: DataFrame, suffix: str = "_vec") -> DataFrame:
    """A sparse 0/1 vector per column; unseen levels and NULL are all zeros.
    The driver knows how many levels there are and nothing else of them."""
    counts = level_counts(table)
    out = _with_level_ids(df, cols, table)
    vectors = [_sparse(max(counts.get(c, 0), 1), _ones(F.col(f"`{c}_id`"))).alias(f"{c}{suffix}") for c in cols]
    return _as_vectors(out.select(*[_q(c) for c in df.columns], *vectors), {f"{c}{suffix}" for c in cols})


def vector_nonzeros(df: DataFrame, vec: str, keep, out: str = "n_nonzero") -> DataFrame:
    """``keep`` columns and how many entries of the vector are not zero, row by row
    (sums per entry would need buffers as long as the vector)."""
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.LongType())])

    def count(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in batches:
            values = batch.column(len(keep)).field("values")
            rows = pc.list_parent_indices(values).to_numpy()[pc.list_flatten(values).to_numpy(zero_copy_only=False) != 0]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(np.bincount(rows, minlength=batch.num_rows), pa.int64())],
                                             names=[*keep, out])

    return df.select(*keep, vec).mapInArrow(count, schema)


def fit_levels(train: DataFrame, col: str) -> list:
    """Sorted train levels by name, for outputs that have a column per level
    (their schema holds the names; ``apply_level_vectors`` needs no names)."""
    return sorted(r["v"] for r in train.filter(_q(col).isNotNull()).select(_q(col).cast("string").alias("v")).distinct().collect())


def apply_one_hot(df: DataFrame, col: str, levels: list, drop_source: bool = True) -> DataFrame:
    """0/1 column per train level; unseen or NULL → all zeros."""
    v = _q(col).cast("string")
    out = df.withColumns({f"{col}_{lv}": F.coalesce((v == F.lit(lv)).cast("int"), F.lit(0)) for lv in levels})
    return out.drop(col) if drop_source else out


def train_fitted_edges_values(train: DataFrame, col: str, n_bins: int) -> list[float]:
    """Train quantile edges as driver values (n_bins + 1 numbers), outer
    edges ±inf, duplicates dropped."""
    from basketry.functions.primitives import exact_quantiles
    e = exact_quantiles(train, col, [i / n_bins for i in range(n_bins + 1)])
    inner = sorted(set(v for v in e[1:-1] if v is not None))
    return [float("-inf"), *inner, float("inf")]


def kbins_quantile_onehot(train: DataFrame, df: DataFrame, col: str, n_bins: int = 4, prefix: str | None = None) -> DataFrame:
    """Quantile edges fitted on train (outer edges ±inf), left-closed
    bins like sklearn's KBinsDiscretizer, then one-hot."""
    prefix = prefix or f"{col}_bin"
    edges = train_fitted_edges(train, col, n_bins)
    b = with_edges(df, edges, col, "_kb", right=False)
    return b.withColumns({f"{prefix}_{i}": F.coalesce((F.col("_kb") == i).cast("int"), F.lit(0)) for i in range(n_bins)}).drop("_kb")


def column_type_split(df: DataFrame, cols: list[str]) -> DataFrame:
    """Binary (numeric with values ⊆ {0, 1}), numeric, categorical."""
    num = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))}
    aggs = [F.count_if(_q(c).isNotNull() & ~_q(c).cast("double").isin(0.0, 1.0)).alias(c) for c in cols if c in num]
    one = df.agg(*aggs) if aggs else None
    rows = []
    for c in cols:
        if c in num:
            kind = F.when(one.select(_q(c)).scalar() == 0, "binary").otherwise("numeric")
        else:
            kind = F.lit("categorical")
        rows.append(F.struct(F.lit(c).alias("column_name"), kind.alias("kind")))
    return df.sparkSession.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weights n / (2·n_class) as a column."""
    n = df.select(F.count(F.lit(1))).scalar()
    pos = df.select(F.sum(F.col(label).cast("long"))).scalar()
    return df.withColumn(out, F.when(F.col(label) == 1, n / (2.0 * pos)).otherwise(n / (2.0 * (n - pos))))


@dataclass
class Preprocessor:
    """Per column group: numeric → median impute + scale, binary →
    0-fill, categorical → mode impute + one-hot, quantile → train-fitted
    bins + one-hot; other columns dropped. ``fit`` touches train only.

    ``assemble`` gives one (sparse) vector a row and works from the level table,
    whatever the number of levels; ``transform`` gives a column per level and so
    needs their names."""

    numeric: list[str] = field(default_factory=list)
    binary: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    quantile: list[str] = field(default_factory=list)
    n_bins: int = 4
    ddof: int = 0
    state: dict = field(default_factory=dict)
    level_table: DataFrame | None = field(default=None, compare=False, repr=False)

    def fit(self, train: DataFrame) -> "Preprocessor":
        if self.numeric:
            med = fit_median(train, self.numeric)
            self.state["median"] = med
            self.state["scale"] = _state_row(fit_scaler(apply_fill(train, med, self.numeric), self.numeric, self.ddof))
        if self.categorical:
            self.state["mode"] = _state_row(fit_mode(train, self.categorical))
            self.level_table = fit_level_table(train, self.categorical)
        self.state["edges"] = {c: train_fitted_edges_values(train, c, self.n_bins) for c in self.quantile}
        return self

    def levels(self, col: str) -> list[str]:
        """Names of a column's levels, fetched when a wide output asks for them."""
        known = self.state.setdefault("levels", {})
        if col not in known:
            rows = self.level_table.filter(F.col("column_name") == col).select("level").collect()
            known[col] = sorted(r["level"] for r in rows)
        return known[col]

    def _filled(self, df: DataFrame) -> DataFrame:
        """All steps but the one-hot of categorical columns."""
        out = df
        if self.numeric:
            out = apply_scaler(apply_fill(out, self.state["median"], self.numeric), self.state["scale"], self.numeric)
        if self.binary:
            out = apply_constant(out, self.binary, 0)
        if self.categorical:
            out = apply_fill(out, self.state["mode"], self.categorical)
        for c in self.quantile:
            edges = F.array(*[F.lit(float(e)) for e in self.state["edges"][c]])
            b = with_edges(out, edges, c, "_kb", right=False)
            out = b.withColumns({f"{c}_bin_{i}": F.coalesce((F.col("_kb") == i).cast("int"), F.lit(0))
                                 for i in range(self.n_bins)}).drop("_kb")
        return out

    def transform(self, df: DataFrame, keep=()) -> DataFrame:
        out = self._filled(df)
        for c in self.categorical:
            out = apply_one_hot(out, c, self.levels(c))
        return out.select(*keep, *self.output_columns())

    def _bins(self) -> list[str]:
        return [f"{c}_bin_{i}" for c in self.quantile for i in range(self.n_bins)]

    def output_columns(self) -> list[str]:
        one_hot = [f"{c}_{lv}" for c in self.categorical for lv in self.levels(c)]
        return [*self.numeric, *self.binary, *one_hot, *self._bins()]

    def assemble(self, df: DataFrame, keep=(), out: str = "features") -> DataFrame:
        t = self._filled(df)
        counts = level_counts(self.level_table) if self.categorical else {}
        if self.categorical:
            t = _with_level_ids(t, self.categorical, self.level_table)
        plain, size, parts = [*self.numeric, *self.binary], 0, []

        def numbers(cols):
            entries = F.array(*[F.struct(F.lit(size + i).alias("place"), F.coalesce(_q(c).cast("double"), F.lit(float("nan"))).alias("value"))
                                for i, c in enumerate(cols)])
            return F.filter(entries, lambda e: e["value"] != 0.0)

        if plain:
            parts.append(numbers(plain))
        size += len(plain)
        for c in self.categorical:
            parts.append(_ones(F.col(f"`{c}_id`"), size))
            size += max(counts.get(c, 0), 1)
        if self.quantile:
            parts.append(numbers(self._bins()))
        size += len(self._bins())
        return _as_vectors(t.select(*keep, _sparse(size, F.concat(*parts)).alias(out)), {out})

    def save(self, spark: SparkSession, path: str):
        """Persist the fitted state: numbers as one JSON row, levels as a table."""
        import json
        meta = {"numeric": self.numeric, "binary": self.binary, "categorical": self.categorical, "quantile": self.quantile,
                "n_bins": self.n_bins, "ddof": self.ddof, "median": self.state.get("median"), "scale": self.state.get("scale"),
                "mode": self.state.get("mode"), "edges": self.state.get("edges")}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")
        if self.categorical:
            self.level_table.write.mode("overwrite").parquet(f"{path}/levels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Preprocessor":
        import json
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        own = {k: meta[k] for k in ("numeric", "binary", "categorical", "quantile", "n_bins", "ddof")}
        state = {k: meta[k] for k in ("median", "scale", "mode", "edges") if meta[k] is not None}
        return cls(**own, state=state, level_table=spark.read.parquet(f"{path}/levels") if own["categorical"] else None)


@dataclass
class PrincipalComponents:
    """Centred projection onto the leading eigenvectors of the train covariance."""
    columns: list[str]
    mean: list[float]
    components: list[list[float]]   # one row per component
    explained: list[float]          # shares of the whole variance

    def project(self, df: DataFrame, prefix: str = "pc") -> DataFrame:
        out = {}
        for i, row in enumerate(self.components, start=1):
            terms = [(_q(c).cast("double") - F.lit(m)) * F.lit(v) for c, m, v in zip(self.columns, self.mean, row)]
            out[f"{prefix}{i}"] = reduce(lambda a, b: a + b, terms)
        return df.withColumns(out)


def principal_components(train: DataFrame, columns: list[str], var: float = 0.95) -> PrincipalComponents:
    """One scan sums products of the columns (rows with a NULL are left out),
    the small covariance is decomposed once, and the fewest components that reach ``var``
    of the variance are kept from that same result. The sign of a component is fixed: the
    first of its greatest loadings is positive, so refits of equal data agree."""
    from basketry.operators.batchfit import _matrix, task_sums
    k = len(columns)
    x = F.array(F.lit(1.0), *[_q(c).cast("double") for c in columns])
    rows = train.na.drop(subset=columns).select(x.alias("x"))

    def add(state, batch):
        m = _matrix(batch.column(0))
        state += m.T @ m

    sums = task_sums(rows, lambda: np.zeros((k + 1, k + 1)), add, lambda s: {"": s})
    if not sums:
        raise ValueError("no train row has all columns")
    m = sums[""].reshape(k + 1, k + 1)
    n, mean = m[0, 0], m[0, 1:] / m[0, 0]
    values, vectors = np.linalg.eigh(m[1:, 1:] / n - np.outer(mean, mean))
    order = np.argsort(-values, kind="stable")
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order].T
    share = values / values.sum() if values.sum() else np.full(k, 1.0 / k)
    keep = min(k, int(np.searchsorted(np.cumsum(share), var - 1e-12)) + 1)
    fixed = []
    for row in vectors[:keep]:
        lead = int(np.argmax(np.abs(row) >= np.abs(row).max() * (1 - 1e-9)))
        fixed.append((row if row[lead] >= 0 else -row).tolist())
    return PrincipalComponents(list(columns), mean.tolist(), fixed, share[:keep].tolist())


def pca_95(train: DataFrame, df: DataFrame, columns: list[str], var: float = 0.95):
    """``(df with pc1.., fitted components)``, fitted on (scaled) train columns."""
    fitted = principal_components(train, columns, var)
    return fitted.project(df), fitted
