"""O01 as a pipeline stage: exact medians that are saved with the pipeline.

MLlib's ``Imputer`` with a relative error of 0 keeps every distinct value of a
column in one summary. This stage takes its medians from ``group_quantiles`` (value
counts combined map-side, a bucketed running sum) for all columns together, and
its model is a list of numbers that a ``PipelineModel`` writes and reads.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.primitives import column_quantiles


class MedianImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Median of the non-null, non-NaN values of every input column (0 where a
    column has none)."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "MedianImputerModel":
        cols = self.getInputCols()
        clean = dataset.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(c) for c in cols])
        found = column_quantiles(clean, cols, [0.5])
        model = MedianImputerModel()
        model._set(inputCols=cols, outputCols=self.getOutputCols(), medians=[0.0 if found[c][0] is None else float(found[c][0]) for c in cols])
        return model


class MedianImputerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Input columns as doubles with NULL and NaN replaced."""

    medians = Param(Params._dummy(), "medians", "median of each input column", typeConverter=TypeConverters.toListFloat)

    def getMedians(self) -> list[float]:
        return self.getOrDefault(self.medians)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({
            out: F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), F.lit(m))
            for c, out, m in zip(self.getInputCols(), self.getOutputCols(), self.getMedians())})
