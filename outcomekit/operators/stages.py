"""Cleaning steps as ``pyspark.ml`` stages that a saved pipeline carries (C3,
C10, C11, C13, C15, S6).

``ClampNegatives`` is a Transformer; ``MissingCut``, ``Fill`` and
``Standardise`` are Estimators whose fitted values (kept columns, fills,
means and scales) are params of the Model, one entry per feature.  All of
them are ``DefaultParamsWritable``: a ``PipelineModel`` of cleaning steps and a
learner is saved and loaded as one folder.  Models are projections with
literals, so they run on a stream as on a batch; fitting goes through the
``fit_*`` tables of ``operators.prep``.

Fitted values of columns without any value (fill or mean unknown) are left
out: such a column passes through as it is.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.config import MISSING_THRESHOLD
from outcomekit.operators import prep


class _Columns(Params):
    columns = Param(Params._dummy(), "columns", "columns of the step", TypeConverters.toListString)

    def get(self, name: str):
        return self.getOrDefault(self.getParam(name))


class _Stage(_Columns, DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose keyword arguments are its params."""

    def __init__(self, **params):
        super().__init__()
        self._set(**params)


class ClampNegatives(_Stage, Transformer):
    """Values below ``floor`` become ``floor``; NULL stays."""

    floor = Param(Params._dummy(), "floor", "least value", TypeConverters.toFloat)

    def __init__(self, columns: list[str] | None = None, floor: float = 0.0):
        super().__init__(columns=columns or [], floor=floor)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return prep.clamp_columns(dataset, self.get("columns"), self.get("floor"))


class MissingCut(_Stage, Estimator):
    """Columns whose missing rate is ``threshold`` or more are dropped."""

    threshold = Param(Params._dummy(), "threshold", "missing rate a kept column is below", TypeConverters.toFloat)

    def __init__(self, columns: list[str] | None = None, threshold: float = MISSING_THRESHOLD):
        super().__init__(columns=columns or [], threshold=threshold)

    def _fit(self, dataset: DataFrame) -> MissingCutModel:
        rows = prep.fitted_rows(prep.fit_missingness(dataset, self.get("columns"), self.get("threshold")))
        # no rows: a rate is unknown and nothing is kept
        keep = {r.column_name for r in rows if r.keep}
        return MissingCutModel(columns=self.get("columns"), dropped=[c for c in self.get("columns") if c not in keep])


class MissingCutModel(_Stage, Model):
    dropped = Param(Params._dummy(), "dropped", "columns that are dropped", TypeConverters.toListString)

    @property
    def kept(self) -> list[str]:
        gone = set(self.get("dropped"))
        return [c for c in self.get("columns") if c not in gone]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        gone = set(self.get("dropped"))
        # by position: drop() would read a dot in a name as a field
        return dataset.select(*[F.col(f"`{c}`") for c in dataset.columns if c not in gone])


class Fill(_Stage, Estimator):
    """NULLs become the column's ``strategy`` (median, mean, zero or, for text, mode).

    Columns that an earlier stage dropped are left out."""

    strategy = Param(Params._dummy(), "strategy", "median, mean, zero or mode", TypeConverters.toString)

    def __init__(self, columns: list[str] | None = None, strategy: str = "median"):
        super().__init__(columns=columns or [], strategy=strategy)

    def _fit(self, dataset: DataFrame) -> FillModel:
        cols = [c for c in self.get("columns") if c in dataset.columns]
        if not cols:
            return FillModel(columns=[], fills=[], text=False)
        text = self.get("strategy") == "mode"
        table = prep.fit_mode(dataset, cols) if text else prep.fit_impute(dataset, cols, self.get("strategy"))
        fills = {r.feature: r.fill for r in prep.fitted_rows(table) if r.fill is not None}
        known = [c for c in cols if c in fills]
        # repr() gives a float back to the last bit
        return FillModel(columns=known, fills=[fills[c] if text else repr(float(fills[c])) for c in known], text=text)


class FillModel(_Stage, Model):
    fills = Param(Params._dummy(), "fills", "value per column", TypeConverters.toListString)
    text = Param(Params._dummy(), "text", "fills are text", TypeConverters.toBoolean)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        def value(c, fill):
            return F.lit(fill if self.get("text") else float(fill)).cast(dataset.schema[c].dataType)
        return dataset.withColumns({c: F.coalesce(F.col(f"`{c}`"), value(c, fill))
                                    for c, fill in zip(self.get("columns"), self.get("fills"))})


class Standardise(_Stage, Estimator):
    """(value - mean) / population std; a constant column is only centred.
    Columns that an earlier stage dropped are left out."""

    def __init__(self, columns: list[str] | None = None):
        super().__init__(columns=columns or [])

    def _fit(self, dataset: DataFrame) -> StandardiseModel:
        cols = [c for c in self.get("columns") if c in dataset.columns]
        if not cols:
            return StandardiseModel(columns=[], means=[], scales=[])
        fitted = {r.feature: r for r in prep.fitted_rows(prep.fit_standardiser(dataset, cols)) if r["mean"] is not None}
        known = [c for c in cols if c in fitted]
        return StandardiseModel(columns=known, means=[fitted[c]["mean"] for c in known], scales=[fitted[c]["scale"] for c in known])


class StandardiseModel(_Stage, Model):
    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "scale per column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({c: (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(s)
                                    for c, m, s in zip(self.get("columns"), self.get("means"), self.get("scales"))})
