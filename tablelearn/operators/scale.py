"""Column scalers and their reverse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..base import TableEstimator, TableModel
from ..functions.columns import as_list, nan_to_null, to_col

MODES = ("normalize", "standardize")
CONSTANT_RULES = ("null", "zero")


class Scaler(TableEstimator):
    """"normalize": ``(x - min) / (max - min)``; "standardize": ``(x - mean) / population deviation``.

    Missing cells are skipped in fitting and stay missing. A constant column has no scale: it becomes NULL, or 0
    with ``constant="zero"``. Values replace the inputs, or go to ``output_cols``.
    """

    def __init__(self, input_cols, mode: str = "standardize", output_cols=None, constant: str = "null"):
        super().__init__()
        if mode not in MODES:
            raise ValueError(f"mode is one of {MODES}")
        if constant not in CONSTANT_RULES:
            raise ValueError(f"constant is one of {CONSTANT_RULES}")
        self.input_cols = as_list(input_cols)
        self.output_cols = as_list(output_cols) or self.input_cols
        if len(self.output_cols) != len(self.input_cols):
            raise ValueError("one output column per input column")
        self.mode = mode
        self.constant = constant

    def _fit(self, dataset: DataFrame) -> "ScalerModel":
        first, second = (F.min, F.max) if self.mode == "normalize" else (F.avg, F.stddev_pop)
        clean = nan_to_null(dataset.select(*[to_col(c) for c in self.input_cols]))
        row = clean.agg(
            *[first(to_col(c).cast("double")).alias(f"a{i}") for i, c in enumerate(self.input_cols)],
            *[second(to_col(c).cast("double")).alias(f"b{i}") for i, c in enumerate(self.input_cols)],
        ).first()
        shift = [row[f"a{i}"] for i in range(len(self.input_cols))]
        spread = [row[f"b{i}"] for i in range(len(self.input_cols))]
        if self.mode == "normalize":
            spread = [None if b is None else b - a for a, b in zip(shift, spread)]
        params = {
            "input_cols": self.input_cols,
            "output_cols": self.output_cols,
            "target_cols": [],
            "mode": self.mode,
            "constant": self.constant,
        }
        return ScalerModel(params, {"shift": shift, "spread": spread})


class ScalerModel(TableModel):
    def _apply(self, df: DataFrame, sources: list[str], outputs: list[str], rule) -> DataFrame:
        clean = nan_to_null(df, sources)
        cells = {
            out: rule(to_col(src).cast("double"), self.state["shift"][i], self.state["spread"][i])
            for i, (src, out) in enumerate(zip(sources, outputs))
        }
        return clean.withColumns(cells)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        def rule(x: Column, shift, spread) -> Column:
            if shift is None:
                return F.lit(None).cast("double")
            if spread == 0:
                return F.when(x.isNotNull(), F.lit(0.0)) if self.params_["constant"] == "zero" else F.lit(None).cast("double")
            return (x - F.lit(shift)) / F.lit(spread)

        return self._apply(dataset, self.input_cols, self.params_["output_cols"], rule)

    def translate(self, df: DataFrame) -> DataFrame:
        """The reverse of ``transform``; a constant column gets its constant back where a value is left."""

        def rule(x: Column, shift, spread) -> Column:
            return F.lit(None).cast("double") if shift is None else x * F.lit(spread) + F.lit(shift)

        return self._apply(df, self.params_["output_cols"], self.input_cols, rule)


def fit_transform(estimator: TableEstimator, df: DataFrame) -> DataFrame:
    return estimator.fit(df).transform(df)
