"""Common base of fitted objects: ``pyspark.ml`` Estimator / Model pairs whose learned state is a plain value.

The state is small by construction (bounded by classes, features, nodes or codebooks, never by rows) and
JSON-able. Whatever grows with the data, such as an encoder's dictionary, is kept in tables instead.
"""

from __future__ import annotations

import datetime
import decimal
import importlib
import json
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession

from .functions.columns import as_list

_MODELS: dict[str, type] = {}


class TableEstimator(Estimator):
    """``fit(df)`` returns a model. Settings are plain attributes; ``copy`` gives an unfitted twin."""

    def _fit(self, dataset: DataFrame) -> "TableModel":
        raise NotImplementedError

    def fit_folds(self, df: DataFrame, fold_col: str, folds: list[int]) -> dict[int, "TableModel"]:
        """A model per fold, trained on the other folds. Aggregate-fitted models do all folds in one job."""
        return {i: self.fit(df.filter(df[fold_col] != i)) for i in folds}


class TableModel(Model):
    """``transform(df)`` adds predictions. ``params`` says how it was set up, ``state`` what it learned."""

    # whether ``transform`` computes columns from a row's own ones only, with no join or exchange
    row_local = True

    def __init__(self, params: dict[str, Any], state: dict[str, Any], tables: dict[str, DataFrame] | None = None):
        super().__init__()
        self.params_ = params
        self.state = state
        self.tables = tables or {}

    def __init_subclass__(cls, **kwargs):
        super().__init_subclass__(**kwargs)
        _MODELS[cls.__name__] = cls

    def get_params(self) -> dict[str, Any]:
        """Everything needed to restore the model, apart from tables."""
        return {"model": type(self).__name__, "params": self.params_, "state": self.state}

    def set_params(self, exported: dict[str, Any]) -> "TableModel":
        """A model with the exported state in place of this one's."""
        if exported["model"] != type(self).__name__:
            raise ValueError(f"parameters of a {exported['model']}, not of a {type(self).__name__}")
        return type(self)(exported["params"], exported["state"], self.tables)

    def save(self, path: str) -> None:
        """Parameters as one line of JSON, tables as Parquet, under any path Spark writes."""
        spark = SparkSession.active()
        exported = {**self.get_params(), "module": type(self).__module__, "tables": sorted(self.tables)}
        text = json.dumps(exported, default=written_value)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/params")
        for name, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/table_{name}")

    @classmethod
    def by_fold(cls, df: DataFrame, models: list["TableModel"], index: Column) -> DataFrame | None:
        """``df`` with each row's prediction by the model that ``index`` numbers; None where a model has no such form."""
        return None

    @property
    def input_cols(self) -> list[str]:
        return self.params_["input_cols"]

    @property
    def target_cols(self) -> list[str]:
        return as_list(self.params_["target_cols"])

    @property
    def prediction_cols(self) -> list[str]:
        return prediction_names(self.target_cols)


_KINDS = {"date": datetime.date, "timestamp": datetime.datetime, "decimal": decimal.Decimal}


def written_value(value: Any) -> dict[str, str]:
    """Class values that JSON has no form for."""
    for kind in ("timestamp", "date", "decimal"):  # a timestamp is a date as well
        if isinstance(value, _KINDS[kind]):
            return {"__kind": kind, "value": str(value) if kind == "decimal" else value.isoformat()}
    raise TypeError(f"cannot save {value!r}")


def read_value(value: dict) -> Any:
    kind = value.get("__kind")
    if kind is None:
        return value
    return decimal.Decimal(value["value"]) if kind == "decimal" else _KINDS[kind].fromisoformat(value["value"])


def prediction_names(targets: list[str]) -> list[str]:
    return ["prediction"] if len(targets) == 1 else [f"prediction_{t}" for t in targets]


def load_model(spark: SparkSession, path: str) -> TableModel:
    exported = json.loads(spark.read.text(f"{path}/params").first()[0], object_hook=read_value)
    if exported["model"] not in _MODELS:
        importlib.import_module(exported["module"])
    tables = {name: spark.read.parquet(f"{path}/table_{name}") for name in exported["tables"]}
    return _MODELS[exported["model"]](exported["params"], exported["state"], tables)
