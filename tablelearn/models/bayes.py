"""Gaussian naive Bayes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..base import TableEstimator, TableModel
from ..functions.columns import as_list, constant_array, feature, literal_table, to_col

# Classes times inputs up to which the scores are written out; above, they come from a constant table. Both add up the
# same terms in the same order, so the size of a model changes no result.
MAX_TERMS = 1000


class NaiveBayesClassifier(TableEstimator):
    """Per class the mean and population deviation of every input and the share of rows; one grouped job.

    A feature with zero deviation in a class has no density there. It is left out for that class, or gets the
    deviation ``std_floor`` when one is given.
    """

    def __init__(self, input_cols, target_cols, std_floor: float | None = None, max_classes: int = 10_000):
        super().__init__()
        self.input_cols = as_list(input_cols)
        self.target_cols = as_list(target_cols)
        if len(self.target_cols) != 1:
            raise ValueError("naive Bayes takes one target")
        self.std_floor = std_floor
        self.max_classes = max_classes

    def _stats(self, df: DataFrame, extra: list[Column], parts: int = 1) -> list:
        """A row per class (and part). More rows than ``max_classes`` classes can have in ``parts`` parts are an error."""
        most = self.max_classes * parts
        d = len(self.input_cols)
        rows = (
            df.select(
                *extra, to_col(self.target_cols[0]).alias("y"), *[feature(c).alias(f"x{i}") for i, c in enumerate(self.input_cols)]
            )
            .filter("y IS NOT NULL")
            .groupBy("y", *["f" for _ in extra])
            .agg(
                F.count(F.lit(1)).alias("n"),
                *[F.avg(f"x{i}").alias(f"m{i}") for i in range(d)],
                *[F.var_pop(f"x{i}").alias(f"v{i}") for i in range(d)],
            )
            .limit(most + 1)
            .collect()
        )
        if len(rows) > most or len({r["y"] for r in rows}) > self.max_classes:
            raise ValueError(f"more than {self.max_classes} classes, or folds other than those given")
        if not rows:
            raise ValueError("no rows to train on")
        return rows

    def _model(self, per_class: dict) -> "NaiveBayesModel":
        classes = sorted(per_class)
        total = sum(per_class[c][0] for c in classes)
        params = {"input_cols": self.input_cols, "target_cols": self.target_cols, "std_floor": self.std_floor}
        state = {
            "classes": classes,
            "priors": [per_class[c][0] / total for c in classes],
            "means": [per_class[c][1] for c in classes],
            "stds": [[math.sqrt(v) for v in per_class[c][2]] for c in classes],
        }
        return NaiveBayesModel(params, state)

    def _fit(self, dataset: DataFrame) -> "NaiveBayesModel":
        d = range(len(self.input_cols))
        rows = self._stats(dataset, [])
        return self._model({r["y"]: (r["n"], [r[f"m{i}"] for i in d], [r[f"v{i}"] for i in d]) for r in rows})

    def fit_folds(self, df: DataFrame, fold_col: str, folds: list[int]) -> dict[int, "NaiveBayesModel"]:
        """One job for all folds: the moments of the other folds are merged, not subtracted from a total."""
        d = range(len(self.input_cols))
        rows = self._stats(df, [to_col(fold_col).alias("f")], len(folds))
        out = {}
        for i in folds:
            merged: dict = {}
            for r in sorted((r for r in rows if r["f"] != i), key=lambda r: r["f"]):
                part = (r["n"], [r[f"m{j}"] for j in d], [r[f"v{j}"] for j in d])
                merged[r["y"]] = _merge(merged[r["y"]], part) if r["y"] in merged else part
            out[i] = self._model(merged)
        return out


def _merge(a, b):
    """Moments of two parts together (Chan, Golub and LeVeque 1979)."""
    (na, ma, va), (nb, mb, vb) = a, b
    n = na + nb
    means = [x + (y - x) * nb / n for x, y in zip(ma, mb)]
    variances = [
        (na * p + nb * q) / n + (y - x) ** 2 * na * nb / n / n for x, y, p, q in zip(ma, mb, va, vb)
    ]
    return n, means, variances


_CLASSES = "array<struct<i:int,base:double,m:array<double>,s:array<double>>>"


def _best_of(input_cols: list[str], table: Column) -> Column:
    """``(score, -class index)`` of the best class in a table of classes."""

    def scored(row: Column) -> Column:
        gap = F.lit(0.0)
        for j, c in enumerate(input_cols):
            z = F.try_divide(feature(c) - row["m"][j], row["s"][j])
            gap = gap + F.when(row["s"][j] > 0, z * z).otherwise(0.0)
        return F.struct((row["base"] - gap * 0.5).alias("s"), row["i"].alias("i"))

    return F.array_max(F.transform(table, scored))


class NaiveBayesModel(TableModel):
    def log_scores(self) -> list[Column]:
        """Per class the log of prior times densities, as plain arithmetic with the model as constants."""
        out = []
        for base, means, stds in self._terms():
            gap = F.lit(0.0)
            for c, mean, std in zip(self.input_cols, means, stds):
                if std > 0:
                    z = (feature(c) - F.lit(mean)) / F.lit(std)
                    gap = gap + z * z
            out.append(F.lit(base) - gap * 0.5)
        return out

    def _terms(self) -> list[tuple[float, list[float], list[float]]]:
        """Per class what doesn't depend on the row, the means, and the deviations (0: the input is left out)."""
        out = []
        for prior, means, stds in zip(self.state["priors"], self.state["means"], self.state["stds"]):
            stds = [max(s, self.params_["std_floor"] or 0.0) for s in stds]
            base = math.log(prior) - sum(math.log(s) + 0.5 * math.log(2 * math.pi) for s in stds if s > 0)
            out.append((base, means, stds))
        return out

    def predict_proba(self, df: DataFrame, normalize: bool = False) -> DataFrame:
        """``score_<class>`` = prior times densities; with ``normalize`` they add up to one."""
        logs = self.log_scores()
        names = [f"score_{c}" for c in self.state["classes"]]
        with_logs = df.withColumns({f"__log_{i}": s for i, s in enumerate(logs)})
        cols = [F.col(f"__log_{i}") for i in range(len(logs))]
        if normalize:
            top = F.greatest(*cols) if len(cols) > 1 else cols[0]
            shifted = [F.exp(c - top) for c in cols]
            total = sum(shifted[1:], shifted[0])
            values = [s / total for s in shifted]
        else:
            values = [F.exp(c) for c in cols]
        return with_logs.withColumns(dict(zip(names, values))).drop(*[f"__log_{i}" for i in range(len(logs))])

    def _rows(self) -> list[dict]:
        return [{"i": -i, "base": base, "m": means, "s": stds} for i, (base, means, stds) in enumerate(self._terms())]

    @classmethod
    def by_fold(cls, df: DataFrame, models: list["NaiveBayesModel"], index: Column) -> DataFrame | None:
        classes = sorted({c for m in models for c in m.state["classes"]})
        number = {c: -i for i, c in enumerate(classes)}  # of any fold's class among all
        rows = [[{**r, "i": number[m.state["classes"][-r["i"]]]} for r in m._rows()] for m in models]
        tables = literal_table(rows, f"array<{_CLASSES}>")
        best = _best_of(models[0].input_cols, F.get(tables, index))
        return df.withColumn("prediction", F.get(constant_array(classes), -best["i"]))

    def _best(self) -> Column:
        """``(score, -class index)`` of the best class."""
        if len(self.state["classes"]) * len(self.input_cols) <= MAX_TERMS:
            ranked = [F.struct(s.alias("s"), F.lit(-i).alias("i")) for i, s in enumerate(self.log_scores())]
            return F.greatest(*ranked) if len(ranked) > 1 else ranked[0]
        return _best_of(self.input_cols, literal_table(self._rows(), _CLASSES))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """The class of the highest score, the smallest class on ties."""
        classes = constant_array(self.state["classes"])
        return dataset.withColumn("__best", self._best()).withColumn(
            "prediction", F.get(classes, -F.col("__best")["i"])
        ).drop("__best")
