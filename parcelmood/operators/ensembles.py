"""Models made of other models: calibrated fold models and a stacked ensemble, saved and loaded like any Spark model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.operators.composite import Composite, load_model  # noqa: F401 - load_model is part of this module's interface
from parcelmood.operators.metrics import margin_to_probability
from parcelmood.operators.modeling import predict_probability

#: Bins of the margin that the isotonic fit distinguishes.
MARGIN_BINS = 10_000
_MARGIN, _BIN, _VECTOR = "_margin", "_bin", "_margin_vector"


def _with_outcome(frame: DataFrame, keep: Sequence[str], proba: Column) -> DataFrame:
    vector = array_to_vector(F.array(1 - proba, proba))
    return frame.select(*keep, vector.alias("probability"), (proba >= 0.5).cast("double").alias("prediction"))


class CalibratedModel(Composite):
    """Mean of the fold models' probabilities, each mapped from its margin by what its held-out rows showed."""

    def __init__(self, members: Sequence[Model] = (), maps: Sequence[Model] = ()) -> None:
        super().__init__()
        self.members, self.maps = list(members), list(maps)

    def parts(self) -> list[Model]:
        return [*self.members, *self.maps]

    @classmethod
    def of_parts(cls, parts: Sequence[Model], names: Sequence[str]) -> CalibratedModel:
        half = len(parts) // 2
        return cls(parts[:half], parts[half:])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored, found = dataset, []
        for i, (member, fitted) in enumerate(zip(self.members, self.maps)):
            found.append(f"_proba_{i}")
            scored = _mapped(fitted, with_margin(member, scored), found[-1])
        mean = sum(map(F.col, found), F.lit(0.0)) / len(found)
        return _with_outcome(scored, dataset.columns, mean)


class StackedModel(Composite):
    """Members score the rows, the last part turns their probabilities into one; all in one ``transform``."""

    def __init__(self, members: dict[str, Model] | None = None, judge: Model | None = None) -> None:
        super().__init__()
        self.members, self.judge = members or {}, judge

    def parts(self) -> list[Model]:
        return [*self.members.values(), self.judge]

    def names(self) -> list[str]:
        return list(self.members)

    @classmethod
    def of_parts(cls, parts: Sequence[Model], names: Sequence[str]) -> StackedModel:
        return cls(dict(zip(names, parts)), parts[-1])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored = dataset
        for name, member in self.members.items():
            scored = predict_probability(member, scored, name)
        proba = vector_to_array(F.col("probability"))[1]
        return _with_outcome(self.judge.transform(scored), dataset.columns, proba)


def with_margin(model: Model, frame: DataFrame, name: str = _MARGIN) -> DataFrame:
    margin = vector_to_array(F.col("rawPrediction"))[1]
    return model.transform(frame).select(*frame.columns, margin.alias(name))


def calibrate(models: Sequence[Model], folded: DataFrame, method: str = "sigmoid") -> CalibratedModel:
    """Fold models with their maps; model i is judged on the rows of fold i, which it never saw."""
    if method not in ("sigmoid", "isotonic"):
        raise ValueError(f"unknown calibration: {method}")
    held = [with_margin(m, folded.where(F.col("fold") == i)) for i, m in enumerate(models)]
    return CalibratedModel(models, [_fit_map(h, method) for h in held])


def _fit_map(held: DataFrame, method: str) -> Model:
    if method == "sigmoid":
        ready = held.select(array_to_vector(F.array(_MARGIN)).alias(_VECTOR), C.TARGET)
        return LogisticRegression(labelCol=C.TARGET, featuresCol=_VECTOR).fit(ready)
    # the learner merges its blocks on the driver, so it gets bins instead of rows
    rounded = F.round(margin_to_probability(F.col(_MARGIN)) * MARGIN_BINS) / MARGIN_BINS
    bins = held.groupBy(rounded.alias(_BIN)).agg(
        F.avg(F.col(C.TARGET).cast("double")).alias(C.TARGET), F.count(F.lit(1)).cast("double").alias("rows")
    )
    return IsotonicRegression(labelCol=C.TARGET, featuresCol=_BIN, weightCol="rows").fit(bins)


def _mapped(fitted: Model, frame: DataFrame, output: str) -> DataFrame:
    """The margin replaced by the probability that the map gives it."""
    if isinstance(fitted, IsotonicRegressionModel):
        placed = frame.withColumn(_BIN, margin_to_probability(F.col(_MARGIN)))
        return fitted.setPredictionCol(output).transform(placed).drop(_BIN, _MARGIN)
    slope, intercept = float(fitted.coefficients[0]), fitted.intercept
    return frame.withColumn(output, 1 / (1 + F.exp(-(slope * F.col(_MARGIN) + intercept)))).drop(_MARGIN)
