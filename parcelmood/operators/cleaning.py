"""Cleaning learned on training rows and applied unchanged to every later month.

What is learned is small by construction: three numbers per numeric column and,
per categorical column, the values that hold at least one percent of the rows,
so never more than one hundred.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.functions.histograms import exact_quantiles
from parcelmood.functions.scalars import clip, half_even, to_double


def category_text(name: str) -> Column:
    """Category as text; a missing value is a value of its own."""
    return F.coalesce(F.col(name).cast("string"), F.lit(C.MISSING_LABEL))


def clip_and_fill_values(
    train: DataFrame, columns: Sequence[str] = C.NUMERIC
) -> DataFrame:
    """(feature, clip_low, clip_high, median); exact interpolated quantiles."""
    present = [c for c in columns if c in train.columns]
    found = exact_quantiles(train, present, [C.CLIP_LOW, C.MEDIAN, C.CLIP_HIGH])
    return found.select(
        "feature",
        F.col("quantiles")[0].alias("clip_low"),
        F.col("quantiles")[2].alias("clip_high"),
        F.col("quantiles")[1].alias("median"),
    )


def category_shares(train: DataFrame, columns: Sequence[str] = C.CATEGORICAL) -> DataFrame:
    """(feature, category, n, share); one unpivot, combined before the shuffle.

    Every row has exactly one value per column, so a feature's total is the row
    count; it is one number, taken from the same counts.
    """
    present = [c for c in columns if c in train.columns]
    counts = (
        train.select(*[category_text(c).alias(c) for c in present])
        .unpivot([], present, "feature", "category")
        .groupBy("feature", "category")
        .agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("feature").agg(F.sum("n").alias("n_total"))
    # totals has one row per column
    return counts.join(F.broadcast(totals), "feature").select(
        "feature", "category", "n", (F.col("n") / F.col("n_total")).alias("share")
    )


def frequent_categories(
    train: DataFrame, columns: Sequence[str] = C.CATEGORICAL, min_share: float = C.RARE_SHARE
) -> DataFrame:
    return category_shares(train, columns).where(F.col("share") >= min_share)


def frequent_members(
    frame: DataFrame, frequent: DataFrame, columns: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """(kept columns, feature, category) for every frequent category of a row; at most one hundred a column, so broadcast."""
    present = [c for c in columns if c in frame.columns]
    return (
        frame.select(*keep, *[category_text(c).alias(f"_{c}") for c in present])
        .select(*keep, F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_{c}").alias("category")) for c in present])))
        .join(F.broadcast(frequent.select("feature", "category")), ["feature", "category"], "left_semi")
        .select(*keep, "feature", "category")
    )


class _State(Params):
    state = Param(
        Params._dummy(), "state", "learned values as JSON", typeConverter=TypeConverters.toString
    )

    def learned(self) -> dict:
        if not self.isDefined(self.state):
            raise RuntimeError("the cleaner is not fitted")
        return json.loads(self.getOrDefault(self.state))


class OrderCleanerModel(Model, _State, DefaultParamsReadable, DefaultParamsWritable):
    """Clip and fill numbers, zero missing flags, group rare categories."""

    def __init__(self, learned: dict | None = None) -> None:
        super().__init__()
        if learned is not None:
            self._set(state=json.dumps(learned))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        learned = self.learned()
        cleaned = {}
        for name, (low, high, median) in learned["numeric"].items():
            if name in dataset.columns:
                bounded = clip(to_double(name), low, high)
                cleaned[name] = F.coalesce(bounded, F.lit(median).cast("double"))
        for name in learned["binary"]:
            if name in dataset.columns:
                cleaned[name] = F.coalesce(F.col(name).try_cast("int"), F.lit(0))
        for name, kept in learned["frequent"].items():
            if name in dataset.columns:
                text = category_text(name)
                grouped = F.lit(C.RARE_LABEL)
                cleaned[name] = F.when(text.isin(*kept), text).otherwise(grouped) if kept else grouped
        return dataset.withColumns(cleaned)

    def report(self, spark) -> DataFrame:
        """What was learned, one row per column, bounds rounded to 3 places."""
        learned = self.learned()
        rows = [
            (name, "numérica", low, high, median, None)
            for name, (low, high, median) in learned["numeric"].items()
        ] + [
            (name, "categórica", None, None, None, len(kept))
            for name, kept in learned["frequent"].items()
        ]
        schema = (
            "variable string, tipo string, clip_low double, clip_high double, "
            "fill_value double, n_categorias_frecuentes int"
        )
        return spark.createDataFrame(rows, schema).withColumns(
            {c: half_even(F.col(c), 3) for c in ("clip_low", "clip_high", "fill_value")}
        )


class OrderCleaner(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns an OrderCleanerModel from training rows."""

    minShare = Param(
        Params._dummy(), "minShare", "least share of a kept category",
        typeConverter=TypeConverters.toFloat,
    )
    nullAsOther = Param(
        Params._dummy(), "nullAsOther", "group missing categories with the rare ones",
        typeConverter=TypeConverters.toBoolean,
    )

    @keyword_only
    def __init__(self, *, minShare: float = C.RARE_SHARE, nullAsOther: bool = False) -> None:
        super().__init__()
        self._setDefault(minShare=C.RARE_SHARE, nullAsOther=False)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> OrderCleanerModel:
        present = set(dataset.columns)
        numeric: dict[str, list[float]] = {}
        if present.intersection(C.NUMERIC):
            for r in clip_and_fill_values(dataset).collect():
                numeric[r.feature] = [r.clip_low, r.clip_high, r.median]
        frequent: dict[str, list[str]] = {c: [] for c in C.CATEGORICAL if c in present}
        if frequent:
            share, drop_missing = (
                self.getOrDefault(p) for p in (self.minShare, self.nullAsOther)
            )
            for r in frequent_categories(dataset, min_share=share).collect():
                if not (drop_missing and r.category == C.MISSING_LABEL):
                    frequent[r.feature].append(r.category)
        return OrderCleanerModel(
            {
                "numeric": {c: numeric[c] for c in C.NUMERIC if c in numeric},
                "binary": list(C.BINARY),
                "frequent": {c: sorted(v) for c, v in frequent.items()},
            }
        )


def cleaning_report(clip_values: DataFrame, frequent: DataFrame) -> DataFrame:
    """The cleaning report as a plan over the learned frames."""
    numeric = clip_values.select(
        F.col("feature").alias("variable"),
        F.lit("numérica").alias("tipo"),
        half_even(F.col("clip_low"), 3).alias("clip_low"),
        half_even(F.col("clip_high"), 3).alias("clip_high"),
        half_even(F.col("median"), 3).alias("fill_value"),
    )
    categorical = frequent.groupBy(F.col("feature").alias("variable")).agg(
        F.lit("categórica").alias("tipo"), F.count("*").alias("n_categorias_frecuentes")
    )
    return numeric.unionByName(categorical, allowMissingColumns=True)
