"""Per-feature value histograms, exact quantiles and ROC areas built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmood.functions.order_statistics import column_quantiles, numbers_of, reached
from parcelmood.functions.ordering import SLICE, running_totals, sliced
from parcelmood.functions.scalars import to_double

Rational = tuple[int, int]


def unpivot(frame: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """One (ids…, feature, value) row per numeric value that is not null."""
    wide = frame.select(*ids, *[to_double(c).alias(c) for c in columns])
    return wide.unpivot(list(ids), list(columns), "feature", "value").where(
        F.col("value").isNotNull()
    )


def value_histogram(
    frame: DataFrame, columns: Sequence[str], label: str | None = None
) -> DataFrame:
    """Rows per (feature, value); with a label also its ones (pos) and zeros (neg).

    Equal values collapse before the shuffle, so a value held by most rows costs
    one row per map task.
    """
    if label is None:
        return unpivot(frame, columns).groupBy("feature", "value").agg(F.count("*").alias("n"))
    source = frame.select(*columns, F.col(label).cast("long").alias("_label"))
    return (
        unpivot(source.where(F.col("_label").isNotNull()), columns, ["_label"])
        .groupBy("feature", "value")
        .agg(
            F.count("*").alias("n"),
            F.sum("_label").alias("pos"),
            F.sum(1 - F.col("_label")).alias("neg"),
        )
    )


def binned_counts(frame: DataFrame, edges: dict[str, Sequence[float]]) -> DataFrame:
    """Rows (feature, bin, n): values of each column by the number of its edges that they reach.

    Bins are found before anything is shuffled, so what is shuffled is counts.
    """
    found = reached(numbers_of(frame, list(edges)), edges)
    return found.groupBy("feature", F.col("reached").alias("bin")).agg(F.count("*").alias("n"))


def ranked_histogram(histogram: DataFrame) -> DataFrame:
    """The histogram with the number of rows below each value of its feature.

    ``values_total`` is the number of distinct values of the feature.
    """
    measures = ["values", *[c for c in ("n", "pos", "neg") if c in histogram.columns]]
    counted = histogram.withColumn("values", F.lit(1))
    return running_totals(counted, ["feature"], [F.col("value")], measures)


def quantiles_of(ranked: DataFrame, quantiles: Sequence[Rational]) -> DataFrame:
    """Per feature: counts and an array with the interpolated quantiles, in order.

    Position q * (N - 1) is taken in integer arithmetic: a quantile that falls on
    a row is exactly the value of that row.  A histogram row is kept only for the
    positions it holds, so at most two rows per quantile and feature go on.
    """
    targets = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.lit(num).alias("num"), F.lit(den).alias("den"))
            for i, (num, den) in enumerate(quantiles)
        ]
    )

    def scaled(target: Column) -> Column:
        return target["num"] * (F.col("n_total") - 1)

    def low(target: Column) -> Column:
        return F.floor(scaled(target) / target["den"])

    def holds(position: Column) -> Column:
        return (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n"))

    def high(target: Column) -> Column:
        return F.least(low(target) + 1, F.col("n_total") - 1)

    hits = ranked.withColumn(
        "target", F.explode(F.filter(targets, lambda t: holds(low(t)) | holds(high(t))))
    )
    target = F.col("target")
    ends = hits.groupBy("feature", target["i"].alias("i")).agg(
        F.max("n_total").alias("n_rows"),
        F.max("values_total").alias("n_values"),
        F.max(F.when(holds(low(target)), F.col("value"))).alias("lo"),
        F.max(F.when(holds(high(target)), F.col("value"))).alias("hi"),
        F.max((scaled(target) % target["den"]) / target["den"]).alias("frac"),
    )
    point = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")
    # one entry per wanted quantile
    listed = F.array_sort(F.collect_list(F.struct("i", point.alias("q"))))
    return ends.groupBy("feature").agg(
        F.max("n_rows").alias("n_rows"),
        F.max("n_values").alias("n_values"),
        F.transform(listed, lambda e: e["q"]).alias("quantiles"),
    )


def exact_quantiles(
    frame: DataFrame, columns: Sequence[str], quantiles: Sequence[Rational]
) -> DataFrame:
    """(feature, n_rows, quantiles) per column with a value; by brackets, see ``order_statistics``."""
    rows = column_quantiles(frame, columns, quantiles)
    return frame.sparkSession.createDataFrame(
        rows, "feature string, n_rows bigint, quantiles array<double>"
    )


def bin_edges(ranked: DataFrame, bins: int) -> DataFrame:
    """Distinct equal-frequency edges per feature, and the inner ones alone."""
    rows = quantiles_of(ranked, [(i, bins) for i in range(bins + 1)])
    return rows.select(
        "feature", "n_rows", "n_values", F.array_distinct("quantiles").alias("edges")
    ).withColumn(
        "inner_edges",
        F.when(F.size("edges") > 2, F.slice("edges", F.lit(2), F.size("edges") - 2)).otherwise(
            F.array().cast("array<double>")
        ),
    )


def area_rows(
    histogram: DataFrame, keys: Sequence[str], value: str = "value", sums: Sequence[str] = ()
) -> DataFrame:
    """ROC area per key from (keys, value, pos, neg) counts, ties at half.

    Each slice adds its own pairs; pairs across slices come from the slice
    totals, so no task ever sees all distinct scores of a key.  ``sums`` names
    more histogram columns to add up per key in the same pass.
    """
    inside = Window.partitionBy(*keys, SLICE).orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1
    )
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0))
    local = (
        sliced(histogram, keys, [F.col(value)])
        .withColumn("_pairs", F.col("pos") * (below + F.col("neg") / 2.0))
        .groupBy(*keys, SLICE)
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum("_pairs").alias("_pairs"),
            F.count("*").alias("n_values"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("neg").over(earlier), F.lit(0))
    # one row per slice and key from here on
    whole = (
        local.withColumn("_offset", offset)
        .groupBy(*keys)
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum(F.col("_pairs") + F.col("pos") * F.col("_offset")).alias("_pairs"),
            F.sum("n_values").alias("n_values"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )
    pairs = F.col("pos").cast("double") * F.col("neg")
    return whole.select(
        *keys,
        "pos",
        "neg",
        "n_values",
        *sums,
        F.when(pairs > 0, F.col("_pairs") / pairs).alias("auc"),
    )


def score_histogram(frame: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    """Ones and zeros per (keys, score)."""
    y = F.col(label).cast("long")
    return (
        frame.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("value"))
        .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    )


def auc_by(frame: DataFrame, keys: Sequence[str], score: str, label: str) -> DataFrame:
    return area_rows(score_histogram(frame, keys, score, label), keys)
