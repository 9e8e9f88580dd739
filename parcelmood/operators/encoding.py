"""Mean target encoding of a category, learned on training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.operators.cleaning import category_text


def target_encoding(
    train: DataFrame, frame: DataFrame, column: str, target: str = C.TARGET, smoothing: float = 0.0
) -> DataFrame:
    """Add ``te_<column>``; a category unseen in training gets the overall mean.

    The means are joined by category, so their number is not bounded; the
    overall mean travels on the same rows through the class counts.
    """
    counts = train.groupBy(category_text(column).alias("_category")).agg(
        F.sum(target).alias("_sum"), F.count(target).alias("_n")
    )
    overall = counts.agg((F.sum("_sum") / F.sum("_n")).alias("mean")).first().mean
    weight = F.nullif(F.col("_n") + F.lit(smoothing), F.lit(0.0))
    mean = (F.col("_sum") + smoothing * overall) / weight
    means = counts.select("_category", mean.alias(f"te_{column}"))
    return (
        frame.withColumn("_category", category_text(column))
        .join(means, "_category", "left")
        .drop("_category")
        .fillna({f"te_{column}": overall})
    )
