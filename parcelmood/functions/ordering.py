"""Running totals over a total order without a one-task window.

A plain ``Window.orderBy`` over raw rows puts a whole group into one task.  Here
the rows are range-partitioned on (keys, order), every slice is summed on its
own, and the slice totals (at most one row per slice and key) give the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmood.session import settle

SLICE = "_slice"


def _slices(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sliced(frame: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Range-partition and tag every row with the number of its slice."""
    ranged = frame.repartitionByRange(_slices(frame), *[F.col(k) for k in keys], *order)
    return ranged.withColumn(SLICE, F.spark_partition_id())


def _earlier(aggregate, column: str, window, default) -> Column:
    value = aggregate(column).over(window)
    return value if default is None else F.coalesce(value, F.lit(default))


def _rows_before(*partition: str):
    return Window.partitionBy(*partition), (Window.unboundedPreceding, -1)


def running_totals(
    frame: DataFrame, keys: Sequence[str], order: Sequence[Column], measures: Sequence[str]
) -> DataFrame:
    """Add ``<m>_before`` (sum over earlier rows of the key) and ``<m>_total``.

    The order should be unique per key; collapse equal rows to one weighted row
    first, which also takes the weight out of a hot value.  The sliced frame is
    written to the checkpoint folder once, so that the offsets and the rows see
    the same slices even after an executor is lost.
    """
    whole, before = _rows_before(*keys)
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(*before)
    local = settle(
        sliced(frame, keys, order).withColumns(
            {f"{m}_before": _earlier(F.sum, m, inside, 0) for m in measures}
        )
    )
    totals = local.groupBy(*keys, SLICE).agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    earlier = whole.orderBy(SLICE).rowsBetween(*before)
    offsets = totals.select(
        *keys,
        SLICE,
        *[_earlier(F.sum, f"_{m}", earlier, 0).alias(f"_{m}_offset") for m in measures],
        *[F.sum(f"_{m}").over(whole).alias(f"{m}_total") for m in measures],
    )
    # offsets has at most slices + keys rows
    joined = local.join(F.broadcast(offsets), [*keys, SLICE])
    return joined.select(
        *[F.col(c) for c in frame.columns],
        *[(F.col(f"{m}_before") + F.col(f"_{m}_offset")).alias(f"{m}_before") for m in measures],
        *[F.col(f"{m}_total") for m in measures],
    )


def running_best(
    frame: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, name: str
) -> DataFrame:
    """Add the largest value so far within the key, sliced like running_totals."""
    whole, before = _rows_before(*keys)
    inside = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = settle(sliced(frame, keys, order).withColumn("_best", F.max(value).over(inside)))
    totals = local.groupBy(*keys, SLICE).agg(F.max(value).alias("_top"))
    earlier = whole.orderBy(SLICE).rowsBetween(*before)
    offsets = totals.select(*keys, SLICE, F.max("_top").over(earlier).alias("_offset"))
    joined = local.join(F.broadcast(offsets), [*keys, SLICE])
    return joined.select(*frame.columns, F.greatest("_best", "_offset").alias(name))
