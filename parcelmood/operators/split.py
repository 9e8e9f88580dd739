"""Temporal partitions by purchase month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmood import config as C


def assign_split(
    frame: DataFrame, calendar: C.SplitCalendar = C.DEFAULT_CALENDAR, month: str = C.MONTH
) -> DataFrame:
    """Label each row; where the calendar overlaps, the later partition wins."""
    m = F.col(month)
    label = (
        F.when(m.isin(*calendar.predict), "predict")
        .when(m.isin(*calendar.live), "live")
        .when(m.isin(*calendar.backtest), "backtest")
        .when(m.isin(*calendar.val), "val")
        .when(m <= calendar.train_end, "train")
        .otherwise("excluded")
    )
    return frame.withColumn(C.SPLIT, label)


def rows_of_split(frame: DataFrame, *splits: str) -> DataFrame:
    return frame.where(F.col(C.SPLIT).isin(*splits))


def rows_of_months(frame: DataFrame, months: Sequence[str]) -> DataFrame:
    return frame.where(F.col(C.MONTH).isin(*months))


def split_rank(column: str = C.SPLIT):
    names = F.array(*[F.lit(s) for s in C.SPLIT_ORDER])
    return F.array_position(names, F.col(column)).cast("int")


def split_summary(frame: DataFrame) -> DataFrame:
    """Rows and month range per partition, in calendar order."""
    return (
        frame.groupBy(C.SPLIT)
        .agg(
            F.count("order_id").alias("filas"),
            F.min(C.MONTH).alias("mes_min"),
            F.max(C.MONTH).alias("mes_max"),
        )
        .orderBy(split_rank())
    )
