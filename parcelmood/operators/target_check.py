"""Evidence about the target: monthly rates, delivery gap and volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.functions.scalars import half_even
from parcelmood.operators.split import split_rank


def monthly_target_rate(frame: DataFrame, target: str = C.TARGET) -> DataFrame:
    return frame.groupBy(C.MONTH).agg(
        F.count("*").alias("n"), half_even(F.avg(target), 4).alias("tasa_satisfechos")
    )


def delivery_gap(frame: DataFrame, target: str = C.TARGET) -> DataFrame:
    """Satisfied rate of on-time and late deliveries and their gap in points."""
    on_time = F.avg(F.when(F.col("delivered_on_time") == 1, F.col(target)))
    late = F.avg(F.when(F.col("delivered_on_time") == 0, F.col(target)))
    return frame.agg(
        half_even(on_time, 4).alias("satisfaccion_entrega_a_tiempo"),
        half_even(late, 4).alias("satisfaccion_entrega_tardia"),
        half_even((on_time - late) * 100, 1).alias("gap_puntos_porcentuales"),
    )


def monthly_volume(frame: DataFrame) -> DataFrame:
    return frame.groupBy(C.MONTH, C.SPLIT).agg(F.count("*").alias("n"))


def volume_pivot(volume: DataFrame, splits: Sequence[str] = C.SPLIT_ORDER) -> DataFrame:
    """One row per month, one count column per partition, 0 where there is none."""
    wide = volume.groupBy(C.MONTH).pivot(C.SPLIT, list(splits)).agg(F.sum("n"))
    return wide.select(C.MONTH, *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in splits])


def volume_stack(volume: DataFrame) -> DataFrame:
    """Base and top of every partition's bar segment within its month.

    Window groups hold one row per partition of a month, at most six.
    """
    order = Window.partitionBy(C.MONTH).orderBy(split_rank()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    top = F.sum("n").over(order)
    return volume.withColumn("top", top).withColumn("base", F.col("top") - F.col("n"))


def check_target(frame: DataFrame, target: str = C.TARGET) -> DataFrame:
    """One-row summary: size, rates, extreme months with enough rows, gap.

    One shuffle by month carries partial sums; the rest works on months.
    """
    on_time = F.col("delivered_on_time") == 1
    late = F.col("delivered_on_time") == 0
    y = F.col(target)
    months = frame.groupBy(C.MONTH).agg(
        F.count("*").alias("n"),
        F.sum(y).alias("hits"),
        F.count_if(on_time).alias("n_on_time"),
        F.sum(F.when(on_time, y)).alias("hits_on_time"),
        F.count_if(late).alias("n_late"),
        F.sum(F.when(late, y)).alias("hits_late"),
    )
    shown = F.when(F.col("n") >= C.MIN_MONTH_ROWS, half_even(F.col("hits") / F.col("n"), 4))
    rated = months.withColumn("rate", shown)
    month = F.col(C.MONTH)
    rate_on_time = F.sum("hits_on_time") / F.nullif(F.sum("n_on_time"), F.lit(0))
    rate_late = F.sum("hits_late") / F.nullif(F.sum("n_late"), F.lit(0))
    known = F.col("rate").isNotNull()
    # struct order breaks ties toward the earliest month
    lowest = F.min(F.when(known, F.struct(F.col("rate").alias("rate"), month.alias("m"))))
    highest = F.min(F.when(known, F.struct((-F.col("rate")).alias("rate"), month.alias("m"))))
    return rated.agg(
        F.sum("n").alias("n_poblacion"),
        half_even(F.sum("hits") / F.sum("n"), 4).alias("tasa_global_satisfechos"),
        lowest["m"].alias("mes_min"),
        lowest["rate"].alias("tasa_min"),
        highest["m"].alias("mes_max"),
        (-highest["rate"]).alias("tasa_max"),
        half_even(F.avg("rate"), 4).alias("media_del_periodo"),
        half_even(rate_on_time, 4).alias("satisfaccion_entrega_a_tiempo"),
        half_even(rate_late, 4).alias("satisfaccion_entrega_tardia"),
        half_even((rate_on_time - rate_late) * 100, 1).alias("gap_puntos_porcentuales"),
    ).select(
        F.lit(target).alias("target"),
        F.lit(f"{C.SCORE} >= {C.SATISFIED_FROM}").alias("regla"),
        "*",
    )
