"""Comparison of models: stability, winners, trial history, importance audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.functions.ordering import running_best
from parcelmood.functions.scalars import half_even

ENSEMBLE = "STACKING"


def stability_score(
    table: DataFrame,
    penalty: float = C.STABILITY_PENALTY,
    unstable: float = C.UNSTABLE_DROP,
) -> DataFrame:
    """Add drop, penalised score and verdict; only a drop from val costs points.

    The backtest takes part in the choice, as in the method it follows, so it is
    no untouched test set afterwards.
    """
    val, backtest = F.col("f1_cls0_val"), F.col("f1_cls0_backtest")
    drop = val - backtest
    return table.withColumns(
        {
            "caida": half_even(drop, 4),
            "score_estabilidad": half_even(
                val - penalty * F.greatest(drop, F.lit(0.0)), 4
            ),
            "estable": F.when(drop <= unstable, "sí").otherwise("NO"),
            "f1_cls0_val": half_even(val, 4),
            "f1_cls0_backtest": half_even(backtest, 4),
        }
    )


def best_model(table: DataFrame, by: str = "score_estabilidad") -> DataFrame:
    """Top row by the given score; the ensemble row does not compete."""
    candidates = table.where(F.col("modelo") != ENSEMBLE)
    return candidates.orderBy(F.desc_nulls_last(by), "modelo").limit(1)


def append_rows(*tables: DataFrame) -> DataFrame:
    """Rows of all report tables; a column that one lacks is null there."""
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table, allowMissingColumns=True)
    return whole


def trial_running_best(trials: DataFrame, score: str = "f1_cls0_val") -> DataFrame:
    return running_best(trials, ["modelo"], [F.col("trial")], score, "mejor_acumulado")


def cv_summary(folds: DataFrame, score: str = "score") -> DataFrame:
    """Mean and population deviation of the fold scores per model."""
    return folds.groupBy("modelo").agg(
        half_even(F.avg(score), 4).alias("cv_f1_mean"),
        half_even(F.stddev_pop(score), 4).alias("cv_f1_std"),
    )


def probability_matrix(
    long: DataFrame, row_id: Sequence[str], models: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """One row for each whole row id, one probability column per model; ``carry`` names what is the same in its rows."""
    columns = [F.max(c).alias(c) for c in carry]
    columns += [F.max(F.when(F.col("modelo") == m, F.col("proba"))).alias(m) for m in models]
    return long.groupBy(*row_id).agg(*columns)


def importance_share(table: DataFrame, raw: str = "importancia") -> DataFrame:
    """Positive importances as percentages; the window covers one row per variable."""
    kept = F.greatest(F.col(raw), F.lit(0.0))
    total = F.sum(kept).over(Window.partitionBy())
    return table.select(
        "variable",
        (100 * kept / F.when(total > 0, total).otherwise(1.0)).alias("importancia_pct"),
    ).orderBy(F.desc("importancia_pct"), "variable")


def top_importance(shares: DataFrame, k: int = 18) -> DataFrame:
    return shares.orderBy(F.desc("importancia_pct"), "variable").limit(k)


def audit_cap(shares: DataFrame, cap: float = C.IMPORTANCE_CAP) -> DataFrame:
    """Whether any variable exceeds the cap; shares add to 100, so few can."""
    above = F.col("importancia_pct") > cap * 100
    offenders = F.array_sort(
        F.collect_list(
            F.when(
                above,
                F.struct(
                    (-F.col("importancia_pct")).alias("orden"),
                    F.col("variable"),
                    half_even(F.col("importancia_pct"), 2).alias("importancia_pct"),
                ),
            )
        )
    )
    return shares.agg(
        F.lit(cap * 100).alias("cap_pct"),
        (F.count_if(above) == 0).alias("cumple"),
        half_even(F.max("importancia_pct"), 2).alias("max_pct"),
        F.transform(
            offenders, lambda e: F.struct(e["variable"], e["importancia_pct"])
        ).alias("infractoras"),
    )
