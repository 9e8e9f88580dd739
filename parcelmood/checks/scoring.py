"""Queries for metrics of a score, model comparison, samples and folds.

Where an operator reads the output of a model, a fixed function of the data
stands in, so that SQL can check the operator.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.checks.base import features_of, query, rounded, scored_of
from parcelmood.functions.ordering import running_totals
from parcelmood.functions.scalars import half_even
from parcelmood.operators import comparison, metrics
from parcelmood.operators.sampling import (
    class_balance,
    fixed_sample,
    numeric_matrix,
    stratified_folds,
)
from parcelmood.operators.split import rows_of_split
from parcelmood.sources.fixture import FIXTURE_CALENDAR, read_table

ROW = ["order_id", "review_id"]

COUNTS = """, judged AS (
  SELECT *, is_satisfied AS y, CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END AS p FROM scored),
ranked AS (
  SELECT {keys}, y,
    rank() OVER (PARTITION BY {keys} ORDER BY proba)
      + (count(*) OVER (PARTITION BY {keys}, proba) - 1) / 2.0 AS r
  FROM judged WHERE {where}),
areas AS (
  SELECT {keys}, (sum(r) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0)
    / nullif(sum(y) * sum(1 - y), 0) AS auc
  FROM ranked GROUP BY {keys}),
counts AS (
  SELECT {keys}, count(*) AS n, sum(y) AS pos,
    count(*) FILTER (WHERE y = 1 AND p = 1)::DOUBLE AS tp,
    count(*) FILTER (WHERE y = 0 AND p = 1)::DOUBLE AS fp,
    count(*) FILTER (WHERE y = 1 AND p = 0)::DOUBLE AS fn,
    count(*) FILTER (WHERE y = 0 AND p = 0)::DOUBLE AS tn,
    avg((proba - y) * (proba - y)) AS brier
  FROM judged WHERE {where} GROUP BY {keys}),
counted AS (SELECT c.*, auc FROM counts c JOIN areas a USING ({keys}))"""

_TECHNICAL = """
  round_even((tp + tn) / n, 4) AS accuracy,
  round_even(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision,
  round_even(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall,
  round_even(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1,
  round_even(auc, 4) AS roc_auc, round_even(2 * auc - 1, 4) AS gini,
  round_even(pos / n, 4) AS tasa_positivos_real, n"""


def _months() -> str:
    return ", ".join(f"'{m}'" for m in (*FIXTURE_CALENDAR.backtest, *FIXTURE_CALENDAR.live))


def _counts(keys: str, where: str = "true") -> str:
    return COUNTS.format(keys=keys, where=where)


# ---- metrics of a score ---------------------------------------------------------

@query("technical_metrics", f"{_counts('dataset_split')} SELECT dataset_split, {_TECHNICAL} FROM counted")
def technical_metrics(spark, directory):
    return metrics.technical_metrics(scored_of(spark, directory), [C.SPLIT])


_THREE = "dataset_split IN ('val', 'backtest', 'live')"


@query("metrics_by_split", f"""{_counts('dataset_split', _THREE)}
SELECT dataset_split, {_TECHNICAL} FROM counted""")
def metrics_by_split(spark, directory):
    return metrics.metrics_by_split(scored_of(spark, directory))


_BACKTEST = f"""{_counts("purchase_month", f"purchase_month IN ({_months()})")}, monthly AS (
  SELECT purchase_month AS month, {_TECHNICAL} FROM counted)"""


@query("monthly_backtest", f"{_BACKTEST} SELECT * FROM monthly")
def monthly_backtest(spark, directory):
    return metrics.monthly_backtest(scored_of(spark, directory), FIXTURE_CALENDAR)


@query("stability_band", f"""{_BACKTEST}
SELECT month, roc_auc, gini, f1,
  round_even(roc_auc - first_value(roc_auc IGNORE NULLS) OVER w, 4) AS delta_roc_auc,
  round_even(gini - first_value(gini IGNORE NULLS) OVER w, 4) AS delta_gini,
  round_even(f1 - first_value(f1 IGNORE NULLS) OVER w, 4) AS delta_f1,
  round_even(roc_auc - lag(roc_auc) OVER w, 4) AS delta_previo,
  CASE WHEN abs(round_even(roc_auc - first_value(roc_auc IGNORE NULLS) OVER w, 4)) > 0.02 THEN 1 ELSE 0 END
    AS alarma
FROM monthly WINDOW w AS (ORDER BY month)""")
def stability_band(spark, directory):
    monthly = metrics.monthly_backtest(scored_of(spark, directory), FIXTURE_CALENDAR)
    return metrics.stability_band(monthly)


_ZERO = """
  coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) AS f1_cls0,
  coalesce(tn / nullif(tn + fp, 0), 0) AS rec_cls0,
  coalesce(tn / nullif(tn + fn, 0), 0) AS pre_cls0"""


@query("class0_metrics", f"""{_counts('dataset_split')}, zero AS (
  SELECT dataset_split, {_ZERO} FROM counted)
SELECT dataset_split, round_even(f1_cls0, 4) AS f1_cls0, round_even(rec_cls0, 4) AS rec_cls0,
  round_even(pre_cls0, 4) AS pre_cls0 FROM zero""")
def class0_metrics(spark, directory):
    found = metrics.class0_metrics(scored_of(spark, directory), [C.SPLIT])
    return found.select(C.SPLIT, *[rounded(c) for c in ("f1_cls0", "rec_cls0", "pre_cls0")])


_FULL = ("f1_cls0", "rec_cls0", "pre_cls0", "f1_cls1", "rec_cls1", "pre_cls1", "f1_macro",
         "accuracy", "auc_roc", "gini", "brier")


@query("full_metrics", f"""{_counts('dataset_split')}, whole AS (
  SELECT dataset_split, {_ZERO},
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_cls1,
    coalesce(tp / nullif(tp + fn, 0), 0) AS rec_cls1,
    coalesce(tp / nullif(tp + fp, 0), 0) AS pre_cls1,
    (coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0)
      + coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)) / 2 AS f1_macro,
    (tp + tn) / n AS accuracy, auc AS auc_roc, 2 * auc - 1 AS gini, brier
  FROM counted)
SELECT dataset_split, {", ".join(f"round_even({c}, 5) AS {c}" for c in _FULL)} FROM whole""")
def full_metrics(spark, directory):
    found = metrics.full_metrics(scored_of(spark, directory), [C.SPLIT])
    return found.select(C.SPLIT, *[rounded(c, 5) for c in _FULL])


@query("business_metrics", """
SELECT dataset_split, count(*) AS n,
  round_even(avg(CASE WHEN review_score >= 4 THEN 1 ELSE 0 END) * 100, 2)
    AS satisfied_customer_rate_pct,
  round_even(avg(CASE WHEN review_score <= 3 THEN 1 ELSE 0 END) * 100, 2)
    AS unsatisfied_customer_rate_pct,
  round_even(avg(review_score), 3) AS average_review_score,
  round_even(avg(delivered_on_time) * 100, 2) AS on_time_delivery_rate_pct,
  round_even(coalesce(avg(delivery_delay_days) FILTER (WHERE delivery_delay_days > 0), 0), 2)
    AS average_delay_days_when_late,
  round_even(coalesce(sum(payment_value) FILTER (WHERE review_score <= 3), 0), 2)
    AS revenue_at_risk_brl,
  round_even(coalesce(coalesce(sum(payment_value) FILTER (WHERE review_score <= 3), 0)
    / nullif(sum(payment_value), 0), 0) * 100, 2) AS revenue_at_risk_pct,
  round_even(avg(payment_value), 2) AS average_order_value_brl
FROM feat GROUP BY dataset_split""")
def business_metrics(spark, directory):
    return metrics.business_metrics(features_of(spark, directory), [C.SPLIT])


@query("alert_metrics", """
SELECT dataset_split,
  count(*) FILTER (WHERE is_satisfied = 0 AND proba < 0.5) AS insatisfechos_detectados,
  count(*) FILTER (WHERE is_satisfied = 0) AS insatisfechos_totales,
  round_even(coalesce(count(*) FILTER (WHERE is_satisfied = 0 AND proba < 0.5)
    / nullif(count(*) FILTER (WHERE is_satisfied = 0), 0), 0) * 100, 2)
    AS deteccion_insatisfechos_pct,
  round_even(coalesce(sum(payment_value) FILTER (WHERE is_satisfied = 0 AND proba < 0.5), 0), 2)
    AS revenue_en_riesgo_detectado_brl
FROM scored GROUP BY dataset_split""")
def alert_metrics(spark, directory):
    return metrics.alert_metrics(scored_of(spark, directory), [C.SPLIT])


@query("confusion_matrix", """
SELECT CASE real WHEN 0 THEN 'insatisfecho' ELSE 'satisfecho' END AS real,
  count(*) FILTER (WHERE is_satisfied = real AND proba < 0.5) AS pred_insatisfecho,
  count(*) FILTER (WHERE is_satisfied = real AND proba >= 0.5) AS pred_satisfecho
FROM scored, (VALUES (0), (1)) t(real) WHERE dataset_split = 'val' GROUP BY real""")
def confusion_matrix(spark, directory):
    return metrics.confusion_matrix(rows_of_split(scored_of(spark, directory), "val"))


@query("lift_table", """, ordered AS (
  SELECT dataset_split, 1 - is_satisfied AS bad,
    row_number() OVER (PARTITION BY dataset_split
      ORDER BY 1.0 - proba DESC, order_id, is_satisfied) AS place,
    count(*) OVER (PARTITION BY dataset_split) AS n,
    sum(1 - is_satisfied) OVER (PARTITION BY dataset_split) AS total
  FROM scored WHERE dataset_split IN ('val', 'backtest', 'live')),
cuts AS (
  SELECT o.*, pct, greatest(CAST(round_even(n * pct / 100.0, 0) AS BIGINT), 1) AS k
  FROM ordered o, (VALUES (5), (10), (20)) t(pct)),
sums AS (
  SELECT dataset_split, pct, max(k) AS k, max(n) AS n, max(total) AS total,
    CAST(sum(CASE WHEN place <= k THEN bad ELSE 0 END) AS BIGINT) AS caught
  FROM cuts GROUP BY dataset_split, pct)
SELECT dataset_split, pct AS top_pct, k AS contactados, caught AS insatisfechos_capturados,
  round_even(caught / greatest(total, 1) * 100, 1) AS captura_pct,
  round_even(caught / k * 100, 1) AS precision_pct,
  round_even(caught / k / greatest(total / n, 1e-9), 2) AS lift FROM sums""")
def lift_table(spark, directory):
    wanted = rows_of_split(scored_of(spark, directory), "val", "backtest", "live")
    return metrics.lift_table(wanted, keys=[C.SPLIT])


@query("scored_month_summary", f"""
SELECT count(*) AS n,
  round_even(avg(CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END) * 100, 1) AS predichos_satisfechos_pct,
  count(*) FILTER (WHERE proba < 0.5) AS pedidos_en_riesgo
FROM scored WHERE dataset_split = 'predict'""")
def scored_month_summary(spark, directory):
    month = rows_of_split(scored_of(spark, directory), "predict")
    return metrics.scored_summary(metrics.decide(month))


@query("margin_sigmoid", """
SELECT order_id, review_id, round_even(1 / (1 + exp(-(delivery_delay_days / -10.0))), 6) AS proba
FROM feat""")
def margin_sigmoid(spark, directory):
    margin = F.col("delivery_delay_days") / F.lit(-10.0)
    return features_of(spark, directory).select(
        *ROW, half_even(metrics.margin_to_probability(margin), 6).alias("proba")
    )


# ---- classes, samples, folds ------------------------------------------------------

@query("class_balance", """
SELECT count(*) FILTER (WHERE is_satisfied = 0) AS neg,
  count(*) FILTER (WHERE is_satisfied = 1) AS pos,
  round_even(avg(1 - is_satisfied), 4) AS insatisfechos_pct,
  round_even(sum(is_satisfied) / greatest(sum(1 - is_satisfied), 1), 4) AS scale_pos_weight,
  round_even(count(*) / (2.0 * sum(1 - is_satisfied)), 6) AS peso_0,
  round_even(count(*) / (2.0 * sum(is_satisfied)), 6) AS peso_1
FROM feat WHERE dataset_split = 'train'""")
def balance(spark, directory):
    train = rows_of_split(features_of(spark, directory), "train")
    return class_balance(train).withColumns(
        {c: half_even(F.col(c), 6) for c in ("peso_0", "peso_1")}
    )


@query("presplit_matrix", f"""
SELECT order_id, review_id, dataset_split, is_satisfied, {", ".join(
    f"round_even(coalesce(CAST({c} AS DOUBLE), 0), 6) AS {c}" for c in C.NUMERIC)} FROM feat""")
def presplit_matrix(spark, directory):
    """Numeric columns only, nulls as 0, with split and label; text columns fall out."""
    matrix = numeric_matrix(
        features_of(spark, directory), C.NUMERIC + C.CATEGORICAL, [*ROW, C.SPLIT, C.TARGET]
    )
    return matrix.select(*ROW, C.SPLIT, C.TARGET, *[rounded(c, 6) for c in C.NUMERIC])


SAMPLE_ROWS = 500


@query("fixed_sample", f"""
SELECT order_id, review_id, is_satisfied FROM feat WHERE dataset_split = 'train'
ORDER BY md5(concat_ws('-', '{C.SEED}', order_id, review_id)), order_id, review_id LIMIT {SAMPLE_ROWS}""")
def sample(spark, directory):
    """A sample of exactly SAMPLE_ROWS shuffled training rows."""
    train = rows_of_split(features_of(spark, directory), "train")
    return fixed_sample(train, SAMPLE_ROWS, ROW).select(*ROW, C.TARGET)


@query("stratified_folds", """, classes AS (
  SELECT is_satisfied, count(*) AS n FROM feat WHERE dataset_split = 'train' GROUP BY 1)
SELECT CAST(f AS INTEGER) AS fold, is_satisfied,
  CAST(n // 3 + CASE WHEN f < n % 3 THEN 1 ELSE 0 END AS BIGINT) AS filas
FROM classes, range(3) t(f)""")
def folds(spark, directory):
    train = rows_of_split(features_of(spark, directory), "train").select(*ROW, C.TARGET)
    placed = stratified_folds(train, ROW)
    return placed.groupBy("fold", C.TARGET).agg(F.count("*").alias("filas"))


# ---- model comparison ----------------------------------------------------------------

def _trials(spark, directory):
    """Stand-in for a trial history: events in time order, per type."""
    events = read_table(spark, directory, "events").select(
        F.col("event_type").alias("modelo"), "ts", "event_id", "value", F.lit(1).alias("one")
    )
    numbered = running_totals(events, ["modelo"], [F.col("ts"), F.col("event_id")], ["one"])
    return numbered.select(
        "modelo", (F.col("one_before") + 1).alias("trial"), F.col("value").alias("f1_cls0_val")
    )


@query("trial_running_best", """
WITH trials AS (
  SELECT event_type AS modelo, value AS f1_cls0_val,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS trial FROM events)
SELECT modelo, trial, f1_cls0_val, max(f1_cls0_val) OVER (
  PARTITION BY modelo ORDER BY trial ROWS UNBOUNDED PRECEDING) AS mejor_acumulado
FROM trials""", prefix=False)
def trial_running_best(spark, directory):
    return comparison.trial_running_best(_trials(spark, directory))


_MODELS_SQL = """WITH models AS (
  SELECT event_type AS modelo,
    avg(value) FILTER (WHERE ts < TIMESTAMP '2024-01-16') / 500 AS val,
    avg(value) FILTER (WHERE ts >= TIMESTAMP '2024-01-16') / 500 AS bt
  FROM events GROUP BY event_type),
compared AS (
  SELECT modelo, round_even(val, 4) AS f1_cls0_val, round_even(bt, 4) AS f1_cls0_backtest,
    round_even(val - bt, 4) AS caida,
    round_even(val - greatest(val - bt, 0), 4) AS score_estabilidad,
    CASE WHEN val - bt <= 0.05 THEN 'sí' ELSE 'NO' END AS estable
  FROM models)"""


def _compared(spark, directory):
    half = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    value = F.col("value")
    models = (
        read_table(spark, directory, "events")
        .groupBy(F.col("event_type").alias("modelo"))
        .agg(
            (F.avg(F.when(half, value)) / 500).alias("f1_cls0_val"),
            (F.avg(F.when(~half, value)) / 500).alias("f1_cls0_backtest"),
        )
    )
    return comparison.stability_score(models)


@query("stability_score", f"{_MODELS_SQL} SELECT * FROM compared", prefix=False)
def stability_score(spark, directory):
    return _compared(spark, directory)


@query("best_model", f"""{_MODELS_SQL}, winners AS (
  (SELECT 'f1' AS criterio, * FROM compared ORDER BY f1_cls0_val DESC, modelo LIMIT 1)
  UNION ALL
  (SELECT 'estabilidad', * FROM compared ORDER BY score_estabilidad DESC, modelo LIMIT 1))
SELECT * FROM winners""", prefix=False)
def best_model(spark, directory):
    table = _compared(spark, directory)
    winners = [
        comparison.best_model(table, column).select(F.lit(name).alias("criterio"), "*")
        for name, column in (("f1", "f1_cls0_val"), ("estabilidad", "score_estabilidad"))
    ]
    return comparison.append_rows(*winners)


@query("cv_summary", """, folds AS (
  SELECT o.o_orderpriority AS modelo, o.o_orderkey % 3 AS fold, avg(is_satisfied) AS score
  FROM feat f JOIN orders o ON f.order_id = o.o_orderkey GROUP BY 1, 2)
SELECT modelo, round_even(avg(score), 4) AS cv_f1_mean,
  round_even(stddev_pop(score), 4) AS cv_f1_std FROM folds GROUP BY modelo""")
def cv_summary(spark, directory):
    priority = read_table(spark, directory, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("modelo")
    )
    folds = (
        features_of(spark, directory)
        .select("order_id", C.TARGET)
        .join(priority, "order_id")
        .groupBy("modelo", (F.col("order_id") % 3).alias("fold"))
        .agg(F.avg(C.TARGET).alias("score"))
    )
    return comparison.cv_summary(folds)


@query("oof_matrix", """
SELECT order_id, review_id, round_even(avg(proba), 6) AS base,
  round_even(avg(1 - proba), 6) AS inverso,
  round_even(avg(proba / 2), 6) AS mitad FROM scored GROUP BY order_id, review_id""")
def oof_matrix(spark, directory):
    """Long (row, model, probability) rows of three linear scores, side by side."""
    score = F.col("proba")
    scores = F.create_map(
        F.lit("base"), score, F.lit("inverso"), 1 - score, F.lit("mitad"), score / 2
    )
    long = scored_of(spark, directory).select(*ROW, F.explode(scores).alias("modelo", "proba"))
    wide = comparison.probability_matrix(long, ROW, ["base", "inverso", "mitad"])
    return wide.select(*ROW, *[rounded(c, 6) for c in ("base", "inverso", "mitad")])


_IMPORTANCE_SQL = """WITH raw AS (
  SELECT p_brand AS variable, greatest(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))
    * (CAST(l_discount AS DECIMAL(4,2)) - 0.05)) AS DOUBLE), 0) AS kept
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand),
shares AS (SELECT variable, 100 * kept / sum(kept) OVER () AS importancia_pct FROM raw)"""


def _importance(spark, directory):
    """Stand-in for raw importances: discount margin per brand, some negative."""
    margin = F.col("l_extendedprice").cast("decimal(12,2)") * (
        F.col("l_discount").cast("decimal(4,2)") - F.lit("0.05").cast("decimal(4,2)")
    )
    per_brand = (
        read_table(spark, directory, "lineitem")
        .join(read_table(spark, directory, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_brand").alias("variable"))
        .agg(F.sum(margin).cast("double").alias("importancia"))
    )
    return comparison.importance_share(per_brand)


@query("importance_share", f"""{_IMPORTANCE_SQL}
SELECT variable, round_even(importancia_pct, 6) AS importancia_pct FROM shares""", prefix=False)
def importance_share(spark, directory):
    return _importance(spark, directory).select("variable", rounded("importancia_pct", 6))


@query("importance_topk", f"""{_IMPORTANCE_SQL}
SELECT variable, round_even(importancia_pct, 6) AS importancia_pct FROM shares
ORDER BY shares.importancia_pct DESC, variable LIMIT 18""", prefix=False)
def importance_topk(spark, directory):
    return comparison.top_importance(_importance(spark, directory)).select(
        "variable", rounded("importancia_pct", 6)
    )


@query("importance_cap_audit", f"""{_IMPORTANCE_SQL}
SELECT CAST(15 AS DOUBLE) AS cap_pct, coalesce(bool_and(importancia_pct <= 15), true) AS cumple,
  round_even(max(importancia_pct), 2) AS max_pct,
  coalesce(string_agg(variable, ',' ORDER BY importancia_pct DESC, variable)
    FILTER (WHERE importancia_pct > 15), '') AS infractoras
FROM shares""", prefix=False)
def importance_cap_audit(spark, directory):
    audit = comparison.audit_cap(_importance(spark, directory))
    names = F.transform("infractoras", lambda e: e["variable"])
    return audit.withColumn("infractoras", F.array_join(names, ","))
