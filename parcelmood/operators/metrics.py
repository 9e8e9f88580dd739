"""Classification, business and lift metrics for one or many partitions at once.

All score metrics come from one histogram of (keys, score) counts, so several
splits or months cost one job and tied scores never travel row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmood import config as C
from parcelmood.functions.histograms import area_rows, score_histogram
from parcelmood.functions.order_statistics import LARGEST, grid_of, proposed_values, values_at
from parcelmood.functions.ordering import running_totals
from parcelmood.functions.scalars import half_even, ratio

PROBA = "proba"
PREDICTION = "pred_satisfecho"


def decide(frame: DataFrame, score: str = PROBA, threshold: float = 0.5) -> DataFrame:
    return frame.withColumn(PREDICTION, (F.col(score) >= threshold).cast("int"))


def margin_to_probability(margin: Column) -> Column:
    """Logistic of a decision margin, for models that give no probability."""
    return 1 / (1 + F.exp(-margin))


def _f1(hits: Column, predicted: Column, actual: Column) -> Column:
    return ratio(2 * hits, predicted + actual)


def score_counts(
    frame: DataFrame,
    keys: Sequence[str] = (),
    score: str = PROBA,
    target: str = C.TARGET,
    threshold: float = 0.5,
) -> DataFrame:
    """Per key: confusion counts, squared error and ROC area."""
    chosen = F.col("value") >= threshold
    histogram = score_histogram(frame, keys, score, target).withColumns(
        {
            "tp": F.when(chosen, F.col("pos")).otherwise(0),
            "fp": F.when(chosen, F.col("neg")).otherwise(0),
            "squared": F.col("pos") * F.pow(1 - F.col("value"), 2)
            + F.col("neg") * F.pow(F.col("value"), 2),
        }
    )
    return area_rows(histogram, keys, sums=["tp", "fp", "squared"]).withColumns(
        {
            "fn": F.col("pos") - F.col("tp"),
            "tn": F.col("neg") - F.col("fp"),
            "n": F.col("pos") + F.col("neg"),
        }
    )


def technical_metrics(frame: DataFrame, keys: Sequence[str] = (), **options) -> DataFrame:
    """Class-1 metrics rounded to 4 places; AUC and Gini are null for one class."""
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n"))
    shown = {
        "accuracy": (tp + tn) / n,
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": _f1(tp, tp + fp, tp + fn),
        "roc_auc": F.col("auc"),
        "gini": 2 * F.col("auc") - 1,
        "tasa_positivos_real": F.col("pos") / n,
    }
    return score_counts(frame, keys, **options).select(
        *keys, *[half_even(e, 4).alias(name) for name, e in shown.items()], "n"
    )


def full_metrics(frame: DataFrame, keys: Sequence[str] = (), **options) -> DataFrame:
    """Both classes, macro F1, accuracy, AUC, Gini and Brier score, unrounded."""
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n"))
    f1_0, f1_1 = _f1(tn, tn + fn, tn + fp), _f1(tp, tp + fp, tp + fn)
    return score_counts(frame, keys, **options).select(
        *keys,
        f1_0.alias("f1_cls0"),
        ratio(tn, tn + fp).alias("rec_cls0"),
        ratio(tn, tn + fn).alias("pre_cls0"),
        f1_1.alias("f1_cls1"),
        ratio(tp, tp + fn).alias("rec_cls1"),
        ratio(tp, tp + fp).alias("pre_cls1"),
        ((f1_0 + f1_1) / 2).alias("f1_macro"),
        ((tp + tn) / n).alias("accuracy"),
        F.col("auc").alias("auc_roc"),
        (2 * F.col("auc") - 1).alias("gini"),
        (F.col("squared") / n).alias("brier"),
    )


def class0_metrics(
    frame: DataFrame,
    keys: Sequence[str] = (),
    score: str = PROBA,
    target: str = C.TARGET,
    threshold: float = 0.5,
) -> DataFrame:
    """F1, recall and precision of the dissatisfied class; one partial aggregate."""
    alert = F.col(score) < threshold
    bad = F.col(target) == 0
    counts = frame.groupBy(*keys).agg(
        F.count_if(alert & bad).alias("hits"),
        F.count_if(alert).alias("alerts"),
        F.count_if(bad).alias("bad"),
    )
    hits, alerts, actual = F.col("hits"), F.col("alerts"), F.col("bad")
    return counts.select(
        *keys,
        _f1(hits, alerts, actual).alias("f1_cls0"),
        ratio(hits, actual).alias("rec_cls0"),
        ratio(hits, alerts).alias("pre_cls0"),
    )


def metrics_by_split(
    frame: DataFrame, splits: Sequence[str] = ("val", "backtest", "live"), **options
) -> DataFrame:
    wanted = frame.where(F.col(C.SPLIT).isin(*splits))
    return technical_metrics(wanted, [C.SPLIT], **options)


def monthly_backtest(frame: DataFrame, calendar: C.SplitCalendar, **options) -> DataFrame:
    """Out-of-time metrics of a frozen score, one row per backtest or live month."""
    months = [*calendar.backtest, *calendar.live]
    wanted = frame.where(F.col(C.MONTH).isin(*months))
    return technical_metrics(wanted, [C.MONTH], **options).withColumnRenamed(C.MONTH, "month")


def stability_band(monthly: DataFrame, band: float = C.DRIFT_BAND) -> DataFrame:
    """Change of each month's metrics against the first month with a known value and the previous month.

    A month with one class has no AUC: its changes are null and it raises no alarm. The window runs over report
    rows, one per month.
    """
    order = Window.orderBy("month")
    first = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    change = F.col("roc_auc") - F.first("roc_auc", ignorenulls=True).over(first)
    added = {
        f"delta_{m}": half_even(F.col(m) - F.first(m, ignorenulls=True).over(first), 4)
        for m in ("roc_auc", "gini", "f1")
    }
    return monthly.select(
        "month",
        "roc_auc",
        "gini",
        "f1",
        *[e.alias(name) for name, e in added.items()],
        half_even(F.col("roc_auc") - F.lag("roc_auc").over(order), 4).alias("delta_previo"),
        F.coalesce(F.abs(half_even(change, 4)) > band, F.lit(False)).cast("int").alias("alarma"),
    )


def business_metrics(frame: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    score, paid, delay = F.col(C.SCORE), F.col("payment_value"), F.col("delivery_delay_days")
    unhappy = score <= C.SATISFIED_FROM - 1
    at_risk = F.coalesce(F.sum(F.when(unhappy, paid)), F.lit(0.0))
    revenue = F.coalesce(F.sum(paid), F.lit(0.0))
    return frame.groupBy(*keys).agg(
        F.count("*").alias("n"),
        half_even(F.avg((score >= C.SATISFIED_FROM).cast("int")) * 100, 2).alias(
            "satisfied_customer_rate_pct"
        ),
        half_even(F.avg(unhappy.cast("int")) * 100, 2).alias("unsatisfied_customer_rate_pct"),
        half_even(F.avg(score), 3).alias("average_review_score"),
        half_even(F.avg("delivered_on_time") * 100, 2).alias("on_time_delivery_rate_pct"),
        half_even(F.coalesce(F.avg(F.when(delay > 0, delay)), F.lit(0.0)), 2).alias(
            "average_delay_days_when_late"
        ),
        half_even(at_risk, 2).alias("revenue_at_risk_brl"),
        half_even(ratio(at_risk, revenue) * 100, 2).alias("revenue_at_risk_pct"),
        half_even(F.avg(paid), 2).alias("average_order_value_brl"),
    )


def alert_metrics(
    frame: DataFrame,
    keys: Sequence[str] = (),
    score: str = PROBA,
    target: str = C.TARGET,
    threshold: float = 0.5,
) -> DataFrame:
    """Use of the model: dissatisfied orders that an alert would have caught."""
    bad = F.col(target) == 0
    caught = bad & (F.col(score) < threshold)
    return frame.groupBy(*keys).agg(
        F.count_if(caught).alias("insatisfechos_detectados"),
        F.count_if(bad).alias("insatisfechos_totales"),
        half_even(ratio(F.count_if(caught), F.count_if(bad)) * 100, 2).alias(
            "deteccion_insatisfechos_pct"
        ),
        half_even(
            F.coalesce(F.sum(F.when(caught, F.col("payment_value"))), F.lit(0.0)), 2
        ).alias("revenue_en_riesgo_detectado_brl"),
    )


def confusion_matrix(
    frame: DataFrame, score: str = PROBA, target: str = C.TARGET, threshold: float = 0.5
) -> DataFrame:
    """Labelled 2x2 counts; cells without rows stay 0."""
    chosen, good = F.col(score) >= threshold, F.col(target) == 1

    def line(label: str, actual: Column) -> Column:
        return F.struct(
            F.lit(label).alias("real"),
            F.count_if(actual & ~chosen).alias("pred_insatisfecho"),
            F.count_if(actual & chosen).alias("pred_satisfecho"),
        )

    lines = F.array(line("insatisfecho", ~good), line("satisfecho", good))
    return frame.agg(F.explode(lines).alias("line")).select("line.*")


def _tied_bad(rows: DataFrame, cut: dict[int, Column], open_cuts: dict[int, Column]) -> DataFrame:
    """Per ``_key`` and percent in ``open_cuts``: bad rows among the first ``room`` at the cut score, by id."""
    hits = F.array_compact(
        F.array(
            *[
                F.when((F.col("_order") == cut[p]) & room.isNotNull(), F.struct(F.lit(p).alias("top_pct"), room.alias("room")))
                for p, room in open_cuts.items()
            ]
        )
    )
    weighted = (
        rows.select("_key", "_id", "_bad", F.explode(hits).alias("hit"))
        .groupBy("_key", "hit.top_pct", "hit.room", "_id", "_bad")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(weighted, ["_key", "top_pct"], [F.col("_id"), F.col("_bad").desc()], ["n"])
    inside = F.least(F.col("n"), F.greatest(F.col("room") - F.col("n_before"), F.lit(0)))
    return ranked.groupBy("_key", "top_pct").agg(F.sum(inside * F.col("_bad")).alias("bad"))


def lift_table(
    frame: DataFrame,
    percents: Sequence[int] = C.LIFT_PERCENTS,
    keys: Sequence[str] = (),
    score: str = PROBA,
    target: str = C.TARGET,
    row_id: str = "order_id",
) -> DataFrame:
    """Capture, precision and lift of the riskiest x %, ties in risk by row id.

    The score at which a share ends is selected by closing intervals, and rows are counted above and at it: no row
    is ranked, sorted or stored. Ids decide only where a share ends among equal scores with both labels; these rows
    alone are ordered, equal ones as one weighted row. A row without a score comes last, one that is no number first.
    The result is a report: the driver holds a few numbers per key, so keys are splits, months and the like.
    """
    spark = frame.sparkSession
    order = F.col(score) - 1.0
    rows = frame.select(
        *keys,
        F.when(order.isNull(), LARGEST)
        .when(F.isnan(order), -LARGEST)
        .otherwise(F.least(F.greatest(order, F.lit(-LARGEST)), F.lit(LARGEST)) + F.lit(0.0))
        .alias("_order"),
        F.col(row_id).alias("_id"),
        (1 - F.col(target)).cast("long").alias("_bad"),
    )
    sizes = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_bad").alias("bad"), grid_of("_order").alias("grid")
    ).collect()
    sizes = [r for r in sizes if r.n]

    def of_key(row) -> Column:
        match = F.lit(True)
        for key in keys:
            match = match & F.col(key).eqNullSafe(F.lit(row[key]))
        return match

    def by_key(values: list) -> Column:
        return F.coalesce(F.lit(None), *[F.when(of_key(r), F.lit(v)) for r, v in zip(sizes, values)])

    contacted = [{p: max(round(r.n * p / 100.0), 1) for p in percents} for r in sizes]
    places = {f"key {i}": {min(k, sizes[i].n) - 1 for k in own.values()} for i, own in enumerate(contacted)}
    proposed = {f"key {i}": proposed_values(places[f"key {i}"], r.n, r.grid) for i, r in enumerate(sizes)}
    value = values_at(
        rows.select(*[F.when(of_key(r), F.col("_order")).alias(f"key {i}") for i, r in enumerate(sizes)]), places, proposed
    ) if sizes else {}
    cut = {
        p: by_key([value[f"key {i}", min(own[p], sizes[i].n) - 1] for i, own in enumerate(contacted)]) for p in percents
    }
    parts = []
    for p in percents:
        above, at = F.col("_order") < cut[p], F.col("_order") == cut[p]
        parts += [F.count_if(above).alias(f"above_{p}"), F.count_if(above & (F.col("_bad") == 1)).alias(f"bad_{p}"),
                  F.count_if(at).alias(f"tied_{p}"), F.count_if(at & (F.col("_bad") == 1)).alias(f"tied_bad_{p}")]
    counted = {tuple(r[k] for k in keys): r for r in (rows.groupBy(*keys).agg(*parts).collect() if sizes else [])}

    caught, rooms = [], {p: [None] * len(sizes) for p in percents}
    for i, r in enumerate(sizes):
        own = counted[tuple(r[k] for k in keys)]
        for p in percents:
            room = min(contacted[i][p], r.n) - own[f"above_{p}"]
            tied, bad = own[f"tied_{p}"], own[f"tied_bad_{p}"]
            inside = min(bad, room) if bad in (0, tied) or room == tied else None
            if inside is None:
                rooms[p][i] = room
            caught.append([i, p, contacted[i][p], own[f"bad_{p}"], inside])
    if any(line[4] is None for line in caught):
        open_cuts = {p: by_key(own) for p, own in rooms.items() if any(x is not None for x in own)}
        numbered = rows.withColumn("_key", by_key(list(range(len(sizes)))))
        found = {(r["_key"], r.top_pct): r.bad for r in _tied_bad(numbered, cut, open_cuts).collect()}
        caught = [[*line[:4], found[line[0], line[1]] if line[4] is None else line[4]] for line in caught]

    report = "n_total bigint, bad_total bigint, top_pct int, contactados bigint, insatisfechos_capturados bigint"
    schema = StructType([frame.schema[k] for k in keys] + StructType.fromDDL(report).fields)
    lines = [
        (*[sizes[i][k] for k in keys], sizes[i].n, sizes[i].bad, p, k, above + inside)
        for i, p, k, above, inside in caught
    ]
    captured, k = F.col("insatisfechos_capturados"), F.col("contactados")
    base = F.col("bad_total") / F.greatest(F.col("n_total"), F.lit(1))
    return (
        spark.createDataFrame(lines, schema)
        .select(
            *keys,
            "top_pct",
            "contactados",
            "insatisfechos_capturados",
            half_even(captured / F.greatest(F.col("bad_total"), F.lit(1)) * 100, 1).alias(
                "captura_pct"
            ),
            half_even(captured / k * 100, 1).alias("precision_pct"),
            half_even(captured / k / F.greatest(base, F.lit(1e-9)), 2).alias("lift"),
        )
    )


def scored_summary(scored: DataFrame) -> DataFrame:
    """Share predicted satisfied and number of alerts among newly scored orders."""
    return scored.agg(
        F.count("*").alias("n"),
        half_even(F.avg(PREDICTION) * 100, 1).alias("predichos_satisfechos_pct"),
        F.count_if(F.col(PREDICTION) == 0).alias("pedidos_en_riesgo"),
    )
