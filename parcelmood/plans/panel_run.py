"""The panel flow: search, stability-penalised choice, stacking, importance audit."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from parcelmood import config as C
from parcelmood.functions.scalars import half_even
from parcelmood.operators import comparison, importance, metrics, modeling, panel
from parcelmood.operators.cleaning import OrderCleaner
from parcelmood.operators.ensembles import StackedModel, load_model
from parcelmood.operators.features import build_features, panel_features, varying_columns
from parcelmood.operators.split import assign_split, rows_of_split
from parcelmood.session import configure
from parcelmood.sources import storage


def panel_parts(
    master: DataFrame, calendar: C.SplitCalendar, keep: Sequence[str] = ()
) -> tuple[DataFrame, list[str], Model]:
    """Clean features with interactions, stored once, the varying candidates, and the cleaner.

    The added columns are made before cleaning, so they keep their outliers and
    gaps; the models' own imputation fills the gaps. With ``keep``, these columns, target, split and the candidates
    alone are stored.
    """
    frame = assign_split(panel_features(build_features(master)), calendar)
    if keep:
        wanted = {*keep, C.TARGET, C.SPLIT, *C.PANEL_CANDIDATES}
        frame = frame.select(*[c for c in frame.columns if c in wanted])
    stored = storage.store_table(frame, "panel", [C.SPLIT])
    cleaner = OrderCleaner().fit(rows_of_split(stored, "train"))
    cleaned = storage.store_table(cleaner.transform(stored), "panel-clean", [C.SPLIT])
    return cleaned, varying_columns(cleaned), cleaner


def panel_frame(
    master: DataFrame, calendar: C.SplitCalendar, keep: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    return panel_parts(master, calendar, keep)[:2]


def artifact(cleaner: Model | None, model: Model) -> PipelineModel:
    """Cleaner and model as one, so that it scores features as they were built."""
    own = model.stages if isinstance(model, PipelineModel) else [model]
    return PipelineModel([*([] if cleaner is None else [cleaner]), *own])


def store_reports(reports: dict[str, DataFrame], directory: str) -> None:
    """Every report under its name: flat ones as CSV, those with nested columns as JSON."""
    for name, report in reports.items():
        nested = any(isinstance(f.dataType, (ArrayType, MapType, StructType)) for f in report.schema.fields)
        (storage.save_json if nested else storage.save_report)(report, f"{directory}/reports/{name}")


def tagged_scores(model, frame: DataFrame) -> DataFrame:
    """Val and backtest rows with the model's probability."""
    return modeling.predict_probability(model, rows_of_split(frame, "val", "backtest"))


def model_row(
    name: str, scored: DataFrame, cv: DataFrame | None = None, params: dict | None = None
) -> DataFrame:
    """Comparison row of one model from its val and backtest scores."""
    found = metrics.full_metrics(scored, [C.SPLIT])
    def of(split, column):
        return F.max(F.when(F.col(C.SPLIT) == split, F.col(column)))

    row = found.agg(
        F.lit(name).alias("modelo"),
        of("val", "f1_cls0").alias("f1_cls0_val"),
        of("backtest", "f1_cls0").alias("f1_cls0_backtest"),
        half_even(of("val", "auc_roc"), 4).alias("auc_val"),
        half_even(of("val", "gini"), 4).alias("gini_val"),
        half_even(of("val", "brier"), 4).alias("brier_val"),
        half_even(of("val", "rec_cls0"), 4).alias("recall_cls0_val"),
        half_even(of("val", "pre_cls0"), 4).alias("prec_cls0_val"),
        F.lit(json.dumps(params or {})).alias("best_params"),
    )
    scored_row = comparison.stability_score(row)
    return scored_row if cv is None else scored_row.join(cv, "modelo", "left")


def process_model(
    name: str,
    frame: DataFrame,
    variables: Sequence[str],
    row_id: Sequence[str],
    trials: int,
    directory: str,
) -> None:
    """Search, cross-validate, refit on all training rows, store the results.

    Boosting stops early on val in the search and in the refit; folds have no rows to stop on.
    """
    train, val = rows_of_split(frame, "train"), rows_of_split(frame, "val")
    history, best = panel.hyper_search(name, train, val, variables, row_id, trials)
    folded = panel.fold_frame(train, row_id, variables)
    oof = panel.out_of_fold(name, folded, variables, row_id, best)
    storage.save_model_results(oof, f"{directory}/oof")
    oof = frame.sparkSession.read.parquet(f"{directory}/oof").where(F.col("modelo") == name)
    model = panel.fit_member(name, train, variables, row_id, best, stop_on=val)
    model.write().overwrite().save(f"{directory}/models/{name}")
    scored = tagged_scores(model, frame)
    kept = scored.where(F.col(C.SPLIT) == "val").select(
        *row_id, C.TARGET, "proba", F.lit(name).alias("modelo")
    )
    storage.save_model_results(kept, f"{directory}/val")
    storage.save_model_results(history, f"{directory}/trials")
    cv = comparison.cv_summary(panel.cv_scores(oof))
    # the comparison row comes last: it marks the model as finished
    storage.save_model_results(model_row(name, scored, cv, best), f"{directory}/comparison")


def process_pending(
    frame: DataFrame,
    variables: Sequence[str],
    directory: str,
    row_id: Sequence[str],
    models: Sequence[str] = panel.PANEL,
    trials: int = C.SEARCH_TRIALS,
) -> list[str]:
    """Process the models without a stored comparison row; returns the names of those that are done now.

    A model that fails is recorded under ``failures`` with its error, and the others go on; a rerun tries it again.
    """
    spark = frame.sparkSession
    wanted = spark.createDataFrame([(m,) for m in models], "modelo string")
    done = f"{directory}/comparison"
    pending = wanted
    if storage.path_exists(spark, done):
        pending = storage.pending_models(wanted, spark.read.parquet(done))
    left = {row.modelo for row in pending.collect()}
    names = [m for m in models if m in left]
    finished = []
    for name in names:
        try:
            process_model(name, frame, variables, row_id, trials, directory)
            finished.append(name)
        except Exception as failure:  # noqa: BLE001 - whatever a learner raises is recorded
            record = [(name, type(failure).__name__, str(failure))]
            failed = spark.createDataFrame(record, "modelo string, error string, mensaje string")
            storage.save_model_results(failed, f"{directory}/failures")
    return finished


def run_panel(
    spark: SparkSession,
    master: DataFrame,
    directory: str,
    row_id: Sequence[str],
    calendar: C.SplitCalendar = C.DEFAULT_CALENDAR,
    models: Sequence[str] = panel.PANEL,
    trials: int = C.SEARCH_TRIALS,
    repeats: int = C.PERMUTATION_REPEATS,
) -> dict[str, DataFrame]:
    """Whole panel; models with a stored comparison row are skipped on a rerun."""
    configure(spark)
    frame, variables, cleaner = panel_parts(master, calendar)
    process_pending(frame, variables, directory, row_id, models, trials)
    return finish_panel(frame, variables, directory, row_id, calendar, models, repeats, cleaner)


def finish_panel(
    frame: DataFrame,
    variables: Sequence[str],
    directory: str,
    row_id: Sequence[str],
    calendar: C.SplitCalendar = C.DEFAULT_CALENDAR,
    models: Sequence[str] = panel.PANEL,
    repeats: int = C.PERMUTATION_REPEATS,
    cleaner: Model | None = None,
) -> dict[str, DataFrame]:
    """Stack the stored models, choose the winner, audit its importances, save both models and all reports.

    The stored artifacts begin with ``cleaner``. Models without a comparison row take no part and are reported with
    their errors.
    """
    spark = frame.sparkSession
    wanted = spark.createDataFrame([(m,) for m in models], "modelo string")
    table = spark.read.parquet(f"{directory}/comparison").join(wanted, "modelo", "left_semi")
    done = {r.modelo for r in table.select("modelo").collect()}
    if not done:
        raise RuntimeError(f"no model of the panel is finished in {directory}")
    names = [m for m in models if m in done]
    train, val = rows_of_split(frame, "train"), rows_of_split(frame, "val")
    oof, val_scores = (spark.read.parquet(f"{directory}/{part}") for part in ("oof", "val"))
    judge, stacked = panel.stack(oof, val_scores, names, row_id)
    members = {name: load_model(spark, f"{directory}/models/{name}") for name in names}
    ensemble = metrics.full_metrics(stacked).select(
        F.lit(comparison.ENSEMBLE).alias("modelo"),
        half_even(F.col("f1_cls0"), 4).alias("f1_cls0_val"),
        half_even(F.col("f1_cls0"), 4).alias("score_estabilidad"),
        F.lit("—").alias("estable"),
        half_even(F.col("auc_roc"), 4).alias("auc_val"),
        half_even(F.col("gini"), 4).alias("gini_val"),
        half_even(F.col("brier"), 4).alias("brier_val"),
        half_even(F.col("rec_cls0"), 4).alias("recall_cls0_val"),
        half_even(F.col("pre_cls0"), 4).alias("prec_cls0_val"),
        F.lit("{}").alias("best_params"),
    )
    compared = comparison.append_rows(table, ensemble)
    winner = comparison.best_model(table).first()
    params = json.loads(winner.best_params)

    def fit(chosen):
        return panel.fit_member(winner.modelo, train, chosen, row_id, params, stop_on=val)

    model = members[winner.modelo]
    shares = storage.store_table(
        importance.permutation_importance(model, val, variables, row_id, repeats), "importance"
    )
    audit = comparison.audit_cap(shares)
    final = list(variables)
    reports = {"model_comparison": compared, "importance": shares, "audit": audit}
    if not audit.first().cumple:
        final, reduced, steps = importance.mitigate(fit, val, variables, row_id, repeats=repeats)
        reports |= {"importance_mitigated": reduced, "mitigation_steps": steps}
        model = fit(final)
    tested = modeling.predict_probability(model, rows_of_split(frame, "backtest"))
    reports["backtest_metrics"] = metrics.full_metrics(tested)
    reports["lift_live"] = metrics.lift_table(
        modeling.predict_probability(model, rows_of_split(frame, "live"))
    )
    if storage.path_exists(spark, f"{directory}/failures"):
        failures = spark.read.parquet(f"{directory}/failures").join(wanted, "modelo", "left_semi")
        reports["failures"] = failures.join(table.select("modelo"), "modelo", "left_anti")
    store_reports(reports, directory)

    def save(chosen: Model, used: Sequence[str], name: str) -> None:
        modeling.save_scorer(artifact(cleaner, chosen), spark, f"{directory}/models", used, calendar, name)

    save(model, final, f"satisfaction_final_{winner.modelo}")
    save(StackedModel(members, judge), variables, "satisfaction_ensemble")
    document = storage.run_document(
        reports["backtest_metrics"],
        calendar,
        {"modelo_ganador": winner.modelo, "hiperparametros": winner.best_params, "variables": final},
    )
    storage.save_json(document, f"{directory}/reports/metrics")
    return reports
