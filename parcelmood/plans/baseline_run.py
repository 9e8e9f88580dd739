"""The monthly baseline flow: master, features, checks, cleaning, selection, model, reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.operators import metrics, modeling, strength, target_check
from parcelmood.operators.cleaning import OrderCleaner
from parcelmood.operators.features import build_features, ordinal_target, strict_target
from parcelmood.operators.master import build_master
from parcelmood.operators.split import assign_split, rows_of_split, split_summary
from parcelmood.session import configure
from parcelmood.sources import storage
from parcelmood.streaming.monthly_scoring import score_orders


@dataclass
class BaselineResult:
    model: PipelineModel
    variables: list[str]
    reports: dict[str, DataFrame]
    artifact: str


def feature_frame(master: DataFrame, calendar: C.SplitCalendar) -> DataFrame:
    features = build_features(master).transform(ordinal_target).transform(strict_target)
    return assign_split(features, calendar)


def run_baseline(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    directory: str,
    calendar: C.SplitCalendar = C.DEFAULT_CALENDAR,
    rebuild: bool = False,
    with_ablation: bool = False,
    classifier=None,
) -> BaselineResult:
    """Run every stage and write reports and the versioned model below ``directory``.

    The master is stored by month and reused unless ``rebuild``; the feature
    frame is stored once because several statistics scan it.
    """
    configure(spark)
    reports: dict[str, DataFrame] = {}

    def report(name: str, frame: DataFrame) -> None:
        storage.save_report(frame, f"{directory}/reports/{name}")
        reports[name] = frame

    master = storage.build_or_reuse(
        spark, f"{directory}/master", lambda: build_master(tables), rebuild
    )
    frame = storage.store_table(
        feature_frame(master.drop(C.MONTH), calendar), "features", [C.SPLIT]
    )
    report("split_summary", split_summary(frame))
    report("target_check", target_check.check_target(frame))
    volume = target_check.monthly_volume(frame)
    report("monthly_target_rate", target_check.monthly_target_rate(frame))
    report("monthly_volume", target_check.volume_pivot(volume))

    raw_train = rows_of_split(frame, "train")
    cleaner = OrderCleaner().fit(raw_train)
    cleaned = storage.store_table(cleaner.transform(frame), "clean", [C.SPLIT])
    train, val = rows_of_split(cleaned, "train"), rows_of_split(cleaned, "val")
    report("cleaning", cleaner.report(spark))
    evidence = strength.feature_evidence(train)
    report("feature_evidence", evidence)
    report("family_champions", strength.family_champions(evidence))
    cascade, ranking, variables = modeling.selection_cascade(train, val)
    report("feature_selection", cascade)
    report("information_value", ranking)
    if with_ablation:
        report("ablation", modeling.ablation(train, val, variables))

    fitted = modeling.fit_pipeline(train, variables, classifier)
    model = PipelineModel([cleaner, *fitted.stages])

    # one scoring pass serves all reports below
    scored = storage.store_table(
        modeling.predict_probability(fitted, cleaned.where(F.col(C.SPLIT) != "train")),
        "scored",
        [C.SPLIT],
    )
    judged = rows_of_split(scored, "val", "backtest", "live")
    monthly = metrics.monthly_backtest(scored, calendar)
    report("technical_metrics", metrics.metrics_by_split(scored))
    report("business_metrics", metrics.business_metrics(judged, [C.SPLIT]))
    report("alert_metrics", metrics.alert_metrics(judged, [C.SPLIT]))
    report("lift", metrics.lift_table(rows_of_split(scored, "live")))
    report("monthly_backtest", monthly)
    report("stability_band", metrics.stability_band(monthly))

    # orders of the unlabeled months, most of which wait for their first review
    waiting = build_master(tables, require_review=False).where(
        F.date_format("order_purchase_timestamp", "yyyy-MM").isin(*calendar.predict)
    )
    score_orders(model, waiting).write.mode("overwrite").parquet(f"{directory}/new_scores")
    new_scores = spark.read.parquet(f"{directory}/new_scores")
    report("new_scores_summary", metrics.scored_summary(new_scores))

    artifact = modeling.save_scorer(model, spark, f"{directory}/models", variables, calendar)
    document = storage.run_document(
        reports["technical_metrics"], calendar, {"features": variables}
    )
    storage.save_json(document, f"{directory}/reports/metrics")
    return BaselineResult(model, variables, reports, artifact)
