"""Storage, streaming and whole flows on the smallest tables."""

import json

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.checks import all_queries
from parcelmood.checks.base import master_of
from parcelmood.functions.scalars import half_even
from parcelmood.operators import metrics
from parcelmood.operators.features import build_features, panel_features
from parcelmood.operators.modeling import WEIGHT, artifact_path, load_scorer, predict_probability
from parcelmood.operators.preprocess import FEATURES
from parcelmood.operators.split import assign_split, rows_of_split
from parcelmood.plans.baseline_run import run_baseline
from parcelmood.plans.panel_run import finish_panel, panel_parts, process_pending
from parcelmood.sources import storage
from parcelmood.sources.catalog import RAW_FILES, read_raw_tables
from parcelmood.sources.fixture import FIXTURE_CALENDAR, fixture_tables


def test_raw_csv(spark, tmp_path):
    header = {
        "orders": "order_id,customer_id,order_status,order_purchase_timestamp\n"
                  "a,c,delivered,2018-01-02 03:04:05\nb,c,shipped,not a date\n",
        "reviews": "review_id,order_id,review_score,review_comment_message\n"
                   'r,a,5,"two\nlines"\ns,b,bad,""\n',
    }
    for alias, name in RAW_FILES.items():
        text = header.get(alias, "order_id\n")
        (tmp_path / name.replace("*", "any")).write_text(text)
    tables = read_raw_tables(spark, str(tmp_path))
    orders = tables["orders"].orderBy("order_id").collect()
    assert orders[0].order_purchase_timestamp.year == 2018
    assert orders[1].order_purchase_timestamp is None
    reviews = tables["reviews"].orderBy("order_id").collect()
    assert [(r.review_score, r.review_comment_message) for r in reviews] == [
        (5, "two\nlines"), (None, None)]


def test_build_or_reuse(spark, small, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return master_of(spark, small)

    path = str(tmp_path / "master")
    first = storage.build_or_reuse(spark, path, build).count()
    assert storage.build_or_reuse(spark, path, build).count() == first and len(calls) == 1
    storage.build_or_reuse(spark, path, build, rebuild=True)
    assert len(calls) == 2
    month = storage.load_master(spark, path).where(F.col(C.MONTH) == "2000-01")
    assert "PartitionFilters: [isnotnull(purchase_month" in month._jdf.queryExecution().toString()


def test_stream_equals_batch(spark, small):
    rows = all_queries()[0]["monthly_stream_scoring"](spark, small).collect()
    assert rows and all(r.igual for r in rows)


def test_baseline_flow(spark, small, tmp_path):
    classifier = LogisticRegression(
        labelCol=C.TARGET, featuresCol=FEATURES, weightCol=WEIGHT, maxIter=20
    )
    tables = fixture_tables(spark, small)
    bought = tables["orders"].select(F.col("order_id").alias("o"), "order_purchase_timestamp")
    month = F.date_format("order_purchase_timestamp", "yyyy-MM").isin(*FIXTURE_CALENDAR.predict)
    # orders of the unlabeled months have no review yet
    tables["reviews"] = tables["reviews"].join(bought.where(month), F.col("order_id") == F.col("o"), "left_anti")
    done = run_baseline(spark, tables, str(tmp_path), FIXTURE_CALENDAR, classifier=classifier)
    scores = spark.read.parquet(f"{tmp_path}/new_scores")
    assert scores.count() == done.reports["new_scores_summary"].first().n > 0
    assert scores.where("review_score is not null or proba_satisfecho is null").isEmpty()
    selection = done.reports["feature_selection"].collect()
    assert [r.orden for r in selection] == [0, 1, 2, 3, 4]
    assert selection[-1].features == len(done.variables) > 0
    assert storage.path_exists(spark, f"{done.artifact}/model/metadata")
    line = (spark.read.text(f"{tmp_path}/reports/metrics").first()).value
    assert json.loads(line)["features"] == done.variables


def test_panel_flow_resumes(spark, small, tmp_path):
    master = master_of(spark, small, review_columns=["review_id"])
    row, models, path = ["order_id", "review_id"], ["logistic", "no_such_model"], str(tmp_path)
    frame, variables, cleaner = panel_parts(master, FIXTURE_CALENDAR)
    assert process_pending(frame, variables, path, row, models, trials=1) == models[:1]
    assert process_pending(frame, variables, path, row, models, trials=1) == []
    reports = finish_panel(frame, variables, path, row, FIXTURE_CALENDAR, models, 1, cleaner)
    compared = reports["model_comparison"].collect()
    assert {r.modelo for r in compared} == {"logistic", "STACKING"}
    assert [(r.modelo, r.error) for r in reports["failures"].collect()] == [("no_such_model", "ValueError")]
    assert storage.path_exists(spark, f"{path}/trials/modelo=logistic")
    assert reports["backtest_metrics"].first().accuracy > 0
    for name in reports:
        assert storage.path_exists(spark, f"{path}/reports/{name}/_SUCCESS")
    # the stored ensemble scores features as they were built
    raw = assign_split(panel_features(build_features(master)), FIXTURE_CALENDAR)
    ensemble, metadata = load_scorer(spark, artifact_path(f"{path}/models", "satisfaction_ensemble"))
    assert metadata.first().n_features == len(variables)
    scored = predict_probability(ensemble, rows_of_split(raw, "val"))
    found = metrics.full_metrics(scored).select(half_even(F.col("brier"), 4).alias("b")).first().b
    assert found == next(r.brier_val for r in compared if r.modelo == "STACKING")
