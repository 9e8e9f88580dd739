"""Model operators: properties that hold for any learner."""

import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.checks.base import master_of, stored_features
from parcelmood.operators import ensembles, importance, modeling, panel
from parcelmood.operators.preprocess import FEATURES, design_of, preprocessor
from parcelmood.operators.split import rows_of_split
from parcelmood.plans.panel_run import panel_frame
from parcelmood.sources.fixture import FIXTURE_CALENDAR

ROW = ["order_id", "review_id"]


def logistic():
    return LogisticRegression(
        labelCol=C.TARGET, featuresCol=FEATURES, weightCol=modeling.WEIGHT, maxIter=20
    )


@pytest.fixture(scope="module")
def frame(spark, small):
    return stored_features(spark, small).persist()


@pytest.fixture(scope="module")
def panel_data(spark, small):
    master = master_of(spark, small, review_columns=["review_id"])
    found, variables = panel_frame(master, FIXTURE_CALENDAR)
    return found.persist(), variables


def test_unseen_category_is_all_zeros(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)] * 50, "payment_type string")
    stages = design_of(preprocessor(["payment_type"]), train)
    later = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "payment_type string")
    vectors = [r[FEATURES].toArray().tolist() for r in stages.transform(later).collect()]
    assert vectors == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_saved_scorer_scores_alike(spark, frame, tmp_path):
    variables = [*C.NUMERIC, "is_late", "payment_type"]
    model = modeling.fit_scorer(rows_of_split(frame, "train"), variables, logistic())
    path = modeling.save_scorer(model, spark, str(tmp_path), variables, FIXTURE_CALENDAR)
    assert path.endswith(f"_v{C.VERSION}")
    loaded, metadata = modeling.load_scorer(spark, path)
    assert metadata.first().n_features == len(variables)
    val = rows_of_split(frame, "val")
    before = {r.review_id: r.proba_satisfecho for r in modeling.score_new_data(model, val).collect()}
    after = {r.review_id: r.proba_satisfecho for r in modeling.score_new_data(loaded, val).collect()}
    assert before == after and all(0 <= p <= 1 for p in before.values())


def test_draws_are_seeded_and_conditional():
    first = [panel.draw("elastic_net", random.Random(7)) for _ in range(2)]
    assert first[0] == first[1]
    rng = random.Random(1)
    for _ in range(50):
        point = panel.draw("elastic_net", rng)
        assert ("l1_ratio" in point) == (point["penalty"] == "elasticnet")
        assert 1e-5 <= point["alpha"] <= 1e-1
    for name in panel.PANEL:
        assert panel.build_classifier(name, panel.draw(name, rng), 100) is not None
    with pytest.raises(ValueError):
        panel.build_classifier("unknown")


def test_out_of_fold_covers_each_row_once(panel_data):
    frame, variables = panel_data
    train = rows_of_split(frame, "train")
    folded = panel.fold_frame(train, ROW)
    oof = panel.out_of_fold("logistic", folded, variables, ROW, folds=3)
    ids = [tuple(r) for r in oof.select(*ROW).collect()]
    assert len(ids) == len(set(ids)) == train.count()
    scores = panel.cv_scores(oof).collect()
    assert len(scores) == 3 and all(0 <= r.score <= 1 for r in scores)


def test_permuted_variants_keep_each_column(spark):
    rows = [(i, i + 100, float(i), float(-i), i % 2) for i in range(40)]
    frame = spark.createDataFrame(rows, "order_id int, review_id int, a double, b double, is_satisfied int")
    found = importance.permuted_variants(frame, ["a", "b"], ROW, repeats=3).collect()
    assert len(found) == 40 * (1 + 2 * 3)
    for repeat in range(3):
        part = [r for r in found if r.variant == "a" and r["repeat"] == repeat]
        assert sorted(r.a for r in part) == sorted(float(i) for i in range(40))
        assert all(r.a != -r.b for r in part)
        assert all(r.is_satisfied == int(-r.b) % 2 for r in part)


def test_irrelevant_variable_has_no_importance(spark):
    rng = random.Random(5)
    rows = [(i, i, x := rng.gauss(0, 1), rng.gauss(0, 1), int(x + rng.gauss(0, 0.3) > 0))
            for i in range(400)]
    frame = spark.createDataFrame(rows, "order_id int, review_id int, total_price double, payment_value double, is_satisfied int")
    variables = ["total_price", "payment_value"]
    model = panel.fit_candidate("logistic", frame, variables)
    shares = {r.variable: r.importancia_pct for r in
              importance.permutation_importance(model, frame, variables, ROW).collect()}
    assert shares["total_price"] > 90


def test_mean_of_calibrated_folds_is_a_probability(panel_data):
    frame, variables = panel_data
    folded = panel.fold_frame(rows_of_split(frame, "train"), ROW)
    models = panel.fold_models("linear_svm", folded, variables)
    for method in ("sigmoid", "isotonic"):
        scored = panel.calibrated(models, folded, rows_of_split(frame, "val"), method)
        low, high = scored.agg(F.min("proba"), F.max("proba")).first()
        assert 0 <= low < high <= 1


@pytest.mark.parametrize("method", ["sigmoid", "isotonic"])
def test_calibrated_and_stacked_models_survive_storage(spark, tmp_path, method):
    rng = random.Random(5)
    rows = [(i, i % 3, i % 2, Vectors.dense(i % 2 + rng.gauss(0, 1), rng.random())) for i in range(300)]
    folded = spark.createDataFrame(rows, ["id", "fold", C.TARGET, FEATURES]).coalesce(2).persist()
    learner = LogisticRegression(labelCol=C.TARGET, featuresCol=FEATURES, maxIter=10)
    members = [learner.fit(folded.where(F.col("fold") != i)) for i in range(3)]
    model = ensembles.calibrate(members, folded, method)
    judge = Pipeline(stages=[
        VectorAssembler(inputCols=["a", "b"], outputCol="both"),
        LogisticRegression(labelCol=C.TARGET, featuresCol="both", maxIter=10),
    ])
    pair = {"a": model, "b": members[0]}
    given = folded
    for name, member in pair.items():
        given = modeling.predict_probability(member, given, name)
    whole = PipelineModel([ensembles.StackedModel(pair, judge.fit(given))])
    whole.write().overwrite().save(str(tmp_path / method))
    again = ensembles.load_model(spark, str(tmp_path / method))
    assert isinstance(again.stages[0].members["a"], ensembles.CalibratedModel)
    before, after = (
        {r.id: r.proba for r in modeling.predict_probability(m, folded).collect()} for m in (whole, again)
    )
    assert before == pytest.approx(after) and 0 <= min(after.values()) < max(after.values()) <= 1


def test_one_review_of_two_orders_stays_two_rows(spark):
    rows = [(o, 7 if o < 2 else 10 + o, o % 2, m, 0.1 + 0.8 * (o % 2)) for o in range(8) for m in ("a", "b")]
    long = spark.createDataFrame(rows, "order_id int, review_id int, is_satisfied int, modelo string, proba double")
    _, scored = panel.stack(long, long, ["a", "b"], ROW)
    assert sorted((r.order_id, r.is_satisfied) for r in scored.collect()) == [(o, o % 2) for o in range(8)]


def test_mitigation_audits_what_it_returns(monkeypatch, spark):
    shares = {3: [("a", 90.0), ("b", 6.0), ("c", 4.0)], 2: [("b", 20.0), ("c", 10.0)]}

    def audit(model, frame, names, row_id, repeats):
        return spark.createDataFrame(shares[len(names)], "variable string, importancia_pct double")

    monkeypatch.setattr(importance, "permutation_importance", audit)
    frame = spark.createDataFrame([(1,)], "x int")
    kept, _, steps = importance.mitigate(lambda n: None, frame, ["a", "b", "c"], ROW, cap=0.25, min_variables=1)
    assert kept == ["b", "c"]
    assert [r.outcome for r in steps.orderBy(F.desc("n_vars")).collect()] == ["reduced", "complies"]
    shares[3] = [("a", 0.0), ("b", 0.0), ("c", 0.0)]
    kept, _, steps = importance.mitigate(lambda n: None, frame, ["a", "b", "c"], ROW, cap=0.25)
    assert kept == ["a", "b", "c"] and steps.first().outcome == "no variable matters"
