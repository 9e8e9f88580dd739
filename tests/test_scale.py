"""What keeps jobs small as tables grow: one star join, stored clean rows, few partitions for forests."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.checks import all_queries, base
from parcelmood.checks.stats import clean_splits
from parcelmood.functions.histograms import ranked_histogram, value_histogram
from parcelmood.operators import forests, modeling, panel, strength
from parcelmood.operators.preprocess import FEATURES


class _Watched:
    """A learner that only looks at its input."""

    def fit(self, frame):
        self.columns, self.partitions = frame.columns, frame.rdd.getNumPartitions()
        return self


def test_learner_gets_vectors_in_no_more_partitions_than_cores_can_use(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(rng.random(), rng.random(), f"comment {i}", i % 2) for i in range(200)]
    frame = spark.createDataFrame(rows, "total_price double, payment_value double, review_comment_message string, is_satisfied int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        learner = _Watched()
        modeling.fit_scorer(frame, ["total_price", "payment_value"], learner)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert set(learner.columns) == {FEATURES, C.TARGET, modeling.WEIGHT}
    assert learner.partitions <= modeling.WAVES * spark.sparkContext.defaultParallelism


def test_forests_do_not_walk_down_every_tree_at_every_level():
    forests = [modeling.baseline_classifier(), modeling.evaluation_classifier()]
    forests += [panel.build_classifier(name) for name in ("random_forest", "rf_no_bootstrap")]
    assert all(f.getCacheNodeIds() and f.getMaxMemoryInMB() <= 512 for f in forests)


def test_linear_learners_keep_one_copy_of_their_rows(spark, monkeypatch):
    learner, kept = _Watched(), []
    learner.fit = lambda frame: kept.append(frame.storageLevel.useMemory) or learner
    monkeypatch.setattr(panel, "build_classifier", lambda *given: learner)
    frame = spark.createDataFrame([(float(i), i % 2) for i in range(40)], "total_price double, is_satisfied int")
    panel.fit_candidate("logistic", frame, ["total_price"])
    panel.fit_candidate("random_forest", frame, ["total_price"])
    assert kept == [False, True]


def test_gini_of_ranks_is_the_gini_of_values(spark):
    rng = random.Random(2)
    rows = [(float(rng.randrange(9)), rng.random(), 1.0, rng.randrange(2)) for _ in range(300)]
    values = value_histogram(spark.createDataFrame(rows, "a double, b double, c double, y int"), ["a", "b", "c"], "y")
    found, wanted = (
        {r.feature: r.gini for r in g.collect()}
        for g in (strength.ranked_gini(ranked_histogram(values)), strength.univariate_gini(values))
    )
    assert found == pytest.approx(wanted) and found["c"] == 0.0


def test_clean_rows_are_stored_for_the_statistics(spark, small):
    train, val = clean_splits(spark, small)
    assert all("/clean-" in path for path in train.inputFiles())
    stored = base.stored_features(spark, small, ["train"], C.NUMERIC)
    assert stored.columns == [*C.NUMERIC, C.SPLIT]
    assert [r[0] for r in stored.select(C.SPLIT).distinct().collect()] == ["train"]
    whole = base.features_of(spark, small).where(F.col(C.SPLIT) == "train")
    assert stored.count() == whole.count() == train.count()


def test_stream_joins_the_star_once(spark, small, monkeypatch):
    built, build = [], base.build_master
    monkeypatch.setattr(base, "build_master", lambda *a, **k: built.append(1) or build(*a, **k))
    same = all_queries()[0]["monthly_stream_scoring_check"](spark, small)
    assert built == [1]
    assert same.where(~F.col("igual") | ~F.col("proba_valida")).count() == 0


def test_folds_are_stored_and_prepared_once_for_all_models(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, i + 500, x := rng.gauss(0, 1), rng.choice("ab"), "unused", int(x + rng.gauss(0, 1) > 0)) for i in range(120)]
    train = spark.createDataFrame(
        rows, "order_id int, review_id int, total_price double, payment_type string, other string, is_satisfied int"
    )
    variables, row_id, names = ["total_price", "payment_type"], ["order_id", "review_id"], ["logistic", "elastic_net"]
    folded = panel.fold_frame(train, row_id, variables)
    assert all("/folds-" in path for path in folded.inputFiles()) and "other" not in folded.columns
    assert sorted(map(tuple, folded.select(*row_id, "fold").collect())) == sorted(
        map(tuple, panel.stratified_folds(train, row_id).select(*row_id, "fold").collect())
    )
    learned, learn = [], panel.design_of
    monkeypatch.setattr(panel, "design_of", lambda *given: learned.append(1) or learn(*given))
    both = panel.out_of_folds(names, folded, variables, row_id)
    assert len(learned) == 3
    found = {(r.order_id, r.review_id, r.fold, r.is_satisfied, r.modelo): r.proba for r in both.collect()}
    assert len(found) == 240
    wanted = {}
    for name in names:
        for i in range(3):
            model = panel.fit_candidate(name, folded.where(F.col("fold") != i), variables)
            for r in modeling.predict_probability(model, folded.where(F.col("fold") == i)).collect():
                wanted[r.order_id, r.review_id, r.fold, r.is_satisfied, name] = r.proba
    assert found == pytest.approx(wanted, abs=1e-6)


def _vectors(spark, rows=400):
    rng = random.Random(4)
    points = [(Vectors.dense(x := rng.gauss(0, 1), rng.gauss(0, 1)), int(x + rng.gauss(0, 1) > 0), 1.0) for _ in range(rows)]
    return spark.createDataFrame(points, [FEATURES, C.TARGET, modeling.WEIGHT]).persist()


def test_large_forests_grow_all_their_trees_in_groups(spark, monkeypatch):
    grown, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, frame: grown.append(self.getNumTrees()) or fit(self, frame))
    monkeypatch.setattr(forests, "WHOLE", 400 * 100)
    monkeypatch.setattr(forests, "GROUP", 50)
    ready = _vectors(spark)
    params = {"n_estimators": 120, "max_depth": 3}
    model = panel.fit_prepared("random_forest", ready, params)
    assert sorted(grown) == [20, 50, 50] and model.getNumTrees == 120
    grown.clear()
    assert panel.fit_prepared("random_forest", ready, {**params, "n_estimators": 100}).getNumTrees == 100
    assert grown == [100]


def test_groups_vote_as_one_forest_and_survive_storage(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(forests, "WHOLE", 0)
    monkeypatch.setattr(forests, "GROUP", 4)
    ready = _vectors(spark)
    learner = panel.build_classifier("random_forest", {"n_estimators": 10, "max_depth": 3})
    model = forests.fit_learner(learner, ready)
    trees = [tree for member in model.members for tree in member.trees]
    assert len(trees) == 10 and len({tree.toDebugString.split("\n", 1)[1] for tree in trees}) > 4
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "forest"))
    loaded = PipelineModel.load(str(tmp_path / "forest"))
    points = [r[FEATURES] for r in ready.limit(20).collect()]
    some = spark.createDataFrame([(i, v) for i, v in enumerate(points)], ["id", FEATURES])
    for scorer in (model, loaded):
        for row in scorer.transform(some).collect():
            mean = sum(tree.predictProbability(row[FEATURES])[1] for tree in trees) / 10
            assert row.probability[1] == pytest.approx(mean) and sum(row.rawPrediction) == pytest.approx(10)
            assert row.prediction == float(row.probability[1] > row.probability[0])
