"""Model panel: classifiers, search spaces, search, folds, stacking, calibration.

Two members have no Spark twin and are re-aimed: extremely randomised trees as a
forest without bootstrap, and three boosting libraries as three presets of
gradient-boosted trees.  Every fit is a distributed Spark ML job.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.operators.comparison import append_rows, probability_matrix
from parcelmood.operators.ensembles import calibrate
from parcelmood.operators.forests import fit_learner
from parcelmood.operators.metrics import class0_metrics
from parcelmood.operators.modeling import FOREST_MEANS, WEIGHT, predict_probability, spread
from parcelmood.operators.preprocess import FEATURES, design_of, typed_preprocessor
from parcelmood.operators.sampling import fixed_sample, stratified_folds, with_class_weight
from parcelmood.sources import storage

PANEL = (
    "logistic",
    "gbt_b",
    "gbt_c",
    "random_forest",
    "rf_no_bootstrap",
    "gbt_a",
    "linear_svm",
    "elastic_net",
)

#: Members without probabilities of their own.
CALIBRATED = ("linear_svm",)

_FOREST_SPACE = {
    "n_estimators": ("int", 150, 350),
    "max_depth": ("int", 2, 14),
    "min_samples_leaf": ("int", 5, 40),
    "max_features": ("choice", "sqrt", "log2"),
}

#: Rows up to which a fit leaves cores idle, and the fits that then run at a time.
FEW_ROWS, FITS_AT_A_TIME = 2**17, 4

# Search spaces (log = log-uniform, real = uniform, int, choice).
SPACES: dict[str, dict[str, tuple]] = {
    "logistic": {"C": ("log", 1e-3, 10.0)},
    "elastic_net": {
        "alpha": ("log", 1e-5, 1e-1),
        "penalty": ("choice", "l2", "l1", "elasticnet"),
        "l1_ratio": ("real", 0.0, 1.0),
    },
    "linear_svm": {"C": ("log", 1e-3, 10.0)},
    "random_forest": _FOREST_SPACE,
    "rf_no_bootstrap": _FOREST_SPACE,
    "gbt_a": {
        "max_iter": ("int", 100, 400),
        "max_depth": ("int", 2, 8),
        "learning_rate": ("log", 5e-3, 0.3),
    },
    "gbt_b": {
        "max_iter": ("int", 200, 500),
        "max_depth": ("int", 2, 12),
        "learning_rate": ("log", 1e-3, 0.3),
        "subsample": ("real", 0.6, 1.0),
    },
    "gbt_c": {
        "max_iter": ("int", 120, 250),
        "max_depth": ("int", 2, 8),
        "learning_rate": ("log", 1e-3, 0.3),
    },
}
# l1_ratio counts only under the mixed penalty
CONDITIONS = {("elastic_net", "l1_ratio"): ("penalty", "elasticnet")}

# Panel defaults.
DEFAULTS: dict[str, dict[str, object]] = {
    "logistic": {"C": 1.0},
    "elastic_net": {"alpha": 1e-4, "penalty": "l2"},
    "linear_svm": {"C": 1.0},
    "random_forest": {"n_estimators": 300, "max_depth": 12, "min_samples_leaf": 20},
    "rf_no_bootstrap": {"n_estimators": 300, "max_depth": 12, "min_samples_leaf": 20},
    "gbt_a": {"max_iter": 300, "max_depth": 5, "learning_rate": 0.08, "min_samples_leaf": 30},
    "gbt_b": {"max_iter": 300, "max_depth": 6, "learning_rate": 0.05, "min_samples_leaf": 20},
    "gbt_c": {"max_iter": 200, "max_depth": 5, "learning_rate": 0.05, "min_samples_leaf": 1},
}


def draw(name: str, rng: random.Random) -> dict[str, object]:
    """One random point of a model's space; conditional values only where they apply."""
    if name not in SPACES:
        raise ValueError(f"unknown model: {name}")
    point: dict[str, object] = {}
    for key, (kind, *bounds) in SPACES[name].items():
        if kind == "log":
            low, high = map(math.log, bounds)
            point[key] = math.exp(rng.uniform(low, high))
        elif kind == "real":
            point[key] = rng.uniform(*bounds)
        elif kind == "int":
            point[key] = rng.randint(*bounds)
        else:
            point[key] = rng.choice(bounds)
    for (model, key), (other, value) in CONDITIONS.items():
        if model == name and point.get(other) != value:
            point.pop(key, None)
    return point


def build_classifier(
    name: str, params: dict | None = None, rows: int = 1, validation: str | None = None
) -> Estimator:
    """Spark estimator of a panel member; ``rows`` turns C into Spark's mean-loss penalty.

    ``validation`` names a boolean column whose rows stop the boosting early.
    """
    if name not in DEFAULTS:
        raise ValueError(f"unknown model: {name}")
    p = {**DEFAULTS[name], **(params or {})}
    common = {"labelCol": C.TARGET, "featuresCol": FEATURES, "weightCol": WEIGHT}
    if name == "logistic":
        return LogisticRegression(
            regParam=1.0 / (p["C"] * rows), maxIter=200, tol=1e-4, **common
        )
    if name == "elastic_net":
        mix = {"l2": 0.0, "l1": 1.0, "elasticnet": p.get("l1_ratio", 0.15)}[p["penalty"]]
        return LogisticRegression(
            regParam=p["alpha"], elasticNetParam=mix, maxIter=200, tol=1e-3, **common
        )
    if name == "linear_svm":
        return LinearSVC(regParam=1.0 / (p["C"] * rows), maxIter=100, tol=1e-4, **common)
    if name in ("random_forest", "rf_no_bootstrap"):
        return RandomForestClassifier(
            numTrees=p["n_estimators"],
            maxDepth=p["max_depth"],
            minInstancesPerNode=p["min_samples_leaf"],
            featureSubsetStrategy=p.get("max_features", "sqrt"),
            bootstrap=name == "random_forest",
            seed=C.SEED,
            **FOREST_MEANS,
            **common,
        )
    boosting = GBTClassifier(
        maxIter=p["max_iter"],
        maxDepth=p["max_depth"],
        stepSize=p["learning_rate"],
        minInstancesPerNode=p["min_samples_leaf"],
        subsamplingRate=p.get("subsample", 1.0),
        maxMemoryInMB=1024,
        seed=C.SEED,
        **common,
    )
    if validation is not None:
        boosting.setValidationIndicatorCol(validation)
    return boosting


def _grows_trees(name: str) -> bool:
    return name.startswith(("gbt", "r"))


def _ready(name: str, frame: DataFrame) -> DataFrame:
    """Tree learners get even partitions; a linear step is too short to gain from it."""
    return spread(frame) if _grows_trees(name) else frame


def prepared(train: DataFrame, variables: Sequence[str]) -> tuple[PipelineModel, DataFrame]:
    """Feature stages learned by type, and the weighted vectors that a learner gets."""
    design = design_of(typed_preprocessor(train, variables), train)
    weighted = with_class_weight(train, name=WEIGHT)
    return design, design.transform(weighted).select(FEATURES, C.TARGET, WEIGHT)


def fit_prepared(
    name: str, ready: DataFrame, params: dict | None = None, validation: str | None = None
) -> Model:
    ready = _ready(name, ready)
    if _grows_trees(name):
        # linear learners keep blocks of their own: a second copy would push them out of memory
        ready.persist()
    rows = ready.count()
    model = fit_learner(build_classifier(name, params, rows, validation), ready, rows)
    ready.unpersist()
    return model


def fit_all(names: Sequence[str], ready: DataFrame, params: dict | None = None) -> list[Model]:
    """``fit_prepared`` of every model on the same stored vectors; several at a time if the rows are few."""
    fit = inheritable_thread_target(ready.sparkSession)(lambda name: fit_prepared(name, ready, params))
    with ThreadPool(FITS_AT_A_TIME if ready.count() <= FEW_ROWS else 1) as pool:
        return pool.map(fit, names, chunksize=1)


def fit_candidate(
    name: str,
    train: DataFrame,
    variables: Sequence[str],
    params: dict | None = None,
    stop_on: DataFrame | None = None,
) -> PipelineModel:
    """Preprocess by type, weight the classes, fit; boosting can stop early on ``stop_on``."""
    design, ready = prepared(train, variables)
    validation = None
    if stop_on is not None and name.startswith("gbt"):
        validation = "is_val"
        held = with_class_weight(stop_on, name=WEIGHT, reference=train)
        ready = ready.withColumn(validation, F.lit(False)).unionByName(
            design.transform(held)
            .select(FEATURES, C.TARGET, WEIGHT)
            .withColumn(validation, F.lit(True))
        )
    return PipelineModel([*design.stages, fit_prepared(name, ready, params, validation)])


def hyper_search(
    name: str,
    train: DataFrame,
    val: DataFrame,
    variables: Sequence[str],
    row_id: Sequence[str],
    trials: int = C.SEARCH_TRIALS,
    sample: int = C.SEARCH_SAMPLE,
    parallelism: int = 2,
) -> tuple[DataFrame, dict]:
    """Seeded random search for F1 of class 0 on val; (trial history, best params).

    The features are prepared once; each trial is a distributed fit on them. Boosting stops early on val; members
    without probabilities are calibrated by folds of the sample.
    """
    spark = train.sparkSession
    subset = fixed_sample(train, sample, row_id)
    design = design_of(typed_preprocessor(train, variables), subset)
    weighted = with_class_weight(subset, name=WEIGHT)
    folds = C.CV_FOLDS if name in CALIBRATED else 0
    if folds:
        weighted = stratified_folds(weighted, row_id)
    columns = [FEATURES, C.TARGET, WEIGHT, *(["fold"] if folds else [])]
    ready = design.transform(weighted).select(*columns)
    rows = subset.count()
    held = design.transform(with_class_weight(val, name=WEIGHT, reference=subset)).select(FEATURES, C.TARGET, WEIGHT)
    validation = "is_val" if name.startswith("gbt") else None
    if validation:
        ready = ready.withColumn(validation, F.lit(False)).unionByName(held.withColumn(validation, F.lit(True)))
    ready, held = _ready(name, ready).persist(), held.persist()
    rng = random.Random(C.SEED)
    points = [draw(name, rng) for _ in range(trials)]

    def attempt(point: dict) -> float:
        learner = build_classifier(name, point, rows, validation)
        if folds:
            model = calibrate([learner.fit(ready.where(F.col("fold") != i)) for i in range(folds)], ready)
        else:
            model = learner.fit(ready)
        return class0_metrics(predict_probability(model, held)).first().f1_cls0

    with ThreadPool(parallelism) as pool:
        scores = pool.map(inheritable_thread_target(spark)(attempt), points)
    ready.unpersist()
    held.unpersist()
    history = spark.createDataFrame(
        [
            (name, i, score, json.dumps(point))
            for i, (score, point) in enumerate(zip(scores, points))
        ],
        "modelo string, trial int, f1_cls0_val double, params string",
    )
    best = max(range(trials), key=lambda i: (scores[i], -i))
    return history, points[best]


def out_of_fold(
    name: str,
    frame: DataFrame,
    variables: Sequence[str],
    row_id: Sequence[str],
    params: dict | None = None,
    folds: int = C.CV_FOLDS,
) -> DataFrame:
    """(row id, fold, target, model, proba): every row scored by a model that never saw it.

    ``frame`` carries a ``fold`` column.
    """
    if name not in CALIBRATED:
        return out_of_folds([name], frame, variables, row_id, params, folds)
    parts = []
    for i in range(folds):
        model = fit_member(name, frame.where(F.col("fold") != i).drop("fold"), variables, row_id, params)
        scored = predict_probability(model, frame.where(F.col("fold") == i))
        parts.append(scored.select(*row_id, "fold", C.TARGET, F.lit(name).alias("modelo"), "proba"))
    return append_rows(*parts)


def out_of_folds(
    names: Sequence[str],
    frame: DataFrame,
    variables: Sequence[str],
    row_id: Sequence[str],
    params: dict | None = None,
    folds: int = C.CV_FOLDS,
) -> DataFrame:
    """``out_of_fold`` of models with probabilities of their own, the features prepared once a fold for all of them."""
    keep = [*row_id, "fold", C.TARGET]
    return append_rows(*[
        scored_by(names, frame.where(F.col("fold") != i), frame.where(F.col("fold") == i), variables, keep, params)
        for i in range(folds)
    ])


def scored_by(
    names: Sequence[str],
    train: DataFrame,
    held: DataFrame,
    variables: Sequence[str],
    keep: Sequence[str],
    params: dict | None = None,
) -> DataFrame:
    """(kept columns, model, proba): ``held`` scored by models with probabilities of their own, fitted on ``train``.

    The vectors of ``train`` are stored, as each learner reads them more than once; the rows of ``held`` become vectors
    once and are scored by all models in one pass.
    """
    design, ready = prepared(train, variables)
    ready = storage.store_table(ready, "fold-vectors")
    scored = design.transform(held).select(*keep, FEATURES)
    found = []
    for place, (name, model) in enumerate(zip(names, fit_all(names, ready, params))):
        scored = predict_probability(model, scored, f"_proba_{place}")
        found.append(F.struct(F.lit(name).alias("modelo"), F.col(f"_proba_{place}").alias("proba")))
    return scored.select(*keep, F.inline(F.array(*found)))


def stack_inputs(
    names: Sequence[str], train: DataFrame, val: DataFrame, variables: Sequence[str], row_id: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """What ``stack`` learns from and is judged on, stored: out-of-fold scores of ``train``, and ``val`` scored by models of all of it.

    Members without probabilities of their own are calibrated, as the flow does.
    """
    own = [name for name in names if name not in CALIBRATED]
    folded = fold_frame(train, row_id, variables)
    keep = [*row_id, C.TARGET]
    oof = [out_of_folds(own, folded, variables, row_id)] if own else []
    scores = [scored_by(own, train, val, variables, keep)] if own else []
    for name in names:
        if name in CALIBRATED:
            oof.append(out_of_fold(name, folded, variables, row_id))
            scored = predict_probability(fit_member(name, train, variables, row_id), val)
            scores.append(scored.select(*keep, F.lit(name).alias("modelo"), "proba"))
    return storage.store_table(append_rows(*oof), "oof"), storage.store_table(append_rows(*scores), "val-scores")


def fold_frame(train: DataFrame, row_id: Sequence[str], variables: Sequence[str] = ()) -> DataFrame:
    """All training rows with stratified folds, stored by fold: a learner's passes read whole folds and digest no row again.

    With ``variables``, these, row id and target alone are stored.
    """
    folded = stratified_folds(train, row_id)
    if variables:
        wanted = {*row_id, C.TARGET, *variables}
        folded = folded.select(*[c for c in train.columns if c in wanted], "fold")
    return storage.store_table(folded, "folds", ["fold"])


def cv_scores(oof: DataFrame) -> DataFrame:
    """F1 of class 0 per model and fold."""
    return class0_metrics(oof, ["modelo", "fold"]).select(
        "modelo", "fold", F.col("f1_cls0").alias("score")
    )


def stack(
    oof: DataFrame, val: DataFrame, models: Sequence[str], row_id: Sequence[str]
) -> tuple[Model, DataFrame]:
    """Logistic meta-learner on out-of-fold probabilities, applied to val's.

    Both inputs are long (row id, target, model, proba) frames.
    """
    def wide(long: DataFrame) -> DataFrame:
        return probability_matrix(long, row_id, models, [C.TARGET])

    train = with_class_weight(wide(oof), name=WEIGHT).persist()
    learner = LogisticRegression(
        labelCol=C.TARGET,
        featuresCol=FEATURES,
        weightCol=WEIGHT,
        regParam=1.0 / max(train.count(), 1),
        maxIter=200,
        tol=1e-4,
    )
    assemble = VectorAssembler(inputCols=list(models), outputCol=FEATURES)
    model = Pipeline(stages=[assemble, learner]).fit(train)
    train.unpersist()
    scored = predict_probability(model, wide(val)).select(*row_id, C.TARGET, "proba")
    return model, scored


def fold_models(
    name: str,
    folded: DataFrame,
    variables: Sequence[str],
    params: dict | None = None,
    folds: int = C.CV_FOLDS,
) -> list[PipelineModel]:
    """One model per fold, each fitted on the rows of the other folds."""
    return [
        fit_candidate(name, folded.where(F.col("fold") != i), variables, params)
        for i in range(folds)
    ]


def calibrated(
    models: Sequence[Model], folded: DataFrame, frame: DataFrame, method: str = "sigmoid"
) -> DataFrame:
    """Mean probability of the fold models, each calibrated on its held-out rows."""
    return predict_probability(calibrate(models, folded, method), frame)


def fit_member(
    name: str,
    train: DataFrame,
    variables: Sequence[str],
    row_id: Sequence[str],
    params: dict | None = None,
    stop_on: DataFrame | None = None,
) -> Model:
    """A panel member as the flow uses it: margins become calibrated probabilities, boosting may stop on ``stop_on``."""
    if name not in CALIBRATED:
        return fit_candidate(name, train, variables, params, stop_on)
    folded = fold_frame(train, row_id, variables)
    return calibrate(fold_models(name, folded, variables, params), folded)
