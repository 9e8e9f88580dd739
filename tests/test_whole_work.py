"""Queries do the whole job that they name: all rounds, all steps, all models."""

import math
import random

import pytest
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.checks import all_queries, models
from parcelmood.operators import modeling, panel

ROW = ["order_id", "review_id"]


def _rows(spark, count=240):
    rng = random.Random(6)
    rows = [
        (i, i + 500, ("train", "train", "train", "val")[i % 4], x := rng.gauss(0, 1), rng.choice("ab"), int(x + rng.gauss(0, 1) > 0))
        for i in range(count)
    ]
    return spark.createDataFrame(
        rows, f"order_id int, review_id int, {C.SPLIT} string, total_price double, payment_type string, {C.TARGET} int"
    )


@pytest.mark.parametrize("name", ["gbt_a", "gbt_b", "gbt_c"])
def test_boosting_queries_run_all_rounds_of_their_model(spark, monkeypatch, name):
    rounds = []
    monkeypatch.setattr(models, "_panel", lambda *given: (_rows(spark, 8), ["total_price"]))
    monkeypatch.setattr(
        panel, "fit_candidate",
        lambda model, train, variables, params=None: rounds.append(panel.build_classifier(model, params).getMaxIter()),
    )
    monkeypatch.setattr(models, "tagged_scores", lambda model, frame: frame)
    monkeypatch.setattr(models, "model_row", lambda model, scored, params=None: scored)
    all_queries()[0][f"panel_{name}"](spark, "")
    assert rounds == [panel.DEFAULTS[name]["max_iter"]] and rounds[0] >= 200


def test_cascade_ends_with_the_information_value_of_its_survivors(spark):
    rng = random.Random(7)
    rows = [(late := int(rng.random() < 0.4), float(i % 2), rng.choice("ab"), int(rng.random() < (0.3 if late else 0.8)))
            for i in range(400)]
    frame = spark.createDataFrame(rows, f"is_late int, total_price double, payment_type string, {C.TARGET} int").persist()
    report, ranking, selected = modeling.selection_cascade(frame, frame, min_gini=0.2, evaluate=lambda names: (0.5, 0.5))
    assert [r.orden for r in report.collect()] == [0, 1, 2, 3, 4] and selected == ["is_late", "payment_type"]
    good, bad = ([sum(1 for late, *_, y in rows if (late, y) == (x, label)) for x in (0, 1)] for label in (1, 0))
    shares = [(g / sum(good), b / sum(bad)) for g, b in zip(good, bad)]
    value = sum((g - b) * math.log((g + 1e-6) / (b + 1e-6)) for g, b in shares)
    found = ranking.collect()
    assert [r.variable for r in found] == ["is_late"] and found[0].information_value == pytest.approx(value, abs=1e-4)
    _, ranking, selected = modeling.selection_cascade(frame, frame, min_gini=2.0, evaluate=lambda names: (0.5, 0.5))
    assert selected == ["payment_type"] and ranking.isEmpty()


def test_stacking_query_stacks_the_whole_panel(spark, monkeypatch):
    names = []
    monkeypatch.setattr(models, "_panel", lambda *given: (_rows(spark, 8), ["total_price"]))
    monkeypatch.setattr(panel, "stack_inputs", lambda given, *rest: names.append(tuple(given)) or (None, None))
    scored = _rows(spark, 8).withColumn("proba", F.lit(0.5))
    monkeypatch.setattr(panel, "stack", lambda oof, scores, given, row_id: names.append(tuple(given)) or (None, scored))
    all_queries()[0]["stacking"](spark, "")
    assert names == [panel.PANEL] * 2


def test_every_member_scores_every_row_of_the_stack(spark, monkeypatch):
    small, calibrated = {"n_estimators": 3, "max_depth": 2, "max_iter": 2}, []
    monkeypatch.setattr(panel, "DEFAULTS", {
        name: {key: small.get(key, value) for key, value in given.items()} for name, given in panel.DEFAULTS.items()
    })
    monkeypatch.setattr(
        panel, "fit_member",
        lambda name, train, variables, row_id, *rest: calibrated.append(name) or panel.fit_candidate("logistic", train, variables),
    )
    names, frame = ["logistic", "gbt_a", "random_forest", "linear_svm"], _rows(spark).persist()
    train, val = (frame.where(F.col(C.SPLIT) == split) for split in ("train", "val"))
    oof, scores = panel.stack_inputs(names, train, val, ["total_price", "payment_type"], ROW)
    assert calibrated == ["linear_svm"] * 4
    for found, given in ((oof, train), (scores, val)):
        wanted = {(*r, name) for r in given.select(*ROW, C.TARGET).collect() for name in names}
        rows = found.collect()
        assert len(rows) == len(wanted) and {(r.order_id, r.review_id, r.is_satisfied, r.modelo) for r in rows} == wanted
        assert all(0 <= r.proba <= 1 for r in rows)
    _, stacked = panel.stack(oof, scores, names, ROW)
    assert stacked.count() == val.count() and stacked.where("proba is null").isEmpty()
