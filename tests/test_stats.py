"""Statistics against brute force, guards, and properties."""

import math
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelmood import config as C
from parcelmood.functions import order_statistics
from parcelmood.functions.histograms import auc_by, binned_counts, exact_quantiles
from parcelmood.functions.ordering import running_best, running_totals
from parcelmood.operators import metrics, selection, strength
from parcelmood.operators.cleaning import OrderCleaner, OrderCleanerModel
from parcelmood.operators.comparison import audit_cap, importance_share, stability_score
from parcelmood.operators.sampling import class_balance, fixed_sample, stratified_folds
from parcelmood.session import shared_dir


def brute_auc(pairs):
    ones = [s for s, y in pairs if y]
    zeros = [s for s, y in pairs if not y]
    wins = sum((a > b) + (a == b) / 2 for a in ones for b in zeros)
    return wins / (len(ones) * len(zeros))


def test_auc_with_ties_and_one_hot_score(spark):
    rng = random.Random(1)
    rows = [("k", 0.5 if rng.random() < 0.4 else rng.randint(0, 50) / 50, rng.randint(0, 1))
            for _ in range(400)]
    frame = spark.createDataFrame([*rows, ("one", 0.1, 1)], "key string, s double, y int")
    found = {r.key: r.auc for r in auc_by(frame, ["key"], "s", "y").collect()}
    assert found["k"] == pytest.approx(brute_auc([(s, y) for _, s, y in rows]))
    assert found["one"] is None
    turned = frame.withColumn("s", -F.col("s"))
    assert auc_by(turned, ["key"], "s", "y").where("key = 'k'").first().auc == pytest.approx(
        1 - found["k"]
    )


def test_quantiles_equal_linear_interpolation(spark):
    rng = random.Random(2)
    values = [rng.choice([rng.gauss(0, 1), 1.0, -2.0]) for _ in range(501)]
    frame = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
    got = exact_quantiles(frame, ["x"], [(1, 100), (1, 2), (99, 100), (0, 1), (1, 1)]).first()
    assert got.n_rows == 501
    assert got.quantiles == pytest.approx(list(np.quantile(values, [0.01, 0.5, 0.99, 0, 1])))


def test_running_totals_and_best(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aab"), i, rng.randint(0, 9)) for i in range(300)]
    frame = spark.createDataFrame(rows, "k string, i int, v int")
    found = running_totals(frame, ["k"], [F.col("i")], ["v"]).collect()
    best = {r.i: r.top for r in running_best(frame, ["k"], [F.col("i")], "v", "top").collect()}
    for r in found:
        assert r.v_before == sum(v for k, i, v in rows if k == r.k and i < r.i)
        assert r.v_total == sum(v for k, _, v in rows if k == r.k)
        assert best[r.i] == max(v for k, i, v in rows if k == r.k and i <= r.i)


def test_psi_of_itself_and_of_a_constant(spark):
    frame = spark.createDataFrame([(float(i), 1.0) for i in range(100)], "a double, b double")
    found = {r.feature: r.psi for r in
             selection.stability_index(frame, frame, ["a", "b"]).collect()}
    assert found["a"] == pytest.approx(0.0) and found["b"] == 0.0


def test_psi_equals_brute_force(spark):
    rng = random.Random(4)
    a = [float(rng.randint(0, 30)) for _ in range(301)]
    b = [float(rng.randint(5, 45)) for _ in range(200)]
    edges = np.unique(np.quantile(a, [i / 10 for i in range(11)]))
    inner = edges[1:-1]
    e = np.bincount([sum(x >= t for t in inner) for x in a], minlength=len(inner) + 1) / len(a)
    o = np.bincount([sum(x >= t for t in inner) for x in b], minlength=len(inner) + 1) / len(b)
    e, o = np.clip(e, 1e-6, None), np.clip(o, 1e-6, None)
    expected = float(np.sum((o - e) * np.log(o / e)))
    frames = [spark.createDataFrame([(v,) for v in side], "x double") for side in (a, b)]
    assert selection.stability_index(*frames, ["x"]).first().psi == pytest.approx(expected)


def test_gini_guards(spark):
    few = spark.createDataFrame([(float(i), i % 2) for i in range(20)], "x double, is_satisfied int")
    assert strength.univariate_gini(strength.feature_values(few, ["x"])).first().gini == 0.0
    one_class = spark.createDataFrame([(float(i), 1) for i in range(50)], "x double, is_satisfied int")
    values = strength.feature_values(one_class, ["x"])
    assert strength.univariate_gini(values).first().gini == 0.0
    assert strength.information_value(strength.woe_table(values)).first().iv == 0.0


def test_information_value_of_a_flag(spark):
    rows = [(1.0, 1)] * 30 + [(1.0, 0)] * 10 + [(0.0, 1)] * 20 + [(0.0, 0)] * 40
    frame = spark.createDataFrame(rows, "x double, is_satisfied int")
    woe = strength.woe_table(strength.feature_values(frame, ["x"]))
    expected = sum(
        (g / 50 - b / 50) * math.log((g / 50 + 1e-6) / (b / 50 + 1e-6))
        for g, b in ((30, 10), (20, 40))
    )
    assert strength.information_value(woe).first().iv == pytest.approx(expected)


def test_chained_redundancy_drops_both(spark):
    pairs = spark.createDataFrame(
        [("a", "b", 0.99), ("b", "c", 0.97), ("a", "c", 0.5)],
        "fila string, columna string, corr double",
    )
    ginis = spark.createDataFrame([("a", 0.3), ("b", 0.2), ("c", 0.1)], "feature string, gini double")
    dropped = {r.feature for r in selection.redundant_features(pairs, ginis).collect()}
    assert dropped == {"b", "c"}


def test_correlation_with_gaps(spark):
    rows = [(float(i), float(i * i), None if i % 7 == 0 else float(-i), 1.0) for i in range(40)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double")
    found = {(r.fila, r.columna): r["corr"] for r in
             selection.correlation_pairs(frame, ["a", "b", "c", "d"]).collect()}
    a = [r[0] for r in rows]
    assert found["a", "b"] == pytest.approx(abs(np.corrcoef(a, [r[1] for r in rows])[0, 1]))
    assert found["a", "c"] == pytest.approx(1.0)
    assert found["a", "d"] is None


def test_cleaner_learns_on_train_only(spark, tmp_path):
    train = spark.createDataFrame(
        [(float(i), None, "rare" if i == 0 else ("x" if i % 2 else None)) for i in range(200)],
        "total_price double, is_late int, payment_type string",
    )
    model = OrderCleaner().fit(train)
    later = spark.createDataFrame(
        [(-50.0, 1, "x"), (None, None, "new"), (900.0, 0, None)],
        "total_price double, is_late int, payment_type string",
    )
    path = str(tmp_path / "cleaner")
    model.write().overwrite().save(path)
    found = OrderCleanerModel.load(path).transform(later).collect()
    low, middle, high = np.quantile(range(200), [0.01, 0.5, 0.99])
    assert [r.total_price for r in found] == pytest.approx([low, middle, high])
    assert [r.is_late for r in found] == [1, 0, 0]
    assert [r.payment_type for r in found] == ["x", C.RARE_LABEL, C.MISSING_LABEL]
    with pytest.raises(RuntimeError):
        OrderCleanerModel().transform(later)


def test_rare_category_bound_is_inclusive(spark):
    rows = [("ten",)] * 10 + [("nine",)] * 9 + [("x",)] * 981
    frame = spark.createDataFrame(rows, "payment_type string")
    kept = OrderCleaner().fit(frame).learned()["frequent"]["payment_type"]
    assert kept == ["ten", "x"]


def test_lift_counts_ties_by_id(spark):
    rows = [(i, 0.5, 1 if i >= 3 else 0) for i in range(10)]
    frame = spark.createDataFrame(rows, "order_id int, proba double, is_satisfied int")
    found = {r.top_pct: r for r in metrics.lift_table(frame, [5, 20, 50]).collect()}
    assert found[5].contactados == 1 and found[5].insatisfechos_capturados == 1
    assert found[20].contactados == 2 and found[20].insatisfechos_capturados == 2
    assert found[50].insatisfechos_capturados == 3 and found[50].captura_pct == 100.0
    assert found[50].lift == 2.0


def test_lift_with_one_hot_order(spark):
    """One order holds most rows; its rows collapse and are still counted whole."""
    rows = [(1, 0.1, 0)] * 60 + [(1, 0.1, 1)] * 20 + [(2, 0.9, 1)] * 20
    frame = spark.createDataFrame(rows, "order_id int, proba double, is_satisfied int")
    found = {r.top_pct: r.insatisfechos_capturados for r in
             metrics.lift_table(frame, [50, 70]).collect()}
    assert found == {50: 50, 70: 60}


def test_lift_against_a_sort(spark):
    """Keys with a null, few and many distinct scores, missing and odd scores; some shares end inside a tie."""
    choose = random.Random(5)
    rows = []
    for key, grain in (("a", 7), ("b", 10**6), (None, 3)):
        for i in range(400):
            score = choose.choice([None, float("nan")]) if i % 97 == 0 else choose.randrange(grain) / grain
            rows.append((key, choose.randrange(250), score, choose.randrange(2)))
    frame = spark.createDataFrame(rows, "k string, order_id int, proba double, is_satisfied int")
    found = {(r.k, r.top_pct): (r.contactados, r.insatisfechos_capturados) for r in
             metrics.lift_table(frame, [1, 5, 37, 100], keys=["k"]).collect()}

    def place(row):
        score = row[2]
        risk = (2, 0) if score is None else (0, 0) if score != score else (1, score - 1.0)
        return (risk, row[1], row[3])

    expected = {}
    for key in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == key), key=place)
        for p in (1, 5, 37, 100):
            n = max(round(len(own) * p / 100.0), 1)
            expected[key, p] = (n, sum(1 - r[3] for r in own[:n]))
    assert found == expected
    assert metrics.lift_table(frame.limit(0), [5], keys=["k"]).count() == 0


def test_metrics_of_one_class_and_without_positives(spark):
    frame = spark.createDataFrame([(0.1, 1), (0.2, 1)], "proba double, is_satisfied int")
    row = metrics.technical_metrics(frame).first()
    assert (row.precision, row.recall, row.f1, row.roc_auc) == (0.0, 0.0, 0.0, None)
    full = metrics.full_metrics(frame).first()
    assert full.brier == pytest.approx((0.9**2 + 0.8**2) / 2)
    cells = {r.real: (r.pred_insatisfecho, r.pred_satisfecho) for r in
             metrics.confusion_matrix(frame).collect()}
    assert cells == {"insatisfecho": (0, 0), "satisfecho": (2, 0)}


def test_stability_penalises_drops_only(spark):
    table = spark.createDataFrame(
        [("a", 0.6, 0.5), ("b", 0.5, 0.6)],
        "modelo string, f1_cls0_val double, f1_cls0_backtest double",
    )
    found = {r.modelo: (r.score_estabilidad, r.estable) for r in stability_score(table).collect()}
    assert found == {"a": (0.5, "NO"), "b": (0.5, "sí")}


def test_importance_shares(spark):
    table = spark.createDataFrame([("a", 3.0), ("b", -1.0), ("c", 1.0)], "variable string, importancia double")
    shares = importance_share(table)
    assert [(r.variable, r.importancia_pct) for r in shares.collect()] == [
        ("a", 75.0), ("c", 25.0), ("b", 0.0)]
    audit = audit_cap(shares).first()
    assert not audit.cumple and [e.variable for e in audit.infractoras] == ["a", "c"]
    zero = importance_share(table.withColumn("importancia", F.lit(0.0)))
    assert audit_cap(zero).first().cumple


def test_folds_and_samples_do_not_depend_on_partitioning(spark):
    rows = [(i, int(i % 5 > 0)) for i in range(307)]
    frame = spark.createDataFrame(rows, "id int, is_satisfied int")
    one = stratified_folds(frame.repartition(1), ["id"]).collect()
    many = stratified_folds(frame.repartition(7), ["id"]).collect()
    assert sorted((r.id, r.fold) for r in one) == sorted((r.id, r.fold) for r in many)
    for label in (0, 1):
        sizes = [sum(r.fold == f and r.is_satisfied == label for r in one) for f in range(3)]
        assert max(sizes) - min(sizes) <= 1
    plan = stratified_folds(frame, ["id"])._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan
    odd = spark.createDataFrame([(None, None)] * 9 + [(i, None) for i in range(9)], "id int, is_satisfied int")
    placed = stratified_folds(odd, ["id"]).collect()
    assert len(placed) == 18 and len({r.fold for r in placed if r.id is None}) == 1
    assert stratified_folds(odd.limit(0), ["id"]).count() == 0
    picked = [sorted(r.id for r in fixed_sample(frame.repartition(n), 50, ["id"]).collect())
              for n in (1, 6)]
    assert picked[0] == picked[1] and len(picked[0]) == 50
    balance = class_balance(frame).first()
    assert balance.neg * balance.peso_0 == pytest.approx(balance.pos * balance.peso_1)


def test_stability_needs_no_known_first_month(spark):
    from parcelmood.operators.metrics import stability_band

    rows = [("2001-01", None, None, 0.5), ("2001-02", 0.7, 0.4, 0.5), ("2001-03", 0.6, 0.2, 0.5)]
    frame = spark.createDataFrame(rows, "month string, roc_auc double, gini double, f1 double")
    found = {r.month: (r.delta_roc_auc, r.alarma) for r in stability_band(frame).collect()}
    assert found == {"2001-01": (None, 0), "2001-02": (0.0, 0), "2001-03": (-0.1, 1)}


def test_sample_is_the_first_in_digest_order(spark):
    from parcelmood.operators.sampling import digest_order, fixed_sample

    frame = spark.range(5000).withColumnRenamed("id", "order_id")
    whole = [r.order_id for r in frame.orderBy(*digest_order(["order_id"])).collect()]
    for size in (0, 1, 700, 5000, 9000):
        assert [r.order_id for r in fixed_sample(frame, size, ["order_id"]).collect()] == whole[:size]


@pytest.mark.parametrize("few", [20_000, 20])
def test_places_found_by_closing_brackets(spark, monkeypatch, few):
    """Ties, nulls, infinities and zeros of either sign; with few rows to rank the brackets close over several rounds."""
    monkeypatch.setattr(order_statistics, "FEW", few)
    rng = random.Random(7)
    count = 20_000
    columns = {
        "a": [rng.gauss(0, 1) for _ in range(count)],
        "b": [rng.choice([1.0, 2.0]) for _ in range(count)],
        "c": [rng.choice([rng.gauss(0, 1), 1.0, -2.0, None]) for _ in range(count)],
        "d": [None] * count,
        "e": [None] * (count - 1) + [3.5],
        "f": [rng.choice([float("inf"), float("-inf"), 0.0, -0.0, 5.0]) for _ in range(count)],
    }
    frame = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).persist()
    quantiles = [(0, 1), (1, 100), (1, 3), (1, 2), (99, 100), (1, 1)]
    found = {c: (n, q) for c, n, q in order_statistics.column_quantiles(frame, list(columns), quantiles)}
    frame.unpersist()
    assert set(found) == set(columns) - {"d"}
    for name, (rows, got) in found.items():
        ordered = sorted(v for v in columns[name] if v is not None)
        assert rows == len(ordered)
        for (num, den), value in zip(quantiles, got):
            at, part = divmod(num * (rows - 1), den)
            low, high = ordered[at], ordered[min(at + 1, rows - 1)]
            expected = low + (high - low) * (part / den)
            assert value == expected or (math.isnan(expected) and math.isnan(value))


def test_counts_decide_whatever_is_proposed(spark):
    frame = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    places = {0, 10, 60, 75, 99}
    for proposed in ({60.0}, {-5.0, 500.0}, {0.5, 75.0}):
        found = order_statistics.values_at(frame, {"x": places}, {"x": proposed})
        assert found == {("x", k): float(k) for k in places}


def test_quantile_jobs_neither_sort_nor_store_the_rows(spark):
    frame = spark.createDataFrame([(float(i % 700), float(i)) for i in range(5_000)], "x double, y double")
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = {f for f in folder.rglob("*")}
    order_statistics.column_quantiles(frame, ["x", "y"], [(1, 2)])
    assert {f for f in folder.rglob("*")} == before
    plan = binned_counts(frame, {"x": [1.0, 2.0]})._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan
