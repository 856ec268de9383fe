from dataclasses import replace
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tallymark.config import DEFAULT, FEATURES
from tallymark.operators import autoencoder, ensemble, explain, features, isolation, metrics, rules
from tests.tables import day, invoice, table

SMALL = replace(DEFAULT, forest_trees=20, forest_sample=64)


def nodes_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def forest(tiny):
    return isolation.load_forest(isolation.fit_forest(tiny.scaled, cfg=SMALL), SMALL)


def matrix(df) -> np.ndarray:
    return np.stack([r["scaled"] for r in df.orderBy("invoice_number").collect()])


def test_forest_does_not_depend_on_partitions(tiny):
    few = isolation.fit_forest(tiny.scaled.coalesce(1), cfg=SMALL)
    many = isolation.fit_forest(tiny.scaled.repartition(13, "vendor_id"), cfg=SMALL)
    assert nodes_of(few) == nodes_of(many)


def test_forest_shape_and_scores(tiny, forest):
    assert len(forest.trees) == 20 and forest.depth <= 6
    for t in forest.trees:
        assert t.n[0] == 64
        inner = ~t.is_leaf
        assert (t.n[t.left[inner]] + t.n[t.right[inner]] == t.n[inner]).all()
    scored = isolation.add_score(tiny.scaled, forest)
    low, high, n = scored.agg(F.min("iso_score"), F.max("iso_score"), F.count("iso_score")).first()
    assert 0 < low < high <= 1 and n == tiny.inv.count()
    auc = metrics.roc_auc(scored, "anomaly_flag", "iso_score").first()["auc"]
    assert auc > 0.75


def test_auc_equals_library_evaluator(tiny):
    df = tiny.zscore_scored.select("anomaly_flag", F.round("ensemble_score", 1).alias("s"))  # many ties
    ours = metrics.roc_auc(df, "anomaly_flag", "s", chunks=5).first()["auc"]
    lib = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="label", numBins=0).evaluate(
        df.withColumn("label", F.col("anomaly_flag").cast("double"))
    )
    assert ours == pytest.approx(lib, abs=1e-9)


@pytest.mark.parametrize("chunks", [None, 5])
def test_roc_corners_equal_a_plain_reduction(spark, chunks):
    rng = np.random.default_rng(6)
    rows = [(m, int(rng.random() < 0.3), float(rng.integers(0, 150) if m == "a" else rng.integers(0, 4))) for m in "aab" for _ in range(300)]
    rows += [("only", 1, 1.0), ("line", 1, 3.0), ("line", 1, 2.0), ("line", 1, 1.0), ("line", 0, 0.0)]
    got = metrics.roc_points(spark.createDataFrame(rows, "m string, y int, s double"), "y", "s", ("m",), chunks).collect()
    for model in ("a", "b", "only", "line"):
        mine = [(y, s) for m, y, s in rows if m == model]
        scores = sorted({s for _, s in mine}, reverse=True)
        tp, fp = ([sum(1 for y, t in mine if y == want and t >= s) for s in scores] for want in (1, 0))
        bent = np.ones(len(scores), bool)
        if len(scores) > 2:
            bent[1:-1] = (np.diff(tp, 2) != 0) | (np.diff(fp, 2) != 0)
        wanted = [(None, 0.0, 0.0)] + [
            (s, f / fp[-1] if fp[-1] else None, t / tp[-1] if tp[-1] else None) for s, f, t, keep in zip(scores, fp, tp, bent) if keep
        ]
        found = sorted(((r.threshold, r.fpr, r.tpr) for r in got if r.m == model), key=lambda r: (r[0] is not None, -(r[0] or 0)))
        assert found == wanted


def shapley(tree, x: np.ndarray) -> np.ndarray:
    """Subset sum over the path-dependent expectation, straight from the definition."""

    def value(at: int, known: set) -> float:
        if tree.is_leaf[at]:
            return -tree.length[at]
        left, right, f = tree.left[at], tree.right[at], tree.feature[at]
        if f in known:
            return value(left if x[f] <= tree.threshold[at] else right, known)
        return (tree.n[left] * value(left, known) + tree.n[right] * value(right, known)) / tree.n[at]

    width = len(FEATURES)
    used = sorted(set(tree.feature[~tree.is_leaf]))
    out, d = np.zeros(width), len(used)
    for f in used:
        rest = [g for g in used if g != f]
        for k in range(d):
            weight = factorial(k) * factorial(d - 1 - k) / factorial(d)
            for s in combinations(rest, k):
                out[f] += weight * (value(0, {*s, f}) - value(0, set(s)))
    return out


def test_contributions_equal_shapley_values(tiny, forest):
    one = isolation.Forest(forest.trees[:1], forest.norm, forest.depth)
    x = matrix(tiny.scaled)[::200]
    got = explain.attribute(explain.leaf_boxes(one), x)
    for row, phi in zip(x, got):
        assert phi == pytest.approx(shapley(one.trees[0], row), abs=1e-9)


def test_rows_are_dealt_to_copies_once(tiny, monkeypatch):
    plans = []
    pin = autoencoder.pin
    monkeypatch.setattr(autoencoder, "EPOCHS", 0)
    monkeypatch.setattr(autoencoder, "pin", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or pin(df, label))
    autoencoder.fit(tiny.scaled, cfg=replace(DEFAULT, rows_per_worker=100))
    assert plans[0].count("Exchange ") == 1


def test_scores_are_stored_once(tiny, forest, monkeypatch):
    labels = []
    pin = ensemble.pin
    monkeypatch.setattr(ensemble, "pin", lambda df, label: labels.append(label) or pin(df, label))
    weights = autoencoder.initial_weights(1)
    got = ensemble.score_models(tiny.scaled, forest, weights, "anomaly_flag = 0").toPandas()
    assert labels == ["scores"]
    unit = [(got[c] - got[c].min()) / (got[c].max() - got[c].min() + 1e-10) for c in ("iso_score", "ae_score")]
    assert got["ensemble_score"].to_numpy() == pytest.approx((0.55 * unit[0] + 0.45 * unit[1]).to_numpy(), abs=1e-12)


def test_leaves_share_tables(tiny, forest, monkeypatch):
    boxes = explain.leaf_boxes(forest)
    x = matrix(tiny.scaled)[:200]
    for f, t in enumerate(explain.tables(boxes).thresholds):  # also rows right on a threshold
        x[: len(t), f] = t[: len(x)]
    shared = explain.tables(boxes)
    got = explain.attribute_by(shared, x)
    assert 4 * len(shared.groups) < sum(len(b.value) for b in boxes)
    monkeypatch.setattr(explain, "STATES", 1)
    alone = explain.tables(boxes)
    assert len(alone.groups) == sum(len(b.value) for b in boxes)
    assert got == pytest.approx(explain.attribute_by(alone, x), abs=1e-10)


def test_contributions_add_up(tiny, forest):
    x = matrix(tiny.scaled)[:150]
    boxes = explain.leaf_boxes(forest)
    total = explain.base_value(boxes) + explain.attribute(boxes, x).sum(axis=1)
    score = isolation.anomaly_score(forest, x)
    assert total == pytest.approx(np.log2(score) * forest.norm, abs=1e-8)


def test_permutation_importance(tiny, forest):
    got = isolation.permutation_importance(tiny.scaled, forest, "anomaly_flag", cfg=SMALL, chunks=3).collect()
    drops = {r["feature"]: r["auc_drop"] for r in got}
    assert set(drops) == set(FEATURES)
    assert max(drops.values()) > 0.005


def test_bit_vectors_agree_with_paths(tiny, forest):
    x = matrix(tiny.scaled)[:300]
    y = x[::-1]
    got = isolation.permuted_scores([isolation.leaf_masks(t) for t in forest.trees], forest.norm, x, y)
    assert (got[:, 0] == isolation.rounded_score(forest, x)).all()
    for f in range(x.shape[1]):
        moved = x.copy()
        moved[:, f] = y[:, f]
        assert (got[:, 1 + f] == isolation.rounded_score(forest, moved)).all()


def test_gradient_matches_differences(monkeypatch):
    monkeypatch.setattr(autoencoder, "DROPOUT", 0.0)
    rng = np.random.default_rng(1)
    w, x = autoencoder.initial_weights(3) + 0.01, rng.normal(size=(5, 10))
    grad, loss = autoencoder._gradient(w, x, rng)
    assert loss == pytest.approx(autoencoder.row_error(w, x).mean())
    for i in range(0, len(w), 37):
        up, down = w.copy(), w.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        slope = (autoencoder.row_error(up, x).mean() - autoencoder.row_error(down, x).mean()) / 2e-6
        assert grad[i] == pytest.approx(slope, abs=1e-5)


def test_autoencoder_learns(tiny, monkeypatch):
    monkeypatch.setattr(autoencoder, "EPOCHS", 6)
    several = replace(DEFAULT, rows_per_worker=300)
    fitted = autoencoder.fit(tiny.scaled.filter("anomaly_flag = 0"), cfg=several)
    losses = [v for _, _, v in fitted.history]
    assert len(losses) == 6 and min(losses) < losses[0]
    assert fitted.best_epoch == int(np.argmin(losses)) + 1
    assert len(fitted.weights) == 685


def test_autoencoder_weights_do_not_depend_on_layout(spark, monkeypatch):
    monkeypatch.setattr(autoencoder, "EPOCHS", 2)
    x = [(F.xxhash64("id", F.lit(i)) % 1000 / 500.0).alias(f"x{i}") for i in range(len(FEATURES))]
    rows = spark.range(60_000).select(F.concat(F.lit("I"), "id").alias("invoice_number"), F.array(*x).alias("scaled"))
    found = []
    for cost, partitions in (("4194304", "8"), ("1", "8"), ("4194304", "2")):
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            found.append(autoencoder.fit(rows))
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    for other in found[1:]:
        assert np.abs(other.weights - found[0].weights).max() < 1e-9
        assert np.abs(np.array(other.history) - np.array(found[0].history)).max() < 1e-9


def test_ensemble(tiny):
    low, high = tiny.scored.agg(F.min("ensemble_score"), F.max("ensemble_score")).first()
    assert 0 <= low < high <= 1
    n = tiny.scored.count()
    for flag in ("iso_prediction", "ensemble_prediction"):
        assert tiny.scored.agg(F.sum(flag)).first()[0] == pytest.approx(0.05 * n, abs=2)
    table_ = {r["model"]: r for r in metrics.compare_models(tiny.scored, "anomaly_flag", {
        "a": ("iso_score", "iso_prediction"), "b": ("ensemble_score", "ensemble_prediction")}).collect()}
    assert table_["b"]["auc"] > 0.75


def test_sentences(tiny):
    cases = tiny.explained_cases.collect()
    assert cases
    for r in cases:
        assert r["shap_explanation"].startswith(("Score raised by: ", "Score raised by nothing"))
        if "order number missing" in r["shap_explanation"]:
            assert r["feat_no_po"] == 1


def test_feature_edges(spark):
    ven = table(spark, "vendors", [{"vendor_id": "A", "vendor_creation_date": day("2020-01-10")}])
    bud = table(spark, "budget", [{"cost_centre": "C", "budget_period": p, "approved_budget": 50, "actual_spend": 1} for p in "12"])
    orders = table(spark, "purchase_orders", [{"po_number": "P", "total_po_value": 50}, {"po_number": "Z", "total_po_value": 0}])
    from tests.tables import ts

    inv = table(
        spark, "invoices",
        [invoice("same1", "2020-01-06T10:00:00", "10", po_number="P", cost_centre="C"),
         invoice("same2", "2020-01-07T10:00:00", "10", po_number="Z", cost_centre="C", payment_date=ts("2020-01-01T10:00:00")),
         invoice("alone", "2020-02-07T10:00:00", "0.5", vendor="B", payment_date=ts("2021-01-01T10:00:00")),
         invoice("lost", "2020-02-07T10:00:00", "12345678.90", vendor=None)],
    )
    f = {r["invoice_number"]: r for r in features.build_features(inv, ven, orders, bud).collect()}
    assert [f[k]["feat_amount_zscore"] for k in ("same1", "alone", "lost")] == [0, 0, 0]
    assert (f["same1"]["feat_invoice_to_po_ratio"], f["same2"]["feat_invoice_to_po_ratio"]) == (0.2, 1.5)
    assert (f["same1"]["feat_vendor_age_days"], f["alone"]["feat_vendor_age_days"]) == (0, 365)
    assert [f[k]["feat_days_to_payment"] for k in ("same1", "same2", "alone")] == [90, 0, 200]
    assert (f["same1"]["feat_vendor_monthly_freq"], f["lost"]["feat_vendor_monthly_freq"]) == (2, 0)
    assert (f["same1"]["feat_pct_of_cc_budget"], f["alone"]["feat_pct_of_cc_budget"]) == (0.1, 0.5)
    assert f["alone"]["feat_benford_dev"] == 0
    assert f["lost"]["feat_benford_dev"] == pytest.approx(abs(1 / 9 - np.log10(2)))


def test_scaler_keeps_flat_columns(tiny):
    by = {r["feature"]: r for r in tiny.scaler.collect()}
    assert set(by) == set(FEATURES)
    assert by["feat_after_hours"]["scale"] == 1.0 and by["feat_no_po"]["scale"] == 1.0


def test_confusion_on_empty_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    r = rules.confusion(df, "y", "p").first()
    assert (r["tn"], r["precision"], r["recall"], r["f1"]) == (2, 0.0, 0.0, 0.0)
