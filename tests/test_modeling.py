"""M1-M14 properties: split sizes, SMOTE parity and geometry, model quality."""

import math

import pytest
from pyspark.sql import functions as F

from shopmetrics.plans import modeling as ml
from shopmetrics.plans.features import CHURN_TARGET, FEATURE_COLS


@pytest.fixture(scope="module")
def feats(spark):
    import __spark_entry__ as E  # noqa: F401
    from shopmetrics.plans.registry_more import features_df
    return features_df(spark, "/root/testdata/sf0.01").cache()


def test_stratified_split_exact_per_class(feats):
    sp = ml.split(feats, label=CHURN_TARGET)
    counts = {(r[0], r[1]): r[2] for r in sp.groupBy(CHURN_TARGET, "split").count().collect()}
    for c in (0, 1):
        n = counts[(c, "train")] + counts[(c, "test")]
        assert counts[(c, "test")] == math.ceil(0.2 * n)
    again = ml.split(feats, label=CHURN_TARGET)
    assert sorted(sp.select("customer_unique_id", "split").collect()) == \
        sorted(again.select("customer_unique_id", "split").collect())


def test_folds_balanced(feats):
    f = ml.with_folds(feats, 5)
    sizes = [r[1] for r in f.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 2


def test_smote_parity_and_segments(feats):
    train = ml.split(feats, label=CHURN_TARGET).where(F.col("split") == "train")
    over = ml.smote(train.select("customer_unique_id", *FEATURE_COLS, CHURN_TARGET), FEATURE_COLS)
    counts = {r[0]: r[1] for r in over.groupBy(CHURN_TARGET).count().collect()}
    assert counts[0] == counts[1]
    minority = over.where(~F.col("synthetic")).where(F.col(CHURN_TARGET) == 1)
    synth = over.where(F.col("synthetic"))
    assert synth.count() > 0
    # every synthetic point lies inside the bounding box of the minority rows
    for c in FEATURE_COLS[:5]:
        lo, hi = minority.agg(F.min(c), F.max(c)).first()
        slo, shi = synth.agg(F.min(c), F.max(c)).first()
        assert lo - 1e-9 <= slo and shi <= hi + 1e-9


def test_churn_model_learns_leaky_label(feats):
    sp = ml.split(feats, label=CHURN_TARGET)
    model = ml.fit_churn(sp.where(F.col("split") == "train"), params={"rounds": 10})
    scored = ml.churn_probability(model, sp.where(F.col("split") == "test"))
    assert ml.auc(scored, "churn_probability", CHURN_TARGET) > 0.95


def test_no_synthetic_row_derives_from_the_validation_slice(feats):
    from shopmetrics.plans import training
    run = training.churn_training(feats, params={"rounds": 2})
    held = run["train"].where(ml.in_validation()).select("customer_unique_id")
    assert held.count() > 0
    assert run["over"].join(held, "customer_unique_id").count() == 0
    real = run["over"].where("NOT synthetic").count()
    assert real + held.count() == run["train"].count()


def test_regression_metrics_perfect(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (5.0, 5.0)], "a double, p double")
    r = ml.regression_metrics(df, "a", "p").first()
    assert (r["mae"], r["rmse"], r["r2"], r["mape"]) == (0.0, 0.0, 1.0, 0.0)


def test_reference_rounds_and_parameters():
    assert (ml.CHURN_PARAMS.rounds, ml.CHURN_PARAMS.patience, ml.CHURN_PARAMS.watch) == (400, 30, "auc")
    assert (ml.CLV_PARAMS.rounds, ml.CLV_PARAMS.patience) == (600, 50)
    assert ml.CHURN_PARAMS.min_gain == 0.1 and ml.CHURN_PARAMS.column_share == ml.CLV_PARAMS.column_share == 0.8


def test_clv_model_explains_most_of_the_variance(feats):
    sp = ml.split(feats, label=None)
    model = ml.fit_clv(sp.where(F.col("split") == "train"))
    assert 1 <= len(model.trees) <= 600
    r = ml.regression_metrics(ml.clv_predict(model, sp.where(F.col("split") == "test")), "monetary", "predicted_clv").first()
    assert r["r2"] > 0.5 and r["mape"] < 60


def test_cv_shares_one_matrix_and_equals_separate_fits(feats):
    from dataclasses import replace

    from shopmetrics.operators import boosting
    mean, std, scores = ml.cv_auc(feats, params={"rounds": 8, "depth": 3})
    assert len(scores) == 5 and mean > 0.9 and std < 0.1
    data = ml.with_folds(feats, 5)
    one = boosting.fit(data, FEATURE_COLS, CHURN_TARGET, "fold", "customer_unique_id", [3],
                       replace(ml.CHURN_PARAMS, patience=None, watch="loss", rounds=8, depth=3))[3]
    alone = ml.auc(data.where("fold = 3").withColumn("s", one.score()), "s", CHURN_TARGET)
    assert abs(alone - scores[3]) < 1e-12


def test_cv_uses_the_reference_rounds(monkeypatch, spark):
    from shopmetrics.plans import registry_more as rm
    seen = {}
    monkeypatch.setattr(rm, "features_df", lambda *_: None)
    monkeypatch.setattr(rm.ml, "cv_auc", lambda f, **k: (seen.update(k), (0.5, 0.0, [0.5] * 5))[1])
    rm._cv_auc(spark, "")
    assert not seen


def test_grouped_auc_equals_the_evaluator(spark):
    rows = [(g, float((i * 7919 + g) % 13) / 13, int((i * 104729) % 3 == 0)) for g in range(3) for i in range(400)]
    df = spark.createDataFrame(rows + [(9, 0.5, 1)], "g int, s double, y int")
    got = {r["g"]: r["auc"] for r in ml.grouped_auc(df, "g", "s", "y").collect()}
    for g in range(3):
        assert abs(got[g] - ml.auc(df.where(F.col("g") == g), "s", "y")) < 1e-12
    assert got[9] is None


def test_permutation_importance_ranks_the_used_feature_first(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    rows = [(f"c{i}", int(x > 0), float(x), float(rng.normal())) for i, x in enumerate(rng.normal(size=600))]
    df = spark.createDataFrame(rows, f"customer_unique_id string, {CHURN_TARGET} int, a double, b double")
    model = ml.fit_churn(df, ["a", "b"], {"rounds": 5})
    drop = {r[0]: r[1] for r in ml.permutation_importance(model, df, ["a", "b"]).collect()}
    assert drop["a"] > 0.3 and abs(drop["b"]) < 0.01 and model.importances()["a"] > 0.9


def test_metrics_ledger_keeps_runs_and_replaces_a_retry(spark, tmp_dir):
    from shopmetrics.plans import training
    path = f"{tmp_dir}/ledger"
    training.record_metrics(spark, [("churn", "auc", 0.5)], path, "a")
    training.record_metrics(spark, [("churn", "auc", 0.6)], path, "b")
    again = training.record_metrics(spark, [("churn", "auc", 0.7)], path, "a")
    assert sorted((r["run_id"], r["value"]) for r in again.collect()) == [("a", 0.7), ("b", 0.6)]


def test_clv_predictions_score_each_customer_once(spark, monkeypatch):
    from shopmetrics.plans import training
    scored = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def value(monetary):
        scored.add(1)
        return monetary * 1.5

    monkeypatch.setattr(training.ml, "clv_predict", lambda model, df: df.withColumn("predicted_clv", value("monetary")))
    rows = [(f"c{i}", float(i), i % 7, 100.0 + i) for i in range(200)]
    features = spark.createDataFrame(rows, "customer_unique_id string, recency_days double, frequency int, monetary double").cache()
    out = training.clv_predictions({"features": features, "model": None}).collect()
    assert len(out) == 200 and scored.value == 200
    assert {r["clv_segment"] for r in out} == set(training.CLV_TIER_LABELS)
    assert all(float(r["predicted_clv"]) == float(r["monetary"]) * 1.5 for r in out)
