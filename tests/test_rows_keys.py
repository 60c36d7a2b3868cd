"""The rows-only keys (model runs) run on the smallest driver tables and keep
a stable schema."""

import pytest

import __spark_entry__ as E
from shopmetrics.plans import registry
from tests.conftest import SF_SMALL

ROWS_ONLY = sorted(set(registry.queries()) - set(registry.oracle_sql()))

EXPECTED = {
    "churn_scores": ["customer_unique_id", "churned", "churn_probability", "prediction"],
    "clv_scores": ["customer_unique_id", "monetary", "predicted_clv"],
    "churn_cv_auc": ["cv_auc_mean", "cv_auc_std", "folds"],
    "feature_importance": ["feature", "importance", "permutation_auc_drop"],
    "prediction_sample": ["customer_unique_id", "actual_clv", "predicted_clv"],
    "model_metrics": ["model", "metric", "value", "recorded_at"],
    "ml_churn_predictions": ["customer_unique_id", "rfm_segment", "recency_days", "frequency", "monetary",
                             "churn_probability", "churn_label", "predicted_at"],
    "ml_clv_predictions": ["customer_unique_id", "rfm_segment", "monetary", "predicted_clv", "clv_segment",
                           "recency_days", "frequency", "predicted_at"],
}


def test_rows_only_set():
    assert len(ROWS_ONLY) == 9


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_rows_only_key_runs(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = df.collect()
    assert len(rows) > 0
    if key in EXPECTED:
        assert df.columns == EXPECTED[key]


def test_prediction_tables_cover_every_customer(spark):
    q = E.queries()
    feats = q["feature_matrix"](spark, SF_SMALL).count()
    churn = q["ml_churn_predictions"](spark, SF_SMALL)
    assert churn.count() == feats
    labels = {r[0] for r in churn.select("churn_label").distinct().collect()}
    assert labels <= {"Low", "Medium", "High"}
    tiers = {r[0] for r in q["ml_clv_predictions"](spark, SF_SMALL).select("clv_segment").distinct().collect()}
    assert tiers == {"Bronze", "Silver", "Gold", "Platinum"}
