"""End-to-end churn and CLV training runs over any star (M1-M3, M8, M10,
M11), shared by the registered queries and the command line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmetrics.functions.core import half_even
from shopmetrics.operators.bucketing import cut_fixed_expr, exact_percentiles, qcut_values_expr
from shopmetrics.plans import features as feat
from shopmetrics.plans import modeling as ml
from shopmetrics.session import ensure_checkpoint_dir

CUID = "customer_unique_id"
# Churn label bins and CLV tier names.
CHURN_BINS = [0.0, 0.33, 0.66, 1.0]
CHURN_LABELS = ["Low", "Medium", "High"]
CLV_TIER_LABELS = ["Bronze", "Silver", "Gold", "Platinum"]


def churn_rows(features: DataFrame, exclude_leaky: bool = False, seed: int = ml.SEED) -> dict:
    """Stratified split, the early-stopping slice held out of the training split, and SMOTE on
    the rest (no synthetic row, nor a neighbour's blend, watches a fit).  ``features`` should be
    materialised (cached or checkpointed): the split and the oversampling both re-read it."""
    ensure_checkpoint_dir(features.sparkSession)
    cols = [c for c in feat.FEATURE_COLS if not (exclude_leaky and c in ml.LEAKY_CHURN)]
    sp = ml.split(features, label=feat.CHURN_TARGET, seed=seed)
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    held = ml.in_validation(seed)
    fitted = train.where(~held).select(CUID, *cols, feat.CHURN_TARGET)
    return {"features": features, "split": sp, "train": train, "test": test, "held": train.where(held),
            "over": ml.smote(fitted, cols, seed=seed).checkpoint(), "feature_cols": cols}


def churn_training(features: DataFrame, params: dict | None = None, exclude_leaky: bool = False,
                   seed: int = ml.SEED, rows: dict | None = None) -> dict:
    """The classifier fitted on ``churn_rows`` (given or built)."""
    rows = rows or churn_rows(features, exclude_leaky, seed)
    return {**rows, "model": ml.fit_churn(rows["over"], rows["feature_cols"], params, validation=rows["held"], seed=seed)}


def clv_training(features: DataFrame, params: dict | None = None, seed: int = ml.SEED) -> dict:
    """Plain 80/20 split and the boosted-tree regressor on log1p(monetary)."""
    ensure_checkpoint_dir(features.sparkSession)
    sp = ml.split(features, label=None, seed=seed)
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    return {"features": features, "split": sp, "train": train, "test": test,
            "model": ml.fit_clv(train, params=params, seed=seed)}


def model_metrics(churn: dict, clv: dict) -> list[tuple[str, str, float]]:
    """(model, metric, value) of a pair of runs on their test splits."""
    test_auc = ml.auc(ml.churn_probability(churn["model"], churn["test"]), "churn_probability", feat.CHURN_TARGET)
    reg = ml.regression_metrics(ml.clv_predict(clv["model"], clv["test"]), "monetary", "predicted_clv").first()
    rows = [("churn", "auc", round(test_auc, 4)), ("churn", "rounds", float(len(churn["model"].trees))),
            ("churn", "train_n", float(churn["over"].count())), ("churn", "test_n", float(churn["test"].count())),
            ("clv", "rounds", float(len(clv["model"].trees)))]
    return rows + [("clv", m, float(reg[m])) for m in ("mae", "rmse", "r2", "mape")]


def record_metrics(spark, rows: list[tuple[str, str, float]], ledger: str, run_id: str) -> DataFrame:
    """Puts one run's metrics into the ledger: a partition for each run id, replaced as a whole
    by a retry of that run, while other runs stay.  Returns the whole ledger."""
    table = spark.createDataFrame(rows, "model string, metric string, value double").withColumn("recorded_at", F.current_timestamp())
    (table.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(ledger))
    return spark.read.schema("model string, metric string, value double, recorded_at timestamp, run_id string").parquet(ledger)


def churn_predictions(run: dict) -> DataFrame:
    """ml_churn_predictions rows for every customer (M10)."""
    seg = feat.rfm_segments_features(run["features"]).select(CUID, "rfm_segment")
    scored = ml.churn_probability(run["model"], run["features"]).join(seg, CUID)
    prob = F.col("churn_probability")
    return scored.select(
        CUID, "rfm_segment",
        F.col("recency_days").cast("decimal(10,2)").alias("recency_days"),
        F.col("frequency").cast("int").alias("frequency"),
        F.col("monetary").cast("decimal(12,2)").alias("monetary"),
        prob.cast("decimal(6,4)").alias("churn_probability"),
        cut_fixed_expr(prob, CHURN_BINS, CHURN_LABELS, lowest_label=CHURN_LABELS[0]).alias("churn_label"),
        F.current_timestamp().alias("predicted_at"))


def clv_tiers_expr(df: DataFrame, value_col: str):
    """Quartile tiers of a money column (exact edges)."""
    edges = exact_percentiles(df, value_col, [0.0, 0.25, 0.5, 0.75, 1.0])
    return qcut_values_expr(value_col, edges, CLV_TIER_LABELS)


def clv_predictions(run: dict) -> DataFrame:
    """ml_clv_predictions rows for every customer (M11).  The joined scores are written once: the
    tiers' edges and the rows both read them."""
    ensure_checkpoint_dir(run["features"].sparkSession)
    seg = feat.rfm_segments_features(run["features"]).select(CUID, "rfm_segment")
    scored = ml.clv_predict(run["model"], run["features"]).select(
        CUID, "monetary", half_even("predicted_clv", 2).alias("predicted_clv"), "recency_days", "frequency")
    pred = scored.join(seg, CUID).checkpoint()
    pred = pred.withColumn("clv_segment", clv_tiers_expr(pred, "predicted_clv"))
    return pred.select(CUID, "rfm_segment",
                       F.col("monetary").cast("decimal(12,2)").alias("monetary"),
                       F.col("predicted_clv").cast("decimal(12,2)").alias("predicted_clv"), "clv_segment",
                       F.col("recency_days").cast("decimal(10,2)").alias("recency_days"),
                       F.col("frequency").cast("int").alias("frequency"),
                       F.current_timestamp().alias("predicted_at"))
