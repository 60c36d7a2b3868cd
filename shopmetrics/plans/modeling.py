"""Churn and CLV models.

* Splits and CV folds come from a hash of the customer id ordered through
  the distributed global rank: reproducible, independent of partition
  layout, and exact in size per class, with no window over a whole class.
* Oversampling (SMOTE) runs on the training split only.  Each synthetic row lies on the
  segment between a minority row and one of its nearest minority rows in the standardised
  features (``operators.neighbours``).
* Boosted trees (``operators.boosting``) have the reference's 400 / 600 rounds and parameters
  and stop 30 / 50 rounds after the best held-out metric (AUC for churn, squared error for
  CLV), which is watched inside the loop on a slice of the *training* split.
* Cross validation fits all folds in the same passes over one binned matrix.
"""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopmetrics.operators import boosting
from shopmetrics.operators.bucketing import global_rank
from shopmetrics.operators.neighbours import nearest_neighbours
from shopmetrics.plans.features import CHURN_TARGET, CLV_FEATURES, FEATURE_COLS

SEED = 42
CUID = "customer_unique_id"
# Hyper-parameters of the reference models.
CHURN_PARAMS = boosting.Params(rounds=400, depth=5, rate=0.05, loss="logistic", watch="auc", patience=30, row_share=0.8,
                               column_share=0.8, l1=0.1, l2=1.0, min_gain=0.1, min_weight=3.0, seed=SEED)
# its row share of 0.8 has no effect there, as no bagging frequency is set; with squared loss a row weighs 1
CLV_PARAMS = boosting.Params(rounds=600, depth=6, rate=0.03, loss="squared", watch="loss", patience=50, row_share=1.0,
                             column_share=0.8, l1=0.1, l2=1.0, min_gain=0.0, min_weight=20.0, seed=SEED)
LEAKY_CHURN = ["recency_days"]
VALIDATION_FRAC = 0.1


def hash01(col: str, seed: int = SEED) -> Column:
    """Deterministic uniform [0, 1) from the row id."""
    return F.pmod(F.xxhash64(F.col(col), F.lit(seed)), F.lit(1 << 53)).cast("double") / float(1 << 53)


# ---- M1: splits and folds -----------------------------------------------------
def _class_offsets(df: DataFrame, label: str | None) -> tuple[dict, list]:
    if label is None:
        return {None: df.count()}, [None]
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # one row per class
    return counts, sorted(counts, key=lambda v: (v is not None, v))


def split_key(id_col: str, seed: int = SEED) -> Column:
    """Reproducible pseudo-random order of rows: md5 of the id and the seed
    (hex text; the same value in any SQL engine, so splits are checkable)."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"#{seed}")))


def ranked_within_class(df: DataFrame, id_col: str, label: str | None, seed: int = SEED):
    """Rank of each row within its class in hash order (1-based), and the
    class sizes."""
    counts, classes = _class_offsets(df, label)
    keyed = df.withColumn("_h", split_key(id_col, seed))
    order = ([F.asc_nulls_first(label)] if label else []) + [F.col("_h"), F.col(id_col)]
    ranked, _ = global_rank(keyed, order, "_r")
    offset, running = None, 0
    for c in classes:
        cond = F.col(label).isNull() if (label and c is None) else (F.col(label) == F.lit(c) if label else F.lit(True))
        offset = F.when(cond, F.lit(running)) if offset is None else offset.when(cond, F.lit(running))
        running += counts[c]
    size = None
    for c in classes:
        cond = F.col(label).isNull() if (label and c is None) else (F.col(label) == F.lit(c) if label else F.lit(True))
        size = F.when(cond, F.lit(counts[c])) if size is None else size.when(cond, F.lit(counts[c]))
    return (ranked.withColumn("_within", F.col("_r") - offset).withColumn("_class_n", size)
            .drop("_r", "_h"))


def split(df: DataFrame, id_col: str = CUID, label: str | None = None, test_frac: float = 0.2,
          seed: int = SEED) -> DataFrame:
    """Adds ``split`` = train/test: ceil(test_frac * n_class) test rows per
    class (stratified when ``label`` is given)."""
    r = ranked_within_class(df, id_col, label, seed)
    is_test = F.col("_within") <= F.ceil(F.col("_class_n") * F.lit(test_frac))
    return r.withColumn("split", F.when(is_test, "test").otherwise("train")).drop("_within", "_class_n")


def with_folds(df: DataFrame, k: int = 5, id_col: str = CUID, label: str | None = CHURN_TARGET,
               seed: int = SEED) -> DataFrame:
    """Stratified fold id 0..k-1 (round robin in hash order within class)."""
    r = ranked_within_class(df, id_col, label, seed)
    return r.withColumn("fold", ((F.col("_within") - 1) % k).cast("int")).drop("_within", "_class_n")


# ---- M2: SMOTE -------------------------------------------------------------------
def smote(train: DataFrame, feature_cols: list[str], label: str = CHURN_TARGET, id_col: str = CUID,
          k: int = 5, seed: int = SEED) -> DataFrame:
    """Oversample the minority class to parity with synthetic rows."""
    counts = {r[0]: r[1] for r in train.groupBy(label).count().collect()}
    if len(counts) < 2:
        return train.withColumn("synthetic", F.lit(False))
    minority = min(counts, key=lambda c: (counts[c], c))
    majority_n = max(counts.values())
    n_min, n_new = counts[minority], majority_n - counts[minority]
    base = train.withColumn("synthetic", F.lit(False))
    if n_new == 0:
        return base
    mino = train.where(F.col(label) == F.lit(minority)).select(id_col, *[F.col(c).cast("double").alias(c) for c in feature_cols])
    ranked, _ = global_rank(mino, [F.col(id_col)], "_r")
    near = nearest_neighbours(mino.select(id_col, standardised(mino, feature_cols).alias("_z")), id_col, "_z", k, seed)
    spark = train.sparkSession
    plan = spark.range(n_new).select(F.col("id").alias("_i"), ((F.col("id") % n_min) + 1).alias("_b"), hash01("id", seed + 1).alias("_gap"))
    a = ranked.select(F.col("_r").alias("_b"), F.col(id_col).alias("_own"), *[F.col(c).alias(f"a_{c}") for c in feature_cols])
    a = a.join(near.select(F.col("id").alias("_own"), F.col("neighbours.id").alias("_near")), "_own", "left")
    pick = F.get("_near", F.pmod(F.xxhash64("_i", F.lit(seed)), F.size("_near")).cast("int"))
    picked = plan.join(a, "_b").withColumn("_n", F.coalesce(pick, F.col("_own")))
    n = mino.select(F.col(id_col).alias("_n"), *[F.col(c).alias(f"n_{c}") for c in feature_cols])
    synth = picked.join(n, "_n").select(
        F.concat(F.lit("smote-"), F.col("_i").cast("string")).alias(id_col),
        *[(F.col(f"a_{c}") + F.col("_gap") * (F.col(f"n_{c}") - F.col(f"a_{c}"))).alias(c) for c in feature_cols],
        F.lit(minority).cast(train.schema[label].dataType).alias(label),
        F.lit(True).alias("synthetic"))
    cols = [id_col, *feature_cols, label, "synthetic"]
    return base.select(*cols).unionByName(synth.select(*cols))


def standardised(df: DataFrame, cols: list[str]) -> Column:
    """Array of (x - mean) / standard deviation; a null counts as the mean."""
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return F.array(*[F.coalesce((F.col(c) - F.lit(stats[f"m{i}"] or 0.0)) / F.lit(stats[f"s{i}"] or 1.0), F.lit(0.0)) for i, c in enumerate(cols)])


# ---- M3 / M8: model fitting -----------------------------------------------------
def in_validation(seed: int = SEED, frac: float = VALIDATION_FRAC) -> Column:
    """Is the row in the early-stopping slice of the training split?"""
    return hash01(CUID, seed + 7) < frac


def _fit_one(rows: DataFrame, cols: list[str], label: Column, held: Column, params: boosting.Params) -> boosting.Model:
    data = rows.select(CUID, *cols, label.alias("_label"), F.when(held, 0).otherwise(1).alias("_held"))
    return boosting.fit(data, cols, "_label", "_held", CUID, [0], params)[0]


def fit_churn(train: DataFrame, feature_cols: list[str] | None = None, params: dict | None = None,
              validation: DataFrame | None = None, seed: int = SEED) -> boosting.Model:
    """``validation`` holds the early-stopping rows; without it a slice of ``train`` is held
    out, which is right only for rows that were not oversampled."""
    cols = feature_cols or FEATURE_COLS
    p = replace(CHURN_PARAMS, seed=seed, **(params or {}))
    if validation is None:
        return _fit_one(train, cols, F.col(CHURN_TARGET), in_validation(seed), p)
    rows = [df.select(CUID, *[F.col(c).cast("double").alias(c) for c in cols], CHURN_TARGET, F.lit(held).alias("_v"))
            for df, held in ((train, False), (validation, True))]
    return _fit_one(rows[0].unionByName(rows[1]), cols, F.col(CHURN_TARGET), F.col("_v"), p)


def churn_probability(model: boosting.Model, df: DataFrame) -> DataFrame:
    return df.withColumn("churn_probability", model.score()).withColumn(
        "prediction", (F.col("churn_probability") >= 0.5).cast("double"))


def fit_clv(train: DataFrame, feature_cols: list[str] | None = None, params: dict | None = None,
            seed: int = SEED) -> boosting.Model:
    return _fit_one(train, feature_cols or CLV_FEATURES, F.log1p(F.col("monetary").cast("double")), in_validation(seed),
                    replace(CLV_PARAMS, seed=seed, **(params or {})))


def clv_predict(model: boosting.Model, df: DataFrame) -> DataFrame:
    return df.withColumn("predicted_clv", F.greatest(F.expm1(model.score()), F.lit(0.0)))


# ---- M4-M9: evaluation -------------------------------------------------------------
def auc(scored: DataFrame, score_col: str, label_col: str) -> float:
    """Exact ROC AUC (``numBins=0``: every distinct score is a threshold)."""
    ev = BinaryClassificationEvaluator(rawPredictionCol="_score", labelCol="_label",
                                       metricName="areaUnderROC", numBins=0)
    return ev.evaluate(scored.select(F.col(score_col).cast("double").alias("_score"),
                                     F.col(label_col).cast("double").alias("_label")))


def confusion_matrix(scored: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    return (scored.groupBy(F.col(label_col).cast("int").alias("actual"), F.col(pred_col).cast("int").alias("predicted"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("count")))


def classification_report(scored: DataFrame, label_col: str, pred_col: str,
                          names: tuple[str, str] = ("Active", "Churned")) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted
    averages, from one aggregation of the 2x2 counts."""
    y, p = F.col(label_col).cast("int"), F.col(pred_col).cast("int")
    c = scored.agg(*[F.sum(F.when((y == a) & (p == b), 1).otherwise(0)).cast("double").alias(f"c{a}{b}")
                     for a in (0, 1) for b in (0, 1)])

    def div(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a / b)

    t = F.col
    n = t("c00") + t("c01") + t("c10") + t("c11")
    prec = {0: div(t("c00"), t("c00") + t("c10")), 1: div(t("c11"), t("c11") + t("c01"))}
    rec = {0: div(t("c00"), t("c00") + t("c01")), 1: div(t("c11"), t("c11") + t("c10"))}
    sup = {0: t("c00") + t("c01"), 1: t("c10") + t("c11")}
    f1 = {i: div(2 * prec[i] * rec[i], prec[i] + rec[i]) for i in (0, 1)}
    rows = c.select(
        *[x.alias(f"p{i}") for i, x in prec.items()], *[x.alias(f"r{i}") for i, x in rec.items()],
        *[x.alias(f"f{i}") for i, x in f1.items()], *[x.alias(f"s{i}") for i, x in sup.items()],
        div(t("c00") + t("c11"), n).alias("acc"), n.alias("n"))
    stack = F.expr(
        "stack(5, "
        f"'{names[0]}', p0, r0, f0, s0, "
        f"'{names[1]}', p1, r1, f1, s1, "
        "'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n, "
        "'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n, "
        "'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n"
        ") as (label, precision, recall, f1_score, support)")
    from shopmetrics.functions.core import half_up
    out = rows.select(stack)
    return out.select("label", half_up("precision", 4).alias("precision"), half_up("recall", 4).alias("recall"),
                      half_up("f1_score", 4).alias("f1_score"), F.col("support").cast("bigint").alias("support"))


def regression_metrics(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE, R^2 and MAPE (denominator max(actual, 1), in %), one agg."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    m = scored.agg(F.avg(F.abs(a - p)).alias("mae"), F.sqrt(F.avg((a - p) ** 2)).alias("rmse"),
                   F.sum((a - p) ** 2).alias("_ss_res"),
                   (F.var_pop(a) * F.count(F.lit(1))).alias("_ss_tot"),
                   F.avg(F.abs((a - p) / F.greatest(a, F.lit(1.0)))).alias("_mape"),
                   F.count(F.lit(1)).alias("n"))
    from shopmetrics.functions.core import half_up
    return m.select(
        F.col("n").cast("bigint").alias("n"),
        half_up("mae", 6).alias("mae"), half_up("rmse", 6).alias("rmse"),
        half_up(F.lit(1.0) - F.col("_ss_res") / F.col("_ss_tot"), 6).alias("r2"),
        half_up(F.col("_mape") * 100.0, 6).alias("mape"))


def grouped_auc(scored: DataFrame, group: str, score: str, label: str) -> DataFrame:
    """(group, auc): exact ROC AUC of every group, ties counted half, from one range sort.

    Counts by (group, score) are sorted over all groups at once; a partition's counts are
    moved up by what lies before it in its group, so no group is one task's work.
    """
    hit = F.col(label).cast("int")
    counts = scored.groupBy(F.col(group).alias("g"), F.col(score).alias("s")).agg(F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg"))
    sorted_counts = counts.repartitionByRange("g", "s").sortWithinPartitions("g", "s").withColumn("p", F.spark_partition_id()).checkpoint()
    parts = sorted_counts.groupBy("g", "p").agg(F.sum("neg").alias("n"))  # a row for each group a partition touches
    earlier = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("g", "p", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    here = Window.partitionBy("g", "p").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("before") + F.coalesce(F.sum("neg").over(here), F.lit(0)) + F.col("neg") / 2
    ranked = sorted_counts.join(parts, ["g", "p"]).select("g", "pos", "neg", (F.col("pos") * below).alias("won"))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.groupBy(F.col("g").alias(group)).agg((F.sum("won") / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def cv_auc(features: DataFrame, k: int = 5, feature_cols: list[str] | None = None,
           params: dict | None = None, seed: int = SEED) -> tuple[float, float, list[float]]:
    """k-fold stratified CV AUC (no oversampling, no early stop): mean and
    population std over folds.  The folds' fits share every pass over the rows."""
    cols = feature_cols or FEATURE_COLS
    p = replace(CHURN_PARAMS, **{"patience": None, "watch": "loss", "seed": seed, **(params or {})})
    data = with_folds(features, k, CUID, CHURN_TARGET, seed).select(CUID, *cols, CHURN_TARGET, "fold").checkpoint()
    models = boosting.fit(data, cols, CHURN_TARGET, "fold", CUID, list(range(k)), p)

    @F.pandas_udf("double")
    def held_out(fold: pd.Series, *columns: pd.Series) -> pd.Series:
        raw = [c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns]
        out = np.zeros(len(fold))
        for f in np.unique(fold):
            mine = (fold == f).to_numpy()
            out[mine] = models[int(f)].score_rows([c[mine] for c in raw])
        return pd.Series(out)

    scored = data.select("fold", CHURN_TARGET, held_out("fold", *[F.col(c).cast("double") for c in cols]).alias("score"))
    scores = [r["auc"] for r in grouped_auc(scored, "fold", "score", CHURN_TARGET).orderBy("fold").collect()]
    mean = sum(scores) / k
    std = math.sqrt(sum((s - mean) ** 2 for s in scores) / k)
    return mean, std, scores


def permutation_importance(model: boosting.Model, test: DataFrame, feature_cols: list[str],
                           seed: int = SEED) -> DataFrame:
    """AUC drop when one feature's values are shuffled across test rows.

    The shuffle pairs global rank by id with global rank by hash(id): one
    equi-join carries every permuted column.  Each row is scored with every permuted feature at
    once, and one grouped AUC ranks all of these scores."""
    base = test.select(CUID, CHURN_TARGET, *[F.col(c).cast("double").alias(c) for c in feature_cols])
    by_id, _ = global_rank(base, [F.col(CUID)], "_r")
    by_hash, _ = global_rank(base.withColumn("_h", hash01(CUID, seed + 3)), [F.col("_h"), F.col(CUID)], "_r")
    perm = by_hash.select("_r", *[F.col(c).alias(f"perm_{c}") for c in feature_cols])
    joined = by_id.join(perm, "_r")
    n = len(feature_cols)

    @F.pandas_udf("array<double>")
    def all_scores(*columns: pd.Series) -> pd.Series:
        raw = [c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns]
        own, other = raw[:n], raw[n:]
        scores = [model.score_rows(own)] + [model.score_rows([*own[:i], other[i], *own[i + 1:]]) for i in range(n)]
        return pd.Series(list(np.stack(scores, axis=1)))

    scores = all_scores(*feature_cols, *[f"perm_{c}" for c in feature_cols])
    scored = joined.select(CHURN_TARGET, F.posexplode(scores).alias("at", "score"))
    areas = grouped_auc(scored, "at", "score", CHURN_TARGET)
    whole = areas.filter("at = 0").select(F.col("auc").alias("whole"))  # one row
    name = F.element_at(F.array(*[F.lit(c) for c in feature_cols]), F.col("at"))
    return areas.filter("at > 0").join(F.broadcast(whole)).select(
        name.alias("feature"), (F.col("whole") - F.col("auc")).alias("permutation_auc_drop"))
