"""Registration of the RFM, bucketing, feature, EDA, load, audit, model and
streaming query families."""

from __future__ import annotations

import hashlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from shopmetrics.functions.core import half_even, half_up
from shopmetrics.operators.bucketing import buckets, cut_fixed_expr
from shopmetrics.operators.selection import Order, ntile_starts
from shopmetrics.plans import features as feat
from shopmetrics.plans import rfm
from shopmetrics.plans.common import payments_per_order
from shopmetrics.plans.oracle_rfm import ORACLE as RFM_SQL
from shopmetrics.plans.registry import register
from shopmetrics.session import ensure_checkpoint_dir, scratch_path
from shopmetrics.sources.binding import star


def _st(spark, sf_dir):
    return star(spark, sf_dir)


# ---- RFM (D7, E1, I1, I2, J8, H4) -----------------------------------------
@register("order_totals", RFM_SQL["order_totals"])
def _order_totals(spark, sf_dir):
    ot = rfm.order_totals(_st(spark, sf_dir))
    return ot.select("order_id", "customer_unique_id", "purchase_date", half_up("order_value", 2).alias("order_value"))


@register("rfm_raw", RFM_SQL["rfm_raw"])
def _rfm_raw(spark, sf_dir):
    return rfm.rfm_raw(_st(spark, sf_dir)).drop("monetary_dec")


_SCORED_COLS = ["customer_unique_id", "recency_days", "frequency", "monetary", "avg_order_value",
                "max_order_value", "last_purchase", "first_purchase", "r_score", "f_score", "m_score"]


@register("rfm_scored", RFM_SQL["rfm_scored"])
def _rfm_scored(spark, sf_dir):
    return rfm.rfm_scored(_st(spark, sf_dir)).select(*_SCORED_COLS)


@register("rfm_segments_sql", RFM_SQL["rfm_segments_sql"])
def _rfm_segments_sql(spark, sf_dir):
    return rfm.rfm_segments_sql(_st(spark, sf_dir))


@register("rfm_top_customers", RFM_SQL["rfm_top_customers"])
def _rfm_top(spark, sf_dir):
    return rfm.rfm_top_customers(_st(spark, sf_dir))


@register("rfm_segment_summary", RFM_SQL["rfm_segment_summary"])
def _rfm_summary(spark, sf_dir):
    return rfm.rfm_segment_summary(_st(spark, sf_dir))


@register("ntile_distributed", RFM_SQL["ntile_distributed"])
def _ntile_distributed(spark, sf_dir):
    ov = payments_per_order(_st(spark, sf_dir)).select("order_id", F.col("pay_sum").alias("v"))
    ensure_checkpoint_dir(spark)
    out = buckets(ov.checkpoint(), {"decile": (Order("v", id="order_id"), ntile_starts(10))})
    return out.select("order_id", half_up("v", 2).alias("order_value"), "decile")


@register("recency_days", RFM_SQL["recency_days"])
def _recency_days(spark, sf_dir):
    return feat.recency_days(_st(spark, sf_dir))


# ---- features (J1-J7) ---------------------------------------------------------
_FEATURE_OUT = ["customer_unique_id", "recency_days", "frequency", "monetary", "avg_order_value",
                "max_order_value", "min_order_value", "std_order_value", "last_purchase_date",
                "first_purchase_date", "review_count", "avg_review_score", "unique_categories",
                "customer_age_days", "orders_per_month", "revenue_per_day", "churned"]


_BUILT: dict = {}


def _fingerprint(spark, sf_dir: str) -> tuple:
    """Names, sizes and times of the tables in a data folder and of the files in them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    tables = list(fs.listStatus(path))
    files = [f for t in tables if t.isDirectory() for f in fs.listStatus(t.getPath())]
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in tables + files))


def _built(kind: str, spark, sf_dir, build):
    """Build once per session and state of the data folder: the feature table, its quantile
    segments and the training runs feed a dozen keys.  Only the latest state is kept: tables
    that were written anew are computed anew, and what the old ones pinned is released.
    The session object is stored and compared, so a new session that happens
    to reuse an old one's id never sees stale DataFrames."""
    now = (sf_dir, _fingerprint(spark, sf_dir))
    hit = _BUILT.get(kind)
    if hit is None or hit[0] is not spark or hit[1] != now:
        ensure_checkpoint_dir(spark)
        hit = _BUILT[kind] = (spark, now, build())
    return hit[2]


def features_df(spark, sf_dir):
    return _built("features", spark, sf_dir,
                  lambda: feat.feature_matrix(_st(spark, sf_dir)).select(*_FEATURE_OUT).checkpoint())


def segments_df(spark, sf_dir):
    return _built("segments", spark, sf_dir, lambda: feat.rfm_segments_features(features_df(spark, sf_dir)).checkpoint())


@register("rfm_feature_base", RFM_SQL["rfm_feature_base"])
def _feature_base(spark, sf_dir):
    return feat.rfm_feature_base(_st(spark, sf_dir))


@register("review_features", RFM_SQL["review_features"])
def _review_features(spark, sf_dir):
    return feat.review_features(_st(spark, sf_dir))


@register("category_features", RFM_SQL["category_features"])
def _category_features(spark, sf_dir):
    return feat.category_features(_st(spark, sf_dir))


@register("feature_matrix", RFM_SQL["feature_matrix"])
def _feature_matrix(spark, sf_dir):
    return features_df(spark, sf_dir)


@register("churn_label_quantile", RFM_SQL["churn_label_quantile"])
def _churn_label(spark, sf_dir):
    return features_df(spark, sf_dir).select("customer_unique_id", "recency_days", "churned")


@register("churn_baseline", RFM_SQL["churn_baseline"])
def _churn_baseline(spark, sf_dir):
    return feat.churn_baseline(_st(spark, sf_dir))


@register("rfm_segments_features", RFM_SQL["rfm_segments_features"])
def _rfm_segments_features(spark, sf_dir):
    return segments_df(spark, sf_dir).select("customer_unique_id", "recency_days", "frequency", "monetary",
                                             "r_score", "f_score", "m_score", "rfm_segment")


@register("qcut_rank", RFM_SQL["qcut_rank"])
def _qcut_rank(spark, sf_dir):
    return segments_df(spark, sf_dir).select("customer_unique_id", "frequency", "f_score")


@register("qcut_values", RFM_SQL["qcut_values"])
def _qcut_values(spark, sf_dir):
    return segments_df(spark, sf_dir).select("customer_unique_id", "recency_days", "r_score")


@register("churn_label_bins", RFM_SQL["churn_label_bins"])
def _churn_label_bins(spark, sf_dir):
    ch = _st(spark, sf_dir).ml_churn_predictions
    prob = F.col("churn_probability")
    return ch.select("customer_unique_id", prob.cast("double").alias("churn_probability"),
                     cut_fixed_expr(prob, [0.0, 0.33, 0.66, 1.0], ["Low", "Medium", "High"],
                                    lowest_label="Low").alias("churn_label"))


@register("segment_churn_stats", RFM_SQL["segment_churn_stats"])
def _segment_churn_stats(spark, sf_dir):
    seg = segments_df(spark, sf_dir)
    agg = seg.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).cast("bigint").alias("customers"),
        F.avg("monetary").alias("_m"), F.avg("recency_days").alias("_r"), F.avg("churned").alias("_c"))
    total = F.sum("customers").over(Window.partitionBy())  # <= 8 aggregated rows
    return agg.select("rfm_segment", "customers", half_even("_m", 2).alias("avg_monetary"),
                      half_even("_r", 2).alias("avg_recency"), half_even("_c", 2).alias("churn_rate"),
                      half_even(F.col("customers") * 100.0 / total, 1).alias("pct_customers")
                      ).orderBy(F.desc("avg_monetary"))


# ---- EDA (L1-L12, B6, D10) ---------------------------------------------------
from shopmetrics.plans import eda  # noqa: E402
from shopmetrics.plans.oracle_eda import ORACLE as EDA_SQL  # noqa: E402

for _name in ["order_status_counts", "eda_revenue_totals", "order_values", "order_value_describe",
              "order_value_trim_p99", "order_value_histogram", "order_value_boxplot", "eda_top_categories",
              "review_score_distribution", "review_score_summary", "eda_state_top12"]:
    register(_name, EDA_SQL.get(_name))(
        (lambda fn: lambda spark, sf_dir: fn(_st(spark, sf_dir)))(getattr(eda, _name)))


@register("eda_monthly_revenue", EDA_SQL["eda_monthly_revenue"])
def _eda_monthly(spark, sf_dir):
    return eda.eda_monthly_revenue(_st(spark, sf_dir)).drop("_rev")


@register("monetary_describe", EDA_SQL["monetary_describe"])
def _monetary_describe(spark, sf_dir):
    return eda.monetary_describe(features_df(spark, sf_dir))


@register("monetary_trim_p95", EDA_SQL["monetary_trim_p95"])
def _monetary_trim(spark, sf_dir):
    return eda.monetary_trim_p95(features_df(spark, sf_dir))


@register("monetary_histograms", EDA_SQL["monetary_histograms"])
def _monetary_hist(spark, sf_dir):
    return eda.monetary_histograms(features_df(spark, sf_dir))


@register("feature_histograms_by_class", EDA_SQL["feature_histograms_by_class"])
def _feature_hist(spark, sf_dir):
    return eda.feature_histograms_by_class(features_df(spark, sf_dir))


# ---- loads, scans, audits (A1-A15), joins/aggregates (C1, D1), H15 ----------
from shopmetrics.operators import quality  # noqa: E402
from shopmetrics.plans import loads  # noqa: E402
from shopmetrics.plans.oracle_loads import ORACLE as LOAD_SQL  # noqa: E402
from shopmetrics.plans.oracle_rfm import FEATURES_CTES  # noqa: E402
from shopmetrics.schema import STAR_TABLES  # noqa: E402
from shopmetrics.sources import ingest  # noqa: E402


def _loaded(spark, sf_dir):
    return loads.star_from_driver(_st(spark, sf_dir))


@register("ingest_raw_csv", LOAD_SQL["table_row_counts"])
def _ingest_raw_csv(spark, sf_dir):
    return loads.ingest_raw_csv(spark, _st(spark, sf_dir))


@register("coerce_dates", LOAD_SQL["coerce_dates"])
def _coerce_dates(spark, sf_dir):
    return loads.raw_from_driver(_st(spark, sf_dir))["raw_orders"].drop(ingest.INGEST_SEQ)


for _t in ["dim_customers", "dim_sellers", "dim_date", "fact_orders", "fact_reviews"]:
    register(_t, LOAD_SQL[_t])((lambda t: lambda spark, sf_dir: _loaded(spark, sf_dir)[t])(_t))


@register("dim_products", LOAD_SQL["dim_products"], as_double=["weight_g", "length_cm", "height_cm", "width_cm"])
def _dim_products(spark, sf_dir):
    return _loaded(spark, sf_dir)["dim_products"]


@register("fact_order_items", LOAD_SQL["fact_order_items"], as_double=["price", "freight_value"])
def _fact_order_items(spark, sf_dir):
    return _loaded(spark, sf_dir)["fact_order_items"].drop("item_id")


@register("fact_payments", LOAD_SQL["fact_payments"], as_double=["payment_value"])
def _fact_payments(spark, sf_dir):
    return _loaded(spark, sf_dir)["fact_payments"].drop("payment_id")


@register("insert_ignore", LOAD_SQL["insert_ignore"])
def _insert_ignore(spark, sf_dir):
    return loads.insert_ignore_reviews(_st(spark, sf_dir))


@register("sink_overwrite", "SELECT * FROM fact_orders")
def _sink_overwrite(spark, sf_dir):
    return loads.sink_overwrite_roundtrip(spark, _st(spark, sf_dir))


@register("orders_scan", LOAD_SQL["orders_scan"])
def _orders_scan(spark, sf_dir):
    return _st(spark, sf_dir).fact_orders.select("order_id", "order_status", "purchase_date")


def _star_tables(spark, sf_dir):
    st = _st(spark, sf_dir)
    return {t: st.table(t) for t in STAR_TABLES}


@register("table_row_counts", LOAD_SQL["table_row_counts"])
def _table_row_counts(spark, sf_dir):
    return ingest.table_row_counts(_star_tables(spark, sf_dir))


@register("audit_primary_keys", LOAD_SQL["audit_primary_keys"])
def _audit_pk(spark, sf_dir):
    return quality.audit_primary_keys(_star_tables(spark, sf_dir))


@register("audit_foreign_keys", LOAD_SQL["audit_foreign_keys"])
def _audit_fk(spark, sf_dir):
    return quality.audit_foreign_keys(_star_tables(spark, sf_dir))


@register("audit_domains", LOAD_SQL["audit_domains"])
def _audit_domains(spark, sf_dir):
    return quality.audit_domains(_star_tables(spark, sf_dir))


@register("join_order_customer_payment", LOAD_SQL["join_order_customer_payment"])
def _join_ocp(spark, sf_dir):
    st = _st(spark, sf_dir)
    o = st.fact_orders.where(F.col("order_status") == "delivered").select("order_id", "customer_id", "purchase_date")
    c = st.dim_customers.select("customer_id", "customer_unique_id", "state")
    p = st.fact_payments.select("order_id", "payment_sequential", "payment_type",
                                F.col("payment_value").cast("double").alias("payment_value"))
    return o.join(c, "customer_id").join(p, "order_id").drop("customer_id")


@register("agg_basic", LOAD_SQL["agg_basic"])
def _agg_basic(spark, sf_dir):
    i = _st(spark, sf_dir).fact_order_items
    return i.groupBy("seller_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("items"),
        F.count("product_id").cast("bigint").alias("items_with_product"),
        half_up(F.sum("price"), 2).alias("total_price"), half_up(F.avg("price"), 2).alias("avg_price"),
        half_up(F.min("price"), 2).alias("min_price"), half_up(F.max("price"), 2).alias("max_price"))


@register("clv_log_target", f"WITH {FEATURES_CTES} {LOAD_SQL['clv_log_target']}")
def _clv_log_target(spark, sf_dir):
    f = features_df(spark, sf_dir)
    log_m = F.log1p("monetary")
    return f.select("customer_unique_id", "monetary",
                    F.round(log_m.cast("decimal(38,9)"), 9).cast("double").alias("log_monetary"),
                    half_up(F.greatest(F.expm1(log_m), F.lit(0.0)), 2).alias("back_transformed"))


# ---- models (M1-M14) -------------------------------------------------------------
from shopmetrics.plans import modeling as ml  # noqa: E402
from shopmetrics.plans import training  # noqa: E402
from shopmetrics.plans.oracle_models import ORACLE as MODEL_SQL  # noqa: E402

def churn_rows(spark, sf_dir):
    return _built("churn_rows", spark, sf_dir, lambda: training.churn_rows(features_df(spark, sf_dir)))


def churn_run(spark, sf_dir):
    return _built("churn", spark, sf_dir, lambda: training.churn_training(
        features_df(spark, sf_dir), rows=churn_rows(spark, sf_dir)))


def clv_run(spark, sf_dir):
    return _built("clv", spark, sf_dir, lambda: training.clv_training(features_df(spark, sf_dir)))


@register("stratified_split", MODEL_SQL["stratified_split"])
def _stratified_split(spark, sf_dir):
    sp = ml.split(features_df(spark, sf_dir), label=feat.CHURN_TARGET)
    return sp.select("customer_unique_id", feat.CHURN_TARGET, "split")


@register("random_split", MODEL_SQL["random_split"])
def _random_split(spark, sf_dir):
    return ml.split(features_df(spark, sf_dir), label=None).select("customer_unique_id", "split")


@register("smote_oversample")
def _smote(spark, sf_dir):
    return churn_rows(spark, sf_dir)["over"]


@register("churn_scores")
def _churn_scores(spark, sf_dir):
    run = churn_run(spark, sf_dir)
    return ml.churn_probability(run["model"], run["test"]).select(
        "customer_unique_id", feat.CHURN_TARGET, "churn_probability", F.col("prediction").cast("int"))


def _bound_churn_scored(spark, sf_dir):
    f = features_df(spark, sf_dir).select("customer_unique_id", feat.CHURN_TARGET)
    p = _st(spark, sf_dir).ml_churn_predictions.select(
        "customer_unique_id", F.col("churn_probability").cast("double").alias("score"),
        F.when(F.col("churn_probability") >= 0.5, 1).otherwise(0).alias("pred"))
    return f.join(p, "customer_unique_id")


@register("binary_auc", MODEL_SQL["binary_auc"])
def _binary_auc(spark, sf_dir):
    scored = _bound_churn_scored(spark, sf_dir).withColumn("one", F.lit(1))
    counts = scored.groupBy("one").agg(F.sum(feat.CHURN_TARGET).cast("bigint").alias("n_pos"),
                                       (F.count(F.lit(1)) - F.sum(feat.CHURN_TARGET)).cast("bigint").alias("n_neg"))
    area = ml.grouped_auc(scored, "one", "score", feat.CHURN_TARGET)
    return counts.join(area, "one").select(half_up("auc", 6).alias("auc"), "n_pos", "n_neg")


@register("confusion_matrix", MODEL_SQL["confusion_matrix"])
def _confusion(spark, sf_dir):
    return ml.confusion_matrix(_bound_churn_scored(spark, sf_dir), feat.CHURN_TARGET, "pred")


@register("classification_report", MODEL_SQL["classification_report"])
def _class_report(spark, sf_dir):
    return ml.classification_report(_bound_churn_scored(spark, sf_dir), feat.CHURN_TARGET, "pred")


@register("churn_cv_auc")
def _cv_auc(spark, sf_dir):
    mean, std, folds = ml.cv_auc(features_df(spark, sf_dir))
    return spark.createDataFrame([(round(mean, 4), round(std, 4), len(folds))],
                                 "cv_auc_mean double, cv_auc_std double, folds int")


@register("clv_scores")
def _clv_scores(spark, sf_dir):
    run = clv_run(spark, sf_dir)
    return ml.clv_predict(run["model"], run["test"]).select("customer_unique_id", "monetary", "predicted_clv")


@register("regression_metrics", MODEL_SQL["regression_metrics"])
def _regression_metrics(spark, sf_dir):
    f = features_df(spark, sf_dir).select("customer_unique_id", "monetary")
    p = _st(spark, sf_dir).ml_clv_predictions.select(
        "customer_unique_id", F.greatest(F.col("predicted_clv").cast("double"), F.lit(0.0)).alias("pred"))
    return ml.regression_metrics(f.join(p, "customer_unique_id"), "monetary", "pred")


@register("clv_tiers", MODEL_SQL["clv_tiers"])
def _clv_tiers(spark, sf_dir):
    v = _st(spark, sf_dir).ml_clv_predictions.select(
        "customer_unique_id", F.col("predicted_clv").cast("double").alias("predicted_clv"))
    return v.withColumn("clv_segment", training.clv_tiers_expr(v, "predicted_clv"))


def _write_read(spark, df, name):
    path = scratch_path(spark, name)
    ingest.sink_overwrite(df, path)
    return spark.read.parquet(path)


@register("ml_churn_predictions")
def _ml_churn_predictions(spark, sf_dir):
    return _write_read(spark, training.churn_predictions(churn_run(spark, sf_dir)), "ml_churn_predictions")


@register("ml_clv_predictions")
def _ml_clv_predictions(spark, sf_dir):
    return _write_read(spark, training.clv_predictions(clv_run(spark, sf_dir)), "ml_clv_predictions")


@register("feature_importance")
def _feature_importance(spark, sf_dir):
    run = churn_run(spark, sf_dir)
    imp = spark.createDataFrame(list(run["model"].importances().items()), "feature string, importance double")
    perm = ml.permutation_importance(run["model"], run["test"], feat.FEATURE_COLS)
    return imp.join(perm, "feature")


@register("prediction_sample")
def _prediction_sample(spark, sf_dir):
    run = clv_run(spark, sf_dir)
    pred = ml.clv_predict(run["model"], run["test"])
    return (pred.orderBy(F.xxhash64("customer_unique_id", F.lit(ml.SEED)), "customer_unique_id").limit(2000)
            .select("customer_unique_id", F.col("monetary").alias("actual_clv"), "predicted_clv"))


@register("model_metrics")
def _model_metrics(spark, sf_dir):
    """This state of the data is one run: asked again, it replaces its own rows in the session's ledger."""
    churn, clv = churn_run(spark, sf_dir), clv_run(spark, sf_dir)
    run_id = hashlib.sha256(repr((sf_dir, _fingerprint(spark, sf_dir))).encode()).hexdigest()[:16]
    ledger = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-metrics"
    recorded = training.record_metrics(spark, training.model_metrics(churn, clv), ledger, run_id)
    return recorded.filter(F.col("run_id") == run_id).select("model", "metric", "value", "recorded_at")


# ---- streaming (N1-N7) ------------------------------------------------------------------
from shopmetrics.plans.oracle_streams import ORACLE as STREAM_SQL  # noqa: E402
from shopmetrics.streaming import live_orders as live  # noqa: E402


def _events(spark, sf_dir):
    return _st(spark, sf_dir).raw("events")


@register("stream_decode_orders", STREAM_SQL["stream_decode_orders"], as_double=["order_value", "freight_value"])
def _stream_decode(spark, sf_dir):
    return live.good_orders(live.decode_orders(live.events_as_messages(_events(spark, sf_dir))))


@register("stream_dashboard_feed", STREAM_SQL["stream_dashboard_feed"], as_double=["order_value"])
def _stream_dashboard(spark, sf_dir):
    return live.dashboard_feed(_stream_decode(spark, sf_dir))


@register("stream_running_totals", STREAM_SQL["stream_running_totals"])
def _stream_totals(spark, sf_dir):
    t = live.running_totals(_stream_decode(spark, sf_dir))
    return t.select("events", half_up("total_value", 2).alias("total_value"))


def _stream_run(spark, sf_dir, broken: bool):
    """Land the derived message feed as files, then drain it through the
    streaming sinks with an availableNow trigger (several micro-batches)."""
    ev = _events(spark, sf_dir)
    msgs = live.with_broken_messages(ev) if broken else live.events_as_messages(ev)
    root = scratch_path(spark, "live-orders")
    live.write_messages(msgs, f"{root}/in")
    stream = live.message_stream(spark, "files", f"{root}/in", max_files_per_trigger=2)
    live.await_all(live.start_order_sinks(stream, f"{root}/orders", f"{root}/dead", f"{root}/_chk",
                                          dashboard_path=f"{root}/dashboard"))
    return root


@register("stream_source", STREAM_SQL["stream_source"])
def _stream_source(spark, sf_dir):
    root = scratch_path(spark, "live-source")
    live.write_messages(live.events_as_messages(_events(spark, sf_dir)), f"{root}/in")
    q = (live.message_stream(spark, "files", f"{root}/in", max_files_per_trigger=2)
         .writeStream.format("parquet").option("checkpointLocation", f"{root}/_chk")
         .trigger(availableNow=True).start(f"{root}/out"))
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register("stream_append_orders", STREAM_SQL["stream_append_orders"], as_double=["order_value", "freight_value"])
def _stream_append(spark, sf_dir):
    """The rows the streaming sink appended (its ``received_at`` ingestion
    stamp is a wall-clock value, left out of the comparison)."""
    root = _stream_run(spark, sf_dir, broken=False)
    return spark.read.parquet(f"{root}/orders").drop("received_at")


@register("stream_dead_letter", STREAM_SQL["stream_dead_letter"])
def _stream_dead(spark, sf_dir):
    root = _stream_run(spark, sf_dir, broken=True)
    return spark.read.text(f"{root}/dead").withColumnRenamed("value", "message")
