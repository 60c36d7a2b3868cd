"""Live-order stream on Structured Streaming.

Every transform is a pure ``DataFrame -> DataFrame`` function, so the same
code runs on a streaming DataFrame and on a batch "twin" (checked against
SQL).  The streaming runners add the sinks:

* source: Kafka topic (``startingOffsets=latest``; the checkpoint replaces
  consumer-group commits) or a folder of JSON-lines files;
* orders sink: Parquet, append, checkpointed -> exactly once across
  restarts (the reference could lose up to a buffer of events);
* dead letters: malformed messages go to their own sink instead of
  stopping the consumer;
* dashboard feed: the 6-field projection as JSON lines;
* running totals: a global aggregate in complete mode, written per
  micro-batch by an idempotent overwrite.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmetrics.functions.core import ntz_text
from shopmetrics.schema import LIVE_ORDER_JSON

TOPIC = "live_orders"
CORRUPT = "_corrupt_record"
# Fixed value: fields kept by the dashboard feed, in order.
DASHBOARD_FIELDS = ["order_id", "product_category", "order_value", "state", "payment_type", "timestamp"]
_DECODE_SCHEMA = T.StructType(LIVE_ORDER_JSON.fields + [T.StructField(CORRUPT, T.StringType())])


# ---- messages ------------------------------------------------------------------
def events_as_messages(events: DataFrame) -> DataFrame:
    """One live-order JSON message per driver event (``value`` string).

    freight_value is present only for events whose id is not a multiple of
    4; a NULL field is omitted from the JSON, so the key is missing."""
    k = F.col("event_id")
    payload = F.struct(
        k.cast("string").alias("order_id"),
        F.col("event_type").alias("product_category"),
        F.col("value").alias("order_value"),
        F.when(k % 4 != 0, F.floor("value").cast("double")).alias("freight_value"),
        ntz_text("ts", iso_t=True).alias("timestamp"))
    return events.select(F.to_json(payload).alias("value"))


def with_broken_messages(events: DataFrame, broken_type: str = "error") -> DataFrame:
    """Messages where every ``broken_type`` event was cut in half in
    transit (a producer fault), to exercise the dead-letter path."""
    k = F.col("event_id")
    js = F.to_json(F.struct(
        k.cast("string").alias("order_id"), F.col("event_type").alias("product_category"),
        F.col("value").alias("order_value"),
        F.when(k % 4 != 0, F.floor("value").cast("double")).alias("freight_value"),
        ntz_text("ts", iso_t=True).alias("timestamp")))
    cut = F.substring(js, 1, (F.length(js) / 2).cast("int"))
    return events.select(F.when(F.col("event_type") == broken_type, cut).otherwise(js).alias("value"))


# ---- N2 / N3: decode -------------------------------------------------------------
def decode_orders(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode and project the 8 stored fields; malformed rows keep their
    text in ``_corrupt_record``.

    ``order_value`` / ``freight_value`` default to 0 only when the key is
    missing; an explicit JSON null stays NULL (``dict.get`` semantics)."""
    v = F.col(value_col)
    parsed = F.from_json(v, _DECODE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    keys = F.json_object_keys(v)

    def keep_or_zero(name):
        return F.when(F.array_contains(F.col("_keys"), name), F.col(f"_m.{name}")).otherwise(F.lit(0.0))

    # not JSON, a field of another type, or a timestamp that cannot be read
    stamp = F.col("_m.timestamp").try_cast("timestamp_ntz")
    bad = (F.col("_keys").isNull() | F.col(f"_m.{CORRUPT}").isNotNull()
           | (F.col("_m.timestamp").isNotNull() & stamp.isNull()))
    return messages.select(v.alias("_raw"), parsed.alias("_m"), keys.alias("_keys")).select(
        F.col("_m.order_id").alias("order_id"),
        F.col("_m.product_category").alias("product_category"),
        keep_or_zero("order_value").cast("decimal(12,2)").alias("order_value"),
        keep_or_zero("freight_value").cast("decimal(12,2)").alias("freight_value"),
        F.col("_m.state").alias("state"),
        F.col("_m.payment_type").alias("payment_type"),
        F.col("_m.review_score").cast("int").alias("review_score"),
        stamp.alias("event_timestamp"),
        F.when(bad, F.col("_raw")).alias(CORRUPT))


def good_orders(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("message"))


# ---- N6 / N7 -------------------------------------------------------------------------
def dashboard_feed(orders: DataFrame) -> DataFrame:
    """The 6-field projection pushed to the dashboard."""
    return orders.select("order_id", "product_category", "order_value", "state", "payment_type",
                         F.col("event_timestamp").alias("timestamp"))


def dashboard_json(orders: DataFrame) -> DataFrame:
    return dashboard_feed(orders).select(F.to_json(F.struct(*DASHBOARD_FIELDS)).alias("value"))


def running_totals(orders: DataFrame) -> DataFrame:
    """Event count and total order value (global aggregate)."""
    return orders.agg(F.count(F.lit(1)).cast("bigint").alias("events"),
                      F.sum("order_value").alias("total_value"))


# ---- N1 / N4 / N5: streaming runners --------------------------------------------------
def message_stream(spark: SparkSession, source: str = "files", path: str | None = None,
                   options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame with one ``value`` string per message."""
    opts = dict(options or {})
    if source == "kafka":
        opts.setdefault("subscribe", TOPIC)
        opts.setdefault("startingOffsets", "latest")
        return spark.readStream.format("kafka").options(**opts).load().select(
            F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text").options(**opts)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def write_messages(messages: DataFrame, folder: str, files: int | None = None) -> str:
    """Land messages as JSON-lines text files (a file-source feed).

    By default one file per core of the cluster (``defaultParallelism``), so
    the landing write uses every executor and later micro-batches
    (``maxFilesPerTrigger``) split evenly."""
    n = files or max(messages.rdd.getNumPartitions(), messages.sparkSession.sparkContext.defaultParallelism)
    messages.repartition(n).write.mode("append").text(folder)
    return folder


def start_order_sinks(stream: DataFrame, orders_path: str, dead_letter_path: str, checkpoint_root: str,
                      dashboard_path: str | None = None, available_now: bool = True,
                      processing_time: str | None = None) -> list:
    """Start the append sink (N4, with ``received_at`` per micro-batch, N5),
    the dead-letter sink (N3) and optionally the dashboard feed (N6)."""
    decoded = decode_orders(stream)

    def _trigger(w):
        if available_now:
            return w.trigger(availableNow=True)
        return w.trigger(processingTime=processing_time or "10 seconds")

    orders = good_orders(decoded).withColumn("received_at", F.current_timestamp())
    queries = [
        _trigger(orders.writeStream.format("parquet").outputMode("append")
                 .option("checkpointLocation", f"{checkpoint_root}/orders")).start(orders_path),
        _trigger(dead_letters(decoded).writeStream.format("text").outputMode("append")
                 .option("checkpointLocation", f"{checkpoint_root}/dead_letters")).start(dead_letter_path),
    ]
    if dashboard_path:
        queries.append(_trigger(dashboard_json(good_orders(decoded)).writeStream.format("text")
                                .outputMode("append")
                                .option("checkpointLocation", f"{checkpoint_root}/dashboard"))
                       .start(dashboard_path))
    return queries


def start_running_totals(stream: DataFrame, out_path: str, checkpoint_root: str, available_now: bool = True):
    """N7: complete-mode global aggregate, each micro-batch overwrites one
    Parquet row (idempotent on replay)."""
    totals = running_totals(good_orders(decode_orders(stream)))

    def _write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    w = (totals.writeStream.outputMode("complete").foreachBatch(_write)
         .option("checkpointLocation", f"{checkpoint_root}/totals"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def await_all(queries: list, timeout_s: float | None = None) -> None:
    for q in queries:
        q.awaitTermination(timeout_s)
