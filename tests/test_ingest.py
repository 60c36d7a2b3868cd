"""A1-A15: CSV ingest, date coercion, dedupe, insert-ignore, sinks, audits."""

import os

import pytest
from pyspark.sql import functions as F

from shopmetrics.operators import quality
from shopmetrics.sources import ingest


def write(folder, name, text):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(text)


@pytest.fixture()
def raw_folder(tmp_dir):
    write(tmp_dir, "olist_customers_dataset.csv",
          "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
          "c1,u1,01001,sao paulo,SP\n"
          "c1,u9,99999,dup,XX\n"
          "c2,u1,02002,rio,RJ\n")
    write(tmp_dir, "olist_orders_dataset.csv",
          "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
          "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
          "o1,c1,delivered,2018-01-02 10:00:00,2018-01-02 11:00:00,garbage,,2018-01-20 00:00:00\n"
          "o2,c2,delivered,2018-02-03 00:00:00,2018-02-03 01:00:00,2018-02-04 00:00:00,"
          "2018-02-10 00:00:00,2018-02-20 00:00:00\n")
    write(tmp_dir, "extra_stuff.csv", "a,b_date\n1,2018-01-01\n2,nope\n")
    return tmp_dir


def test_ingest_folder_and_loads(spark, raw_folder):
    raw = ingest.load_raw_folder(spark, raw_folder)
    assert set(raw) == {"raw_customers", "raw_orders", "raw_extra_stuff"}
    extra = {r["a"]: r["b_date"] for r in raw["raw_extra_stuff"].collect()}
    assert extra["2"] is None and extra["1"] is not None  # name-driven coercion, bad -> NULL
    star = ingest.build_star(raw)
    cust = {r["customer_id"]: r for r in star["dim_customers"].collect()}
    assert cust["c1"]["zip_code"] == "01001"            # leading zero kept
    assert cust["c1"]["customer_unique_id"] == "u1"     # first row wins
    orders = {r["order_id"]: r for r in star["fact_orders"].collect()}
    assert orders["o1"]["delivered_carrier_date"] is None
    assert orders["o1"]["delivered_customer_date"] is None
    assert star["dim_date"].count() == 2


def test_no_csv_raises(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        ingest.list_raw_csv(spark, tmp_dir)


def test_strict_approved_cast_fails(spark, tmp_dir):
    write(tmp_dir, "olist_orders_dataset.csv",
          "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
          "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
          "o1,c1,delivered,2018-01-02 10:00:00,not-a-time,,,\n")
    star = ingest.build_star(ingest.load_raw_folder(spark, tmp_dir))
    with pytest.raises(Exception):
        star["fact_orders"].collect()


def test_insert_ignore(spark):
    target = spark.createDataFrame([("k1", "old")], "k string, v string")
    batch = spark.createDataFrame([("k1", "new", 1), ("k2", "first", 2), ("k2", "second", 3)],
                                  "k string, v string, seq int")
    out = ingest.insert_ignore_result(target, batch.select("k", "v", F.col("seq").alias(ingest.INGEST_SEQ)),
                                      ["k"]).drop(ingest.INGEST_SEQ)
    assert sorted(tuple(r) for r in out.collect()) == [("k1", "old"), ("k2", "first")]


def test_sink_overwrite_is_idempotent(spark, tmp_dir):
    df = spark.range(10)
    path = os.path.join(tmp_dir, "sink")
    ingest.sink_overwrite(df, path)
    ingest.sink_overwrite(df, path)
    assert spark.read.parquet(path).count() == 10


def test_audits_find_dirt(spark):
    from tests.fixtures import cust, order, review, star
    st = star(spark, [cust("c1", "u1", state="SPX"), cust("c1", "u2")],
              [order("o1", "c1", "2020-01-01"), order("o2", "cX", "2020-01-02")],
              reviews=[review("r1", "o1", 0), review("r2", "o1", 6), review("r3", "oX", 5),
                       review(None, "o1", 3)])
    tables = {t: st.table(t) for t in ["dim_customers", "fact_orders", "fact_reviews", "dim_date"]}
    pk = {r["table_name"]: r for r in quality.audit_primary_keys(tables).collect()}
    assert pk["dim_customers"]["duplicate_keys"] == 1 and pk["fact_reviews"]["null_keys"] == 1
    fk = {(r["child_table"], r["child_column"]): r["orphan_rows"] for r in quality.audit_foreign_keys(tables).collect()}
    assert fk[("fact_orders", "customer_id")] == 1 and fk[("fact_reviews", "order_id")] == 1
    dom = {(r["table_name"], r["rule"]): r["violations"] for r in quality.audit_domains(tables).collect()}
    assert dom[("fact_reviews", "between_1_5")] == 2 and dom[("dim_customers", "max_length_2")] == 1


def test_composite_keys_and_decimal_fit(spark):
    lines = spark.createDataFrame([("o1", 1), ("o1", 2), ("o1", 2), ("o1", None), (None, None), ("o2", 1)],
                                  "order_id string, order_item_id int")
    row = quality.audit_primary_keys({"lines": lines}, {"lines": ["order_id", "order_item_id"]}).first()
    assert (row["key_column"], row["rows"], row["null_keys"], row["duplicate_keys"], row["duplicate_rows"]) == (
        "order_id, order_item_id", 6, 2, 1, 1)
    products = spark.createDataFrame(
        [("p1", None, 1e8, 9999.99, 1e4, None), ("p2", "x", 99999999.0, -1e4, None, 2.0)],
        "product_id string, category_name_english string, weight_g double, length_cm double, height_cm double, width_cm double")
    dom = {r["column_name"]: r["violations"] for r in quality.audit_domains({"dim_products": products}).collect()
           if r["rule"].startswith("fits")}
    assert dom == {"weight_g": 1, "length_cm": 1, "height_cm": 1, "width_cm": 0}


def test_quoted_line_breaks_and_doubled_quotes_stay_one_row(spark, tmp_dir):
    write(tmp_dir, "olist_order_reviews_dataset.csv",
          "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
          "review_answer_timestamp\n"
          'r1,o1,5,ok,"first line\nsecond ""line""",2018-01-01 00:00:00,2018-01-02 00:00:00\n'
          "r2,o2,4,,,2018-01-03 00:00:00,2018-01-04 00:00:00\n")
    path = os.path.join(tmp_dir, "olist_order_reviews_dataset.csv")
    df = ingest.read_raw_csv(spark, path, "raw_reviews")
    rows = {r["review_id"]: r for r in df.collect()}
    assert set(rows) == {"r1", "r2"}
    assert rows["r1"]["review_comment_message"] == 'first line\nsecond "line"'
    assert ingest.malformed_rows(spark, path, "raw_reviews").count() == 0


def test_malformed_rows_are_found(spark, tmp_dir):
    write(tmp_dir, "odd.csv", "a,b\n1,2\n3,4,5\n6,7\n")
    assert ingest.malformed_rows(spark, os.path.join(tmp_dir, "odd.csv")).count() == 1


def test_first_row_wins_over_part_files_of_any_size(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "olist_customers_dataset.csv")
    os.makedirs(folder)
    head = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    write(folder, "part-0.csv", head + "c1,FIRST,01001,sp,SP\n")
    write(folder, "part-1.csv", head + "c1,SECOND,01001,sp,SP\n" + "".join(f"x{i},u{i},01001,sp,SP\n" for i in range(5000)))
    raw = ingest.read_raw_csv(spark, folder, "raw_customers")
    got = ingest.first_per_key(raw, ["customer_id"]).where("customer_id = 'c1'").first()
    assert got["customer_unique_id"] == "FIRST"
