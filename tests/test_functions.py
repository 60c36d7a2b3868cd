"""H-row helpers: whole days, month diff, rounding rules."""

import datetime as dt

from pyspark.sql import functions as F

from shopmetrics.functions.core import half_even, half_up, month_diff, ntz_text, whole_days


def test_whole_days_truncates_and_ignores_session_zone(spark):
    rows = [(dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 9, 23)),      # 8 days 23 hours -> 8
            (dt.datetime(2000, 10, 1), dt.datetime(2000, 10, 20)),       # spans a DST start
            (dt.datetime(2001, 1, 9, 23), dt.datetime(2001, 1, 1))]      # negative: toward zero
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(whole_days("b", "a")).collect()]
            assert got == [8, 19, -8], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_month_diff_and_text(spark):
    df = spark.createDataFrame([(dt.date(2019, 11, 1), dt.date(2020, 2, 1))], "a date, b date")
    assert df.select(month_diff("b", "a")).first()[0] == 3
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "t timestamp_ntz")
    assert ts.select(ntz_text("t", iso_t=True)).first()[0] == "2024-01-01T00:00:07.179575"


def test_rounding_rules(spark):
    import numpy as np
    vals = [1.005, 2.675, 0.125, 0.285, 1.115]
    df = spark.createDataFrame([tuple(vals)], ", ".join(f"v{i} double" for i in range(len(vals))))
    got = list(df.select(*[half_even(f"v{i}", 2) for i in range(len(vals))]).first())
    assert got == list(np.round(np.array(vals), 2))   # numpy rounding, bit for bit
    r = df.select(half_up("v0", 2), half_up(F.lit(-2.5), 0)).first()
    assert r[0] == 1.01            # SQL ROUND(numeric): half away from zero
    assert r[1] == -3.0
