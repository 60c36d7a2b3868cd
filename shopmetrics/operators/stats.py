"""Distribution summaries as Spark jobs (describe, equal-width histograms,
box-plot statistics, share of total).

Only scalars (quantiles, min/max) and bin counts reach the driver; every
pass over the rows is an aggregation on the executors.  Quantiles come from
``selection``: sketches narrow them down, exact counts decide, at any row
count.  Pass materialised frames: these functions read them several times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmetrics.functions.core import half_even, half_up
from shopmetrics.operators.selection import linear_quantiles


def describe(df: DataFrame, col: str, ndigits: int = 2) -> DataFrame:
    """pandas ``Series.describe().round(n)``: count, mean, std, min, 25%,
    50%, 75%, max (sample std; linear quantiles)."""
    q25, q50, q75 = linear_quantiles(df, {col: [0.25, 0.5, 0.75]})[col]
    x = F.col(col)
    agg = df.agg(F.count(x).cast("bigint").alias("count"), F.avg(x).alias("_mean"),
                 F.stddev_samp(x.cast("double")).alias("_std"), F.min(x).alias("_min"), F.max(x).alias("_max"))
    return agg.select(
        "count",
        half_even("_mean", ndigits).alias("mean"),
        half_even("_std", ndigits).alias("std"),
        half_even("_min", ndigits).alias("min"),
        half_even(F.lit(q25), ndigits).alias("p25"),
        half_even(F.lit(q50), ndigits).alias("p50"),
        half_even(F.lit(q75), ndigits).alias("p75"),
        half_even("_max", ndigits).alias("max"))


def trim_at_quantile(df: DataFrame, col: str, q: float) -> DataFrame:
    """Rows with ``col <= quantile(col, q)`` (p99 / p95 trims)."""
    cut = linear_quantiles(df, {col: [q]})[col][0]
    return df.where(F.col(col).cast("double") <= F.lit(cut))


def bin_index(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin of x in [lo, hi]; the last bin is closed."""
    span = hi - lo
    if span == 0:
        return F.lit(0)
    return F.least(F.floor((x.cast("double") - F.lit(lo)) / F.lit(span) * F.lit(bins)).cast("int"),
                   F.lit(bins - 1))


def histogram(df: DataFrame, col: str, bins: int, label: str | None = None) -> DataFrame:
    """numpy-style histogram over [min, max]: bin, bin_start, bin_end, count
    (every bin present, empty ones with 0)."""
    mm = df.agg(F.min(F.col(col).cast("double")).alias("lo"), F.max(F.col(col).cast("double")).alias("hi")).first()
    spark = df.sparkSession
    if mm is None or mm["lo"] is None:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, count bigint")
    lo, hi = float(mm["lo"]), float(mm["hi"])
    counts = (df.where(F.col(col).isNotNull())
              .groupBy(bin_index(F.col(col), lo, hi, bins).alias("bin"))
              .agg(F.count(F.lit(1)).cast("bigint").alias("count")))
    # the bin frame is a fixed-size range: broadcasting it is size-bounded
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    out = (F.broadcast(all_bins).join(counts, "bin", "left")
           .select("bin",
                   half_up(F.lit(lo) + F.col("bin") * F.lit(width), 6).alias("bin_start"),
                   half_up(F.lit(lo) + (F.col("bin") + 1) * F.lit(width), 6).alias("bin_end"),
                   F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))
    if label is not None:
        out = out.select(F.lit(label).alias("kind"), *out.columns)
    return out


def boxplot_stats(df: DataFrame, col: str, whis: float = 1.5) -> DataFrame:
    """matplotlib box-plot statistics: quartiles, whiskers at the most extreme
    values within ``whis * IQR``, and the outlier count."""
    q1, med, q3 = linear_quantiles(df, {col: [0.25, 0.5, 0.75]})[col]
    iqr = q3 - q1
    lo_fence, hi_fence = q1 - whis * iqr, q3 + whis * iqr
    x = F.col(col).cast("double")
    agg = df.agg(
        F.count(x).cast("bigint").alias("n"),
        F.min(F.when(x >= lo_fence, x)).alias("whisker_low"),
        F.max(F.when(x <= hi_fence, x)).alias("whisker_high"),
        F.sum(F.when((x < lo_fence) | (x > hi_fence), 1).otherwise(0)).cast("bigint").alias("outliers"))
    return agg.select(
        "n",
        half_up(F.lit(q1), 4).alias("q1"), half_up(F.lit(med), 4).alias("median"),
        half_up(F.lit(q3), 4).alias("q3"), half_up(F.lit(iqr), 4).alias("iqr"),
        half_up("whisker_low", 4).alias("whisker_low"), half_up("whisker_high", 4).alias("whisker_high"),
        F.coalesce("outliers", F.lit(0)).cast("bigint").alias("outliers"))


def grouped_density_histograms(long_df: DataFrame, group_cols: list[str], value_col: str,
                               bins: int) -> DataFrame:
    """Per-group equal-width density histograms (each group its own range).

    Every bin of every group is present, empty ones with 0.  The per-group
    ranges are one row per group (groups are few: a feature and a class), so
    they are broadcast and rows never gather on a group key."""
    v = F.col(value_col).cast("double")
    rng = long_df.groupBy(*group_cols).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"),
                                           F.count(v).alias("_n"))
    span = F.col("_hi") - F.col("_lo")
    b = F.when(span == 0, F.lit(0)).otherwise(
        F.least(F.floor((v - F.col("_lo")) / span * F.lit(bins)).cast("int"), F.lit(bins - 1)))
    counts = (long_df.where(v.isNotNull()).join(F.broadcast(rng), group_cols)
              .groupBy(*group_cols, b.alias("bin")).agg(F.count(F.lit(1)).cast("bigint").alias("count")))
    width = F.when(span == 0, F.lit(1.0)).otherwise(span / bins)
    every = rng.where("_n > 0").withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    counts = counts.withColumnRenamed("count", "_count")
    return (every.join(counts, [*group_cols, "bin"], "left")
            .withColumn("count", F.coalesce("_count", F.lit(0)).cast("bigint"))
            .select(*group_cols, "bin",
                    (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
                    "count",
                    (F.col("count") / (F.col("_n") * width)).alias("density")))
