"""Two-sample drift tests on all numeric columns at once."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import clip_low
from millrace.operators.quantiles import (
    bin_index, exact_percentiles, select_percentiles, tag_buckets, to_long,
)

# fixed values: severity limits of the stability index
PSI_SLIGHT = 0.1
PSI_SIGNIFICANT = 0.2
PSI_LEVELS = ("none", "slight", "significant")

# where one series of the limit distribution takes over from the other, and the terms used of each
SERIES_MEET = 1.18
SERIES_TERMS = 6

# the exact distribution takes time in proportion to the product of the sample sizes
EXACT_P_VALUE_ROWS = 10_000


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [c for c, t in df.dtypes if t in kinds or t.startswith("decimal")]


def _both(reference, current, columns):
    sides = [to_long(df.select(*columns), columns).withColumn("is_ref", F.lit(flag))
             for df, flag in ((reference, True), (current, False))]
    return sides[0].unionByName(sides[1])


def _side_counts(tagged):
    return tagged.groupBy("feature", "bucket").agg(
        F.count_if("is_ref").alias("r"), F.count_if(~F.col("is_ref")).alias("c"))


def ks_statistic(reference: DataFrame, current: DataFrame, columns,
                 buckets: int | None = None) -> DataFrame:
    """(feature, statistic, n_ref, n_cur): the greatest distance between the two ECDFs.

    Counts per range bucket give the distance at every bucket edge, and bound it
    inside every bucket. Only buckets whose bound beats the best edge are opened,
    so nearly all rows are counted in place and never shuffled; the result is exact.
    """
    return _ks_of(tag_buckets(_both(reference, current, list(columns)), buckets))


def _ks_of(tagged):
    upto = W.partitionBy("feature").orderBy("bucket")
    whole = W.partitionBy("feature")
    edges = (
        _side_counts(tagged)
        .withColumn("n_ref", F.sum("r").over(whole)).withColumn("n_cur", F.sum("c").over(whole))
        .withColumn("r_upto", F.sum("r").over(upto)).withColumn("c_upto", F.sum("c").over(upto))
        .withColumn("after", F.try_divide("r_upto", "n_ref") - F.try_divide("c_upto", "n_cur"))
        .withColumn("before", F.try_divide(F.col("r_upto") - F.col("r"), F.col("n_ref"))
                    - F.try_divide(F.col("c_upto") - F.col("c"), F.col("n_cur")))
        .withColumn("best", F.max(F.abs("after")).over(whole))
        .withColumn("reach", F.greatest(
            F.abs(F.col("before") + F.try_divide("r", "n_ref")),
            F.abs(F.col("before") - F.try_divide("c", "n_cur"))))
    )
    opened = edges.filter(F.col("reach") > F.col("best")).select(
        "feature", "bucket", "n_ref", "n_cur",
        (F.col("r_upto") - F.col("r")).alias("r_before"), (F.col("c_upto") - F.col("c")).alias("c_before"))
    inside = W.partitionBy("feature", "bucket").orderBy("value")
    # one row per feature and bucket at most
    refined = (
        tagged.join(F.broadcast(opened.select("feature", "bucket")), ["feature", "bucket"], "left_semi")
        .groupBy("feature", "bucket", "value")
        .agg(F.count_if("is_ref").alias("r"), F.count_if(~F.col("is_ref")).alias("c"))
        .select("feature", "bucket", F.sum("r").over(inside).alias("r"), F.sum("c").over(inside).alias("c"))
        .join(F.broadcast(opened), ["feature", "bucket"])
        .select("feature", F.abs(
            F.try_divide(F.col("r_before") + F.col("r"), F.col("n_ref"))
            - F.try_divide(F.col("c_before") + F.col("c"), F.col("n_cur"))).alias("d"))
    )
    at_edges = edges.select("feature", F.abs("after").alias("d"), "n_ref", "n_cur")
    return (
        at_edges.unionByName(refined, allowMissingColumns=True).groupBy("feature")
        .agg(F.max("d").alias("statistic"), F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"))
    )


def asymptotic_p_value(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """Limit distribution of the two-sample statistic; 1 where the statistic is 0.

    The distribution has two series: one in exp(-2 k^2 x^2), which converges for
    a large x, and one in exp(-(2 k - 1)^2 pi^2 / (8 x^2)), which converges for a
    small one. On its own side of SERIES_MEET each needs a few terms only; at
    x = 1/20 and below the p-value differs from 1 by less than 10^-200.
    """
    x = statistic * F.sqrt(n_ref.cast("double") * n_cur / (n_ref + n_cur))
    square = F.greatest(x * x, F.lit(0.0025))
    upper = sum((2.0 if k % 2 else -2.0) * F.exp(-2.0 * k * k * square) for k in range(1, SERIES_TERMS + 1))
    lower = sum(F.exp(-((2 * k - 1) ** 2 * math.pi ** 2 / 8) / square) for k in range(1, SERIES_TERMS + 1))
    below = 1.0 - math.sqrt(2 * math.pi) / F.sqrt(square) * lower
    p = F.when(x < SERIES_MEET, below).otherwise(upper)
    return F.when(statistic <= 0, F.lit(1.0)).when(statistic > 0, F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


def _exact_p(statistic: float, n: int, m: int) -> float:
    """Share of the merge orders of n and m values whose ECDF distance reaches the statistic.

    Counts the lattice paths that stay below it, one row of the lattice at a
    time: within the allowed band a row is the running sum of the row above.
    """
    limit = round(statistic * n * m) - 0.5
    across = np.arange(m + 1)
    paths = (across * n < limit).astype(float)
    log_scale = 0.0
    for i in range(1, n + 1):
        allowed = np.abs(i * m - across * n) < limit
        paths = np.where(allowed, np.cumsum(np.where(allowed, paths, 0.0)), 0.0)
        peak = paths.max()
        if peak == 0.0:
            return 1.0
        if peak > 1e100:
            paths /= peak
            log_scale += math.log(peak)
    if paths[m] == 0.0:
        return 1.0
    all_paths = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    inside = math.exp(math.log(paths[m]) + log_scale - all_paths)
    return min(max(1.0 - inside, 0.0), 1.0)


@F.pandas_udf(T.DoubleType())
def exact_p_value(statistic: pd.Series, n_ref: pd.Series, n_cur: pd.Series) -> pd.Series:
    """Permutation p-value from (statistic, sizes) alone: one value per feature."""
    largest = max(n_ref.max(), n_cur.max()) if len(n_ref) else 0
    if largest > EXACT_P_VALUE_ROWS:
        raise ValueError(f"exact p-values take samples of at most {EXACT_P_VALUE_ROWS} rows, not {largest}")
    return pd.Series([None if d != d else _exact_p(d, int(a), int(b)) if d > 0 else 1.0
                      for d, a, b in zip(statistic, n_ref, n_cur)], dtype="float64")


def ks_test(reference: DataFrame, current: DataFrame, columns, threshold: float = 0.05,
            method: str = "asymptotic", digits: int = 4) -> DataFrame:
    """Kolmogorov-Smirnov test per feature; the verdict uses the unrounded p-value.

    `method`: "asymptotic", or "exact" for samples of at most EXACT_P_VALUE_ROWS
    rows; larger ones are an error. The method is a column of the result.
    """
    return _ks_verdict(ks_statistic(reference, current, columns), threshold, method, digits)


def _ks_verdict(stats, threshold=0.05, method="asymptotic", digits=4):
    d, a, b = F.col("statistic"), F.col("n_ref"), F.col("n_cur")
    limit = asymptotic_p_value(d, a, b)
    if method == "asymptotic":
        stats = stats.withColumn("method", F.lit("asymptotic")).withColumn("p", limit)
    elif method == "exact":
        stats = stats.withColumn("method", F.lit("exact")).withColumn("p", exact_p_value(d, a, b))
    else:
        raise ValueError(f"unknown method {method}")
    return stats.select(
        "feature", F.round("statistic", digits).alias("ks_statistic"), F.round("p", digits).alias("ks_p_value"),
        (F.col("p") < threshold).alias("ks_drift"), F.lit(float(threshold)).alias("ks_threshold"), "method")


def psi(reference: DataFrame, current: DataFrame, columns, buckets: int = 10, digits: int = 4) -> DataFrame:
    """Population stability index per feature over bins of the reference sample.

    The bin edges are the exact percentiles of the reference; the outer bins are
    open. Shares are kept at 1e-4 or more. Severity and verdict use the
    unrounded index.
    """
    long = _both(reference, current, list(columns))
    points = [i / buckets for i in range(1, buckets)]
    return _psi_of(long, exact_percentiles(long.filter("is_ref").drop("is_ref"), points), buckets, digits)


def _psi_of(long, percentiles, buckets=10, digits=4):
    edges = percentiles.groupBy("feature").agg(F.array_sort(F.collect_list("percentile")).alias("edges"))
    # the broadcast side has one row per column
    counts = (
        long.join(F.broadcast(edges), "feature")
        .groupBy("feature", bin_index(F.col("value"), F.col("edges")).alias("bin"))
        .agg(F.count_if("is_ref").alias("r"), F.count_if(~F.col("is_ref")).alias("c"))
    )
    every = edges.select("feature", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bin"))
    totals = W.partitionBy("feature")
    r = clip_low(F.coalesce(F.try_divide("r", "n_ref"), F.lit(0.0)))
    c = clip_low(F.coalesce(F.try_divide("c", "n_cur"), F.lit(0.0)))
    return (
        every.join(counts, ["feature", "bin"], "left").na.fill(0, ["r", "c"])
        .withColumn("n_ref", F.sum("r").over(totals)).withColumn("n_cur", F.sum("c").over(totals))
        .groupBy("feature").agg(F.sum((c - r) * F.ln(c / r)).alias("index"))
        .select(
            "feature", F.round("index", digits).alias("psi"),
            F.when(F.col("index") < PSI_SLIGHT, PSI_LEVELS[0]).when(F.col("index") < PSI_SIGNIFICANT, PSI_LEVELS[1])
            .otherwise(PSI_LEVELS[2]).alias("severity"),
            (F.col("index") >= PSI_SIGNIFICANT).alias("psi_drift"))
    )


def drift_report(reference: DataFrame, current: DataFrame, columns=None, buckets: int = 10, **ks_options) -> DataFrame:
    """Both tests for every numeric column of the reference, one row each.

    A column without values on a side has no verdicts: its row holds nulls.
    The two tests share the range buckets and the counts in them: the optimizer
    sees the same shuffle twice and runs it once.
    """
    columns = list(columns or numeric_columns(reference))
    long = _both(reference, current, columns)
    tagged = tag_buckets(long)
    # both counts are read here, or this aggregation would be pruned and no longer be the one of the other test
    sizes = _side_counts(tagged).filter("r > 0 and c >= 0").select("feature", "bucket", F.col("r").alias("n"))
    points = [i / buckets for i in range(1, buckets)]
    percentiles = select_percentiles(tagged.filter("is_ref"), sizes, points)
    every = reference.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return every.join(_ks_verdict(_ks_of(tagged), **ks_options), "feature", "left").join(
        _psi_of(long, percentiles, buckets), "feature", "left")


def drift_summary(report: DataFrame) -> DataFrame:
    """Data-set verdict: how many columns drifted by each test, and their share."""
    n = F.count(F.lit(1))
    return report.agg(
        n.alias("n_features"), F.count_if("ks_drift").alias("n_ks_drift"),
        F.count_if("psi_drift").alias("n_psi_drift"),
        F.round(F.try_divide(F.count_if("ks_drift"), n), 4).alias("ks_drift_share"),
        F.round(F.try_divide(F.count_if("psi_drift"), n), 4).alias("psi_drift_share"),
        (F.try_divide(F.count_if("ks_drift"), n) >= 0.5).alias("dataset_drift"))
