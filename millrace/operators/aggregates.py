"""Grouped summaries. All are single hash aggregations, combined before the shuffle."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def model_performance(df: DataFrame, model="model", accuracy="accuracy", status="status",
                      failure="failure") -> DataFrame:
    """Average and worst accuracy, runs, failures and failure rate per model, best first."""
    return (
        df.groupBy(model)
        .agg(F.avg(accuracy).alias("avg_accuracy"), F.min(accuracy).alias("min_accuracy"),
             F.count(F.lit(1)).alias("n_runs"), F.count_if(F.col(status) == failure).alias("failures"))
        .withColumn("failure_rate", F.try_divide("failures", "n_runs"))
        .orderBy(F.desc("avg_accuracy"), model)
    )


def describe_numeric(df: DataFrame, columns) -> DataFrame:
    """count, mean, sample standard deviation, minimum and maximum of each column, typed."""
    parts = []
    for c in columns:
        v = F.col(c).cast("double")
        parts.append(F.struct(F.lit(c).alias("column"), F.count(v).alias("n"), F.avg(v).alias("mean"),
                              F.stddev_samp(v).alias("stddev"), F.min(v).alias("min"),
                              F.max(v).alias("max")).alias(f"s{len(parts)}"))
    row = df.agg(*parts)
    return row.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(parts))])))


def value_counts(df: DataFrame, *columns) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def prediction_summary(df: DataFrame, threshold: float = 0.7, keys=()) -> DataFrame:
    """Events, low-confidence events and average confidence.

    A missing confidence counts as 1 in the threshold test and is left out of the average.
    """
    low = F.coalesce(F.col("max_prob"), F.lit(1.0)) < threshold
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(low).alias("low_confidence"),
        F.avg("max_prob").alias("avg_max_prob"))


def counter(df: DataFrame, *labels) -> DataFrame:
    """Counter value per label tuple."""
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias("total"))


def request_metrics(df: DataFrame, status="status", latency_ms="latency_ms", keys=()) -> DataFrame:
    """Request totals; the latency of successes is averaged over all requests, 0 if there are none."""
    ok = F.col(status) == "success"
    spent = F.sum(F.when(ok, F.col(latency_ms)))
    n = F.count(F.lit(1))
    return df.groupBy(*keys).agg(
        n.alias("total_requests"), F.count_if(ok).alias("success_requests"),
        F.count_if(~F.coalesce(ok, F.lit(False))).alias("error_requests"),
        F.round(F.coalesce(F.try_divide(spent, n), F.lit(0.0)), 2).alias("avg_latency_ms"))


def last_value_by(df: DataFrame, keys, order, value: str) -> DataFrame:
    """Gauge: the value at the greatest `order` tuple per label set."""
    return df.groupBy(*keys).agg(
        F.max_by(value, F.struct(*[F.col(c) for c in order])).alias(value))


def fold_summary(df: DataFrame, score: str, *keys) -> DataFrame:
    """Mean and population standard deviation of the scores."""
    return df.groupBy(*keys).agg(
        F.count(score).alias("folds"), F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"))
