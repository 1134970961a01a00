"""Joins of predictions with labels, feedback, names and baselines."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import label_name


def label_lookup(df: DataFrame, code: str, names: dict, name: str = "class_name") -> DataFrame:
    return df.withColumn(name, label_name(F.col(code), names))


def pair_predictions(labels: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """True and predicted values of the same record, matched by key."""
    return labels.join(predictions, key)


def join_feedback(predictions: DataFrame, feedback: DataFrame, within: str = "1 hour",
                  key: str = "request_id", predicted_at: str = "ts", given_at: str = "feedback_ts") -> DataFrame:
    """Feedback given for a prediction no later than `within` after it.

    The same join runs on two streams once both sides carry a watermark.
    """
    span = F.expr(f"interval {within}")
    right = feedback.withColumnRenamed(key, "_key")
    timely = (
        (F.col(key) == F.col("_key"))
        & (F.col(given_at) >= F.col(predicted_at))
        & (F.col(given_at) <= F.col(predicted_at) + span)
    )
    return predictions.join(right, timely).drop("_key")


def diff_runs(runs: DataFrame, baseline, run_id="run_id", key="key", value="value") -> DataFrame:
    """Every metric of every other run next to the baseline run's, with the change.

    Metrics only the baseline has appear once with a null run.
    """
    base = runs.filter(F.col(run_id) == baseline).select(F.col(key), F.col(value).alias("baseline_value"))
    others = runs.filter(F.col(run_id) != baseline).select(run_id, key, F.col(value).alias("run_value"))
    # a run has few metrics: adaptive execution sees their true size and sends them to the rows
    only_base = base.join(others.select(key).distinct(), key, "left_anti")
    return (
        others.join(base, key, "left").unionByName(only_base, allowMissingColumns=True)
        .withColumn("delta", F.col("run_value") - F.col("baseline_value"))
    )
