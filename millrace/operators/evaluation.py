"""Quality of predictions: class metrics, windows, gates, regression, clusterings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.arrays import argmax, normalize


def confusion_counts(df: DataFrame, keys=(), label="y_true", prediction="prediction") -> DataFrame:
    """(keys, label, prediction, n): all class metrics start from this small table."""
    return (
        df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(*keys, F.col(label).alias("label"), F.col(prediction).alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion_matrix(df: DataFrame, classes=None, label="y_true", prediction="prediction") -> DataFrame:
    """Counts per (label, predicted). With `classes` the zero cells are there too."""
    counts = confusion_counts(df, (), label, prediction)
    if classes is None:
        return counts
    classes = list(classes)
    pairs = [F.struct(F.lit(a).alias("label"), F.lit(b).alias("predicted")) for a in classes for b in classes]
    cells = df.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    return cells.join(counts, ["label", "predicted"], "left").select(
        "label", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def class_scores(counts: DataFrame, keys=()) -> DataFrame:
    """Precision, recall, F1 and support per class from confusion counts; 0 for an empty ratio."""
    keys = list(keys)
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = counts.withColumn("_hit", hit).select(*keys, F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("chosen"), F.col("_hit").alias("hits")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("chosen"), F.lit(0).cast("bigint").alias("hits")))))
    per_class = sides.groupBy(*keys, "class").agg(
        F.sum("support").alias("support"), F.sum("chosen").alias("chosen"), F.sum("hits").alias("hits"))
    zero = F.lit(0.0)
    return per_class.select(
        *keys, "class", "support", "hits",
        F.coalesce(F.try_divide("hits", "chosen"), zero).alias("precision"),
        F.coalesce(F.try_divide("hits", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hits"), F.col("support") + F.col("chosen")), zero).alias("f1"))


def classification_report(df: DataFrame, label="y_true", prediction="prediction", keys=()) -> DataFrame:
    """Rows per class, then accuracy, macro and weighted means.

    In the accuracy row all three scores are the accuracy.
    """
    keys = list(keys)
    scores = class_scores(confusion_counts(df, keys, label, prediction), keys)
    names = ["precision", "recall", "f1"]
    n = F.sum("support")
    means = scores.groupBy(*keys).agg(
        n.alias("support"), F.try_divide(F.sum("hits"), n).alias("accuracy"),
        *[F.avg(c).alias(f"m_{c}") for c in names],
        *[F.try_divide(F.sum(F.col(c) * F.col("support")), n).alias(f"w_{c}") for c in names])
    kinds = (("accuracy", ["accuracy"] * 3), ("macro avg", [f"m_{c}" for c in names]),
             ("weighted avg", [f"w_{c}" for c in names]))
    totals = means.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(kind).alias("class"), *[F.col(s).alias(c) for s, c in zip(sources, names)],
                 F.col("support").alias("support")) for kind, sources in kinds])))
    per_class = scores.select(*keys, F.col("class").cast("string").alias("class"), *names, "support")
    return per_class.unionByName(totals)


def quality(df: DataFrame, keys=(), label="y_true", prediction="prediction") -> DataFrame:
    """(keys, n_samples, accuracy, f1_weighted, precision_weighted, recall_weighted), unrounded."""
    scores = class_scores(confusion_counts(df, keys, label, prediction), keys)
    n = F.sum("support")
    weighted = [F.try_divide(F.sum(F.col(c) * F.col("support")), n).alias(f"{c}_weighted")
                for c in ("f1", "precision", "recall")]
    return scores.groupBy(*keys).agg(
        n.alias("n_samples"), F.try_divide(F.sum("hits"), n).alias("accuracy"), *weighted)


def monitor_windows(df: DataFrame, ts="ts", width="1 hour", threshold: float = 0.85,
                    label="y_true", prediction="prediction", keys=()) -> DataFrame:
    """Accuracy and weighted F1 per time window; alert on the unrounded accuracy.

    The window start is a plain grouping key, so the confusion counts are the
    only shuffle of the rows.
    """
    moment = F.window(F.col(ts).cast("timestamp"), width)["start"]
    windowed = df.withColumn("window_start", moment)
    keys = ["window_start", *keys]
    return windows_report(quality(windowed, keys, label, prediction), keys, threshold)


def windows_report(metrics: DataFrame, keys, threshold: float) -> DataFrame:
    return metrics.select(
        *keys, F.date_format("window_start", "yyyyMMdd_HHmm").alias("window_id"), "n_samples",
        F.round("accuracy", 4).alias("accuracy"), F.round("f1_weighted", 4).alias("f1_weighted"),
        (F.col("accuracy") < threshold).alias("alert"))


def append_history(report: DataFrame, path: str, run: str) -> None:
    """Add one run's report to the history at `path`; a run written again replaces itself."""
    report.write.mode("overwrite").parquet(f"{path}/run={run}")


def read_history(spark, path: str) -> DataFrame:
    """All reports of a history, with the run each came from."""
    return spark.read.parquet(path)


def quality_gate(metrics: DataFrame, threshold: float = 0.90, round_digits: int | None = None,
                 metric: str = "accuracy") -> DataFrame:
    """Whether the metric reaches the threshold and which way to go on.

    `round_digits` compares the rounded metric instead of the exact one.
    """
    value = F.col(metric) if round_digits is None else F.round(metric, round_digits)
    passed = F.coalesce(value >= threshold, F.lit(False))
    return metrics.withColumns({
        "threshold": F.lit(float(threshold)), "passed": passed,
        "branch": F.when(passed, "deploy").otherwise("retrain")})


def alerts(df: DataFrame, alert_type: str, condition, at: str, details: dict) -> DataFrame:
    """Alert records (event_type, alert_type, timestamp, details) of the rows meeting `condition`.

    `details` maps a name to an expression; values are kept as text.
    """
    pairs = [x for name, e in details.items() for x in (F.lit(name), e.cast("string"))]
    return df.filter(condition).select(
        F.lit("alert").alias("event_type"), F.lit(alert_type).alias("alert_type"),
        F.col(at).alias("timestamp"), F.create_map(*pairs).alias("details"))


def regression_metrics(df: DataFrame, actual="y_true", predicted="prediction", keys=()) -> DataFrame:
    """RMSE, MAE and R squared from one pass."""
    error = F.col(actual).cast("double") - F.col(predicted).cast("double")
    y = F.when(F.col(predicted).isNotNull(), F.col(actual).cast("double"))
    return df.groupBy(*keys).agg(
        F.count(error).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(error))).alias("r2"))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labelings, from their contingency counts."""
    def pairs(n):
        return n * (n - 1) / 2.0

    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(
        F.count(F.lit(1)).cast("double").alias("n"))
    sums = []
    for column in ("a", "b"):
        sides = cells.groupBy(column).agg(F.sum("n").alias("n"))
        sums.append(sides.agg(F.sum(pairs(F.col("n")))).scalar())
    both = F.sum(pairs(F.col("n")))
    n = F.sum("n")
    return cells.agg(both.alias("both"), pairs(n).alias("all"), n.cast("bigint").alias("n_rows")).select(
        "n_rows", "both", "all", sums[0].alias("sa"), sums[1].alias("sb")).select(
        "n_rows",
        F.coalesce(F.try_divide(
            F.col("both") - F.try_divide(F.col("sa") * F.col("sb"), F.col("all")),
            (F.col("sa") + F.col("sb")) / 2 - F.try_divide(F.col("sa") * F.col("sb"), F.col("all"))),
            F.lit(1.0)).alias("adjusted_rand"))


# fixed values of the rule-based scorer: weights, cuts and class probabilities
RULE_WEIGHTS = {"petal_length": 0.5, "petal_width": 0.8}
RULE_CUTS = (2.5, 5.0)
RULE_PROBABILITIES = ((0.90, 0.08, 0.02), (0.05, 0.85, 0.10), (0.02, 0.13, 0.85))


def rule_score(df: DataFrame) -> DataFrame:
    """Score rows by a weighted sum and two cuts; adds score, probabilities, prediction, confidence."""
    score = sum(F.col(c).cast("double") * w for c, w in RULE_WEIGHTS.items())
    rows = [F.array(*[F.lit(p) for p in triple]) for triple in RULE_PROBABILITIES]
    chosen = (F.when(F.col("score") < RULE_CUTS[0], rows[0])
              .when(F.col("score") < RULE_CUTS[1], rows[1]).otherwise(rows[2]))
    return (
        df.withColumn("score", score).withColumn("probabilities", normalize(chosen))
        .withColumn("prediction", argmax(F.col("probabilities")))
        .withColumn("confidence", F.round(F.array_max("probabilities"), 4))
    )
