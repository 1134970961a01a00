"""ROC, precision-recall and calibration curves and their summaries.

Rows are first counted per score, so ties form one point, and the running counts
are built bucket by bucket (see `ordered.running_sums`).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import running_sums


def one_vs_rest(df: DataFrame, label: str, scores: str, classes) -> DataFrame:
    """Long table (class, y, score) from an array of class scores."""
    rows = [F.struct(F.lit(str(c)).alias("class"), (F.col(label) == F.lit(c)).cast("int").alias("y"),
                     F.col(scores)[i].alias("score")) for i, c in enumerate(classes)]
    return df.select(F.inline(F.array(*rows)))


def _counts(df, label, score, keys):
    rated = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    # descending scores are ascending negated scores
    return rated.groupBy(*keys, (-F.col(score).cast("double")).alias("_down")).agg(
        F.sum(F.col(label).cast("bigint")).alias("p"), F.sum(1 - F.col(label).cast("bigint")).alias("q"))


def score_table(df: DataFrame, label="y", score="score", keys=()) -> DataFrame:
    """(keys, threshold, tp, fp, n_pos, n_neg): counts of rows at or above every score."""
    keys = list(keys)
    counts = _counts(df, label, score, keys)
    running = running_sums(counts, "_down", {"tp": "p", "fp": "q"}, keys, totals=True)
    return running.withColumnsRenamed({"tp_total": "n_pos", "fp_total": "n_neg"}).withColumn(
        "threshold", -F.col("_down")).drop("_down")


def roc_points(df: DataFrame, label="y", score="score", keys=()) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    return score_table(df, label, score, keys).select(
        *keys, "threshold", F.try_divide("fp", "n_neg").alias("fpr"), F.try_divide("tp", "n_pos").alias("tpr"))


def roc_auc(df: DataFrame, label="y", score="score", keys=()) -> DataFrame:
    """Area under the ROC curve: share of (positive, negative) pairs in the right order, ties half."""
    table = score_table(df, label, score, keys)
    won = F.col("q").cast("double") * (F.col("tp") - F.col("p") / 2)
    return table.groupBy(*keys).agg(
        F.try_divide(F.sum(won), F.max("n_pos").cast("double") * F.max("n_neg")).alias("auc"))


def macro_auc(df: DataFrame, label: str, scores: str, classes) -> DataFrame:
    """Mean one-vs-rest AUC over the classes."""
    return roc_auc(one_vs_rest(df, label, scores, classes), "y", "score", ["class"]).agg(
        F.count("auc").alias("n_classes"), F.avg("auc").alias("macro_auc"))


def pr_points(df: DataFrame, label="y", score="score", keys=()) -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    return score_table(df, label, score, keys).select(
        *keys, "threshold", F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", "n_pos").alias("recall"))


def average_precision(df: DataFrame, label="y", score="score", keys=()) -> DataFrame:
    """Sum of precision times the step in recall; a step's size is the positives at that score."""
    table = score_table(df, label, score, keys)
    precision = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    return table.groupBy(*keys).agg(
        F.try_divide(F.sum(precision * F.col("p")), F.max("n_pos")).alias("average_precision"))


def calibration_curve(df: DataFrame, bins: int = 10, label="y", score="score", keys=()) -> DataFrame:
    """Mean score and share of positives per uniform bin; empty bins are left out.

    Bin i holds scores in [i/bins, (i+1)/bins); a score of 1 is in the last bin.
    """
    slot = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    rated = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    return rated.groupBy(*keys, slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("fraction_positive"),
        F.avg(score).alias("mean_predicted"))


def brier_score(df: DataFrame, label="y", score="score", keys=()) -> DataFrame:
    gap = F.col(score) - F.col(label)
    return df.groupBy(*keys).agg(F.count(gap).alias("n"), F.avg(gap * gap).alias("brier"))
