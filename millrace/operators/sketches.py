"""Drift from mergeable quantile sketches, without edges fixed beforehand.

Every time window keeps one KLL sketch per feature: a few kilobytes, whatever the window holds, and itself an
aggregate that streams keep as state. The sketches of any span of windows merge into one, and both the stability
index and the KS statistic of that span against a reference sketch follow from them alone; no row is read again.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import clip_low
from millrace.operators import drift

SIZE = 4096


def rank_error(size: int = SIZE, shares: bool = False) -> float:
    """What a rank read off one sketch may be off by, with 99 % confidence; for the share between two values if
    `shares`. Sketches are exact for up to about `size` values."""
    return 2.446 / size ** 0.9433 if shares else 2.296 / size ** 0.9723


def window_sketches(df: DataFrame, columns, ts: str = "ts", width: str = "1 day", size: int = SIZE) -> DataFrame:
    """(window_start, feature, n, sketch) of numeric columns; missing values are left out. Works on streams."""
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]))
    long = df.select(ts, cells).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return (
        long.groupBy(F.window(ts, width).alias("w"), "feature")
        .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", size).alias("sketch"))
        .select(F.col("w.start").alias("window_start"), "feature", "n", "sketch")
    )


def merged(sketches: DataFrame, keys=("feature",), size: int = SIZE) -> DataFrame:
    """(keys, n, sketch) over all windows of `sketches`: filter these to the span wanted."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", size).alias("sketch"))


def sketch_drift(reference: DataFrame, current: DataFrame, keys=(), buckets: int = 10, steps: int = 500,
                 size: int = SIZE, digits: int = 4) -> DataFrame:
    """(keys, feature, n, psi, psi_drift, ks_statistic, ks_error) of sketches against the reference's.

    `reference` has one row per feature. Either distribution is read as its `steps` quantiles (a multiple of
    `buckets`). The index uses the reference's `buckets` quantiles as edges, a value equal to an edge lying
    below it; a bin's share is off by at most 2 / steps and the sketches' error. The KS statistic is the greatest
    gap at all these quantiles; the true one lies within `ks_error` of it, with the sketches' confidence.
    """
    if steps % buckets:
        raise ValueError("steps must be a multiple of buckets")
    ranks = F.array(*[F.lit(i / steps) for i in range(1, steps + 1)])
    both = current.join(F.broadcast(reference.select("feature", F.col("sketch").alias("_reference"))), "feature")  # a row a feature
    read = both.withColumns({name: F.kll_sketch_get_quantile_double(sketch, ranks)
                             for name, sketch in (("_r", F.col("_reference")), ("_c", F.col("sketch")))})

    def upto(quantiles, value):
        return F.size(F.filter(quantiles, lambda q: q <= value)) / F.lit(steps)

    def shares(quantiles):
        edges = F.transform(F.sequence(F.lit(1), F.lit(buckets - 1)), lambda i: F.get("_r", i * (steps // buckets) - 1))
        ends = F.concat(F.array(F.lit(0.0)), F.transform(edges, lambda e: upto(quantiles, e)), F.array(F.lit(1.0)))
        return F.zip_with(F.slice(ends, 2, buckets), F.slice(ends, 1, buckets), lambda a, b: clip_low(a - b))

    terms = F.zip_with(shares(F.col("_r")), shares(F.col("_c")), lambda r, c: (c - r) * F.ln(c / r))
    gaps = F.transform(F.concat("_r", "_c"), lambda v: F.abs(upto(F.col("_r"), v) - upto(F.col("_c"), v)))
    found = read.withColumns({"_psi": F.aggregate(terms, F.lit(0.0), lambda total, x: total + x), "_gap": F.array_max(gaps)})
    return found.select(
        *keys, "feature", "n", F.round("_psi", digits).alias("psi"), (F.col("_psi") >= drift.PSI_SIGNIFICANT).alias("psi_drift"),
        F.round("_gap", digits).alias("ks_statistic"), F.lit(2 * (rank_error(size) + 1 / steps)).alias("ks_error"))
