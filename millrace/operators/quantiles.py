"""Exact percentiles, histograms over given edges, and quantiles from buckets."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.balance import bucket_by, bucket_count, split_points


def to_long(df: DataFrame, columns, *keep) -> DataFrame:
    """(feature, value) rows of the numeric `columns`; missing and NaN values are left out."""
    doubles = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot(list(keep), list(columns), "feature", "value")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def tag_buckets(long: DataFrame, buckets: int | None = None) -> DataFrame:
    """Range bucket of every value within its feature.

    The broadcast side has one row per feature, that is per column of the frame.
    """
    buckets = buckets or bucket_count(long)
    splits = long.groupBy("feature").agg(split_points(F.col("value"), buckets).alias("_splits"))
    tagged = long.join(F.broadcast(splits), "feature")
    return bucket_by(tagged, F.col("value"), F.col("_splits"), "bucket", buckets).drop("_splits")


def exact_percentiles(long: DataFrame, shares, buckets: int | None = None) -> DataFrame:
    """Linearly interpolated percentiles of each feature, exact at any size.

    Rows are counted per range bucket (combined map-side, nothing is moved), the
    few buckets that hold a wanted rank are found from the counts, and only the
    rows of those buckets are shuffled and ordered.
    Returns (feature, share, percentile).
    """
    tagged = tag_buckets(long, buckets)
    return select_percentiles(
        tagged, tagged.groupBy("feature", "bucket").agg(F.count(F.lit(1)).alias("n")), shares)


def select_percentiles(tagged: DataFrame, sizes: DataFrame, shares) -> DataFrame:
    """`exact_percentiles` of tagged rows whose (feature, bucket, n) are already counted."""
    shares = sorted({float(s) for s in shares})
    running = W.partitionBy("feature").orderBy("bucket")
    counts = (
        sizes.withColumn("before", F.sum("n").over(running) - F.col("n"))
        .withColumn("total", F.sum("n").over(W.partitionBy("feature")))
    )
    wanted = (
        counts.withColumn("share", F.explode(F.array(*[F.lit(s) for s in shares])))
        .withColumn("height", F.col("share") * (F.col("total") - 1))
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("height"), F.ceil("height")))))
        .filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        .select("feature", "bucket", "before", "share",
                (F.col("height") - F.floor("height")).alias("part"), "rank")
    )
    # at most two ranks per share and feature, so this is a small list per bucket and few buckets
    wanted = wanted.groupBy("feature", "bucket").agg(
        F.first("before").alias("before"), F.collect_list(F.struct("share", "part", "rank")).alias("_ranks"))
    inside = W.partitionBy("feature", "bucket").orderBy("value")
    values = (
        tagged.join(F.broadcast(wanted), ["feature", "bucket"])
        .groupBy("feature", "bucket", "value")
        .agg(F.count(F.lit(1)).alias("m"), F.first("before").alias("before"), F.first("_ranks").alias("_ranks"))
        .withColumn("upto", F.col("before") + F.sum("m").over(inside))
    )
    hits = F.filter("_ranks", lambda w: (w["rank"] < F.col("upto")) & (w["rank"] >= F.col("upto") - F.col("m")))
    return (
        values.select("feature", "value", F.inline(hits))
        .groupBy("feature", "share")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.max("part").alias("part"))
        .select("feature", "share",
                (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("percentile"))
    )


def approximate_percentiles(long: DataFrame, shares, accuracy: int = 10_000) -> DataFrame:
    """One-pass sketch for when an approximate answer will do."""
    shares = sorted({float(s) for s in shares})
    points = F.array(*[F.lit(s) for s in shares])
    return (
        long.groupBy("feature").agg(F.percentile_approx("value", points, F.lit(accuracy)).alias("v"))
        .select("feature", F.posexplode(F.arrays_zip(points.alias("share"), F.col("v"))).alias("i", "p"))
        .select("feature", "p.share", F.col("p.v").alias("percentile"), F.lit(True).alias("approximate"))
    )


def bin_index(value: Column, inner_edges: Column) -> Column:
    """Histogram bin of `value`: how many inner edges are at or below it.

    The outer bins are open to plus and minus infinity; repeated edges leave
    empty bins between them.
    """
    return F.size(F.filter(inner_edges, lambda edge: edge <= value))


def histogram_edges(df: DataFrame, column: str, inner_edges) -> DataFrame:
    """Counts in the bins cut by `inner_edges`, empty bins included."""
    edges = F.array(*[F.lit(float(e)) for e in inner_edges])
    present = F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))
    counts = (
        df.filter(present)
        .groupBy(bin_index(F.col(column).cast("double"), edges).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every = df.sparkSession.range(len(inner_edges) + 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def le_histogram(df: DataFrame, column: str, bounds, labels=()) -> DataFrame:
    """Cumulative `le` buckets per label set, with the sum and count of the series.

    One aggregation computes every bound; rows (labels, le, n, total, count).
    """
    labels = list(labels)
    bounds = sorted(float(b) for b in bounds)
    value = F.col(column)
    wide = df.groupBy(*labels).agg(
        F.struct(*[F.count_if(value <= b).alias(f"b{i}") for i, b in enumerate(bounds)]).alias("_b"),
        F.count(value).alias("count"), F.sum(value).alias("total"))
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"_b.b{i}").alias("n"), F.lit(i).alias("bound_index"))
            for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("n"),
                         F.lit(len(bounds)).alias("bound_index")))
    return wide.select(*labels, "total", "count", F.inline(F.array(*rows)))


def histogram_quantile(buckets: DataFrame, share: float, bounds, labels=()) -> DataFrame:
    """Quantile estimated from `le_histogram` rows.

    The first bucket whose cumulative count reaches the rank is interpolated
    linearly, from 0 below the first bound; a rank in the +Inf bucket gives the
    last finite bound; an empty series gives null.
    """
    labels = list(labels)
    bounds = sorted(float(b) for b in bounds)
    series = buckets.groupBy(*labels).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("bound_index", "n"))),
                    lambda b: b["n"].cast("double")).alias("cum"),
        F.max("count").alias("count"))
    limits = F.array(*[F.lit(b) for b in bounds])
    rank = F.lit(share) * F.col("count")
    series = series.withColumn(
        "hit", F.size(F.filter("cum", lambda c: c < rank)))
    low = F.when(F.col("hit") == 0, F.lit(0.0)).otherwise(F.try_element_at(limits, F.col("hit")))
    below = F.when(F.col("hit") == 0, F.lit(0.0)).otherwise(F.try_element_at("cum", F.col("hit")))
    high = F.try_element_at(limits, F.col("hit") + 1)
    inside = F.try_element_at("cum", F.col("hit") + 1) - below
    estimate = low + (high - low) * F.coalesce(F.try_divide(rank - below, inside), F.lit(0.0))
    return series.select(*labels, F.when(F.col("count") == 0, F.lit(None))
                         .when(F.col("hit") >= len(bounds), F.lit(bounds[-1]))
                         .otherwise(estimate).alias("quantile"))
