"""Helpers that keep every shuffle group small, however the keys are spread.

Two ideas are used throughout the package:

* *range buckets*: approximate quantiles of a column (one map-side combined
  sketch, a bounded array) cut it into buckets holding about equal numbers of
  rows. Ordered work then runs inside a bucket, and only the bucket totals, of
  which there is a fixed number, are ever put in one global order;
* *hot keys*: a key with more rows than a fair share of one shuffle partition.
  There can be at most as many of them as there are partitions, so their list
  may be broadcast, and only their rows are spread over several groups.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEWEST_BUCKETS = 1 << 10
MOST_BUCKETS = 1 << 16


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bucket_count(df: DataFrame) -> int:
    """Enough buckets for every shuffle partition to get several: a power of two that grows with
    the cluster's setting, kept small enough for its split points to be one array."""
    wanted = max(FEWEST_BUCKETS, 4 * shuffle_partitions(df))
    return min(MOST_BUCKETS, 1 << (wanted - 1).bit_length())


def split_points(value: Column, buckets: int) -> Column:
    """Aggregate: `buckets - 1` approximate quantiles of `value`, ascending."""
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    return F.percentile_approx(value.cast("double"), shares, F.lit(buckets * 4))


def bucket_by(df: DataFrame, value: Column, splits: Column, name: str, buckets: int) -> DataFrame:
    """Add the number of split points at or below `value`; equal values share a bucket.

    A binary search written as one projection per halving: each reads one
    element of the array inside generated code, where a higher-order function
    would be interpreted. `buckets` must be a power of two.
    """
    if buckets < 2 or buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two, at least 2")
    df = df.withColumns({name: F.lit(0), "_number": value.cast("double"), "_points": splits})
    for halving in range(1, buckets.bit_length()):
        stride = buckets >> halving
        ahead = F.get("_points", F.col(name) + (stride - 1)) <= F.col("_number")
        df = df.withColumn(name, F.col(name) + F.when(ahead, stride).otherwise(0))
    return df.drop("_number", "_points")


def with_bucket(df: DataFrame, value: Column, name: str = "_bucket",
                buckets: int | None = None) -> DataFrame:
    """Add the range bucket of `value` over the whole frame."""
    buckets = buckets or bucket_count(df)
    return bucket_by(df, value, df.agg(split_points(value, buckets)).scalar(), name, buckets)


def hot_keys(df: DataFrame, keys, parts: int | None = None) -> DataFrame:
    """Keys holding more than 1/`parts` of all rows: never more than `parts` of them."""
    parts = parts or shuffle_partitions(df)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    return counts.filter(F.col("_rows") * parts > total).select(*keys)
