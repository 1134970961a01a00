"""Computations over an order, without ever sorting everything in one task."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.balance import shuffle_partitions, with_bucket
from millrace.session import cut_lineage

# monotonically_increasing_id() keeps the row's place in its partition in the low 33 bits
_PLACE_BITS = 33


def running_sums(df: DataFrame, order: str, sums: dict, keys=(),
                 buckets: int | None = None, totals: bool = False) -> DataFrame:
    """Add running totals along `order` within `keys`, and with `totals` also each key's
    whole sum as `<name>_total`.

    `sums` maps a new column to the column summed. `order` (a number or a time)
    must be unique within `keys`: group by it first. Rows are placed in range
    buckets, summed inside each bucket, and shifted by the totals of the buckets
    before: at most `buckets` totals per key meet in one ordered group. Without
    `buckets` their number follows the cluster's shuffle setting.
    """
    keys = list(keys)
    position = F.col(order)
    if dict(df.dtypes)[order] == "timestamp_ntz":
        position = position.cast("timestamp")
    placed = with_bucket(df, position, buckets=buckets)
    group = keys + ["_bucket"]
    sizes = placed.groupBy(*group).agg(
        *[F.sum(source).alias(f"_t_{new}") for new, source in sums.items()])
    whole = _by(W, keys)
    before = whole.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    # without keys the bucket totals are at most `buckets` rows, so one group may hold them
    shifts = sizes.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bucket").alias("_b"),
        *[F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_s_{new}")
          for new in sums],
        *[F.sum(f"_t_{new}").over(whole).alias(f"{new}_total") for new in sums if totals])
    inside = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(source).over(inside).alias(f"_l_{new}")
                                 for new, source in sums.items()])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_bucket") == F.col("_b")]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return (
        local.join(shifts, condition)
        .select(*df.columns, *[(F.col(f"_l_{new}") + F.col(f"_s_{new}")).alias(new)
                               for new in sums],
                *[f"{new}_total" for new in sums if totals])
    )


def _by(window, keys):
    return window.partitionBy(*keys) if keys else window.partitionBy(F.lit(0))


def row_index(df: DataFrame, order, name: str = "row_index") -> DataFrame:
    """Number all rows 0, 1, 2, ... along `order` (columns that identify a row).

    One range shuffle on the whole order tuple, so a repeated first column does
    not pile up; the placed rows are written once because partition numbers must
    not change between counting partitions and shifting their rows.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = (
        df.repartitionByRange(shuffle_partitions(df), *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _PLACE_BITS))
        .withColumn("_place", F.col("_id") - F.shiftleft("_part", _PLACE_BITS))
        .drop("_id")
    )
    placed = cut_lineage(placed, "row-index")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # one row per shuffle partition: bounded by the setting, not by the data
    shifts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return (
        placed.join(F.broadcast(shifts), "_part")
        .withColumn(name, F.col("_first") + F.col("_place"))
        .drop("_part", "_place", "_first")
    )


def assign_batches(df: DataFrame, order, size: int = 32) -> DataFrame:
    """Fixed-size batches of rows in order: batch_id = floor(row_index / size)."""
    if size < 1:
        raise ValueError("size must be positive")
    return row_index(df, order).withColumn(
        "batch_id", F.floor(F.col("row_index") / F.lit(size)).cast("bigint"))


def slice_rows(df: DataFrame, order, start: int = 0, stop: int | None = None) -> DataFrame:
    """Rows at positions [start, stop) of the order."""
    indexed = row_index(df, order)
    kept = F.col("row_index") >= start
    if stop is not None:
        kept = kept & (F.col("row_index") < stop)
    return indexed.filter(kept)


def cumulative_share(df: DataFrame, order: str, value: str, keys=(),
                     buckets: int | None = None) -> DataFrame:
    """Running total of `value` along `order` and its share of the key's total."""
    keys = list(keys)
    summed = df.groupBy(*keys, order).agg(F.sum(value).alias(value))
    running = running_sums(summed, order, {"cumulative": value}, keys, buckets, totals=True)
    return running.withColumn("share", F.try_divide("cumulative", "cumulative_total")).drop("cumulative_total")


def in_flight(df: DataFrame, start: str, end: str, keys=(),
              buckets: int | None = None) -> DataFrame:
    """Requests running after every moment at which one starts or ends.

    Each request counts +1 at `start` and -1 at `end`; changes at the same moment
    are summed first, so the number is the one after all of them.
    """
    keys = list(keys)
    change = F.explode(F.array(
        F.struct(F.col(start).alias("at"), F.lit(1).cast("bigint").alias("change")),
        F.struct(F.col(end).alias("at"), F.lit(-1).cast("bigint").alias("change"))))
    steps = (
        df.select(*keys, change.alias("_c")).select(*keys, "_c.at", "_c.change")
        .filter(F.col("at").isNotNull())
        .groupBy(*keys, "at").agg(F.sum("change").alias("change"))
    )
    return running_sums(steps, "at", {"active": "change"}, keys, buckets)


def latest_by(df: DataFrame, keys, order, values) -> DataFrame:
    """The row with the greatest `order` tuple per key: an aggregate, so a hot key
    is combined before the shuffle instead of being sorted in one task."""
    keys, values = list(keys), list(values)
    ranked = F.struct(*[F.col(c) for c in order])
    last = F.max_by(F.struct(*[F.col(c) for c in values]), ranked).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in values])


def with_previous(df: DataFrame, order: str, value: str, keys=(), name: str = "previous",
                  buckets: int | None = None) -> DataFrame:
    """Add the value of the row before along `order` within `keys`; null for the first.

    Looks back inside a range bucket; a bucket's first row takes the last value of
    the nearest earlier bucket that has one, from a table of at most `buckets`
    rows per key. `order` must be unique within `keys`.
    """
    keys = list(keys)
    position = F.col(order)
    if dict(df.dtypes)[order] == "timestamp_ntz":
        position = position.cast("timestamp")
    placed = with_bucket(df, position, buckets=buckets)
    group = keys + ["_bucket"]
    inside = W.partitionBy(*group).orderBy(order)
    local = placed.withColumn("_place", F.row_number().over(inside)).withColumn(
        "_back", F.lag(value).over(inside))
    ends = placed.groupBy(*group).agg(F.max_by(F.struct(value), order).alias("_end"))
    carried = ends.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bucket").alias("_b"),
        F.lag("_end").over(_by(W, keys).orderBy("_bucket")).alias("_carried"))
    condition = F.col("_bucket") == F.col("_b")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    previous = F.when(F.col("_place") == 1, F.col(f"_carried.{value}")).otherwise(F.col("_back"))
    return local.join(carried, condition).select(*df.columns, previous.alias(name))
