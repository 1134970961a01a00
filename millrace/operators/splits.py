"""Deterministic splits and folds that do not depend on partitioning.

A row's place is its 60-bit digest of (id, seed), ties by id. Digests are even
over their range, so their leading bits are ready-made equal buckets whatever
the data looks like: counts per (class, bucket) decide all but one bucket of
each class, and only that bucket is ordered.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.balance import shuffle_partitions

_DIGITS = 15          # hexadecimal digits of the digest that are used: 60 bits
_FEWEST_DIGITS = 3    # leading digits that name a bucket, at least: 4096 buckets


def digest(key: Column, seed) -> Column:
    """First 60 bits of md5(key || seed) as hexadecimal text; sorts like the number."""
    return F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}"))), 1, _DIGITS)


def hash_share(key: Column, seed) -> Column:
    """The digest as a fraction in [0, 1)."""
    return F.conv(digest(key, seed), 16, 10).cast("double") / F.lit(float(16 ** _DIGITS))


def hash_split(df: DataFrame, key: str, share: float = 0.2, seed=42) -> DataFrame:
    """Mark about `share` of the rows as test, by digest alone: no shuffle, streaming-safe."""
    return df.withColumn("is_test", hash_share(F.col(key), seed) < share)


def random_split(df: DataFrame, share: float = 0.2, seed=42):
    """Spark's own split; depends on how the frame is partitioned."""
    return df.randomSplit([1 - share, share], seed)


def _bucket_digits(df: DataFrame) -> int:
    """Enough digits for every shuffle partition to get several buckets; results do not depend on it."""
    digits = _FEWEST_DIGITS
    while 16 ** digits < 4 * shuffle_partitions(df):
        digits += 1
    return digits


def _place(key, seed):
    return F.struct(digest(F.col(key), seed).alias("h"), F.col(key).alias("id"))


def _tagged(df, key, seed, *classes):
    """Digest bucket and place of every row, and the rows before each (class, bucket)."""
    tagged = df.select(*classes, F.substring(digest(F.col(key), seed), 1, _bucket_digits(df)).alias("_b"),
                       _place(key, seed).alias("_p"))
    names = [c for c in tagged.columns if c not in ("_b", "_p")]
    counts = tagged.groupBy(*names, "_b").agg(F.count(F.lit(1)).alias("_n"))
    # the number of buckets per class follows the cluster, not the data
    upto = W.partitionBy(*(names or [F.lit(0)])).orderBy("_b")
    return tagged, counts.withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))


def _cuts(tagged, edge, *names):
    """The places at which each class's quota ends: only the bucket holding it is ordered."""
    order = W.partitionBy(*names, "_b").orderBy("_p")
    return (
        tagged.join(edge, [*names, "_b"])
        .withColumn("_r", F.row_number().over(order)).filter(F.col("_r") == F.col("_k"))
        .select(*names, F.col("_p").alias("_cut"))
    )


def _edge(counts, names):
    return (
        counts.filter((F.col("_before") < F.col("take")) & (F.col("take") <= F.col("_before") + F.col("_n")))
        .select(*names, "_b", (F.col("take") - F.col("_before")).alias("_k"))
    )


def exact_split(df: DataFrame, key: str, share: float = 0.2, seed=42) -> DataFrame:
    """Mark exactly ceil(share x n) rows as test: those first in digest order."""
    tagged, counts = _tagged(df, key, seed)
    take = counts.agg(F.ceil(F.sum("_n") * share)).scalar()
    cut = _cuts(tagged, _edge(counts.withColumn("take", take), [])).select("_cut").scalar()
    return df.withColumn("is_test", F.coalesce(_place(key, seed) <= cut, F.lit(False)))


def stratified_split(df: DataFrame, key: str, label: str, share: float = 0.2, seed=42) -> DataFrame:
    """Mark ceil(share x n) rows as test with the class shares kept.

    Each class gets the floor of its share of the test rows; what is left goes,
    one row each, to the classes with the greatest remainders (smallest label on
    ties). Rows without a class stay in training.
    """
    tagged, counts = _tagged(df, key, seed, F.col(label).alias("_c"))
    totals = counts.groupBy("_c").agg(F.sum("_n").alias("total"))
    n = totals.agg(F.sum("total")).scalar()
    shares = (
        totals.withColumn("n_test", F.ceil(n * share))
        .withColumn("want", F.col("n_test") * F.col("total") / n).withColumn("base", F.floor("want"))
    )
    by_rest = [F.desc(F.round(F.col("want") - F.col("base"), 9)), F.col("_c")]
    # one row per class
    ranked = shares.withColumn("_nth", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*by_rest)) - 1)
    left = F.col("n_test") - shares.agg(F.sum("base")).scalar()
    takes = ranked.select("_c", (F.col("base") + (F.col("_nth") < left).cast("bigint")).alias("take"))
    cuts = _cuts(tagged, _edge(counts.join(takes, "_c"), ["_c"]), "_c")
    return (
        df.withColumn("_c", F.col(label)).join(cuts, "_c", "left")
        .withColumn("is_test", F.coalesce(_place(key, seed) <= F.col("_cut"), F.lit(False)))
        .drop("_c", "_cut")
    )


def kfold_assign(df: DataFrame, key: str, folds: int = 5, seed=42, label: str | None = None) -> DataFrame:
    """Balanced folds 0..k-1, dealt out in digest order (within each class if `label` is given).

    One shuffle by (class, digest bucket): a class of any size is spread over
    all buckets, and each bucket knows how many rows come before it.
    """
    place = digest(F.col(key), seed)
    cls = F.col(label) if label else F.lit(0)
    tagged = df.withColumn("_c", cls).withColumn("_b", F.substring(place, 1, _bucket_digits(df)))
    counts = tagged.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("_c").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select("_c", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = W.partitionBy("_c", "_b").orderBy(place, key)
    return (
        tagged.withColumn("_r", F.row_number().over(inside) - 1)
        .join(firsts, ["_c", "_b"])
        .withColumn("fold", ((F.col("_first") + F.col("_r")) % folds).cast("int"))
        .drop("_c", "_b", "_r", "_first")
    )
