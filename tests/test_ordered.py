import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import balance, ordered, quantiles


def skewed(spark, n=3000, partitions=5):
    """A third of the rows share one key and one value."""
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 17}", 5.0 if i % 3 == 0 else float((i * 7919) % 1013)) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, k string, v double").repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 7])
def test_running_sums_match_pandas(spark, partitions):
    df = skewed(spark, partitions=partitions)
    got = ordered.running_sums(df, "id", {"total": "v"}, ["k"], buckets=16).toPandas().sort_values("id")
    want = df.toPandas().sort_values("id")
    want["total"] = want.groupby("k")["v"].cumsum()
    assert np.allclose(got["total"].to_numpy(), want["total"].to_numpy())


def test_running_sums_without_keys(spark):
    got = ordered.running_sums(skewed(spark), "id", {"total": "v"}, buckets=8).toPandas().sort_values("id")
    assert np.allclose(got["total"], got["v"].cumsum())


def test_with_previous_matches_shift(spark):
    df = skewed(spark)
    got = ordered.with_previous(df, "id", "v", ["k"], buckets=32).toPandas().sort_values("id")
    want = got.groupby("k")["v"].shift()
    pd.testing.assert_series_equal(got["previous"], want, check_names=False)


def test_row_index_with_repeated_first_column(spark):
    rows = skewed(spark, 2000).withColumn("day", F.lit(1))
    got = ordered.row_index(rows, ["day", "id"]).select("id", "row_index").collect()
    assert all(r["id"] == r["row_index"] for r in got) and len(got) == 2000


def test_batches_and_slices(spark):
    df = spark.range(100)
    sizes = ordered.assign_batches(df, ["id"], 32).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in sizes] == [32, 32, 32, 4]
    assert sorted(r["id"] for r in ordered.slice_rows(df, ["id"], 90).collect()) == list(range(90, 100))
    assert ordered.slice_rows(df, ["id"], 0, 0).count() == 0


def test_buckets_are_even_and_ordered(spark):
    df = spark.range(10_000).withColumn("v", (F.col("id") * 7919 % 10_007).cast("double"))
    placed = balance.with_bucket(df, F.col("v"), buckets=16)
    stats = placed.groupBy("_bucket").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_bucket").collect()
    assert len(stats) == 16 and max(r["n"] for r in stats) < 2 * 10_000 / 16
    assert all(a["hi"] < b["lo"] for a, b in zip(stats, stats[1:]))
    with pytest.raises(ValueError):
        balance.with_bucket(df, F.col("v"), buckets=10)


def test_hot_keys_are_few_and_found(spark):
    hot = balance.hot_keys(skewed(spark), ["k"], parts=8).collect()
    assert [r["k"] for r in hot] == ["hot"]


@pytest.mark.parametrize("partitions", [1, 6])
def test_percentiles_equal_numpy(spark, partitions):
    df = skewed(spark, partitions=partitions).withColumn("w", F.col("v") * 1.37 + F.col("id"))
    shares = [0, 0.1, 0.333, 0.5, 0.9, 0.999, 1]
    got = quantiles.exact_percentiles(quantiles.to_long(df, ["v", "w"]), shares, buckets=64).collect()
    pdf = df.toPandas()
    assert len(got) == 14
    for r in got:
        assert r["percentile"] == pytest.approx(np.percentile(pdf[r["feature"]], r["share"] * 100), rel=1e-12)


def test_percentiles_ignore_missing_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    got = quantiles.exact_percentiles(quantiles.to_long(df, ["v"]), [0.5]).first()
    assert got["percentile"] == 2.0


def test_histogram_of_repeated_edges_equals_numpy(spark):
    df = skewed(spark)
    edges = [5.0, 5.0, 300.0, 301.5, 5000.0]
    got = [r["n"] for r in quantiles.histogram_edges(df, "v", edges).orderBy("bin").collect()]
    values = df.toPandas()["v"]
    want = np.histogram(values, bins=[-np.inf, *edges, np.inf])[0]
    assert got == list(want)


def test_quantile_from_buckets(spark):
    bounds = [1.0, 2.0, 4.0]
    df = spark.createDataFrame([(0.5,), (1.5,), (1.7,), (3.0,)], "v double")
    buckets = quantiles.le_histogram(df, "v", bounds)
    assert quantiles.histogram_quantile(buckets, 0.5, bounds).first()["quantile"] == pytest.approx(1.5)
    beyond = spark.createDataFrame([(9.0,)], "v double")
    assert quantiles.histogram_quantile(quantiles.le_histogram(beyond, "v", bounds), 0.95, bounds).first()["quantile"] == 4.0
    none = quantiles.le_histogram(df.filter("v > 100"), "v", bounds)
    assert quantiles.histogram_quantile(none, 0.95, bounds).first()["quantile"] is None


def test_whole_sums_come_with_running_sums(spark):
    got = ordered.running_sums(skewed(spark), "id", {"total": "v"}, ["k"], buckets=16, totals=True).toPandas()
    assert np.allclose(got["total_total"], got.groupby("k")["v"].transform("sum"))
