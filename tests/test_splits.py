import pytest
from pyspark.sql import functions as F

from millrace.operators import splits


def labelled(spark, n=1001, partitions=3):
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 7 == 0, "b").otherwise("c").alias("y")).repartition(partitions)


@pytest.mark.parametrize("share", [0.2, 0.3, 1.0, 0.0])
def test_exact_split_has_the_exact_size(spark, share):
    import math
    got = splits.exact_split(labelled(spark), "id", share).filter("is_test").count()
    assert got == math.ceil(1001 * share)


def test_splits_do_not_depend_on_partitions(spark):
    def picked(partitions, f):
        return {r["id"] for r in f(labelled(spark, partitions=partitions)).filter("is_test").collect()}
    for f in (lambda df: splits.exact_split(df, "id", 0.2), lambda df: splits.stratified_split(df, "id", "y", 0.2),
              lambda df: splits.hash_split(df, "id", 0.2)):
        assert picked(1, f) == picked(6, f)


def test_stratified_split_keeps_class_shares(spark):
    marked = splits.stratified_split(labelled(spark), "id", "y", 0.2)
    rows = marked.groupBy("y").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()
    assert sum(r["t"] for r in rows) == 201
    assert all(abs(r["t"] - 201 * r["n"] / 1001) < 1 for r in rows)


def test_smaller_exact_samples_lie_in_larger_ones(spark):
    taken = [{r["id"] for r in splits.exact_split(labelled(spark), "id", s, "curve").filter("is_test").collect()}
             for s in (0.1, 0.4, 0.9)]
    assert taken[0] < taken[1] < taken[2]


def test_folds_are_balanced_within_classes(spark):
    folds = splits.kfold_assign(labelled(spark), "id", 5, label="y").groupBy("y", "fold").count().collect()
    for y in "abc":
        sizes = [r["count"] for r in folds if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_random_split_covers_everything(spark):
    train, test = splits.random_split(labelled(spark), 0.2)
    assert train.count() + test.count() == 1001
