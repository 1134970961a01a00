import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import drift


def frames(spark, seed=3, shift=0.3, n=700, m=500):
    random = np.random.default_rng(seed)
    a = np.column_stack([random.normal(size=n), np.round(random.uniform(0, 1, n), 1)])
    b = np.column_stack([random.normal(shift, 1, m), np.round(random.uniform(0, 1, m), 1)])
    make = lambda x: spark.createDataFrame([tuple(map(float, r)) for r in x], "x double, d double")
    return a, b, make(a), make(b)


def numpy_ks(a, b):
    points = np.sort(np.concatenate([a, b]))
    return np.max(np.abs(np.searchsorted(np.sort(a), points, "right") / len(a)
                         - np.searchsorted(np.sort(b), points, "right") / len(b)))


def stability_index(reference, current, bins=10):
    """By the definition: shares of both samples between the reference's deciles, one bin after the other."""
    ordered = sorted(reference)
    inner = []
    for i in range(1, bins):
        at = i / bins * (len(ordered) - 1)
        low = ordered[int(at)]
        inner.append(low + (ordered[min(int(at) + 1, len(ordered) - 1)] - low) * (at - int(at)))
    total = 0.0
    for low, high in zip([-math.inf, *inner], [*inner, math.inf]):
        share = [max(sum(low <= x < high for x in sample) / len(sample), 0.0001) for sample in (reference, current)]
        total += (share[1] - share[0]) * math.log(share[1] / share[0])
    return total


@pytest.mark.parametrize("buckets", [2, 32, 1024])
def test_ks_statistic_is_exact_for_any_bucket_number(spark, buckets):
    a, b, ref, cur = frames(spark)
    got = {r["feature"]: r["statistic"] for r in drift.ks_statistic(ref, cur, ["x", "d"], buckets).collect()}
    for i, c in enumerate(["x", "d"]):
        assert got[c] == pytest.approx(numpy_ks(a[:, i], b[:, i]), abs=1e-12)


def test_psi_follows_its_definition(spark):
    a, b, ref, cur = frames(spark)
    got = {r["feature"]: r for r in drift.psi(ref, cur, ["x", "d"], digits=9).collect()}
    for i, c in enumerate(["x", "d"]):
        assert got[c]["psi"] == pytest.approx(stability_index(a[:, i], b[:, i]), abs=1e-8)


def brute_p(statistic, n, m):
    """All ways to choose which ranks belong to the first sample."""
    hits = total = 0
    for chosen in combinations(range(n + m), n):
        mark = np.zeros(n + m)
        mark[list(chosen)] = 1
        gap = np.abs(np.cumsum(mark) / n - np.cumsum(1 - mark) / m).max()
        hits += gap >= statistic - 1e-12
        total += 1
    return hits / total


@pytest.mark.parametrize("n,m,d", [(4, 5, 0.55), (6, 6, 0.5), (3, 8, 1.0), (7, 4, 0.25)])
def test_exact_p_value_counts_all_orders(n, m, d):
    steps = sorted({abs(i / n - j / m) for i in range(n + 1) for j in range(m + 1)})
    nearest = min(steps, key=lambda s: abs(s - d))
    assert drift._exact_p(nearest, n, m) == pytest.approx(brute_p(nearest, n, m), abs=1e-12)


def test_exact_and_asymptotic_agree_for_larger_samples(spark):
    _, _, ref, cur = frames(spark, n=2000, m=1800, shift=0.03)
    exact = {r["feature"]: r["ks_p_value"] for r in drift.ks_test(ref, cur, ["x"], method="exact").collect()}
    limit = {r["feature"]: r["ks_p_value"] for r in drift.ks_test(ref, cur, ["x"]).collect()}
    assert exact["x"] == pytest.approx(limit["x"], abs=0.03)


# the limit distribution's upper tail, worked out with 400 terms of both series, which agree
TAIL = [(0.0005, 1.0), (0.005, 1.0), (0.05, 1.0), (0.3, 0.9999906941986655), (0.5, 0.9639452436648751),
        (0.8, 0.5441424115741981), (1.0, 0.26999967167735456), (1.18, 0.12345380942977), (1.36, 0.04948587675), (2.0, 0.00067092525578)]


def test_limit_distribution(spark):
    n = 200_000  # of each sample, so that x = statistic * sqrt(n / 2)
    rows = [(x / math.sqrt(n / 2), n, n) for x, _ in TAIL] + [(0.0, n, n)]
    df = spark.createDataFrame(rows, "d double, a bigint, b bigint")
    got = [r.p for r in df.select(drift.asymptotic_p_value(F.col("d"), F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == pytest.approx([p for _, p in TAIL] + [1.0], rel=1e-4)


def test_exact_p_values_have_a_bound(spark):
    _, _, ref, _ = frames(spark)
    many = spark.range(drift.EXACT_P_VALUE_ROWS + 1).selectExpr("cast(id as double) as x")
    with pytest.raises(Exception, match="at most"):
        drift.ks_test(ref, many, ["x"], method="exact").collect()


def test_a_column_without_values_keeps_its_row(spark):
    ref = spark.range(50).selectExpr("cast(id as double) as x", "cast(null as double) as y")
    cur = spark.range(50).selectExpr("cast(id as double) as x", "cast(id as double) as y")
    report = drift.drift_report(ref, cur)
    got = {r["feature"]: r for r in report.collect()}
    assert set(got) == {"x", "y"} and got["y"]["psi"] is None and got["y"]["ks_drift"] is None
    assert drift.drift_summary(report).first()["n_features"] == 2


def test_same_data_does_not_drift_and_noise_does(spark):
    _, _, ref, _ = frames(spark)
    same = {r["feature"]: r for r in drift.drift_report(ref, ref).collect()}
    assert all(r["ks_p_value"] == 1.0 and not r["ks_drift"] and r["psi"] == 0.0 and r["severity"] == "none" for r in same.values())
    noisy = ref.selectExpr("x + 5 * sin(monotonically_increasing_id() * 12.9898) as x", "d")
    report = drift.drift_report(ref, noisy)
    got = {r["feature"]: r for r in report.collect()}
    assert got["x"]["ks_drift"] and got["x"]["psi_drift"] and not got["d"]["ks_drift"]
    assert drift.drift_summary(report).first()["n_ks_drift"] == 1
