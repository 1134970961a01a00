"""Sketches of windows merge into the answer of the whole, within their stated error."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import drift, sketches


def rows(spark, n, shift=0.0, days=5):
    random = np.random.default_rng(int(shift * 10) + n)
    data = [(float(x), float(i % 50), i % days) for i, x in enumerate(random.normal(shift, 1, n))]
    return spark.createDataFrame(data + [(None, float("nan"), 0)], "a double, b double, day int").withColumn(
        "ts", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("day") * 86_400))


@pytest.mark.parametrize("size, n", [(4096, 3000), (200, 20_000)])
def test_any_span_of_windows_equals_the_batch_answer(spark, size, n):
    reference, current = rows(spark, n), rows(spark, n, 0.4)
    columns = ["a", "b"]
    windows = sketches.window_sketches(current, columns, size=size)
    assert windows.count() == 10
    base = sketches.merged(sketches.window_sketches(reference, columns, size=size), size=size)
    for days in ((0, 1), (2, 3, 4), (0, 1, 2, 3, 4)):
        span = windows.filter(F.dayofmonth("window_start").isin([d + 1 for d in days]))
        got = {r["feature"]: r for r in sketches.sketch_drift(base, sketches.merged(span, size=size), size=size).collect()}
        chosen = current.filter(F.col("day").isin(*days))
        ks = {r["feature"]: r["statistic"] for r in drift.ks_statistic(reference, chosen, columns).collect()}
        whole = {r["feature"]: r for r in drift.psi(reference, chosen, columns).collect()}
        for c in columns:
            assert abs(got[c]["ks_statistic"] - ks[c]) <= got[c]["ks_error"]
            assert got[c]["n"] == chosen.filter(F.col(c).isNotNull() & ~F.isnan(c)).count()
            error = sketches.rank_error(size, True)
            # a bin's share is off by at most the error; the index by its slope there
            assert abs(got[c]["psi"] - whole[c]["psi"]) <= 10 * 2 * (error + 0.004 + 0.02) * (1 + abs(np.log(0.02)))


def test_error_falls_with_the_size():
    assert sketches.rank_error(200) == pytest.approx(0.0133, abs=1e-4)
    assert sketches.rank_error(4096) < 0.001 < sketches.rank_error(200, True)


def test_no_rows(spark):
    none = rows(spark, 10).limit(0)
    base = sketches.merged(sketches.window_sketches(rows(spark, 10), ["a"]))
    assert sketches.sketch_drift(base, sketches.merged(sketches.window_sketches(none, ["a"]))).count() == 0
