"""Isotonic fits equal the sequential algorithm, however many buckets the scores are cut into."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators.isotonic import IsotonicModel


def sequential(s, y):
    """(lo, hi, value) by pooling adjacent violators, one score after the other."""
    pools = []
    for score in sorted(set(s)):
        mine = [b for a, b in zip(s, y) if a == score]
        pools.append([score, score, sum(mine), len(mine)])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            lo, hi, total, n = pools.pop()
            pools[-1][1:] = [hi, pools[-1][2] + total, pools[-1][3] + n]
    return [(lo, hi, total / n) for lo, hi, total, n in pools]


def cases():
    random = np.random.default_rng(3)
    s = random.random(700).round(3)
    yield "rising", s, (random.random(700) < s).astype(float)
    yield "falling", s, (random.random(700) > s).astype(float)
    yield "flat", s, (random.random(700) < 0.5).astype(float)
    yield "steps", s, (np.floor(s * 8) % 2)
    yield "clean", s, (s > 0.5).astype(float)
    yield "hot", np.where(random.random(700) < 0.4, 0.25, s), (random.random(700) < s).astype(float)
    yield "wave", s, (random.random(700) < 0.5 + 0.4 * np.sin(9 * s)).astype(float)


@pytest.mark.parametrize("bucket_scores", [10, 1 << 16])
@pytest.mark.parametrize("name, s, y", list(cases()), ids=[c[0] for c in cases()])
def test_pools_equal_the_sequential_ones(spark, name, s, y, bucket_scores):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(s, y)], "score double, label double")
    model = IsotonicModel.fit(df, bucket_scores=bucket_scores)
    got = sorted((r["lo"], r["hi"], r["value"]) for r in model.pools.collect())
    want = sequential(s.tolist(), y.tolist())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want])
    if name in ("rising", "wave"):
        points = spark.range(-20, 1120, 7).select((F.col("id") / 1000).alias("score"))
        levels = {r["score"]: r["p"] for r in model.transform(points, "p").collect()}
        ends = [x for w in want for x in w[:2]]
        for x, level in levels.items():
            assert level == pytest.approx(float(np.interp(x, ends, np.repeat([w[2] for w in want], 2))))
        assert len(levels) == points.count()


def test_no_rows_and_missing_values(spark):
    none = spark.createDataFrame([(None, 1.0), (0.5, None)], "score double, label double")
    model = IsotonicModel.fit(none)
    assert model.pools.count() == 0
    asked = spark.createDataFrame([(0.5,), (None,)], "score double")
    assert model.transform(asked, "p").count() == 2
    one = IsotonicModel.fit(spark.createDataFrame([(0.5, 1.0), (None, 0.0)], "score double, label double"))
    assert {r["p"] for r in one.transform(asked, "p").collect()} == {1.0, None}
