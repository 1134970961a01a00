"""Isolation forest (Liu, Ting and Zhou, 2008).

A tree is grown from a fixed number of rows, so growing needs little data and
scoring is one pass: rows are drawn for all trees at once, each tree's sample is
a group of known size, and the grown trees, whose size is bounded too, go to
every task that scores.
"""

from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.quantiles import exact_percentiles

_SPARE = 2.0  # rows drawn per tree before the exact sample is cut, as a multiple of it


def _average_path(n):
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def tree_samples(df: DataFrame, key: str, columns, trees: int = 100, rows: int = 256, seed: int = 42) -> DataFrame:
    """(tree, columns): `rows` rows per tree, drawn without replacement by digest of (row, tree).

    A first digest keeps about as many rows as all trees together need, so only
    these are tried for each tree; the excess is cut to the exact number by rank.
    """
    n = df.count()
    if n == 0:
        raise ValueError("no rows to grow trees from")
    share = min(1.0, _SPARE * rows / n)
    first = min(1.0, share * trees)
    second = share / first
    def chance(*parts):
        return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / float(1 << 40)

    drawn = df.filter(chance(F.col(key), F.lit(seed)) < first).select(
        key, *[F.col(c).cast("double").alias(c) for c in columns])
    tried = drawn.withColumn("tree", F.explode(F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: chance(F.col(key), t, F.lit(seed + 1)) < second)))
    order = W.partitionBy("tree").orderBy(F.xxhash64(key, "tree", F.lit(seed + 2)), key)
    return tried.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= rows).drop("_r", key)


def grow_trees(samples: DataFrame, columns, rows: int = 256, seed: int = 42) -> DataFrame:
    """(tree, node, feature, cut, child, size) rows; `child` is the left child, the right one follows."""
    columns = list(columns)
    deepest = int(np.ceil(log2(max(rows, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        random = np.random.default_rng([seed, tree])
        points = pdf[columns].to_numpy()
        points = points[np.lexsort(points.T)]
        nodes = [(-1, 0.0, -1, len(points))]
        waiting = [(0, points, 0)]
        while waiting:
            at, inside, depth = waiting.pop()
            low, high = inside.min(axis=0), inside.max(axis=0)
            open_features = np.flatnonzero(high > low)
            if depth >= deepest or len(inside) < 2 or not len(open_features):
                continue
            feature = int(random.choice(open_features))
            cut = float(random.uniform(low[feature], high[feature]))
            left = inside[:, feature] <= cut
            nodes[at] = (feature, cut, len(nodes), len(inside))
            for part in (inside[left], inside[~left]):
                waiting.append((len(nodes), part, depth + 1))
                nodes.append((-1, 0.0, -1, len(part)))
        grown = pd.DataFrame(nodes, columns=["feature", "cut", "child", "size"])
        grown.insert(0, "node", range(len(grown)))
        grown.insert(0, "tree", tree)
        return grown

    return samples.groupBy("tree").applyInPandas(
        grow, "tree int, node int, feature int, cut double, child int, size int")


def anomaly_scores(df: DataFrame, key: str, columns, trees: int = 100, rows: int = 256, seed: int = 42) -> DataFrame:
    """`df` with `anomaly_score` in (0, 1]: near 1 for rows that few cuts set apart."""
    columns = list(columns)
    samples = tree_samples(df, key, columns, trees, rows, seed)
    # at most trees x (2 x rows) nodes, whatever the size of the data
    nodes = grow_trees(samples, columns, rows, seed).toPandas().sort_values(["tree", "node"])
    forest = [g[["feature", "cut", "child", "size"]].to_numpy() for _, g in nodes.groupby("tree")]
    scale = float(_average_path(min(rows, max(int(t[0, 3]) for t in forest))))
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def score(frames):
        for pdf in frames:
            points = pdf[columns].to_numpy(dtype=float)
            depth = np.zeros(len(points))
            for tree in shared.value:
                feature, cut = tree[:, 0].astype(int), tree[:, 1]
                child, size = tree[:, 2].astype(int), tree[:, 3]
                at = np.zeros(len(points), dtype=int)
                moving = np.flatnonzero(child[at] >= 0)
                while len(moving):
                    here = at[moving]
                    right = points[moving, feature[here]] > cut[here]
                    at[moving] = child[here] + right
                    depth[moving] += 1
                    moving = moving[child[at[moving]] >= 0]
                depth += _average_path(size[at])
            mean = depth / len(shared.value)
            yield pdf.assign(anomaly_score=2.0 ** (-mean / scale) if scale > 0 else 0.5)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(score, f"{fields}, anomaly_score double")


def flag_anomalies(scored: DataFrame, contamination: float = 0.06) -> DataFrame:
    """Adds `is_anomaly`: the score is above the exact (1 - contamination) percentile."""
    long = scored.select(F.lit("score").alias("feature"), F.col("anomaly_score").alias("value"))
    cut = exact_percentiles(long, [1 - contamination]).select("percentile").scalar()
    return scored.withColumn("is_anomaly", F.col("anomaly_score") > cut)
