"""Isotonic regression of a label on a score, without bringing the pools to one place.

Pooling adjacent violators gives the slopes of the greatest convex minorant of the cumulative sums (weight so far,
label sum so far). The distinct scores are cut into range buckets; every bucket finds the lower hull of its own
points. A vertex of the whole hull is a vertex of its bucket's; what is missing is only where the edges lie
that cross bucket borders. The driver holds two vertices a border, asks all buckets for the point that lies furthest
below each chord, and halves the chord there until nothing lies below it: an aggregation whose size
follows the number of buckets. Then every bucket keeps its hull between the vertices found. The pools stay a
distributed table; a score is looked up by range bucket.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.balance import bucket_by, split_points
from millrace.session import cut_lineage

BUCKET_SCORES = 1 << 16


def lower_hull(x, y):
    """Places of the vertices of the lower hull of points in order of x: pooling, with a stack."""
    kept = []
    for i in range(len(x)):
        while len(kept) > 1 and (y[kept[-1]] - y[kept[-2]]) * (x[i] - x[kept[-1]]) >= (y[i] - y[kept[-1]]) * (x[kept[-1]] - x[kept[-2]]):
            kept.pop()
        kept.append(i)
    return np.array(kept, dtype=np.int64)


def _below(point, left, right):
    """How far a point lies below the chord from `left` to `right`, times its length."""
    return (right[1] - left[1]) * (point[0] - left[0]) - (point[1] - left[1]) * (right[0] - left[0])


@dataclass(frozen=True)
class IsotonicModel:
    """`pools`: (bucket, lo, hi, value), a pool's first and last score and its level; `splits`: the buckets' borders."""

    pools: DataFrame
    splits: list

    @classmethod
    def fit(cls, scored: DataFrame, score="score", label="label", bucket_scores: int = BUCKET_SCORES) -> "IsotonicModel":
        """Rows without a score or label are left out."""
        merged = cut_lineage(scored.select(F.col(score).cast("double").alias("s"), F.col(label).cast("double").alias("y")).filter(
            "s is not null and y is not null and not isnan(s)").groupBy("s").agg(
            F.sum("y").alias("y"), F.count(F.lit(1)).cast("double").alias("w")), "scores")
        n = merged.count()
        buckets = 1 << max(0, -(-n // bucket_scores) - 1).bit_length()
        splits = []
        if buckets > 1:  # one number a border
            splits = list(merged.agg(split_points(F.col("s"), buckets).alias("p")).first()["p"])
        placed = _placed(merged, splits)
        sums = sorted(placed.groupBy("bucket").agg(F.sum("w").alias("w"), F.sum("y").alias("y"), F.min("s").alias("first"),
                                                     F.max("s").alias("last")).collect())  # one row a bucket
        starts, x, y = {}, 0.0, 0.0
        for row in sums:
            starts[row["bucket"]] = x, y
            x, y = x + row["w"], y + row["y"]
        order = [row["bucket"] for row in sums]
        nan = float("nan")
        following = {b: row["first"] for b, row in zip(order, sums[1:])}
        preceding = {b: row["last"] for b, row in zip(order[1:], sums)}

        def hull_of(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("s")
            bucket = int(rows["bucket"].iloc[0])
            px = starts[bucket][0] + np.concatenate(([0.0], np.cumsum(rows["w"])))
            py = starts[bucket][1] + np.concatenate(([0.0], np.cumsum(rows["y"])))
            kept = lower_hull(px, py)
            scores = rows["s"].to_numpy()
            ended = np.concatenate(([preceding.get(bucket, nan)], scores))[kept]  # the last score up to a vertex
            begun = np.concatenate((scores, [following.get(bucket, nan)]))[kept]  # the first one behind it
            return pd.DataFrame({"bucket": [bucket], **{k: [v.tobytes()] for k, v in (
                ("x", px[kept]), ("y", py[kept]), ("ended", ended), ("begun", begun))}})

        hulls = cut_lineage(placed.groupBy("bucket").applyInPandas(
            hull_of, "bucket int, x binary, y binary, ended binary, begun binary"), "hulls")
        edges = _crossing(hulls, [starts[b] for b in order], (x, y), sums, order)
        return cls(_pools(hulls, edges, starts, order, (x, y)), splits)

    def transform(self, df: DataFrame, name: str, score="score") -> DataFrame:
        """`df` with the level of every score: linear between two pools, the outer ones' beyond them."""
        key = F.col(score).cast("double")
        asked = _placed(df.select(key.alias("s")).filter("s is not null").distinct(), self.splits)
        # the last pool before a bucket and the first behind it: one row a bucket
        by_bucket = {row["bucket"]: row for row in self.pools.groupBy("bucket").agg(
            F.max(F.struct("lo", "hi", "value")).alias("last"), F.min(F.struct("lo", "hi", "value")).alias("first")).collect()}
        marks = []
        for turn, side in ((range(len(self.splits) + 1), "last"), (range(len(self.splits), -1, -1), "first")):
            carried = None
            for b in turn:
                marks += [(*carried, b)] if carried else []
                carried = by_bucket[b][side] if b in by_bucket else carried
        known = self.pools.select("lo", "hi", "value", "bucket")
        if marks:
            known = known.unionByName(df.sparkSession.createDataFrame(marks, "lo double, hi double, value double, bucket int"))

        def level(rows: pd.DataFrame, pools: pd.DataFrame) -> pd.DataFrame:
            s = rows["s"].to_numpy()
            if not len(pools):
                return pd.DataFrame({"s": s, "level": np.full(len(s), np.nan)})
            pools = pools.sort_values("lo").drop_duplicates("lo")
            ends = pools[["lo", "hi"]].to_numpy().ravel()
            return pd.DataFrame({"s": s, "level": np.interp(s, ends, np.repeat(pools["value"].to_numpy(), 2))})

        found = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInPandas(level, "s double, level double")
        return df.join(found.select(F.col("s").alias("_s"), F.col("level").alias(name)), key == F.col("_s"), "left").drop("_s")


def _placed(rows, splits):
    if not splits:
        return rows.withColumn("bucket", F.lit(0))
    return bucket_by(rows, F.col("s"), F.array(*map(F.lit, splits)), "bucket", len(splits) + 1)


def _crossing(hulls, corners, end, sums, order):
    """The hull's edges over bucket borders: [(left vertex, right vertex)], a vertex being (x, y, ended, begun)."""
    if not order:
        return []
    first, last = (0.0, 0.0, float("nan"), sums[0]["first"]), (*end, sums[-1]["last"], float("nan"))
    borders = [x for x, _ in corners[1:]]
    open_, edges = [(first, last)] if borders else [], []
    while open_:
        chords = open_

        def lowest(batches):
            for batch in batches:
                out = []
                for row in batch.to_dict("records"):
                    x, y, ended, begun = (np.frombuffer(row[c]) for c in ("x", "y", "ended", "begun"))
                    for n, (left, right) in enumerate(chords):
                        if x[0] < right[0] and x[-1] > left[0]:
                            depth = _below((x, y), left, right)
                            i = int(depth.argmax())
                            out.append((n, float(depth[i]), float(x[i]), float(y[i]), float(ended[i]), float(begun[i])))
                yield pd.DataFrame(out, columns=["chord", "depth", "x", "y", "ended", "begun"])

        met = hulls.mapInPandas(lowest, "chord int, depth double, x double, y double, ended double, begun double").groupBy(
            "chord").agg(F.max(F.struct("depth", "x", "y", "ended", "begun")).alias("p")).collect()  # a row a chord
        points = {row["chord"]: row["p"] for row in met}
        open_ = []
        for n, (left, right) in enumerate(chords):
            p = points.get(n)
            if p is None or p["depth"] <= 4e-16 * abs(end[0] * end[1]) or not left[0] < p["x"] < right[0]:
                edges.append((left, right))
                continue
            middle = (p["x"], p["y"], p["ended"], p["begun"])
            open_ += [(a, b) for a, b in ((left, middle), (middle, right)) if any(a[0] < x < b[0] for x in borders)]
    return edges


def _pools(hulls, edges, starts, order, end):
    """(bucket, lo, hi, value) of every edge of the hull: crossing ones from the driver, the others from their bucket."""
    edges = sorted(edges)
    reach = {}
    for b, after in zip(order, [*order[1:], None]):
        low, high = starts[b][0], starts[after][0] if after is not None else end[0]
        over_low = [right[0] for left, right in edges if left[0] < low < right[0]]
        over_high = [left[0] for left, right in edges if left[0] < high < right[0]]
        reach[b] = over_low[0] if over_low else low, over_high[0] if over_high else high

    def inside(batches):
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                x, y, ended, begun = (np.frombuffer(row[c]) for c in ("x", "y", "ended", "begun"))
                low, high = reach[row["bucket"]]
                kept = np.flatnonzero((x >= low) & (x <= high))
                out += [(row["bucket"], float(begun[i]), float(ended[j]), float((y[j] - y[i]) / (x[j] - x[i])))
                        for i, j in zip(kept[:-1], kept[1:])]
            yield pd.DataFrame(out, columns=["bucket", "lo", "hi", "value"])

    local = hulls.mapInPandas(inside, "bucket int, lo double, hi double, value double")
    rows = []
    for left, right in edges:
        owner = max(b for b in order if starts[b][0] <= left[0])  # of the first score behind the left vertex
        rows.append((owner, left[3], right[2], (right[1] - left[1]) / (right[0] - left[0])))
    whole = local if not rows else local.unionByName(hulls.sparkSession.createDataFrame(rows, local.schema))
    return cut_lineage(whole, "pools")
