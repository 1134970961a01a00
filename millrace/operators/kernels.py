"""Kernel support vector machines by random Fourier features, many at once.

The Gaussian kernel exp(-gamma |x - y|^2) is the mean of cos(w(x - y)) over random w, so `width` cosines of
random projections stand in for it and a linear machine on them bends. It minimises |w|^2 / 2 + c times the
squared hinge losses by Newton steps: a step needs only the sums of z z' and y z over the rows inside the margin,
which every partition adds up for all classes and folds in one pass. No row leaves its partition.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class KernelMachine:
    """`gamma` None is one over the number of features, for columns of unit variance."""

    c: float = 1.0
    gamma: float | None = None
    width: int = 128
    passes: int = 25
    seed: int = 42

    def projection(self, features: int):
        random = np.random.default_rng(self.seed)
        gamma = 1 / features if self.gamma is None else self.gamma
        return random.normal(0, np.sqrt(2 * gamma), (features, self.width)), random.uniform(0, 2 * np.pi, self.width)

    def lifted(self, x):
        """Random cosine features of standardised rows, and a one for the constant."""
        w, b = self.projection(x.shape[1])
        return np.hstack([np.sqrt(2 / self.width) * np.cos(x @ w + b), np.ones((len(x), 1))])


_SLICE = 1 << 13  # rows lifted together


def _tables(batches, columns, marks):
    """(features, labels, marks) of a stream of frames in slices of bounded size; missing numbers are zero."""
    for batch in batches:
        for at in range(0, len(batch), _SLICE):
            some = batch.iloc[at:at + _SLICE]
            yield (np.nan_to_num(some[columns].to_numpy(dtype=np.float64)), some["label"].to_numpy().astype(np.int64),
                   some[marks].to_numpy().astype(np.int64))


def _scaling(rows: DataFrame, columns, marks):
    """Mean and deviation of the columns over every fold's training rows: one row."""
    wanted = [f(F.when(F.col(m) >= 0, F.col(c).cast("double"))).alias(f"{n}_{i}_{j}")
              for i, m in enumerate(marks) for j, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    facts = rows.agg(*wanted).first()
    out = []
    for i in range(len(marks)):
        mean, spread = (np.array([facts[f"{n}_{i}_{j}"] or 0.0 for j in range(len(columns))]) for n in "ms")
        out.append((mean, np.where(spread > 0, spread, 1.0)))  # a constant column stays at zero
    return out


def fit_machines(rows: DataFrame, columns, marks, classes: int, machine: KernelMachine):
    """(weights of (fold, class, feature), scaling of every fold): one machine a class against the others, for
    every fold; a row trains where its mark is 0 or more."""
    columns, marks = list(columns), list(marks)
    scaling = _scaling(rows, columns, marks)
    size = machine.width + 1
    weights = np.zeros((len(marks), classes, size))
    best, last = np.full((len(marks), classes), np.inf), weights.copy()
    kept = [f"_{m}" for m in marks]
    shaped = rows.select(*columns, F.col("label"), *[F.col(m).alias(k) for m, k in zip(marks, kept)])
    ridge = np.eye(size)
    ridge[-1, -1] = 1e-6  # the constant is hardly held back
    open_ = np.ones((len(marks), classes), dtype=bool)
    for _ in range(machine.passes):
        now, todo = weights.copy(), [tuple(j) for j in np.argwhere(open_).tolist()]

        def added(batches):
            sums = {job: [np.zeros((size, size)), np.zeros(size), 0.0] for job in todo}
            for x, y, m in _tables(batches, columns, kept):
                for fold in sorted({f for f, _ in todo}):
                    used = m[:, fold] >= 0
                    z = machine.lifted((x[used] - scaling[fold][0]) / scaling[fold][1])
                    for job in todo:
                        if job[0] == fold:
                            sign = np.where(y[used] == job[1], 1.0, -1.0)
                            gap = 1 - sign * (z @ now[job])
                            inside = gap > 0
                            some, total = z[inside], sums[job]
                            total[0] += some.T @ some
                            total[1] += some.T @ sign[inside]
                            total[2] += float((gap[inside] ** 2).sum())
            yield pd.DataFrame([(*job, h.tobytes(), g.tobytes(), loss) for job, (h, g, loss) in sums.items()],
                               columns=["fold", "cls", "gram", "pull", "loss"])

        met = {job: [np.zeros((size, size)), np.zeros(size), 0.0] for job in todo}
        parts = shaped.mapInPandas(added, "fold int, cls int, gram binary, pull binary, loss double")
        # the sums of a partition meet in one task a machine before they come here
        def together(some: pd.DataFrame) -> pd.DataFrame:
            gram, pull = (sum(np.frombuffer(x) for x in some[name]) for name in ("gram", "pull"))
            return pd.DataFrame({"fold": some["fold"].iloc[:1], "cls": some["cls"].iloc[:1], "gram": [gram.tobytes()],
                                 "pull": [pull.tobytes()], "loss": [float(some["loss"].sum())]})

        for row in parts.groupBy("fold", "cls").applyInPandas(
                together, "fold int, cls int, gram binary, pull binary, loss double").collect():
            met[row["fold"], row["cls"]] = [np.frombuffer(row["gram"]).reshape(size, size), np.frombuffer(row["pull"]), row["loss"]]
        for job, (gram, pull, loss) in met.items():
            value = float(now[job] @ ridge @ now[job]) / 2 + machine.c * loss
            if value > best[job] + 1e-9 * abs(best[job]):  # too far: go back half the way
                weights[job] = (last[job] + now[job]) / 2
                open_[job] = np.abs(weights[job] - last[job]).max() > 1e-7
                continue
            wanted = np.linalg.solve(ridge + 2 * machine.c * gram, 2 * machine.c * pull)
            settled = np.abs(wanted - now[job]).max() <= 1e-6 * max(1.0, np.abs(now[job]).max())
            best[job], last[job], weights[job] = value, now[job], wanted
            open_[job] = not settled
        if not open_.any():
            break
    return np.where(np.isfinite(best)[..., None], last, weights), scaling


def judge_machines(rows: DataFrame, columns, marks, classes: int, machine: KernelMachine, fitted) -> DataFrame:
    """(fold, label, prediction, n) of the rows whose mark is -1."""
    columns, marks = list(columns), list(marks)
    weights, scaling = fitted
    kept = [f"_{m}" for m in marks]

    def run(batches):
        counts = np.zeros((len(marks), classes * classes), dtype=np.int64)
        for x, y, m in _tables(batches, columns, kept):
            for fold, (mean, spread) in enumerate(scaling):
                asked = m[:, fold] == -1
                said = (machine.lifted((x[asked] - mean) / spread) @ weights[fold].T).argmax(axis=1)
                counts[fold] += np.bincount(y[asked] * classes + said, minlength=classes * classes)
        yield pd.DataFrame([(f, c // classes, c % classes, int(n)) for f, some in enumerate(counts) for c, n in enumerate(some) if n],
                           columns=["fold", "label", "prediction", "n"])

    shaped = rows.select(*columns, F.col("label"), *[F.col(m).alias(k) for m, k in zip(marks, kept)])
    return shaped.mapInPandas(run, "fold int, label int, prediction int, n bigint").groupBy("fold", "label", "prediction").agg(
        F.sum("n").alias("n"))
