"""Ensembles grown together equal ones grown alone, on one block or many, and plain versions on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import comparison, ensembles, kernels
from millrace.operators.ensembles import Blocks, Boosted, Forest, Run

COLUMNS = ["a", "b", "c"]


def table(spark, n=240, seed=5, noise=0.1):
    random = np.random.default_rng(seed)
    x = random.normal(size=(n, 3)) * [1.0, 3.0, 0.5] + [2.0, -1.0, 0.0]
    y = (x[:, 0] + x[:, 1] / 3 > 1.7).astype(int) + (x[:, 2] > 0.4)
    y = np.where(random.random(n) < noise, (y + 1) % 3, y)
    rows = [(i, *map(float, p), int(c)) for i, (p, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double, label int").withColumns(
        {"m0": F.when(F.col("id") % 4 == 0, -1).otherwise(0), "m1": F.when(F.col("id") % 4 == 1, -1).otherwise(
            (F.col("id") % 3).cast("int"))}).persist()


RUNS = [Run("f", Forest(30, 6), 0), Run("f", Forest(12, 3), 0), Run("f", Forest(30, 6, leaf=4), 1, 2), Run("f", Forest(7, 6), 1, 0),
        Run("t", Forest(1, 5, subset="all", bagged=False), 0), Run("g", Boosted(12, 3), 0), Run("g", Boosted(12, 2), 1, 1)]


@pytest.fixture(scope="module")
def rows(spark):
    return table(spark)


@pytest.fixture(scope="module")
def together(rows):
    return ensembles.scores(Blocks.of(rows, "id", COLUMNS, "label", ["m0", "m1"]), RUNS)


def test_models_equal_ones_grown_alone(rows, together):
    blocks = Blocks.of(rows, "id", COLUMNS, "label", ["m0", "m1"])
    for run in RUNS:
        assert ensembles.scores(blocks, [run])[run] == together[run]


def test_many_blocks_give_the_same_models(rows, together):
    blocks = Blocks.of(rows, "id", COLUMNS, "label", ["m0", "m1"], block_rows=50)
    assert blocks.count > 3
    assert ensembles.scores(blocks, RUNS) == together


def test_passes_per_level_give_the_same_models(rows, together, monkeypatch):
    monkeypatch.setattr(ensembles, "TREE_ROWS", 0)
    monkeypatch.setattr(ensembles, "BOOSTED_ROWS", 0)
    blocks = Blocks.of(rows, "id", COLUMNS, "label", ["m0", "m1"], block_rows=120)
    assert blocks.count > 1 and blocks.n == 240
    few = RUNS[:4] + RUNS[6:]
    assert ensembles.scores(blocks, few) == {run: together[run] for run in few}


def test_trees_are_grown_in_waves(monkeypatch):
    """The first wave holds a few hundred trees, the next as many as their nodes allow, one group at least."""
    groups = [(Forest(300, 5), i, 0, []) for i in range(6)]
    monkeypatch.setattr(ensembles, "WAVE_NODES", 6300)
    waves = ensembles._waves(groups, range(6))
    assert next(waves) == [0, 1]
    small = {(0, i): ensembles.Tree(np.full(7, -1), None, None, None) for i in range(3)}
    assert waves.send(small) == [2, 3, 4]
    large = {(2, 0): ensembles.Tree(np.full(5000, -1), None, None, None)}
    assert waves.send(large) == [5]


def test_subsets_that_try_as_many_features_share_their_trees():
    runs = [Run("a", Forest(10, 4, 2, "sqrt"), 0), Run("b", Forest(20, 3, 2, "log2"), 0), Run("c", Forest(5, 3, 1, "log2"), 0)]
    assert [same for *_, same in ensembles._grown_together(runs, 4)] == [runs[:2], runs[2:]]
    assert len(ensembles._grown_together(runs, 9)) == 3


def test_a_forest_learns(together):
    assert together[RUNS[0]]["validation"][0] > 0.55 and together[RUNS[0]]["train"][0] > 0.85
    assert together[RUNS[0]]["validation"][2] == 60 and together[RUNS[0]]["train"][2] == 180
    assert together[RUNS[3]]["train"][2] < together[RUNS[2]]["train"][2] == 180


def block_of(rows, marks=("m0", "m1")):
    blocks = Blocks.of(rows, "id", COLUMNS, "label", list(marks))
    return blocks.open(blocks.rows.first())


def plain_tree(codes, labels, rows, depth, classes):
    """Class counts of the leaf of every row of a greedy tree, straight from the definition."""
    counts = np.bincount(labels[rows], minlength=classes)
    worth = lambda some: (np.bincount(labels[some], minlength=classes) ** 2).sum() / max(len(some), 1)
    best = None
    if depth:
        for f in range(codes.shape[1]):
            for cut in range(ensembles.BINS - 1):
                left, right = rows[codes[rows, f] <= cut], rows[codes[rows, f] > cut]
                if len(left) and len(right) and (best is None or worth(left) + worth(right) > best[0]):
                    best = worth(left) + worth(right), f, cut
    if best is None or best[0] <= worth(rows) + 1e-9 * max(1.0, worth(rows)):
        return lambda some: np.tile(counts, (len(some), 1))
    _, f, cut = best
    low, high = (plain_tree(codes, labels, rows[side], depth - 1, classes) for side in (codes[rows, f] <= cut, codes[rows, f] > cut))
    def leaf(some):
        out = np.empty((len(some), classes))
        down = some[:, f] <= cut
        out[down], out[~down] = low(some[down]), high(some[~down])
        return out
    return leaf


def test_a_tree_equals_the_greedy_one(rows):
    block, met = block_of(rows), {}
    ensembles.grow_tree(block, Forest(1, 4, subset="all", bagged=False), 0, 0, 0, 3, 3,
                        lambda level, tree, at: met.__setitem__(level, tree.sums[at].copy()))
    leaf = plain_tree(block["codes"], block["labels"], np.flatnonzero(block["marks"][:, 0] >= 0), 4, 3)
    assert (met[4] == leaf(block["codes"])).all()


def test_bags_are_poisson_and_features_differ_by_node():
    drawn = ensembles.bag(np.arange(200_000, dtype=np.uint64), ensembles._salt(3, 1))
    assert drawn.mean() == pytest.approx(1, abs=0.01) and drawn.var() == pytest.approx(1, abs=0.02)
    assert np.corrcoef(drawn, ensembles.bag(np.arange(200_000, dtype=np.uint64), ensembles._salt(3, 2)))[0, 1] < 0.01


def plain_boosting(block, rounds, depth, rate, classes):
    """Scores after every round, with plain loops over rows, nodes and cuts."""
    codes, labels = block["codes"].astype(int), block["labels"]
    training = np.flatnonzero(block["marks"][:, 0] >= 0)
    share = np.bincount(labels[training], minlength=classes) / len(training)
    scores, out = np.tile(np.log(share), (len(labels), 1)), []

    def grown(rows, r, depth):
        value = lambda: rate * (classes - 1) / classes * r[rows].sum() / (np.abs(r[rows]) * (1 - np.abs(r[rows]))).sum()
        best = None
        for f in range(codes.shape[1]) if depth else ():
            for cut in range(ensembles.BINS - 1):
                left, right = rows[codes[rows, f] <= cut], rows[codes[rows, f] > cut]
                if len(left) and len(right):
                    gain = r[left].sum() ** 2 / len(left) + r[right].sum() ** 2 / len(right)
                    if best is None or gain > best[0] + 1e-7:
                        best = gain, f, cut
        if best is None or best[0] <= r[rows].sum() ** 2 / len(rows) + 1e-7:
            return lambda row, v=value(): v
        _, f, cut = best
        low, high = grown(rows[codes[rows, f] <= cut], r, depth - 1), grown(rows[codes[rows, f] > cut], r, depth - 1)
        return lambda row: low(row) if row[f] <= cut else high(row)

    for _ in range(rounds):
        p = np.exp(scores) / np.exp(scores).sum(1, keepdims=True)
        trees = [grown(training, (labels == k) - p[:, k], depth) for k in range(classes)]
        scores = scores + np.array([[tree(row) for tree in trees] for row in codes])
        out.append(scores)
    return out


def test_softmax_boosting_equals_the_plain_one_and_its_loss_falls(spark):
    block, met = block_of(table(spark, 200, noise=0.0)), []
    ensembles.boost(block, Boosted(10, 3), 0, 0, 3, lambda n, scores: met.append(scores))
    for ours, theirs in zip(met[1:], plain_boosting(block, 10, 3, 0.1, 3)):
        assert np.allclose(ours, theirs, atol=1e-4)
    held_out = block["marks"][:, 0] == -1
    losses = [-np.log((np.exp(s) / np.exp(s).sum(1, keepdims=True))[np.arange(len(s)), block["labels"]][held_out]).mean() for s in met]
    assert all(b < a for a, b in zip(losses, losses[1:]))


def rings(spark, n=400):
    random = np.random.default_rng(1)
    angle, label = random.uniform(0, 2 * np.pi, n), np.arange(n) % 2
    radius = 1 + 1.5 * label + random.normal(0, 0.15, n)
    data = [(i, float(r * np.cos(t)), float(r * np.sin(t)), 1.0, int(k)) for i, (r, t, k) in enumerate(zip(radius, angle, label))]
    return spark.createDataFrame(data, "id bigint, a double, b double, c double, label int").withColumns(
        {"m0": F.when(F.col("id") % 5 == 0, -1).otherwise(0), "m1": F.when(F.col("id") % 5 == 1, -1).otherwise(0)})


def accuracy(rows, machine, columns=COLUMNS):
    fitted = kernels.fit_machines(rows, columns, ["m0", "m1"], 2, machine)
    counts = kernels.judge_machines(rows, columns, ["m0", "m1"], 2, machine, fitted).collect()
    return [sum(r["n"] for r in counts if r["fold"] == f and r["label"] == r["prediction"]) /
            sum(r["n"] for r in counts if r["fold"] == f) for f in (0, 1)], fitted


def test_kernel_machine_tells_rings_apart(spark):
    """A constant column among them: no not-a-number anywhere."""
    rows = rings(spark)
    met, (weights, _) = accuracy(rows, kernels.KernelMachine())
    assert min(met) > 0.97 and np.isfinite(weights).all()
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC

    from millrace.operators import learn
    linear = Pipeline(stages=learn.preparation(["a", "b"]) + [LinearSVC()]).fit(rows.filter("m0 >= 0")).transform(rows.filter("m0 < 0"))
    assert linear.filter("prediction = label").count() / linear.count() < 0.75


def test_kernel_machine_reaches_the_minimum(spark):
    """The gradient of the squared hinge loss vanishes at the fitted weights."""
    rows, machine = rings(spark, 120), kernels.KernelMachine(width=24)
    _, (weights, scaling) = accuracy(rows, machine)
    some = rows.filter("m0 >= 0").toPandas()
    z = machine.lifted((some[COLUMNS].to_numpy() - scaling[0][0]) / scaling[0][1])
    for k in (0, 1):
        sign, w = np.where(some["label"] == k, 1.0, -1.0), weights[0, k]
        gap = np.maximum(1 - sign * (z @ w), 0)
        slope = np.append(w[:-1], 1e-6 * w[-1]) - 2 * machine.c * z.T @ (sign * gap)
        assert np.abs(slope).max() < 1e-3


def test_random_features_stand_for_the_kernel():
    x = np.random.default_rng(4).normal(size=(30, 4))
    machine = kernels.KernelMachine(width=20_000)
    z = machine.lifted(x)[:, :-1]
    assert np.allclose(z @ z.T, np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / 4), atol=0.05)


def test_benchmark_search_and_curve(rows):
    table = comparison.classifier_benchmark(rows.drop("m0", "m1"), "id", COLUMNS, "label", 2, trees=10, boosting_rounds=10).toPandas()
    assert set(table["model"]) == {"Logistic Regression", "Decision Tree", "Random Forest", "Gradient Boosting", "SVM", "KNN"}
    assert (table["test_accuracy"] > 0.5).all() and table["test_accuracy"].is_monotonic_decreasing
    found = comparison.search(rows, "id", COLUMNS, "label", comparison.forest_grid([3, 8], [1, 4], [1]), 2).orderBy("rank").toPandas()
    assert found["rank"].tolist() == [1, 2, 3, 4] and found["mean_score"].is_monotonic_decreasing
    curve = comparison.learning_curve(rows.drop("m0", "m1"), "id", COLUMNS, "label", {"d3": Forest(5, 3)}, [0.25, 1.0], 2).toPandas()
    assert len(curve) == 4
    for _, part in curve.groupby("fold"):
        small, large = part.sort_values("share")["n_train"]
        assert small == np.ceil(large * 0.25) and abs(large - 120) <= 1
    scores = comparison.cv_scores(rows, "id", COLUMNS, "label", Forest(5, 3), {"x": (2, 7, False), "y": (3, 7, True)}).toPandas()
    assert sorted(zip(scores["strategy"], scores["fold"])) == [("x", 0), ("x", 1), ("y", 0), ("y", 1), ("y", 2)]
    names = lambda: [p for p, _ in comparison.sampled_forests(6, 1)]
    assert names() == names() and len(names()) == 6


def test_shares_take_the_first_rows_of_the_others(rows):
    from millrace.operators import learn
    from millrace.operators.splits import digest

    shaped = learn.prepared(rows, "id", COLUMNS, "label", 3).withColumn("d", digest(F.col("id"), "curve"))
    marked = comparison.curve_marks(shaped, "id", [0.1, 0.5, 1.0], 3).toPandas()
    for fold in range(3):
        others = marked[marked["fold"] != fold].sort_values(["d", "id"])
        assert (marked[marked["fold"] == fold][f"m{fold}"] == -1).all()
        ends = [int(np.ceil(s * len(others))) for s in (0.1, 0.5, 1.0)]
        assert others[f"m{fold}"].tolist() == [next(s for s, e in enumerate(ends) if i < e) for i in range(len(others))]


def test_cells_add_up_rows_of_the_same_bins(rows):
    """Rows met three times make no new cells; draws and counts are those of the rows."""
    block = Blocks.of(rows, "id", COLUMNS, "label", ["m0", "m1"]).rows.first()
    opened, thrice = Blocks.open(block), ensembles.Cells([block] * 3, 1, 1, 3)
    used = opened["marks"][:, 1] != 2
    assert len(thrice.codes) == len(np.unique(opened["codes"][used], axis=0))
    assert thrice.counts["train"].sum() == 3 * np.isin(opened["marks"][:, 1], (0, 1)).sum()
    assert thrice.counts["validation"].sum() == 3 * (opened["marks"][:, 1] == -1).sum()
    cell = {tuple(c): i for i, c in enumerate(thrice.codes)}
    drawn = np.zeros_like(thrice.counts["train"])
    for codes, label, key, mark in zip(opened["codes"], opened["labels"], opened["keys"], opened["marks"][:, 1]):
        if mark in (0, 1):
            uniform = (ensembles._mixed(np.array([key]) ^ ensembles._salt(42, 7)) >> np.uint64(11)) * 2.0 ** -53
            drawn[cell[tuple(codes)], label] += 3 * np.searchsorted(ensembles._POISSON, uniform, side="right")[0]
    assert (thrice.weights(Forest(1), 7) == drawn.T).all()
    wide = np.random.default_rng(2).integers(0, 2, (500, 9)).astype(np.uint8)
    distinct, ids = ensembles.Cells.distinct(wide)
    assert (distinct[ids] == wide).all() and len(distinct) == len(np.unique(wide, axis=0))


def test_cells_grow_the_trees_of_their_rows(rows):
    block = Blocks.of(rows, "id", COLUMNS, "label", ["m0", "m1"]).rows.first()
    opened, cells = Blocks.open(block), ensembles.Cells([block], 0, 0, 3)
    for model in (Forest(1, 6, 3), Forest(1, 5, subset="all", bagged=False)):
        tree = ensembles.grow_on_cells(cells, model, 4, lambda *_: None)
        same = ensembles.grow_tree(opened, model, 0, 0, 4, model.tried(3), 3, lambda *_: None)
        assert all((a == b).all() for a, b in zip(tree.arrays(), same.arrays())) and len(tree.feature) > 9
    by_row = ensembles.boost(opened, Boosted(8, 3), 0, 0, 3)
    at = {tuple(c): i for i, c in enumerate(cells.codes)}
    assert (by_row == ensembles.boost_cells(cells, Boosted(8, 3))[[at[tuple(c)] for c in opened["codes"]]]).all()


def test_classes_added_up_side_by_side():
    """Whole numbers of any size meet exactly, one, two or many classes to a number."""
    random = np.random.default_rng(8)
    for classes, top in ((3, 9), (5, 900_000), (2, 1 << 40), (3, 0)):
        weights, index = random.integers(0, top + 1, (classes, 400)).astype(float), random.integers(0, 6, 400)
        plain = np.array([np.bincount(index, w, 7) for w in weights])
        assert (np.array(ensembles._class_sums(index, weights, 7, plain.max())) == plain).all()
