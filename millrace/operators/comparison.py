"""Comparing classifiers: benchmark, searches, cross-validation and learning curves over ensembles grown together."""

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import ensembles, kernels, learn
from millrace.operators.ensembles import Blocks, Boosted, Forest, Run
from millrace.operators.evaluation import quality
from millrace.operators.neighbors import knn_topk, knn_vote
from millrace.operators.ordered import row_index, running_sums
from millrace.operators.splits import digest, kfold_assign, stratified_split
from millrace.session import cut_lineage


def fold_marks(rows: DataFrame, folds: int, fold: str = "fold", name: str = "m") -> DataFrame:
    """A column per fold: -1 for the rows of the fold, 0 for the others."""
    return rows.withColumns({f"{name}{i}": F.when(F.col(fold) == i, -1).otherwise(0) for i in range(folds)})


def forest_grid(trees, depths, leaves):
    """[(parameters, forest)] of every combination."""
    return [_named(Forest(t, d, leaf)) for t in trees for d in depths for leaf in leaves]


def sampled_forests(trials: int = 20, seed: int = 42, trees=(50, 300), depth=(3, 15), leaf=(1, 5)):
    """`trials` forests drawn evenly from the given ranges."""
    random = np.random.default_rng(seed)
    pick = lambda ends: int(random.integers(ends[0], ends[1], endpoint=True))
    return [_named(Forest(pick(trees), pick(depth), pick(leaf), str(random.choice(["sqrt", "log2"])))) for _ in range(trials)]


def _named(forest: Forest):
    return ({"numTrees": forest.trees, "maxDepth": forest.depth, "minInstancesPerNode": forest.leaf,
             "featureSubsetStrategy": forest.subset}, forest)


def search(df: DataFrame, key: str, columns, label: str, forests, folds: int = 5, **sizes) -> DataFrame:
    """(trial, params, mean_score, std_score, rank) of all forests, by accuracy over stratified folds."""
    shaped = fold_marks(learn.prepared(df, key, columns, label, folds), folds)
    blocks = Blocks.of(shaped, key, columns, "label", [f"m{i}" for i in range(folds)], **sizes)
    runs = {(t, i): Run("forest", forest, i) for t, (_, forest) in enumerate(forests) for i in range(folds)}
    met = ensembles.scores(blocks, runs.values())
    means = [[met[runs[t, i]]["validation"][0] for i in range(folds)] for t in range(len(forests))]
    order = sorted(range(len(forests)), key=lambda t: (-np.mean(means[t]), t))
    rank = {t: place + 1 for place, t in enumerate(order)}
    rows = [(t, {k: str(v) for k, v in params.items()}, float(np.mean(means[t])), float(np.std(means[t])), rank[t])
            for t, (params, _) in enumerate(forests)]
    return df.sparkSession.createDataFrame(
        rows, "trial int, params map<string,string>, mean_score double, std_score double, rank int")


def cv_scores(df: DataFrame, key: str, columns, label: str, forest: Forest, strategies: dict, **sizes) -> DataFrame:
    """(strategy, fold, score) for strategies given as {name: (folds, seed, stratified)}, all in one pass."""
    rows, marks = df.select(key, F.col(label).cast("double").alias("label"), *columns), []
    for n, (folds, seed, stratified) in enumerate(strategies.values()):
        rows = fold_marks(kfold_assign(rows, key, folds, seed, "label" if stratified else None), folds, name=f"s{n}_").drop("fold")
        marks += [f"s{n}_{i}" for i in range(folds)]
    blocks = Blocks.of(cut_lineage(rows, "strategies"), key, columns, "label", marks, **sizes)
    met = ensembles.scores(blocks, [Run("forest", forest, i) for i in range(len(marks))])
    owners = [(name, i) for name, (folds, _, _) in strategies.items() for i in range(folds)]
    by_mark = {run.fold: found["validation"][0] for run, found in met.items()}
    return df.sparkSession.createDataFrame(
        [(name, i, by_mark[n]) for n, (name, i) in enumerate(owners)], "strategy string, fold int, score double")


def curve_marks(shaped: DataFrame, key: str, shares, folds: int) -> DataFrame:
    """A column per fold: -1 for its rows; for the others the number of the least share that takes the row,
    where a share takes the first ceil(share x n) of them in digest order."""
    placed = row_index(shaped.withColumn("_d", digest(F.col(key), "curve")), ["_d", key], "_at").drop("_d")
    own = placed.withColumns({f"_o{i}": (F.col("fold") == i).cast("bigint") for i in range(folds)})
    counted = running_sums(own.withColumn("_one", F.lit(1).cast("bigint")), "_at",
                           {**{f"_b{i}": f"_o{i}" for i in range(folds)}, "_all": "_one"}, totals=True)
    steps = {}
    for i in range(folds):
        others = F.col("_all_total") - F.col(f"_b{i}_total")
        taken = F.array(*[F.ceil(F.lit(float(s)) * others) for s in shares])
        rank = F.col("_at") - F.col(f"_b{i}")
        step = F.size(F.filter(taken, lambda n: n <= rank))
        steps[f"m{i}"] = F.when(F.col("fold") == i, -1).when(step < len(shares), step).otherwise(-2)
    return counted.withColumns(steps).select(*shaped.columns, *steps)


def learning_curve(df: DataFrame, key: str, columns, label: str, models: dict, shares=None, folds: int = 5, **sizes) -> DataFrame:
    """(model, share, fold, n_train, train_accuracy, validation_accuracy) of forests by name."""
    shares = shares or [i / 10 for i in range(1, 11)]
    shaped = cut_lineage(learn.prepared(df, key, columns, label, folds), "curve")
    marked = curve_marks(shaped, key, shares, folds)
    blocks = Blocks.of(marked, key, columns, "label", [f"m{i}" for i in range(folds)], **sizes)
    runs = {(name, s, i): Run(name, forest, i, s) for name, forest in models.items() for s in range(len(shares)) for i in range(folds)}
    met = ensembles.scores(blocks, runs.values())
    rows = []
    for (name, s, i), run in runs.items():
        (train, _, n), (held_out, _, _) = met[run]["train"], met[run]["validation"]
        rows.append((name, float(shares[s]), i, int(n), train, held_out))
    return df.sparkSession.createDataFrame(
        rows, "model string, share double, fold int, n_train bigint, train_accuracy double, validation_accuracy double")


def benchmark_models(trees: int = 100, boosting_rounds: int = 100):
    """The compared ensembles by name."""
    return {"Decision Tree": Forest(1, 5, subset="all", bagged=False), "Random Forest": Forest(trees),
            "Gradient Boosting": Boosted(boosting_rounds)}


def classifier_benchmark(df: DataFrame, key: str, columns, label: str, folds: int = 5, knn: int | None = 5, trees: int = 100,
                         boosting_rounds: int = 100, max_iter: int = 1000, machine=kernels.KernelMachine(),
                         **sizes) -> DataFrame:
    """(model, cv_mean, cv_std, test_accuracy, f1_weighted), best test accuracy first."""
    columns = list(columns)
    split = cut_lineage(stratified_split(df, key, label), "benchmark")
    dealt = learn.prepared(split.filter(~F.col("is_test")), key, columns, label, folds)
    train = cut_lineage(fold_marks(dealt, folds).withColumn(f"m{folds}", F.lit(0)), "benchmark-train")
    test = split.filter("is_test").select(key, F.col(label).cast("double").alias("label"), *columns)
    whole = cut_lineage(train.drop("fold").unionByName(test.withColumns(
        {**{f"m{i}": F.lit(-2) for i in range(folds)}, f"m{folds}": F.lit(-1)})), "benchmark-rows")
    marks = [f"m{i}" for i in range(folds + 1)]
    blocks = Blocks.of(whole, key, columns, "label", marks, **sizes)
    rows = []

    def add(name, found):
        """`found`: (accuracy, weighted F1) per fold, the test rows last."""
        held_out = [a for a, _ in found[:-1]]
        rows.append((name, *[round(float(x), 4) for x in (np.mean(held_out), np.std(held_out), *found[-1])]))

    def by_ensembles():
        models = benchmark_models(trees, boosting_rounds)
        runs = {(name, i): Run(name, model, i) for name, model in models.items() for i in range(folds + 1)}
        met = ensembles.scores(blocks, runs.values())
        for name in models:
            add(name, [met[runs[name, i]]["validation"][:2] for i in range(folds + 1)])

    def by_machine():
        fitted = kernels.fit_machines(whole, columns, marks, blocks.classes, machine)
        counts = {}
        for row in kernels.judge_machines(whole, columns, marks, blocks.classes, machine, fitted).collect():
            counts.setdefault(row["fold"], {})[row["label"], row["prediction"]] = row["n"]
        add("SVM", [ensembles.quality(counts.get(i, {})) for i in range(folds + 1)])

    def sides(i):
        if i == folds:
            return train, test
        return train.filter(F.col("fold") != i), train.filter(F.col("fold") == i)

    def measured(predictions):
        found = quality(predictions, label="label").first()
        return found["accuracy"], found["f1_weighted"]

    def by_logistic(i):
        fit_on, asked = sides(i)
        model = learn.with_preparation(columns, LogisticRegression(maxIter=max_iter)).fit(fit_on)
        return measured(model.transform(asked))

    def by_neighbours(i):
        fit_on, asked = sides(i)
        scaler = Pipeline(stages=learn.preparation(columns)).fit(fit_on)
        arrays = [scaler.transform(side).select(key, "label", vector_to_array("features").alias("v")) for side in (fit_on, asked)]
        votes = knn_vote(knn_topk(*arrays, knn, key, "v"), arrays[0], key)
        return measured(asked.select(F.col(key).alias("query_id"), "label").join(votes, "query_id"))

    tasks = [by_ensembles, by_machine]
    tasks += [(lambda i=i: by_logistic(i)) for i in range(folds + 1)]
    tasks += [(lambda i=i: by_neighbours(i)) for i in range(folds + 1)] if knn else []
    done = learn._in_parallel(tasks)
    add("Logistic Regression", done[2:3 + folds])
    if knn:
        add("KNN", done[3 + folds:])
    table = df.sparkSession.createDataFrame(
        rows, "model string, cv_mean double, cv_std double, test_accuracy double, f1_weighted double")
    return table.orderBy(F.desc("test_accuracy"), "model")
