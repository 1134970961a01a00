"""Training, search, calibration and scoring with Spark ML."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.arrays import argmax, named_probabilities
from millrace.functions.scalars import label_name
from millrace.operators.evaluation import (
    classification_report, quality, quality_gate, regression_metrics,
)
from millrace.operators.isotonic import IsotonicModel
from millrace.operators.neighbors import knn_topk, knn_vote
from millrace.operators.splits import exact_split, kfold_assign, stratified_split
from millrace.operators.validation import run_checks
from millrace.session import cut_lineage


# --- features ----------------------------------------------------------------

def standardize(df: DataFrame, columns, ddof: int = 0, suffix: str = "_scaled") -> DataFrame:
    """Columns less their mean over their standard deviation (population for ddof 0, sample for 1).

    The statistics are one row from one aggregation, used as a scalar; a constant
    column becomes 0.
    """
    spread = F.stddev_pop if ddof == 0 else F.stddev_samp
    value = {c: F.col(c).cast("double") for c in columns}
    stats = df.agg(F.struct(*[F.struct(F.avg(v).alias("m"), spread(v).alias("s")).alias(c) for c, v in value.items()]))
    scaled = df.withColumn("_stats", stats.scalar())
    return scaled.withColumns({
        f"{c}{suffix}": F.when(v.isNotNull(), F.coalesce(
            F.try_divide(v - F.col(f"_stats.{c}.m"), F.col(f"_stats.{c}.s")), F.lit(0.0)))
        for c, v in value.items()}).drop("_stats")


def preparation(columns, scale_mean: bool = False):
    """Assembler and scaler stages: column `features` from numeric columns."""
    return [
        VectorAssembler(inputCols=list(columns), outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=scale_mean, withStd=True),
    ]


def fit_pca(df: DataFrame, columns, k: int = 2) -> PipelineModel:
    """Assemble, standardise and project to `k` components (`pca_features`)."""
    return Pipeline(stages=preparation(columns, True) + [
        PCA(k=k, inputCol="features", outputCol="pca_features")]).fit(df)


def explained_variance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """(component, share, cumulative) of a fitted projection: the scree table, one row per component."""
    shares = [float(x) for x in model.stages[-1].explainedVariance]
    rows = [(i + 1, s, float(c)) for i, (s, c) in enumerate(zip(shares, np.cumsum(shares)))]
    return spark.createDataFrame(rows, "component int, share double, cumulative double")


# --- classifiers -------------------------------------------------------------

def random_forest(trees: int = 100, depth: int = 5, seed: int = 42, **options):
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **options)


def benchmark_classifiers(trees: int = 100, boosting_rounds: int = 100, max_iter: int = 1000) -> dict:
    """The compared classifiers. Boosting and the linear SVM have two classes only, so one per class is fitted."""
    return {
        "Logistic Regression": LogisticRegression(maxIter=max_iter),
        "Decision Tree": DecisionTreeClassifier(maxDepth=5),
        "Random Forest": random_forest(trees),
        "Gradient Boosting": OneVsRest(classifier=GBTClassifier(maxIter=boosting_rounds, maxDepth=3, seed=42), parallelism=4),
        "SVM": OneVsRest(classifier=LinearSVC(maxIter=max_iter, regParam=0.01, tol=1e-4), parallelism=4),
    }


def _cross_validator(estimator, grid, folds, parallelism):
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
        numFolds=folds, foldCol="fold", parallelism=parallelism)


def cross_validate(df: DataFrame, estimator, folds: int, grid=None, parallelism: int = 4):
    """Accuracy of every parameter map: [(params, mean, population std)].

    `df` has label, fold and what the estimator reads.
    """
    grid = grid or [{}]
    rows = df
    if not df.is_cached:
        rows = rows.persist()
    try:
        model = _cross_validator(estimator, grid, folds, parallelism).fit(rows)
    finally:
        if not df.is_cached:
            rows.unpersist()
    return [({p.name: v for p, v in params.items()}, float(m), float(s))
            for params, m, s in zip(grid, model.avgMetrics, model.stdMetrics)]


def prepared(df: DataFrame, key: str, columns, label: str, folds: int = 5, seed=42, stratified: bool = True) -> DataFrame:
    """(key, label, columns, fold): balanced folds, dealt once for all fits. Nothing is fitted here."""
    rows = df.select(key, F.col(label).cast("double").alias("label"), *columns)
    return kfold_assign(rows, key, folds, seed, "label" if stratified else None)


def with_preparation(columns, estimator, scale_mean: bool = False) -> Pipeline:
    """The estimator behind assembler and scaler, so that both learn from the rows of each fit alone."""
    return Pipeline(stages=preparation(columns, scale_mean) + [estimator])


def classifier_benchmark(df: DataFrame, key: str, columns, label: str, folds: int = 5, knn: int | None = 5,
                         **sizes) -> DataFrame:
    """(model, cv_mean, cv_std, test_accuracy, f1_weighted), best test accuracy first."""
    split = stratified_split(df, key, label)
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    train = prepared(train, key, columns, label, folds).persist()
    test = test.select(key, F.col(label).cast("double").alias("label"), *columns).persist()
    train.count(), test.count()  # both are in memory before the fits start side by side

    def measured(name, scores, predictions):
        found = quality(predictions, label="label").first()
        return name, *scores, found["accuracy"], found["f1_weighted"]

    def one(name, classifier):
        estimator = with_preparation(columns, classifier)
        _, mean, std = cross_validate(train, estimator, folds)[0]
        return measured(name, (mean, std), estimator.fit(train).transform(test))

    def neighbours(fit_on, asked):
        scaler = Pipeline(stages=preparation(columns)).fit(fit_on)
        arrays = [scaler.transform(side).select(key, "label", vector_to_array("features").alias("v"))
                  for side in (fit_on, asked)]
        votes = knn_vote(knn_topk(*arrays, knn, key, "v"), arrays[0], key)
        return asked.select(F.col(key).alias("query_id"), "label").join(votes, "query_id")

    def by_neighbours():
        scores = [quality(neighbours(train.filter(F.col("fold") != i), train.filter(F.col("fold") == i)),
                          label="label").first()["accuracy"] for i in range(folds)]
        return measured("KNN", (float(np.mean(scores)), float(np.std(scores))), neighbours(train, test))

    tasks = [(lambda a=pair: one(*a)) for pair in benchmark_classifiers(**sizes).items()]
    rows = _in_parallel(tasks + ([by_neighbours] if knn else []))
    train.unpersist()
    test.unpersist()
    digits = [(name, *[round(float(x), 4) for x in values]) for name, *values in rows]
    table = df.sparkSession.createDataFrame(
        digits, "model string, cv_mean double, cv_std double, test_accuracy double, f1_weighted double")
    return table.orderBy(F.desc("test_accuracy"), "model")


# --- search and curves -------------------------------------------------------

def forest_grid(trees, depths, min_instances):
    """Grid over forest size, depth and the smallest leaf, which stands in for a smallest split."""
    forest = random_forest()
    grid = (
        ParamGridBuilder().addGrid(forest.numTrees, list(trees)).addGrid(forest.maxDepth, list(depths))
        .addGrid(forest.minInstancesPerNode, list(min_instances)).build()
    )
    return forest, grid


def sampled_forests(trials: int = 20, seed: int = 42, trees=(50, 300), depth=(3, 15), leaf=(1, 5)):
    """`trials` parameter maps drawn evenly from the given ranges."""
    forest = random_forest()
    random = np.random.default_rng(seed)
    pick = lambda ends: int(random.integers(ends[0], ends[1], endpoint=True))
    grid = [{forest.numTrees: pick(trees), forest.maxDepth: pick(depth), forest.minInstancesPerNode: pick(leaf),
             forest.featureSubsetStrategy: str(random.choice(["sqrt", "log2"]))} for _ in range(trials)]
    return forest, grid


def search(df: DataFrame, estimator, grid, columns, folds: int = 5, parallelism: int = 4) -> DataFrame:
    """(trial, params, mean_score, std_score, rank) of all parameter maps over `prepared` rows."""
    results = cross_validate(df, with_preparation(columns, estimator), folds, grid, parallelism)
    by_score = sorted(range(len(results)), key=lambda i: (-results[i][1], i))
    rank = {i: place + 1 for place, i in enumerate(by_score)}
    rows = [(i, {k: str(v) for k, v in params.items()}, mean, std, rank[i])
            for i, (params, mean, std) in enumerate(results)]
    return df.sparkSession.createDataFrame(
        rows, "trial int, params map<string,string>, mean_score double, std_score double, rank int")


def cv_scores(df: DataFrame, key: str, columns, label: str, estimator, strategies: dict) -> DataFrame:
    """(strategy, fold, score) for strategies given as {name: (folds, seed, stratified)}."""
    rows = []
    for name, (folds, seed, stratified) in strategies.items():
        shaped = prepared(df, key, columns, label, folds, seed, stratified).persist()
        whole = with_preparation(columns, estimator)
        scores = _in_parallel([
            (lambda i=i: _accuracy(whole.fit(shaped.filter(F.col("fold") != i)), shaped.filter(F.col("fold") == i)))
            for i in range(folds)])
        rows += [(name, i, s) for i, s in enumerate(scores)]
        shaped.unpersist()
    return df.sparkSession.createDataFrame(rows, "strategy string, fold int, score double")


def _accuracy(model, rows):
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(model.transform(rows))


def _in_parallel(tasks, threads: int = 4):
    """Start fits from a few threads, so that one fit's small stages do not leave the cluster idle."""
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(lambda task: task(), tasks))


def learning_curve(df: DataFrame, key: str, columns, label: str, models: dict, shares=None, folds: int = 5) -> DataFrame:
    """(model, share, fold, n_train, train_accuracy, validation_accuracy).

    The training rows of a smaller share are among those of a larger one: each
    share takes exactly the first ceil(share x n) rows of the fold in digest order.
    """
    shares = shares or [i / 10 for i in range(1, 11)]
    shaped = prepared(df, key, columns, label, folds).persist()

    def part(share, fold):
        """All models on one share of one fold: its rows are chosen once."""
        chosen = exact_split(shaped.filter(F.col("fold") != fold), key, share, "curve").filter("is_test").persist()
        n, held_out, rows = chosen.count(), shaped.filter(F.col("fold") == fold), []
        for name, estimator in models.items():
            model = with_preparation(columns, estimator).fit(chosen)
            rows.append((name, share, fold, n, _accuracy(model, chosen), _accuracy(model, held_out)))
        chosen.unpersist()
        return rows

    parts = _in_parallel([(lambda a=(share, fold): part(*a)) for share in shares for fold in range(folds)])
    rows = [row for some in parts for row in some]
    shaped.unpersist()
    return df.sparkSession.createDataFrame(
        rows, "model string, share double, fold int, n_train bigint, train_accuracy double, validation_accuracy double")


# --- calibration -------------------------------------------------------------

def _positive(df, name="score"):
    return df.withColumn(name, vector_to_array("probability")[1])


@dataclass(frozen=True)
class PlattScaling:
    """Logistic regression on the score, with the targets moved off 0 and 1 as Platt proposed."""

    def fit(self, scored: DataFrame):
        sizes = scored.agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n")).first()
        high, low = (sizes["p"] + 1) / (sizes["p"] + 2), 1 / (sizes["n"] + 2)
        target = F.when(F.col("label") == 1, F.lit(high)).otherwise(F.lit(low))
        halves = scored.select("score", F.inline(F.array(
            F.struct(F.lit(1.0).alias("label"), target.alias("weight")),
            F.struct(F.lit(0.0).alias("label"), (1 - target).alias("weight")))))
        shaped = halves.withColumn("features", array_to_vector(F.array("score")))
        model = LogisticRegression(weightCol="weight", maxIter=200, tol=1e-10).fit(shaped)
        return float(model.coefficients[0]), float(model.intercept)

    def transform(self, fitted, df: DataFrame, name: str) -> DataFrame:
        slope, intercept = fitted
        return df.withColumn(name, 1 / (1 + F.exp(-(F.lit(slope) * F.col("score") + F.lit(intercept)))))


@dataclass(frozen=True)
class IsotonicScaling:
    """Non-decreasing step function of the score, linear between its steps."""

    def fit(self, scored: DataFrame):
        return IsotonicModel.fit(scored)

    def transform(self, fitted, df: DataFrame, name: str) -> DataFrame:
        return fitted.transform(df, name)


def calibrated_by(train: DataFrame, test: DataFrame, key: str, estimator, scalings: dict, folds: int = 5) -> DataFrame:
    """`test` with a column per scaling in `scalings`: the mean over folds of (model of the other folds,
    scaling of this fold). Every fold's model is fitted once, for all scalings.

    Both frames have the key, a 0/1 `label` and what the estimator reads.
    """
    dealt = kfold_assign(train, key, folds, label="label").persist()

    def one(fold):
        model = estimator.fit(dealt.filter(F.col("fold") != fold))
        held_out = _positive(model.transform(dealt.filter(F.col("fold") == fold))).select("score", "label").persist()
        fitted = {name: scaling.fit(held_out) for name, scaling in scalings.items()}
        held_out.unpersist()
        return model, fitted

    scored = test
    for fold, (model, fitted) in enumerate(_in_parallel([(lambda i=i: one(i)) for i in range(folds)])):
        kept, scored = scored.columns, _positive(model.transform(scored))
        for name, scaling in scalings.items():
            scored = scaling.transform(fitted[name], scored, f"_c{fold}_{name}")
        scored = scored.select(*kept, *[f"_c{fold}_{name}" for name in scalings])
    dealt.unpersist()
    means = {name: sum([F.col(f"_c{i}_{name}") for i in range(1, folds)], F.col(f"_c0_{name}")) / folds for name in scalings}
    return scored.select(*test.columns, *[mean.alias(name) for name, mean in means.items()])


def calibrated_scores(train: DataFrame, test: DataFrame, key: str, estimator, scaling, folds: int = 5) -> DataFrame:
    """`test` with `calibrated`, for one scaling."""
    return calibrated_by(train, test, key, estimator, {"calibrated": scaling}, folds)


# --- regression and clustering -----------------------------------------------

def ridge(df: DataFrame, label: str = "label", alpha: float = 1.0):
    """Ridge regression minimising |y - Xw - c|^2 + alpha |w|^2, by the normal equations.

    Spark divides the squared error by 2n and scales the penalty by the label's
    spread, hence the conversion of alpha.
    """
    stats = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return LinearRegression(labelCol=label, elasticNetParam=0.0, standardization=False, solver="normal",
                            regParam=alpha * stats["s"] / stats["n"]).fit(df)


def regression_models(train: DataFrame, test: DataFrame, alpha: float = 1.0, boosting_rounds: int = 100) -> DataFrame:
    """(model, n, rmse, mae, r2) of ridge and boosted trees on the test rows."""
    fits = _in_parallel([
        lambda: ("Ridge", ridge(train, "label", alpha)),
        lambda: ("GBR", GBTRegressor(maxIter=boosting_rounds, maxDepth=3, stepSize=0.1, seed=42).fit(train))])
    scored = [model.transform(test).select(F.lit(name).alias("model"), "label", "prediction") for name, model in fits]
    return regression_metrics(scored[0].unionByName(scored[1]), "label", "prediction", ["model"])


def best_kmeans(df: DataFrame, k: int, restarts: int = 10, seed: int = 42):
    """The k-means fit of least cost among `restarts` seeds."""
    models = _in_parallel([(lambda s=s: KMeans(k=k, seed=s).fit(df)) for s in range(seed, seed + restarts)])
    return min(models, key=lambda m: m.summary.trainingCost)


def kmeans_elbow(df: DataFrame, ks=range(2, 10), restarts: int = 10) -> DataFrame:
    """(k, inertia, silhouette_squared): the silhouette is the squared-distance form Spark computes at scale."""
    held, rows = df.select("features").persist(), []  # read by every fit
    for k in ks:
        model = best_kmeans(held, k, restarts)
        rows.append((k, float(model.summary.trainingCost), float(ClusteringEvaluator().evaluate(model.transform(held)))))
    held.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette_squared double")


def feature_importance(model, columns, spark: SparkSession) -> DataFrame:
    """(feature, importance), least first."""
    rows = [(c, float(v)) for c, v in zip(columns, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy("importance", "feature")


# --- text, scoring and the whole run -----------------------------------------

def text_classifier(rows: DataFrame, strength: float = 1.0, max_iter: int = 1000):
    """Multinomial logistic regression with an L2 penalty of 1 / strength on the summed loss."""
    n = rows.count()
    return LogisticRegression(family="multinomial", maxIter=max_iter, regParam=1.0 / (strength * n),
                              standardization=False).fit(rows)


def batch_score(model, df: DataFrame, names: dict, keep=()) -> DataFrame:
    """Class, class name, confidence and rounded class probabilities of every row; works on streams."""
    scored = model.transform(df).withColumn("_p", vector_to_array("probability"))
    return scored.withColumn("class", argmax(F.col("_p"))).select(
        *keep, F.col("class").alias("prediction"), label_name(F.col("class"), names).alias("class_name"),
        F.round(F.array_max("_p"), 4).alias("confidence"),
        named_probabilities([names[c] for c in sorted(names)], F.col("_p")).alias("probabilities"))


@dataclass(frozen=True)
class TrainedModel:
    """What one run of `train_and_gate` leaves: the model, its report and the gate's verdict."""

    model: PipelineModel
    report: DataFrame
    verdict: DataFrame


def train_and_gate(df: DataFrame, key: str, columns, label: str, checks, trees: int = 150, depth: int = 6,
                   threshold: float = 0.90) -> TrainedModel:
    """Check the data, split it by class, train a forest, report on the test rows and judge the accuracy.

    Failed checks stop the run before anything is trained.
    """
    failed = [f"{row['check']}({row['column']})" for row in run_checks(df, checks).filter(~F.col("passed")).collect()]
    if failed:
        raise ValueError("data checks failed: " + ", ".join(failed))
    split = cut_lineage(stratified_split(df, key, label), "gate")
    stages = preparation(columns) + [random_forest(trees, depth, labelCol=label)]
    model = Pipeline(stages=stages).fit(split.filter(~F.col("is_test")))
    predictions = model.transform(split.filter("is_test")).select(F.col(label).cast("double").alias("y_true"), "prediction")
    metrics = quality(predictions).withColumn("accuracy", F.round("accuracy", 4))
    return TrainedModel(model, classification_report(predictions), quality_gate(metrics, threshold, round_digits=4))
