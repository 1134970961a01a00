import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from millrace.operators import learn, textfeatures, validation
from millrace.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def rows(spark):
    random = np.random.default_rng(5)
    x = random.normal(size=(240, 3)) * [1.0, 3.0, 0.5] + [2.0, -1.0, 0.0]
    y = (x[:, 0] + x[:, 1] / 3 > 1.7).astype(int) + (x[:, 2] > 0.4)
    data = [(i, *map(float, p), int(c)) for i, (p, c) in enumerate(zip(x, y))]
    return x, spark.createDataFrame(data, "id bigint, a double, b double, c double, label int").persist()


COLUMNS = ["a", "b", "c"]


@pytest.mark.parametrize("ddof", [0, 1])
def test_standardize_equals_numpy(rows, ddof):
    x, df = rows
    got = learn.standardize(df, COLUMNS, ddof).orderBy("id").select(*[f"{c}_scaled" for c in COLUMNS]).toPandas().to_numpy()
    assert np.allclose(got, (x - x.mean(0)) / x.std(0, ddof=ddof))


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert {r["v_scaled"] for r in learn.standardize(df, ["v"]).collect()} == {0.0}


def test_explained_variance_equals_eigenvalues(spark, rows):
    x, df = rows
    got = learn.explained_variance(learn.fit_pca(df, COLUMNS, 3), spark).orderBy("component").toPandas()
    values = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1]
    assert np.allclose(got["share"], values / values.sum())
    assert np.allclose(got["cumulative"], np.cumsum(values / values.sum()))


def test_ridge_equals_the_closed_form(spark):
    random = np.random.default_rng(8)
    x = random.normal(size=(120, 3))
    y = x @ [1.0, -2.0, 0.5] + 4 + random.normal(size=120)
    df = spark.createDataFrame([([*map(float, p)], float(t)) for p, t in zip(x, y)], "v array<double>, label double")
    model = learn.ridge(df.select(array_to_vector("v").alias("features"), "label"), alpha=2.5)
    centred = x - x.mean(0)
    want = np.linalg.solve(centred.T @ centred + 2.5 * np.eye(3), centred.T @ (y - y.mean()))
    assert np.allclose(model.coefficients.toArray(), want, atol=1e-8)


def test_saved_model_predicts_the_same(rows, tmp_path):
    _, df = rows
    model = Pipeline(stages=learn.preparation(COLUMNS) + [learn.random_forest(5, 3)]).fit(df)
    save_model(model, str(tmp_path / "m"))
    back = load_model(str(tmp_path / "m"))
    predicted = lambda m: {r["id"]: r["prediction"] for r in m.transform(df).select("id", "prediction").collect()}
    assert predicted(model) == predicted(back)


def test_text_model_keeps_to_its_training_terms(spark, tmp_path):
    train = spark.createDataFrame([(1, "red blue"), (2, "red green"), (3, "red blue green"), (4, "")], "k int, c string")
    other = spark.createDataFrame([(7, "red red violet"), (8, "violet"), (9, "blue green")], "k int, c string")
    model = textfeatures.TfidfModel.fit(train, "k", F.col("c"), min_df=2, ngram_range=(1, 1))
    assert [r["term"] for r in model.vocabulary.orderBy("index").collect()] == ["blue", "green", "red"]
    model.save(str(tmp_path / "terms"))
    back = textfeatures.TfidfModel.load(spark, str(tmp_path / "terms"))
    rows = [m.vectors(other, "k", F.col("c")).orderBy("k").collect() for m in (model, back)]
    assert rows[0] == rows[1] and [r["features"].size for r in rows[0]] == [3, 3, 3]
    assert rows[0][0]["features"].toArray().tolist() == [0, 0, 1] and rows[0][1]["features"].numNonzeros() == 0
    labelled = train.withColumn("label", (F.col("k") % 2).cast("double"))
    fitted = learn.text_classifier(model.vectors(labelled, "k", F.col("c"), ["label"]), max_iter=20)
    scored = [learn.batch_score(fitted, m.vectors(other, "k", F.col("c")), {0: "a", 1: "b"}, ["k"]).orderBy("k").collect()
              for m in (model, back)]
    assert scored[0] == scored[1] and len(scored[0]) == 3


def test_scaling_learns_from_the_fitted_rows_alone(rows):
    _, df = rows
    shaped = learn.prepared(df, "id", COLUMNS, "label", 2)
    model = learn.with_preparation(COLUMNS, learn.random_forest(2, 2)).fit(shaped.filter("fold = 0"))
    part = shaped.filter("fold = 0").agg(*[F.stddev_samp(c) for c in COLUMNS]).first()
    assert np.allclose(model.stages[1].std.toArray(), list(part))


def test_terms_are_counted_in_partitions_of_bounded_text(spark, monkeypatch):
    """More text gives more partitions, none of them holding much; repeated and null ids still meet in one row a term."""
    rows = [(i, f"red fox w{i} red fox") for i in range(60)] + [(7, "red fox"), (None, "red fox"), (None, "red fox")]
    df = spark.createDataFrame(rows, "k bigint, c string")
    monkeypatch.setattr(textfeatures, "TEXT_BYTES", 100)
    terms = textfeatures.term_rows(df, "k", F.col("c"))
    assert terms.select(F.spark_partition_id()).distinct().count() > 5
    got = {(r["k"], r["term"]): r["tf"] for r in terms.collect()}
    assert (got[7, "red fox"], got[8, "red fox"], got[None, "red fox"]) == (3, 2, 2)
    assert textfeatures.term_rows(df.limit(0), "k", F.col("c")).count() == 0


def test_learning_curve_sizes_grow_exactly(rows):
    _, df = rows
    curve = learn.learning_curve(df, "id", COLUMNS, "label", {"tree": learn.random_forest(3, 3)}, [0.25, 1.0], folds=2).toPandas()
    assert len(curve) == 4
    for _, part in curve.groupby("fold"):
        small, large = part.sort_values("share")["n_train"]
        assert small == np.ceil(large * 0.25)


def test_grid_search_ranks_all_maps(rows):
    _, df = rows
    table = learn.search(learn.prepared(df, "id", COLUMNS, "label", 2), *learn.forest_grid([3], [1, 4], [1]), COLUMNS, folds=2)
    got = table.orderBy("rank").collect()
    assert len(got) == 2 and got[0]["mean_score"] >= got[1]["mean_score"]


def test_sampled_maps_repeat_with_the_seed():
    values = lambda: [{p.name: v for p, v in m.items()} for m in learn.sampled_forests(6, 1)[1]]
    assert values() == values() and len(values()) == 6


@pytest.mark.parametrize("scaling", [learn.PlattScaling(), learn.IsotonicScaling()])
def test_calibration_is_monotone_and_bounded(spark, scaling):
    scored = spark.range(400).select(
        (F.col("id") % 100 / 100).alias("score"), ((F.col("id") * 37 % 100) < F.col("id") % 100).cast("double").alias("label"))
    fitted = scaling.fit(scored)
    points = spark.range(-5, 106).select((F.col("id") / 100).alias("score"))
    got = [r[0] for r in scaling.transform(fitted, points, "p").orderBy("score").select("p").collect()]
    assert all(a <= b + 1e-12 for a, b in zip(got, got[1:])) and 0 <= got[0] and got[-1] <= 1


def test_run_stops_on_bad_data_and_gates_on_accuracy(spark, rows):
    _, df = rows
    with pytest.raises(ValueError, match="positive"):
        learn.train_and_gate(df, "id", COLUMNS, "label", [validation.all_positive("b")])
    done = learn.train_and_gate(df, "id", COLUMNS, "label", [validation.no_nulls("a")], 20, 5, threshold=0.5)
    verdict = done.verdict.first()
    assert verdict["passed"] and verdict["branch"] == "deploy" and verdict["n_samples"] == 48


def test_scores_come_with_names_and_probabilities(rows):
    _, df = rows
    model = Pipeline(stages=learn.preparation(COLUMNS) + [learn.random_forest(5, 3)]).fit(df)
    row = learn.batch_score(model, df, {0: "no", 1: "maybe", 2: "yes"}, ["id"]).first()
    assert set(row["probabilities"]) == {"no", "maybe", "yes"}
    assert sum(row["probabilities"].values()) == pytest.approx(1, abs=1e-3)
    assert row["probabilities"][row["class_name"]] == row["confidence"]


def test_elbow_cost_is_the_sum_of_squares(spark, rows):
    _, df = rows
    shaped = Pipeline(stages=learn.preparation(COLUMNS, True)).fit(df).transform(df).select("features").persist()
    model = learn.best_kmeans(shaped, 3, 2)
    points = np.array([r["features"].toArray() for r in shaped.collect()])
    centres = np.array(model.clusterCenters())
    cost = ((points[:, None] - centres[None]) ** 2).sum(-1).min(1).sum()
    assert model.summary.trainingCost == pytest.approx(cost, rel=1e-6)
