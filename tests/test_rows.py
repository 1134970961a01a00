import json
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import scalars, text
from millrace.operators import aggregates, evaluation, frames, neighbors, runs, validation
from millrace.sources import events as ev
from millrace.sources import files


def test_text_matches_the_two_step_definition(spark):
    samples = ["Hello,  World!\n\tTabs", "  ", "", "Ünïcode café x", "a.b..c", "ÀÉ 42%"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r[0] for r in df.select(text.clean_text(F.col("t"))).collect()]
    want = [re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", s.lower())).strip() for s in samples]
    assert got == want
    counts = [r[0] for r in df.select(text.word_count(text.clean_text(F.col("t")))).collect()]
    assert counts == [len(w.split()) for w in want]


def test_ngrams_after_stop_words(spark):
    df = spark.createDataFrame([("the big red dog a runs",), ("dog",), ("",)], "t string")
    got = [r[0] for r in df.select(text.ngrams(text.tokens(F.col("t"), ["the"]), 1, 3)).collect()]
    assert got[0] == ["big", "red", "dog", "runs", "big red", "red dog", "dog runs", "big red dog", "red dog runs"]
    assert got[1] == ["dog"] and got[2] == []


def test_validation_splits_nan_null_and_bounds(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (float("nan"),), (None,), (20.0,)], "v double")
    valid, rejected = validation.validate_rows(df, validation.positive_rules(["v"], 20))
    assert [r["v"] for r in valid.collect()] == [1.0]
    assert sorted(len(r["failed_rules"]) for r in rejected.collect()) == [1, 1, 2, 2]


def test_batch_limit_edge(spark):
    df = spark.range(201).select((F.col("id") >= 100).cast("int").alias("b"))
    got = {r["b"]: r["accepted"] for r in validation.validate_batch(df, "b", 100).collect()}
    assert got == {0: True, 1: False}


def test_flagship_on_literal_rows(spark):
    rows = [("left", 0.5, "failure"), ("right", 0.6, "success"), ("left", 0.3, "success"), ("right", 0.7, "degraded"),
            ("right", 0.8, "failure"), ("left", 0.1, "failure")]
    df = files.from_rows(spark, rows, "model string, accuracy double, status string")
    got = aggregates.model_performance(df).collect()
    assert [r["model"] for r in got] == ["right", "left"]
    assert [r["avg_accuracy"] for r in got] == pytest.approx([0.7, 0.3])
    assert [r["failure_rate"] for r in got] == pytest.approx([1 / 3, 2 / 3])


def test_empty_frames_do_not_fail(spark):
    none = spark.createDataFrame([], "status string, latency_ms double")
    assert aggregates.request_metrics(none).first()["avg_latency_ms"] == 0.0
    empty = spark.createDataFrame([], "y_true int, prediction int")
    assert evaluation.quality(empty).first()["accuracy"] is None
    assert validation.shape_report(none).first()["not_empty"] is False


def test_replicate_and_missing_metric(spark):
    assert frames.replicate_rows(spark.range(3), 4).count() == 12
    assert frames.replicate_rows(spark.range(3), 0).count() == 0
    df = spark.createDataFrame([(1, None), (2, 0.95)], "id int, accuracy double")
    assert [r["id"] for r in frames.filter_runs(df, "accuracy").collect()] == [2]
    low = spark.createDataFrame([(None,), (0.65,)], "max_prob double")
    assert frames.low_confidence(low, 0.7).count() == 1 and frames.low_confidence(low, 0.6).count() == 0


def test_best_run_and_votes_take_text_names(spark):
    runs = spark.createDataFrame([("run-b", 0.9), ("run-a", 0.9), ("run-c", 0.4)], "run_id string, accuracy double")
    assert frames.best_run(runs, "accuracy", "run_id", []).first()["run_id"] == "run-a"
    near = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "query_id int, neighbor_id int")
    labels = spark.createDataFrame([(10, "dog"), (11, "cat")], "id int, label string")
    assert {r["query_id"]: r["prediction"] for r in neighbors.knn_vote(near, labels).collect()} == {1: "cat", 2: "dog"}


def test_event_json_and_bad_messages(spark):
    df = spark.createDataFrame([("r1", 2, [0.1, 0.9])], "request_id string, prediction int, probabilities array<double>")
    row = ev.encode(df, ev.TOPIC_PREDICTIONS, "request_id").first()
    assert row["key"] == "r1" and json.loads(row["value"]) == {"request_id": "r1", "prediction": 2, "probabilities": [0.1, 0.9]}
    raw = spark.createDataFrame([(row["value"],), ("{broken",)], "value string")
    good, bad = ev.split_corrupt(ev.decode(raw, ev.PREDICTION_EVENT))
    assert good.first()["prediction"] == 2 and bad.first()["_corrupt"] == "{broken"


def test_request_ids(spark):
    df = spark.createDataFrame([("given",), (None,), (None,)], "id string")
    ids = [r[0] for r in df.select(scalars.request_id(F.col("id"))).collect()]
    assert "given" in ids and len(set(ids)) == 3
    stable = df.select(scalars.content_id("id"))
    assert sorted(stable.collect()) == sorted(stable.collect())


def test_line_count_and_csv(spark, tmp_path):
    files.write_csv(spark.range(10).coalesce(1), str(tmp_path / "c"))
    assert files.count_lines(spark, str(tmp_path / "c")) == 11
    assert files.read_csv(spark, str(tmp_path / "c"), "id bigint").count() == 10


def test_feature_files_are_pruned_by_date(spark, tmp_path):
    df = spark.sql("select id, timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int)) as ts from range(10)")
    files.write_features(df, str(tmp_path / "f"), "ts")
    late = files.read_features(spark, str(tmp_path / "f"), since="2024-01-08")
    assert late.count() == 3
    assert "PartitionFilters: [isnotnull(event_date" in late._jdf.queryExecution().executedPlan().toString()


def test_fingerprint_ignores_order_and_sees_repeats(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    mark = lambda x: tuple(runs.fingerprint(x).first())
    assert mark(df) == mark(df.repartition(5).orderBy(F.desc("id")))
    assert mark(df) != mark(df.withColumn("v", F.col("v") + (F.col("id") == 3).cast("int")))
    assert mark(df.union(df)) != mark(df.filter("false"))
    stored = runs.fingerprint(df).withColumn("stage", F.lit("prepare"))
    now = stored.unionByName(runs.fingerprint(df.limit(5)).withColumn("stage", F.lit("train")))
    assert {r["stage"]: r["stale"] for r in runs.stale_stages(stored, now).collect()} == {"prepare": False, "train": True}


def test_signatures(spark):
    old = runs.schema_signature(spark.createDataFrame([], "a int, b string"))
    new = runs.schema_signature(spark.createDataFrame([], "a bigint, c string"))
    assert {r["name"]: r["change"] for r in runs.signature_diff(old, new).collect()} == {"a": "retyped", "b": "removed", "c": "added"}


def test_manifest_is_nested(spark, tmp_path):
    metrics = spark.createDataFrame([(0.93,)], "accuracy double")
    files.write_json(runs.manifest(metrics, "clf", "1.0.0", "/m", [0, 1], {"x": "float"}).coalesce(1), str(tmp_path / "m"))
    row = json.loads(next((tmp_path / "m").glob("*.json")).read_text())
    assert row["metrics"] == {"accuracy": 0.93} and row["input_schema"] == {"x": "float"} and row["classes"] == ["0", "1"]


def test_promotion_of_an_unknown_run_changes_nothing(spark):
    registry = spark.createDataFrame([("m", 1, 7, "Staging"), ("m", 2, 8, "None")], "name string, version int, run_id int, stage string")
    assert sorted(runs.promote_model(registry, 99, "Staging").collect()) == sorted(registry.collect())
    moved = {r["version"]: r["stage"] for r in runs.promote_model(registry, 8, "Staging").collect()}
    assert moved == {1: "Archived", 2: "Staging"}


def test_gate_on_rounded_and_exact_accuracy(spark):
    metrics = spark.createDataFrame([(0.89996,)], "accuracy double")
    assert evaluation.quality_gate(metrics, 0.9).first()["branch"] == "retrain"
    assert evaluation.quality_gate(metrics, 0.9, round_digits=4).first()["branch"] == "deploy"


def test_rand_index_of_equal_and_constant_labels(spark):
    df = spark.range(30).select((F.col("id") % 3).alias("a"), ((F.col("id") + 1) % 3).alias("b"), F.lit(0).alias("one"))
    assert evaluation.adjusted_rand(df, "a", "b").first()["adjusted_rand"] == pytest.approx(1.0)
    assert evaluation.adjusted_rand(df, "a", "one").first()["adjusted_rand"] == pytest.approx(0.0)
    assert evaluation.adjusted_rand(df, "one", "one").first()["adjusted_rand"] == pytest.approx(1.0)
