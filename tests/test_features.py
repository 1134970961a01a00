from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import featurestore
from millrace.operators.featurestore import FeatureView

VIEW = FeatureView("f", "k", "event_ts", {"x": "double"}, "created", timedelta(days=3))
DAY = datetime(2024, 1, 1)


def rows(spark, data):
    return spark.createDataFrame([(k, DAY + timedelta(days=d), c, x) for k, d, c, x in data],
                                 "k bigint, event_ts timestamp_ntz, created bigint, x double")


def asked(spark, data):
    return spark.createDataFrame([(k, DAY + timedelta(days=d)) for k, d in data], "k bigint, entity_ts timestamp_ntz")


def fetch(spark, entities, features, **options):
    got = featurestore.get_historical_features(asked(spark, entities), rows(spark, features), VIEW, **options).collect()
    return {(r["k"], (r["entity_ts"] - DAY).days): r["x"] for r in got}


def test_newest_created_wins_and_same_moment_counts(spark):
    assert fetch(spark, [(1, 2)], [(1, 2, 1, 10.0), (1, 2, 2, 20.0), (1, 1, 9, 5.0)]) == {(1, 2): 20.0}


def test_lifetime_edge_is_inside(spark):
    got = fetch(spark, [(1, 3), (1, 4)], [(1, 0, 1, 10.0)])
    assert got == {(1, 3): 10.0, (1, 4): None}


def test_null_feature_is_still_the_newest(spark):
    assert fetch(spark, [(1, 2)], [(1, 0, 1, 10.0), (1, 1, 1, None)]) == {(1, 2): None}


def test_no_history_and_future_rows(spark):
    assert fetch(spark, [(7, 1), (1, 0)], [(1, 1, 1, 10.0)]) == {(7, 1): None, (1, 0): None}


def test_hot_entity_is_cut_into_buckets_and_still_exact(spark):
    features = [(0 if i % 2 else i % 50, (i * 37) % 400, i, float(i)) for i in range(2000)]
    entities = [(0 if i % 3 else i % 50, i % 410) for i in range(900)]
    left, right = asked(spark, entities), rows(spark, features)
    view = FeatureView("f", "k", "event_ts", {"x": "double"}, "created")
    got = featurestore.get_historical_features(left, right, view).toPandas()
    best = right.toPandas().sort_values("created").drop_duplicates(["k", "event_ts"], keep="last").sort_values("event_ts")
    want = pd.merge_asof(left.toPandas().sort_values("entity_ts"), best, left_on="entity_ts", right_on="event_ts", by="k")
    key = ["k", "entity_ts", "x"]
    pd.testing.assert_frame_equal(got[key].sort_values(key).reset_index(drop=True), want[key].sort_values(key).reset_index(drop=True))


def test_online_lookup_keeps_order_and_repeats(spark):
    store = featurestore.materialize(rows(spark, [(1, 0, 1, 1.0), (1, 1, 1, 2.0), (2, 0, 1, 3.0)]), VIEW)
    requests = spark.createDataFrame([(0, 2), (1, 1), (2, 2), (3, 9)], "position bigint, k bigint")
    got = featurestore.get_online_features(store, requests, VIEW, ["x", "none"]).orderBy("position").collect()
    assert [(r["k"], r["x"], r["none"]) for r in got] == [(2, 3.0, None), (1, 2.0, None), (2, 3.0, None)]
    assert [r["k"] for r in featurestore.online_misses(store, requests, VIEW).collect()] == [9]


def test_incremental_equals_full(spark):
    data = rows(spark, [(i % 5, i % 11, i, float(i)) for i in range(60)])
    state = featurestore.materialize_incremental(None, data, VIEW, None, DAY + timedelta(days=4))
    state = featurestore.materialize_incremental(state, data, VIEW, DAY + timedelta(days=4), DAY + timedelta(days=30))
    assert sorted(state.collect()) == sorted(featurestore.materialize(data, VIEW).collect())


def test_view_checks_the_schema(spark):
    assert VIEW.problems(rows(spark, [(1, 0, 1, 1.0)])) == []
    wrong = rows(spark, [(1, 0, 1, 1.0)]).withColumn("x", F.lit("text")).drop("created")
    assert len(VIEW.problems(wrong)) == 2
    with pytest.raises(ValueError):
        VIEW.check(wrong)
