from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.sources import events as ev
from millrace.streaming import streams

START = datetime(2024, 1, 1)
SCHEMA = "request_id string, ts timestamp, prediction int, y_true int, max_prob double"


def write(spark, path, minutes, name):
    rows = [(f"{name}{i}", START + timedelta(minutes=m), i % 3, (i // 2) % 3, 0.5 + (i % 50) / 100) for i, m in enumerate(minutes)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return streams.table_stream(spark, path, "*.parquet", spark.read.parquet(path).schema, files_per_trigger=1)


def test_restart_continues_without_repeats(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    write(spark, src, range(20), "a")
    low = lambda: source(spark, src).filter("max_prob < 0.7").select("request_id")
    streams.run_append(low(), out, checkpoint)
    first = spark.read.parquet(out).count()
    streams.run_append(low(), out, checkpoint)
    assert spark.read.parquet(out).count() == first == 20
    write(spark, src, range(10), "b")
    streams.run_append(low(), out, checkpoint)
    assert spark.read.parquet(out).distinct().count() == spark.read.parquet(out).count() == 30


def test_running_totals_equal_the_batch_over_files(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for name in "abc":
        write(spark, src, range(30), name)
    streams.run_batches(streams.confidence_totals(source(spark, src)), out, checkpoint, "complete")
    want = streams.confidence_totals(spark.read.parquet(src))
    got = streams.last_batch(spark, out).select(*want.columns)
    assert sorted(got.collect()) == sorted(want.collect())
    assert spark.read.parquet(out).select("batch").distinct().count() == 3


def test_window_state_over_files_equals_the_batch(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for i, name in enumerate("abc"):
        write(spark, src, range(i * 40, i * 40 + 60), name)
    counts = streams.window_confusion(streams.with_event_time(source(spark, src), delay="2 hours"))
    streams.run_batches(counts, out, checkpoint, "update")
    state = streams.current_state(spark, out, ["window_start", "y_true", "prediction"])
    want = streams.window_confusion(spark.read.parquet(src))
    assert sorted(state.select(*want.columns).collect()) == sorted(want.collect())
    assert streams.confusion_report(state, 0.8).count() == 3


def test_the_first_rows_are_taken_once(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for name in "abc":
        write(spark, src, range(30), name)
    streams.run_first(source(spark, src), 45, out, checkpoint)
    write(spark, src, range(30), "d")
    streams.run_first(source(spark, src), 45, out, checkpoint)
    assert spark.read.parquet(out).select("request_id").distinct().count() == spark.read.parquet(out).count() == 45


def test_messages_after_the_nth_stay(spark, tmp_path):
    """15 of 50, then 40, then all: in order, each once, nothing lost."""
    src, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    write(spark, src, range(50), "a")
    got = lambda: sorted(r["request_id"] for r in spark.read.parquet(out).select("request_id").collect())
    whole = sorted(r["request_id"] for r in spark.read.parquet(src).select("request_id").collect())
    first = [r["request_id"] for r in spark.read.parquet(src).orderBy("ts", "request_id").select("request_id").collect()]
    for n in (15, 15, 40, 50, 60):
        streams.run_first(source(spark, src), n, out, checkpoint, ["ts", "request_id"])
        assert got() == sorted(first[:n])
    write(spark, src, range(50, 80), "b")
    streams.run_first(source(spark, src), 60, out, checkpoint, ["ts", "request_id"])
    assert len(got()) == 60 and set(whole) <= set(got())


def test_a_folded_state_reads_few_batches(spark, tmp_path):
    """Over 100 batches the state equals the batch answer and is read from one base and a few batches."""
    src, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    keys, sizes = ["window_start", "y_true", "prediction"], []
    counts = lambda i: spark.createDataFrame([(i % 7, 0, 1, i)], "window_start int, y_true int, prediction int, n int")
    for i in range(100):
        counts(i).write.mode("overwrite").parquet(f"{out}/batch={i}")
        if (i + 1) % 10 == 0:
            streams.current_state(spark, out, keys).write.mode("overwrite").parquet(f"{out}-base/upto={i}")
        if i % 9 == 4:
            base, newer = streams.state_parts(spark, out)
            sizes.append(len(newer))
            state = {r["window_start"]: r["n"] for r in streams.current_state(spark, out, keys).collect()}
            assert state == {j % 7: j for j in range(i + 1)}
    assert max(sizes) <= 10
    for i, name in enumerate("abcd"):
        write(spark, src, range(i * 20, i * 20 + 30), name)
    rows = streams.with_event_time(source(spark, src), delay="2 hours")
    out2 = f"{out}2"
    streams.run_batches(streams.window_confusion(rows), out2, checkpoint, "update", keys, every=2)
    base, newer = streams.state_parts(spark, out2)
    assert base is not None and len(newer) < 3
    want = streams.window_confusion(spark.read.parquet(src))
    state = streams.current_state(spark, out2, keys)
    assert sorted(state.select(*want.columns).collect()) == sorted(want.collect())


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    write(spark, src, [600, 601], "a")
    counts = lambda: streams.rate(streams.with_event_time(source(spark, src), delay="1 minute"), width_s=60, slide_s=60)
    streams.run_batches(counts(), out, checkpoint, "update")
    write(spark, src, [0, 602], "b")
    query = streams.run_batches(counts(), out, checkpoint, "update")
    assert streams.late_rows(query) == 1


def test_message_topic_round_trip_over_files(spark, tmp_path):
    src, topic, sent = (str(tmp_path / n) for n in ("in", "topic", "sent"))
    write(spark, src, range(5), "a")
    rows = source(spark, src).select("request_id", "prediction", "max_prob")
    ev.write_events(rows, ev.TOPIC_PREDICTIONS, "request_id", sent, "parquet", path=topic).trigger(availableNow=True).start().awaitTermination()
    out = str(tmp_path / "out")
    streams.run_append(ev.decode(ev.read_events(spark, "parquet", topic), ev.PREDICTION_EVENT), out, str(tmp_path / "cp"))
    got = spark.read.parquet(out).orderBy("request_id").collect()
    assert [r["key"] for r in got] == [r["request_id"] for r in got] == [f"a{i}" for i in range(5)]
    assert all(r["_corrupt"] is None for r in got)


def test_kafka_options_are_set(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ev.read_events(spark, "kafka", subscribe=ev.TOPIC_PREDICTIONS, **{"kafka.bootstrap.servers": "none:1"})
    assert ev.SINK_OPTIONS["kafka.acks"] == "all" and ev.SOURCE_OPTIONS["startingOffsets"] == "earliest"


def test_counter_that_starts_again(spark):
    values = [10.0, 15.0, 3.0, 9.0]
    df = spark.createDataFrame([(START + timedelta(seconds=i), v) for i, v in enumerate(values)], "ts timestamp, v double")
    got = streams.counter_rate(df.withColumn("s", F.lit("a")), "ts", "v", ["s"], 60).first()
    assert got["increase"] == 5 + 3 + 6 and got["rate"] == pytest.approx(14 / 60)


def test_rejected_rows_branch_off_a_stream(spark, tmp_path):
    from millrace.operators import validation

    src, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    write(spark, src, range(10), "a")
    valid, rejected = validation.validate_rows(source(spark, src), validation.positive_rules(["prediction"]))
    streams.run_append(rejected, out, checkpoint)
    assert spark.read.parquet(out).count() == 4 and valid.isStreaming
