"""Running streams to a written result, and the monitoring queries as streams.

Every operator here is a plain DataFrame transformation that also works on batch
frames; only `run_*` start anything. State lives in the query's checkpoint, so a
restarted query continues where it stopped.
"""

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import clip_low
from millrace.operators import drift
from millrace.operators.evaluation import class_scores, windows_report
from millrace.operators.ordered import latest_by, with_previous
from millrace.operators.quantiles import bin_index, exact_percentiles, to_long


def table_stream(spark: SparkSession, folder: str, pattern: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the parquet files of a folder whose names match `pattern`."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def with_event_time(df: DataFrame, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Event time as an instant, with a watermark on streams: later rows than `delay` are dropped
    and counted in the query's progress."""
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay) if df.isStreaming else df


def late_rows(query) -> int:
    """Rows a query dropped for coming after the watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def run_append(stream: DataFrame, path: str, checkpoint: str):
    """Process what is there and stop; the file sink's own log makes a replayed batch count once."""
    query = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def run_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "update", keys=None, every: int = 10):
    """Process what is there, writing every micro-batch to its own folder.

    The folder is named by the batch number and overwritten, so a batch that is
    run again after a failure replaces itself. With `keys`, the newest value per
    key is folded into a base after every `every` batches, so that `current_state`
    reads one base and at most `every` batches, however long the stream has run.
    """
    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if keys and (number + 1) % every == 0:
            current_state(stream.sparkSession, path, keys).write.mode("overwrite").parquet(f"{path}{_BASE}/upto={number}")

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .outputMode(mode).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


class _Enough(Exception):
    """Raised to leave a micro-batch uncommitted."""


def run_first(stream: DataFrame, n: int, path: str, checkpoint: str, order=()):
    """Write the first `n` rows to come, then stop, also over restarts; messages after them stay to be read.

    `order` are columns that say which rows of a micro-batch come first. The batch in which the n-th
    row lies is not committed: a later run with a larger `n` gets it again and takes only
    rows that are not written yet. What is missing is counted from the written rows, and a
    batch that is run again after a failure goes on where its written rows end.
    """
    spark, full = stream.sparkSession, []

    def written():
        try:
            return spark.read.parquet(path)
        except AnalysisException:  # nothing is written yet
            return None

    def write(batch, number):
        before = written()
        taken = 0 if before is None else before.count()
        if taken < n:
            mine = None if before is None else before.filter(F.col("batch") == number).select(*batch.columns)
            rest = batch if mine is None else batch.exceptAll(mine)
            first = rest.orderBy(*order) if order else rest
            first.limit(n - taken).write.mode("overwrite").parquet(f"{path}/batch={number}/after={taken}")
            if written().filter(F.col("batch") == number).count() == batch.count():
                return  # the whole batch is written
        full.append(number)
        raise _Enough(f"{n} rows are written")

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not full:
            raise
    return query


_BASE = "-base"  # behind the path of the batches


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers n of the complete folders `name`=n under a path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = (status.getPath().getName() for status in files.listStatus(root))
    numbers = [int(folder.split("=")[1]) for folder in found if folder.startswith(f"{name}=")]
    return sorted(n for n in numbers if files.exists(hadoop.Path(f"{path}/{name}={n}/_SUCCESS")))


def state_parts(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """(number of the newest base, numbers of the batches after it): all that a state is read from."""
    bases = _numbers(spark, f"{path}{_BASE}", "upto")
    base = bases[-1] if bases else None
    return base, [n for n in _numbers(spark, path, "batch") if base is None or n > base]


def current_state(spark: SparkSession, path: str, keys) -> DataFrame:
    """Newest value per key over the micro-batches of an update-mode run."""
    base, batches = state_parts(spark, path)
    parts = [spark.read.parquet(f"{path}{_BASE}/upto={base}").withColumn("batch", F.lit(-1))] if base is not None else []
    if batches or not parts:
        parts.append(spark.read.option("basePath", path).parquet(*[f"{path}/batch={n}" for n in batches]))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    return latest_by(rows, keys, ["batch"], values)


def last_batch(spark: SparkSession, path: str) -> DataFrame:
    """Result of the newest micro-batch of a complete-mode run."""
    rows = spark.read.parquet(path)
    return rows.filter(F.col("batch") == rows.agg(F.max("batch")).scalar()).drop("batch")


def confidence_totals(df: DataFrame, threshold: float = 0.7, keys=("prediction",)) -> DataFrame:
    """Running n, low-confidence count and confidence sum per key: the state of a summary."""
    low = F.coalesce(F.col("max_prob"), F.lit(1.0)) < threshold
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(low).alias("low_confidence"), F.avg("max_prob").alias("avg_max_prob"))


def rate(df: DataFrame, ts: str = "ts", width_s: int = 300, slide_s: int = 60, keys=()) -> DataFrame:
    """Events per second over sliding windows."""
    span = F.window(ts, f"{width_s} seconds", f"{slide_s} seconds")
    return (
        df.groupBy(span.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), *keys, "n", (F.col("n") / width_s).alias("rate"))
    )


def counter_rate(samples: DataFrame, ts: str, value: str, keys=(), width_s: int = 300) -> DataFrame:
    """Rate per tumbling window from samples of a growing counter.

    A sample below the one before means the counter started again from 0, so the
    sample itself is the increase; a series' first sample adds nothing.
    """
    stepped = with_previous(samples, ts, value, keys)
    increase = (F.when(F.col("previous").isNull(), F.lit(0.0))
                .when(F.col(value) < F.col("previous"), F.col(value)).otherwise(F.col(value) - F.col("previous")))
    return (
        stepped.groupBy(F.window(F.col(ts).cast("timestamp"), f"{width_s} seconds")["start"].alias("window_start"), *keys)
        .agg(F.sum(increase).alias("increase"))
        .withColumn("rate", F.col("increase") / width_s)
    )


def window_confusion(df: DataFrame, ts="ts", width="1 hour", label="y_true", prediction="prediction") -> DataFrame:
    """Confusion counts per time window: the only state a monitored stream keeps."""
    return (
        df.groupBy(F.window(ts, width).alias("w"), label, prediction).agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), label, prediction, "n")
    )


def confusion_report(counts: DataFrame, threshold: float, label="y_true", prediction="prediction") -> DataFrame:
    """Window report from confusion counts, as `monitor_windows` gives from rows."""
    cells = counts.select("window_start", F.col(label).alias("label"), F.col(prediction).alias("predicted"), "n")
    scores = class_scores(cells, ["window_start"])
    n = F.sum("support")
    metrics = scores.groupBy("window_start").agg(
        n.alias("n_samples"), F.try_divide(F.sum("hits"), n).alias("accuracy"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), n).alias("f1_weighted"))
    return windows_report(metrics, ["window_start"], threshold)


def reference_edges(reference: DataFrame, columns, buckets: int = 10) -> DataFrame:
    """(feature, edges, shares): exact percentile bins of a reference sample and its share in each."""
    long = to_long(reference, columns)
    points = [i / buckets for i in range(1, buckets)]
    edges = exact_percentiles(long, points).groupBy("feature").agg(
        F.array_sort(F.collect_list("percentile")).alias("edges"))
    counts = (
        long.join(F.broadcast(edges), "feature")
        .groupBy("feature", bin_index(F.col("value"), F.col("edges")).alias("bin")).agg(F.count(F.lit(1)).alias("r"))
    )
    # bounded: one row per feature, `buckets` entries
    shares = counts.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "r"))).alias("_counts"), F.sum("r").alias("_n"))
    share = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda i: F.coalesce(
        F.try_divide(F.try_element_at("_counts", i), F.col("_n")), F.lit(0.0)))
    return edges.join(shares, "feature").select("feature", "edges", share.alias("shares"))


def window_bins(df: DataFrame, edges: DataFrame, columns, ts="ts", width="1 day") -> DataFrame:
    """Histogram counts of every feature per time window over fixed edges (a stream-static join)."""
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]))
    long = df.select(ts, cells).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return (
        long.join(F.broadcast(edges.select("feature", "edges")), "feature")
        .groupBy(F.window(ts, width).alias("w"), "feature", bin_index(F.col("value"), F.col("edges")).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "feature", "bin", "n")
    )


def window_psi(bins: DataFrame, edges: DataFrame, digits: int = 4) -> DataFrame:
    """Stability index of every (window, feature) against the reference shares."""
    # bounded: one entry per bin
    counts = bins.groupBy("window_start", "feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_counts"), F.sum("n").alias("n"))
    cells = counts.join(F.broadcast(edges.select("feature", "shares")), "feature").select(
        "window_start", "feature", "n", "_counts", F.posexplode("shares").alias("bin", "share"))
    r = clip_low(F.col("share"))
    c = clip_low(F.coalesce(F.try_divide(F.try_element_at("_counts", F.col("bin")), F.col("n")), F.lit(0.0)))
    return (
        cells.groupBy("window_start", "feature")
        .agg(F.max("n").alias("n"), F.sum((c - r) * F.ln(c / r)).alias("index"))
        .select("window_start", "feature", "n", F.round("index", digits).alias("psi"),
                (F.col("index") >= drift.PSI_SIGNIFICANT).alias("psi_drift"))
    )
