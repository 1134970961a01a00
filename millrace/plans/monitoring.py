"""Queries over drift, prediction quality, curves and streams."""

from pyspark.sql import functions as F

from millrace.operators import curves, drift, evaluation, frames, sketches
from millrace.plans import bindings as b
from millrace.plans import tabular
from millrace.plans.registry import query
from millrace.plans.tabular import r
from millrace.session import scratch_path
from millrace.sources import events as ev
from millrace.streaming import streams

# --- drift -------------------------------------------------------------------

KS = """ks_values as (
  select feature, value, count(*) filter (where is_ref) as r, count(*) filter (where not is_ref) as c
  from drift_long group by feature, value),
ks_steps as (
  select feature, sum(r) over w as r_upto, sum(c) over w as c_upto, sum(r) over a as n_ref, sum(c) over a as n_cur
  from ks_values window w as (partition by feature order by value), a as (partition by feature)),
ks as (
  select feature, max(abs(r_upto / n_ref - c_upto / n_cur)) as d, max(n_ref)::bigint as n_ref, max(n_cur)::bigint as n_cur
  from ks_steps group by feature),
ks_x as (select *, d * d * n_ref * n_cur / (n_ref + n_cur) as x2 from ks),
ks_p as (
  select feature, d, n_ref, n_cur, case when d <= 0 or x2 < 0.001 then 1.0 else least(greatest(case when x2 >= 1 then 2 * (
      select sum((case when k % 2 = 1 then 1.0::double else -1.0::double end) * exp(-2.0::double * k * k * x2)) from range(1, 101) t(k))
      else 1 - sqrt(2 * pi() / x2) * (select sum(exp(0 - pow((2 * k - 1) * pi(), 2) / (8 * x2))) from range(1, 41) t(k)) end, 0.0), 1.0) end as p
  from ks_x)"""

PSI = """psi_edges as (
  select feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as edges
  from drift_long where is_ref group by feature),
psi_counts as (
  select feature, len(list_filter(edges, lambda e: e <= value)) as bin,
         count(*) filter (where is_ref) as r, count(*) filter (where not is_ref) as c
  from drift_long join psi_edges using (feature) group by all),
psi_shares as (
  select feature, bin, greatest(coalesce(r, 0) / sum(r) over (partition by feature), 0.0001::double) as r,
         greatest(coalesce(c, 0) / sum(c) over (partition by feature), 0.0001::double) as c
  from (select feature, unnest(range(10)) as bin from psi_edges) left join psi_counts using (feature, bin)),
psi as (select feature, sum((c - r) * ln(c / r)) as v from psi_shares group by feature)"""

_KS_COLUMNS = """feature, round(d, 4) as ks_statistic, round(p, 4) as ks_p_value, p < 0.05 as ks_drift,
  0.05::double as ks_threshold, 'asymptotic' as method"""
_PSI_COLUMNS = """feature, round(v, 4) as psi,
  case when v < 0.1 then 'none' when v < 0.2 then 'slight' else 'significant' end as severity, v >= 0.2 as psi_drift"""


@query("ks_statistic", b.with_ctes(b.DRIFT, KS) + "select feature, round(d, 9) as statistic, n_ref, n_cur from ks")
def ks_statistic(spark, d):
    reference, current = b.drift_samples(spark, d)
    return drift.ks_statistic(reference, current, b.DRIFT_COLUMNS).withColumn("statistic", r("statistic", 9))


@query("ks_test", b.with_ctes(b.DRIFT, KS) + f"select {_KS_COLUMNS} from ks_p")
def ks_test(spark, d):
    return drift.ks_test(*b.drift_samples(spark, d), b.DRIFT_COLUMNS)


_NEAR = """drift_long as (
  select 'one_changed' as feature, l_extendedprice as value, true as is_ref from lineitem
  union all select 'one_changed', case when l_orderkey = m and l_linenumber = 1 then -1 else l_extendedprice end, false
  from lineitem, (select min(l_orderkey) as m from lineitem)
  union all select 'few_changed', l_extendedprice, true from lineitem
  union all select 'few_changed', case when l_orderkey % 100 = 0 then -1 else l_extendedprice end, false from lineitem
  union all select 'all_null', null, true from lineitem where false)"""


@query("ks_near_equal", b.with_ctes(_NEAR, KS) + f"""
select f.feature, ks_statistic, ks_p_value, ks_drift, ks_threshold, method, psi_known from
(select unnest(['all_null', 'few_changed', 'one_changed']) as feature, unnest([false, true, true]) as psi_known) f
left join (select {_KS_COLUMNS} from ks_p) k on f.feature = k.feature""")
def ks_near_equal(spark, d):
    """Samples that differ in one row and in one row of a hundred, and a column without values."""
    lines = b.table(spark, d, "lineitem")
    first = lines.agg(F.min("l_orderkey")).scalar()
    price, key = F.col("l_extendedprice"), F.col("l_orderkey")
    none = F.lit(None).cast("double").alias("all_null")
    reference = lines.select(price.alias("one_changed"), price.alias("few_changed"), none)
    current = lines.select(
        F.when((key == first) & (F.col("l_linenumber") == 1), -1.0).otherwise(price).alias("one_changed"),
        F.when(key % 100 == 0, -1.0).otherwise(price).alias("few_changed"), none)
    return drift.drift_report(reference, current).select(
        "feature", "ks_statistic", "ks_p_value", "ks_drift", "ks_threshold", "method",
        F.col("psi").isNotNull().alias("psi_known"))


@query("psi", b.with_ctes(b.DRIFT, PSI) + f"select {_PSI_COLUMNS} from psi")
def psi(spark, d):
    return drift.psi(*b.drift_samples(spark, d), b.DRIFT_COLUMNS)


_REPORT = f"report as (select * from (select {_KS_COLUMNS} from ks_p) join (select {_PSI_COLUMNS} from psi) using (feature))"


@query("drift_report", b.with_ctes(b.DRIFT, KS, PSI, _REPORT) + "select * from report")
def drift_report(spark, d):
    return drift.drift_report(*b.drift_samples(spark, d))


@query("drift_summary", b.with_ctes(b.DRIFT, KS, PSI, _REPORT) + """
select count(*) as n_features, count(*) filter (where ks_drift) as n_ks_drift,
       count(*) filter (where psi_drift) as n_psi_drift,
       round(count(*) filter (where ks_drift) / count(*), 4) as ks_drift_share,
       round(count(*) filter (where psi_drift) / count(*), 4) as psi_drift_share,
       count(*) filter (where ks_drift) / count(*) >= 0.5 as dataset_drift from report""")
def drift_summary(spark, d):
    return drift.drift_summary(drift.drift_report(*b.drift_samples(spark, d)))


# --- prediction quality ------------------------------------------------------

def scores_sql(keys=""):
    """Per-class scores from pred_log as CTEs: cells, classes, class_scores (grouped by `keys`)."""
    k = f"{keys}, " if keys else ""
    by = f"partition by {keys}" if keys else ""
    return f"""cells as (select {k}y_true, prediction, count(*) as n from pred_rows group by all),
classes as (
  select {k}y_true as class, n as support, 0 as chosen, case when y_true = prediction then n else 0 end as hits from cells
  union all select {k}prediction, 0, n, 0 from cells),
class_scores as (
  select {k}class, sum(support)::bigint as support, sum(hits)::bigint as hits,
         coalesce(sum(hits) / nullif(sum(chosen), 0), 0)::double as precision,
         coalesce(sum(hits) / nullif(sum(support), 0), 0)::double as recall,
         coalesce(2 * sum(hits) / nullif(sum(support) + sum(chosen), 0), 0)::double as f1
  from classes group by all)"""


_ALL_ROWS = "pred_rows as (select * from pred_log)"


@query("classification_report", b.with_ctes(b.PRED_LOG, _ALL_ROWS, scores_sql()) + """
select cast(class as varchar) as class, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1, support from class_scores
union all
select 'accuracy', round(sum(hits) / sum(support), 9), round(sum(hits) / sum(support), 9), round(sum(hits) / sum(support), 9), sum(support)::bigint from class_scores
union all
select 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), sum(support)::bigint from class_scores
union all
select 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
       round(sum(f1 * support) / sum(support), 9), sum(support)::bigint from class_scores""")
def classification_report(spark, d):
    report = evaluation.classification_report(b.pred_log(spark, d))
    return report.withColumns({c: r(c) for c in ("precision", "recall", "f1")})


@query("confusion_matrix", b.with_ctes(b.PRED_LOG) + """
select label, predicted, coalesce(n, 0) as n
from (select unnest(range(4))::integer as label) cross join (select unnest(range(4))::integer as predicted)
left join (select y_true as label, prediction as predicted, count(*) as n from pred_log group by all) using (label, predicted)""")
def confusion_matrix(spark, d):
    # class 3 never occurs
    return evaluation.confusion_matrix(b.pred_log(spark, d), range(4))


_WINDOWED = "pred_rows as (select *, date_trunc('hour', ts) as window_start from pred_log)"
WINDOWS_SQL = b.with_ctes(b.PRED_LOG, _WINDOWED, scores_sql("window_start")) + """
select window_start, strftime(window_start, '%Y%m%d_%H%M') as window_id, sum(support)::bigint as n_samples,
       round(sum(hits) / sum(support), 4) as accuracy, round(sum(f1 * support) / sum(support), 4) as f1_weighted,
       sum(hits) / sum(support) < 0.8 as alert
from class_scores group by window_start"""


def plain_time(df, column="window_start"):
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


@query("monitor_windows", WINDOWS_SQL)
def monitor_windows(spark, d):
    return plain_time(evaluation.monitor_windows(b.pred_log(spark, d), threshold=0.8))


@query("monitor_history", WINDOWS_SQL)
def monitor_history(spark, d):
    """Two monitoring runs, one after the other, appended to one history and read back."""
    log, path = b.pred_log(spark, d), scratch_path(spark, "history")
    middle = log.agg(F.date_trunc("day", F.timestamp_micros(
        F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5)))).first()[0]
    early = F.col("ts").cast("timestamp") < F.lit(middle)
    for run, rows in (("first", log.filter(early)), ("second", log.filter(~early))):
        evaluation.append_history(evaluation.monitor_windows(rows, threshold=0.8), path, run)
    return plain_time(evaluation.read_history(spark, path).drop("run"))


@query("quality_gate", b.with_ctes(b.PRED_LOG, """q as (
  select model_version, count(*) filter (where y_true = prediction) / count(*) as accuracy from pred_log group by 1)""") + """
select model_version, round(accuracy, 9) as accuracy, threshold, passed, case when passed then 'deploy' else 'retrain' end as branch, rounded
from (select *, 0.8::double as threshold, accuracy >= 0.8 as passed, false as rounded from q
      union all select *, 0.8, round(accuracy, 1) >= 0.8, true from q)""")
def quality_gate(spark, d):
    metrics = evaluation.quality(b.pred_log(spark, d), ["model_version"]).select("model_version", "accuracy")
    exact = evaluation.quality_gate(metrics, 0.8).withColumn("rounded", F.lit(False))
    rounded = evaluation.quality_gate(metrics, 0.8, round_digits=1).withColumn("rounded", F.lit(True))
    return exact.unionByName(rounded).withColumn("accuracy", r("accuracy"))


@query("alert_rows", b.with_ctes(b.PRED_LOG) + """
select 'alert' as event_type, 'low_confidence' as alert_type, ts as timestamp, request_id, cast(k as varchar) as k
from pred_log where max_prob < 0.7""")
def alert_rows(spark, d):
    rows = evaluation.alerts(
        b.pred_log(spark, d), "low_confidence", F.coalesce(F.col("max_prob"), F.lit(1.0)) < 0.7, "ts",
        {"request_id": F.col("request_id"), "k": F.col("k")})
    return rows.select("event_type", "alert_type", "timestamp", F.col("details")["request_id"].alias("request_id"),
                       F.col("details")["k"].alias("k"))


@query("regression_metrics", """
select l_returnflag, count(*) as n, round(sqrt(avg(e * e)), 4) as rmse, round(avg(abs(e)), 4) as mae,
       round(1 - sum(e * e) / (var_pop(l_extendedprice) * count(*)), 9) as r2
from (select *, l_extendedprice - l_quantity * 1500 as e from lineitem) group by l_returnflag""")
def regression_metrics(spark, d):
    rows = b.table(spark, d, "lineitem").withColumn("predicted", F.col("l_quantity") * 1500)
    return evaluation.regression_metrics(rows, "l_extendedprice", "predicted", ["l_returnflag"]).withColumns(
        {"rmse": r("rmse", 4), "mae": r("mae", 4), "r2": r("r2")})


@query("adjusted_rand", """
with cells as (select label as a, list_position(embedding, list_max(embedding)) % 10 as b, count(*)::double as n
               from embeddings group by all),
s as (select (select sum(n * (n - 1) / 2) from cells) as both_pairs,
             (select sum(n * (n - 1) / 2) from (select sum(n) as n from cells group by a)) as sa,
             (select sum(n * (n - 1) / 2) from (select sum(n) as n from cells group by b)) as sb,
             (select sum(n) from cells) as n)
select n::bigint as n_rows, round((both_pairs - sa * sb / (n * (n - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (n * (n - 1) / 2)), 9) as adjusted_rand from s""")
def adjusted_rand(spark, d):
    peak = (F.array_position("embedding", F.array_max("embedding")) % 10).alias("peak")
    return evaluation.adjusted_rand(b.table(spark, d, "embeddings").select("label", peak), "label", "peak").withColumn(
        "adjusted_rand", r("adjusted_rand"))


@query("rule_score", b.with_ctes(b.MEASUREMENTS, """scored as (
  select *, petal_length * 0.5::double + petal_width * 0.8::double as score from measurements)""") + """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(score, 9) as score,
       case when score < 2.5 then 0 when score < 5.0 then 1 else 2 end as prediction,
       case when score < 2.5 then 0.9 when score < 5.0 then 0.85 else 0.85 end::double as confidence from scored""")
def rule_score(spark, d):
    return evaluation.rule_score(b.measurements(spark, d)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r("score").alias("score"), "prediction", "confidence")


# --- curves ------------------------------------------------------------------

_POINTS = """points as (
  select lang, score as threshold, sum(p) over w as tp, sum(q) over w as fp, p, q,
         sum(p) over (partition by lang) as n_pos, sum(q) over (partition by lang) as n_neg
  from (select lang, score, sum(y) as p, sum(1 - y) as q from doc_scores group by all)
  window w as (partition by lang order by score desc))"""


@query("roc_points", b.with_ctes(b.DOC_SCORES, _POINTS) + """
select lang, threshold, round(fp / nullif(n_neg, 0), 9) as fpr, round(tp / nullif(n_pos, 0), 9) as tpr from points""")
def roc_points(spark, d):
    return curves.roc_points(b.doc_scores(spark, d), keys=["lang"]).withColumns({"fpr": r("fpr"), "tpr": r("tpr")})


@query("roc_auc", b.with_ctes(b.DOC_SCORES, """ranked as (
  select y, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2 as place from doc_scores)""") + """
select round((sum(place) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2)
       / (count(*) filter (where y = 1) * count(*) filter (where y = 0)), 9) as auc from ranked""")
def roc_auc(spark, d):
    return curves.roc_auc(b.doc_scores(spark, d)).withColumn("auc", r("auc"))


def _ovr(i):
    return (f"select '{i}' as class, (y_true = {i})::int as y, {b.class_probability_sql(i)} as score from pred_log")


@query("macro_auc", b.with_ctes(b.PRED_LOG, "ovr as (" + " union all ".join(_ovr(i) for i in range(3)) + ")", """ranked as (
  select class, y, rank() over (partition by class order by score) + (count(*) over (partition by class, score) - 1) / 2 as place from ovr)""",
  """per_class as (select class, (sum(place) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2)
       / (count(*) filter (where y = 1) * count(*) filter (where y = 0)) as auc from ranked group by class)""") + """
select count(*) as n_classes, round(avg(auc), 9) as macro_auc from per_class""")
def macro_auc(spark, d):
    scored = b.class_probabilities(b.pred_log(spark, d))
    return curves.macro_auc(scored, "y_true", "probabilities", range(3)).withColumn("macro_auc", r("macro_auc"))


@query("pr_points", b.with_ctes(b.DOC_SCORES, _POINTS) + """
select lang, threshold, round(tp / (tp + fp), 9) as precision, round(tp / nullif(n_pos, 0), 9) as recall from points""")
def pr_points(spark, d):
    return curves.pr_points(b.doc_scores(spark, d), keys=["lang"]).withColumns(
        {"precision": r("precision"), "recall": r("recall")})


@query("average_precision", b.with_ctes(b.DOC_SCORES, _POINTS) + """
select lang, round(sum(tp / (tp + fp) * p) / nullif(max(n_pos), 0), 9) as average_precision from points group by lang""")
def average_precision(spark, d):
    return curves.average_precision(b.doc_scores(spark, d), keys=["lang"]).withColumn(
        "average_precision", r("average_precision"))


_CALIBRATION = "hits as (select (y_true = prediction)::int as y, max_prob as score, model_version from pred_log)"


def _hits(spark, d):
    return b.pred_log(spark, d).select(
        (F.col("y_true") == F.col("prediction")).cast("int").alias("y"), F.col("max_prob").alias("score"), "model_version")


@query("calibration_curve", b.with_ctes(b.PRED_LOG, _CALIBRATION) + """
select model_version, least(floor(score * 10), 9)::integer as bin, count(*) as n, round(avg(y), 9) as fraction_positive,
       round(avg(score), 9) as mean_predicted from hits group by all""")
def calibration_curve(spark, d):
    return curves.calibration_curve(_hits(spark, d), 10, keys=["model_version"]).withColumns(
        {"fraction_positive": r("fraction_positive"), "mean_predicted": r("mean_predicted")})


@query("brier_score", b.with_ctes(b.PRED_LOG, _CALIBRATION) + """
select model_version, count(*) as n, round(avg((score - y) * (score - y)), 9) as brier from hits group by model_version""")
def brier_score(spark, d):
    return curves.brier_score(_hits(spark, d), keys=["model_version"]).withColumn("brier", r("brier"))


# --- streams -----------------------------------------------------------------

def event_stream(spark, d):
    schema = b.table(spark, d, "events").schema
    return b.as_pred_log(streams.table_stream(spark, d, "events.parquet", schema))


def _folders(spark, name):
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"


@query("stream_parse", tabular.EVENT_FIELDS_SQL.replace("request_id as key, 'ml.predictions' as topic, ", "request_id as key, "))
def stream_parse(spark, d):
    topic, sent = _folders(spark, "topic")
    out, checkpoint = _folders(spark, "parsed")
    events = tabular.prediction_events(event_stream(spark, d))
    ev.write_events(events, ev.TOPIC_PREDICTIONS, "request_id", sent, "parquet", path=topic).trigger(
        availableNow=True).start().awaitTermination()
    good, _ = ev.split_corrupt(ev.decode(ev.read_events(spark, "parquet", topic), ev.PREDICTION_EVENT))
    streams.run_append(good, out, checkpoint)
    return spark.read.parquet(out).select(
        "key", "event_type", "request_id", "timestamp", "model_version",
        F.col("features")["value"].alias("feature_value"), "prediction",
        r(F.col("probabilities")[2]).alias("probability_2"), "max_prob")


@query("stream_low_confidence", b.with_ctes(b.PRED_LOG) + "select request_id, ts, max_prob from pred_log where max_prob < 0.7")
def stream_low_confidence(spark, d):
    out, checkpoint = _folders(spark, "low")
    low = frames.low_confidence(event_stream(spark, d), 0.7).select("request_id", "ts", "max_prob")
    streams.run_append(low, out, checkpoint)
    return spark.read.parquet(out)


@query("stream_first", b.with_ctes(b.PRED_LOG) + "select request_id, ts, prediction from pred_log order by ts, request_id limit 250")
def stream_first(spark, d):
    """A consumer that takes 100 messages and stops, then takes up to 250 of the same stream."""
    out, checkpoint = _folders(spark, "first")
    for n in (100, 250):
        streams.run_first(event_stream(spark, d), n, out, checkpoint, ["ts", "request_id"])
    return spark.read.parquet(out).select("request_id", "ts", "prediction")


@query("stream_summary", tabular.SUMMARY_SQL)
def stream_summary(spark, d):
    out, checkpoint = _folders(spark, "summary")
    streams.run_batches(streams.confidence_totals(event_stream(spark, d)), out, checkpoint, "complete")
    return streams.last_batch(spark, out).withColumn("avg_max_prob", r("avg_max_prob"))


RATE_SQL = """
select window_start, count(*) as n, round(count(*) / 300, 9) as rate
from (select date_trunc('minute', ts) - to_minutes(unnest(range(5))) as window_start from events) group by window_start"""


@query("rate_sliding", RATE_SQL)
def rate_sliding(spark, d):
    rows = streams.with_event_time(b.table(spark, d, "events"))
    return plain_time(streams.rate(rows)).withColumn("rate", r("rate"))


@query("stream_rate", RATE_SQL)
def stream_rate(spark, d):
    out, checkpoint = _folders(spark, "rate")
    rows = streams.with_event_time(event_stream(spark, d))
    keys = ["window_start"]
    streams.run_batches(streams.rate(rows), out, checkpoint, "update", keys)
    return plain_time(streams.current_state(spark, out, keys)).withColumn("rate", r("rate"))


@query("counter_rate", b.with_ctes(b.PRED_LOG, """samples as (
  select model_version, ts, k::double as value, lag(k) over (partition by model_version order by ts) as previous from pred_log)""") + """
select model_version, date_trunc('hour', ts) as window_start,
       sum(case when previous is null then 0 when value < previous then value else value - previous end) as increase,
       round(sum(case when previous is null then 0 when value < previous then value else value - previous end) / 3600, 9) as rate
from samples group by 1, 2""")
def counter_rate(spark, d):
    # k falls again and again, which reads as a counter being reset
    samples = b.pred_log(spark, d).select("model_version", "ts", F.col("k").cast("double").alias("value"))
    rates = streams.counter_rate(samples, "ts", "value", ["model_version"], 3600)
    return plain_time(rates).withColumn("rate", r("rate"))


@query("stream_monitor", WINDOWS_SQL)
def stream_monitor(spark, d):
    out, checkpoint = _folders(spark, "monitor")
    rows = streams.with_event_time(event_stream(spark, d))
    keys = ["window_start", "y_true", "prediction"]
    streams.run_batches(streams.window_confusion(rows), out, checkpoint, "update", keys)
    counts = streams.current_state(spark, out, keys)
    return plain_time(streams.confusion_report(counts, 0.8))


@query("feedback_join_stream", tabular.FEEDBACK_SQL)
def feedback_join_stream(spark, d):
    from millrace.operators.lookups import join_feedback

    out, checkpoint = _folders(spark, "feedback")
    predictions = streams.with_event_time(event_stream(spark, d), delay="2 hours").select("request_id", "ts", "prediction")
    given = streams.with_event_time(tabular.as_feedback(event_stream(spark, d)), "feedback_ts", "2 hours")
    streams.run_append(join_feedback(predictions, given, "1 hour"), out, checkpoint)
    return plain_time(plain_time(spark.read.parquet(out), "ts"), "feedback_ts")


_STREAM_PSI = """long as (
  select ts, 'value' as feature, value from pred_log union all select ts, 'k', k::double from pred_log),
edges as (
  select feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as edges from long
  where ts < timestamp '2024-01-08' group by feature),
bins as (
  select feature, time_bucket(interval 2 days, ts, timestamp '1970-01-01') as window_start, ts < timestamp '2024-01-08' as is_ref,
         len(list_filter(edges, lambda e: e <= value)) as bin, count(*) as n from long join edges using (feature) group by all),
ref as (select feature, bin, sum(n) as n, sum(sum(n)) over (partition by feature) as total from bins where is_ref group by feature, bin),
cur as (select feature, window_start, bin, sum(n) as n from bins group by all),
totals as (select feature, window_start, sum(n)::bigint as n from cur group by all),
grid as (select feature, window_start, t.n, unnest(range(10)) as bin from totals t),
shares as (
  select g.feature, g.window_start, g.n, greatest(coalesce(ref.n / ref.total, 0), 0.0001::double) as r,
         greatest(coalesce(cur.n / g.n, 0), 0.0001::double) as c
  from grid g left join ref on g.feature = ref.feature and g.bin = ref.bin
  left join cur on g.feature = cur.feature and g.bin = cur.bin and g.window_start = cur.window_start)"""


@query("stream_psi", b.with_ctes(b.PRED_LOG, _STREAM_PSI) + """
select window_start, feature, n, round(sum((c - r) * ln(c / r)), 4) as psi, sum((c - r) * ln(c / r)) >= 0.2 as psi_drift
from shares group by window_start, feature, n""")
def stream_psi(spark, d):
    columns = ["value", "k"]
    cut = F.lit("2024-01-08").cast("timestamp_ntz")
    edges = streams.reference_edges(b.pred_log(spark, d).filter(F.col("ts") < cut), columns)
    out, checkpoint = _folders(spark, "psi")
    rows = streams.with_event_time(event_stream(spark, d))
    keys = ["window_start", "feature", "bin"]
    streams.run_batches(streams.window_bins(rows, edges, columns, width="2 days"), out, checkpoint, "update", keys)
    bins = streams.current_state(spark, out, keys)
    return plain_time(streams.window_psi(bins, edges))


_SKETCHED = """long as (
  select ts, 'value' as feature, value as v from pred_log union all select ts, 'k', k::double from pred_log),
ref as (select feature, list_sort(list(v)) as rs, count(*) as rn from long where ts < timestamp '2024-01-08' and v is not null
        group by feature),
cur as (select feature, time_bucket(interval 2 days, ts, timestamp '1970-01-01') as window_start, list_sort(list(v)) as cs,
               count(*) as n from long where v is not null group by all),
met as (select feature, window_start, n, list_transform(range(1, 501), lambda i: rs[ceil(round(i * rn / 500, 6))::int]) as r,
               list_transform(range(1, 501), lambda i: cs[ceil(round(i * n / 500, 6))::int]) as c from cur join ref using (feature)),
ends as (select *, [0.0::double] || list_transform(range(1, 10), lambda i: len(list_filter(r, lambda v: v <= r[50 * i])) / 500)
                || [1.0::double] as re,
                [0.0::double] || list_transform(range(1, 10), lambda i: len(list_filter(c, lambda v: v <= r[50 * i])) / 500)
                || [1.0::double] as ce,
                list_max(list_transform(r || c, lambda e: abs(len(list_filter(r, lambda v: v <= e)) / 500
                                                              - len(list_filter(c, lambda v: v <= e)) / 500))) as gap
         from met),
terms as (select *, list_sum(list_transform(range(1, 11), lambda i: (greatest(ce[i + 1] - ce[i], 0.0001) - greatest(re[i + 1] - re[i], 0.0001))
                  * ln(greatest(ce[i + 1] - ce[i], 0.0001) / greatest(re[i + 1] - re[i], 0.0001)))) as index from ends)"""


@query("sketch_drift", b.with_ctes(b.PRED_LOG, _SKETCHED) + """
select window_start, feature, n, round(index, 4) as psi, index >= 0.2 as psi_drift, round(gap, 4) as ks_statistic from terms""")
def sketch_drift(spark, d):
    """Drift of every two days of a stream against its first week, from one sketch a window and feature."""
    out, checkpoint = _folders(spark, "sketches")
    keys = ["window_start", "feature"]
    rows = streams.with_event_time(event_stream(spark, d))
    kept = sketches.window_sketches(rows, ["value", "k"], width="2 days")
    streams.run_batches(kept, out, checkpoint, "update", keys)
    week = b.pred_log(spark, d).filter(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    reference = sketches.merged(sketches.window_sketches(week.withColumn("ts", F.col("ts").cast("timestamp")), ["value", "k"]))
    found = sketches.sketch_drift(reference, streams.current_state(spark, out, keys), ["window_start"])
    return plain_time(found.drop("ks_error"))
