"""Queries over sources, projections, joins, summaries, ordered work, splits and text expressions."""

from datetime import timedelta

from pyspark.sql import functions as F

from millrace.functions import arrays, scalars, text
from millrace.operators import aggregates, featurestore, frames, lookups, ordered, quantiles, runs, splits, validation
from millrace.plans import bindings as b
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources import events as ev
from millrace.sources import files


def r(column, digits=9):
    return F.round(column, digits)


# --- sources and sinks -------------------------------------------------------

@query("csv_roundtrip", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def csv_roundtrip(spark, d):
    df = b.table(spark, d, "customer")
    path = scratch_path(spark, "csv")
    files.write_csv(df, path)
    return files.read_csv(spark, path, df.schema)


@query("parquet_scan", """
select strftime(ts, '%Y-%m-%d') as event_date, count(*) as n, round(sum(value), 4) as total
from events group by 1""")
def parquet_scan(spark, d):
    path = scratch_path(spark, "features")
    files.write_features(b.table(spark, d, "events").select("event_id", "user_id", "ts", "value"), path, "ts")
    return files.read_features(spark, path).groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("value"), 4).alias("total"))


@query("json_roundtrip", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders")
def json_roundtrip(spark, d):
    df = b.table(spark, d, "orders")
    path = scratch_path(spark, "json")
    files.write_json(df, path)
    return files.read_json(spark, path, df.schema)


def prediction_events(log):
    """Log rows as event records in the fixed event schema."""
    return b.class_probabilities(log).select(
        F.lit("prediction").alias("event_type"), "request_id", scalars.iso_timestamp(F.col("ts")).alias("timestamp"),
        "model_version", F.create_map(F.lit("value"), F.col("value"), F.lit("k"), F.col("k").cast("double"))
        .alias("features"), "prediction", "probabilities", "max_prob")


EVENT_FIELDS_SQL = b.with_ctes(b.PRED_LOG) + f"""
select request_id as key, 'ml.predictions' as topic, 'prediction' as event_type, request_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as timestamp, model_version, value as feature_value, prediction,
       round({b.class_probability_sql(2)}, 9) as probability_2, max_prob
from pred_log"""


@query("kafka_envelope", EVENT_FIELDS_SQL)
def kafka_envelope(spark, d):
    sent = ev.encode(prediction_events(b.pred_log(spark, d)), ev.TOPIC_PREDICTIONS, "request_id")
    path = scratch_path(spark, "topic")
    sent.write.parquet(path)
    back = spark.read.schema(sent.schema).parquet(path)
    event = F.from_json("value", ev.PREDICTION_EVENT).alias("e")
    return back.select("key", "topic", event).select(
        "key", "topic", "e.event_type", "e.request_id", "e.timestamp", "e.model_version",
        scalars.map_value(F.col("e.features"), "value").alias("feature_value"), "e.prediction",
        r(F.col("e.probabilities")[2]).alias("probability_2"), "e.max_prob")


@query("json_parse", """
select event_id, cast(json_extract_string(props, '$.k') as integer) as k,
       case when event_id % 2 = 0 then 'ok' else 'corrupt' end as state
from events where event_id % 2 = 0
union all
select event_id, null as k, 'corrupt' as state from events where event_id % 2 <> 0""")
def json_parse(spark, d):
    # every second record is broken by cutting its closing brace
    raw = b.table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, F.col("props"))
        .otherwise(F.concat(F.lit("{"), F.col("props"))).alias("value"))
    decoded = ev.decode(raw, "k INT")
    return decoded.select(
        "event_id", "k", F.when(F.col("_corrupt").isNull(), "ok").otherwise("corrupt").alias("state"))


# --- projections and filters -------------------------------------------------

@query("derive_columns", """
select l_orderkey, l_linenumber, l_quantity * l_extendedprice as area, l_quantity / nullif(l_tax, 0) as ratio
from lineitem""")
def derive_columns(spark, d):
    df = b.table(spark, d, "lineitem")
    return frames.derive(df, {"area": frames.product("l_quantity", "l_extendedprice"),
                              "ratio": frames.ratio("l_quantity", "l_tax")}).select(
        "l_orderkey", "l_linenumber", "area", "ratio")


@query("filter_isin", "select event_id, event_type, value from events where event_type in ('click', 'purchase')")
def filter_isin(spark, d):
    return frames.isin(b.table(spark, d, "events"), "event_type", ["click", "purchase"]).select(
        "event_id", "event_type", "value")


@query("project_rename", "select c_custkey as entity_id, c_acctbal as balance, c_mktsegment as segment from customer")
def project_rename(spark, d):
    return frames.project_rename(
        b.table(spark, d, "customer"), {"c_custkey": "entity_id", "c_acctbal": "balance", "c_mktsegment": "segment"})


@query("filter_high_accuracy_runs", b.with_ctes(b.RUNS_LOG) + """
select run_id, model, round(cost / 500000, 8) as accuracy from runs_log
where coalesce(cost / 500000, 0) >= 0.9""")
def filter_high_accuracy_runs(spark, d):
    scored = b.runs_log(spark, d).withColumn("accuracy", F.col("cost") / 500000)
    return frames.filter_runs(scored, "accuracy", 0.90).select("run_id", "model", r("accuracy", 8).alias("accuracy"))


@query("metric_trend", b.with_ctes(b.RUNS_LOG) + """
select model, date, run_id, cost from runs_log where cost is not null""")
def metric_trend(spark, d):
    return frames.metric_trend(b.runs_log(spark, d), "cost", ["date", "run_id"], ["model"])


@query("low_confidence", b.with_ctes(b.PRED_LOG) + """
select request_id, case when event_type <> 'view' then max_prob end as max_prob from pred_log
where coalesce(case when event_type <> 'view' then max_prob end, 1.0) < 0.7""")
def low_confidence(spark, d):
    log = b.pred_log(spark, d).withColumn("max_prob", F.when(F.col("event_type") != "view", F.col("max_prob")))
    return frames.low_confidence(log, 0.7).select("request_id", "max_prob")


# --- validation and data quality ---------------------------------------------

FEATURES = ["sepal_length", "sepal_width", "petal_length", "petal_width"]
_REASONS = " ".join(
    f"|| case when coalesce({c} > 0 and not isnan({c}), false) then '' else '{c}_positive;' end "
    f"|| case when coalesce({c} < 20 and not isnan({c}), false) then '' else '{c}_below_20;' end" for c in FEATURES)


@query("validate_rows", b.with_ctes(b.MEASUREMENTS) + f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, reasons, reasons = '' as valid
from (select *, '' {_REASONS} as reasons from measurements)""")
def validate_rows(spark, d):
    checked = validation.check_rows(b.measurements(spark, d), validation.positive_rules(FEATURES, 20))
    valid = F.size("failed_rules") == 0
    reasons = F.when(valid, "").otherwise(F.concat(F.array_join("failed_rules", ";"), F.lit(";")))
    return checked.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", reasons.alias("reasons"), valid.alias("valid"))


@query("batch_limit", """
select user_id, count(*) as n_samples, count(*) <= 100 as accepted from events group by user_id""")
def batch_limit(spark, d):
    return validation.validate_batch(b.table(spark, d, "events"), "user_id", 100)


@query("dq_nulls", b.with_ctes(b.RUNS_LOG) + " union all ".join(
    f"select '{c}' as \"column\", count(*) filter (where {c} is null) as n_null from runs_log"
    for c in ("run_id", "date", "model", "accuracy", "cost", "status")))
def dq_nulls(spark, d):
    return validation.null_report(b.runs_log(spark, d))


@query("dq_positive", " union all ".join(
    f"select '{c}' as \"column\", bool_and({c} > 0) as all_positive from lineitem" for c in b.DRIFT_COLUMNS))
def dq_positive(spark, d):
    return validation.positive_report(b.table(spark, d, "lineitem"), b.DRIFT_COLUMNS)


@query("dq_range", " union all ".join(
    f"select '{c}' as \"column\", max({c}) as max_value, max({c}) < 20 as within from lineitem"
    for c in b.DRIFT_COLUMNS))
def dq_range(spark, d):
    return validation.range_report(b.table(spark, d, "lineitem"), b.DRIFT_COLUMNS, 20)


@query("dq_domain", """
select 'event_type' as "column", cast(count(distinct event_type) filter (where event_type in ('click', 'view', 'error', 'refund')) as integer) as n_allowed_seen,
       count(*) filter (where event_type not in ('click', 'view', 'error', 'refund')) as n_outside,
       false as is_subset, false as is_equal from events
union all
select 'event_type', cast(count(distinct event_type) as integer), 0, true, true from events""")
def dq_domain(spark, d):
    events = b.table(spark, d, "events")
    some = validation.domain_report(events, "event_type", ["click", "view", "error", "refund"])
    every = validation.domain_report(events, "event_type", ["click", "view", "error", "signup", "purchase"])
    return some.unionByName(every)


@query("dq_shape", """
select count(*) as n_rows, 5 as n_columns, count(*) > 0 as not_empty, true as as_expected from customer""")
def dq_shape(spark, d):
    return validation.shape_report(b.table(spark, d, "customer"), columns=5)


@query("dq_suite", """
select 'no_nulls' as "check", 'l_quantity' as "column", count(*) filter (where l_quantity is null)::double as value,
       count(*) filter (where l_quantity is null) = 0 as passed from lineitem
union all select 'positive', 'l_quantity', count(*) filter (where not l_quantity > 0)::double, count(*) filter (where not l_quantity > 0) = 0 from lineitem
union all select 'positive', 'l_tax', count(*) filter (where not l_tax > 0)::double, count(*) filter (where not l_tax > 0) = 0 from lineitem
union all select 'max_below', 'l_quantity', max(l_quantity), max(l_quantity) < 20 from lineitem
union all select 'domain', 'l_returnflag', count(*) filter (where l_returnflag not in ('A', 'N', 'R'))::double, count(*) filter (where l_returnflag not in ('A', 'N', 'R')) = 0 from lineitem
union all select 'not_empty', '*', count(*)::double, count(*) > 0 from lineitem""")
def dq_suite(spark, d):
    v = validation
    return v.run_checks(b.table(spark, d, "lineitem"), [
        v.no_nulls("l_quantity"), v.all_positive("l_quantity"), v.all_positive("l_tax"),
        v.maximum_below("l_quantity", 20), v.only_values("l_returnflag", ["A", "N", "R"]), v.not_empty()])


# --- joins and lookups -------------------------------------------------------

VIEW = featurestore.FeatureView(
    "order_features", "entity_id", "event_ts", {"price": "double", "half_price": "double"}, "created",
    timedelta(days=30), {"team": "ml"})

_LATEST = """latest as (
  select entity_id, event_ts, created, price, half_price from feature_rows
  qualify row_number() over (partition by entity_id order by event_ts desc, created desc) = 1)"""
_REQUESTS = """requests as (
  select c_custkey as position, (c_custkey // 2) * 3 as entity_id from customer)"""


def _requests(spark, d):
    return b.table(spark, d, "customer").select(
        F.col("c_custkey").alias("position"), (F.floor(F.col("c_custkey") / 2) * 3).alias("entity_id"))


@query("materialize_latest", b.with_ctes(b.FEATURE_ROWS, _LATEST) + "select * from latest")
def materialize_latest(spark, d):
    return featurestore.materialize(b.feature_rows(spark, d), VIEW)


@query("materialize_incremental", b.with_ctes(b.FEATURE_ROWS, _LATEST) + "select * from latest")
def materialize_incremental(spark, d):
    rows = b.feature_rows(spark, d)
    state, since = None, None
    for until in ("1997-01-01 00:00:00", "1999-06-30 00:00:00", "2002-01-01 00:00:00"):
        moment = F.lit(until).cast("timestamp_ntz")
        state, since = featurestore.materialize_incremental(state, rows, VIEW, since, moment), moment
    return state


@query("online_features", b.with_ctes(b.FEATURE_ROWS, _LATEST, _REQUESTS) + """
select position, entity_id, price, half_price, null::double as no_such from requests join latest using (entity_id)""")
def online_features(spark, d):
    store = featurestore.materialize(b.feature_rows(spark, d), VIEW)
    return featurestore.get_online_features(
        store, _requests(spark, d), VIEW, ["price", "half_price", "no_such"])


@query("online_misses", b.with_ctes(b.FEATURE_ROWS, _LATEST, _REQUESTS) + """
select position, entity_id from requests where entity_id not in (select entity_id from latest)""")
def online_misses(spark, d):
    store = featurestore.materialize(b.feature_rows(spark, d), VIEW)
    return featurestore.online_misses(store, _requests(spark, d), VIEW)


@query("historical_features", b.with_ctes(b.FEATURE_ROWS, b.ENTITY_ROWS, """newest as (
  select * from feature_rows qualify row_number() over (partition by entity_id, event_ts order by created desc) = 1)""") + """
select e.entity_id, e.entity_ts,
       case when f.event_ts + interval 30 day >= e.entity_ts then f.event_ts end as event_ts,
       case when f.event_ts + interval 30 day >= e.entity_ts then f.price end as price,
       case when f.event_ts + interval 30 day >= e.entity_ts then f.half_price end as half_price
from entity_rows e asof left join newest f on e.entity_id = f.entity_id and e.entity_ts >= f.event_ts""")
def historical_features(spark, d):
    return featurestore.get_historical_features(b.entity_rows(spark, d), b.feature_rows(spark, d), VIEW)


# fixed values: class names by code
CLASS_NAMES = {0: "negative", 1: "neutral", 2: "positive"}
_CLASS_SQL = "case prediction when 0 then 'negative' when 1 then 'neutral' when 2 then 'positive' end"


@query("label_lookup", b.with_ctes(b.PRED_LOG) + f"select request_id, prediction, {_CLASS_SQL} as class_name from pred_log")
def label_lookup(spark, d):
    return lookups.label_lookup(b.pred_log(spark, d), "prediction", CLASS_NAMES).select(
        "request_id", "prediction", "class_name")


def as_feedback(log):
    """Feedback comes k minutes after the prediction, for three event types."""
    given = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("k"))
    return log.filter(F.col("event_type").isin("click", "purchase", "signup")).select(
        "request_id", given.alias("feedback_ts"), "y_true")


FEEDBACK = """feedback as (
  select request_id, ts + to_minutes(k) as feedback_ts, y_true from pred_log
  where event_type in ('click', 'purchase', 'signup'))"""
FEEDBACK_SQL = b.with_ctes(b.PRED_LOG, FEEDBACK) + """
select p.request_id, p.ts, p.prediction, f.feedback_ts, f.y_true from pred_log p join feedback f
  on p.request_id = f.request_id and f.feedback_ts >= p.ts and f.feedback_ts <= p.ts + interval 1 hour"""


@query("feedback_join", FEEDBACK_SQL)
def feedback_join(spark, d):
    log = b.pred_log(spark, d)
    return lookups.join_feedback(log.select("request_id", "ts", "prediction"), as_feedback(log), "1 hour")


@query("pair_predictions", b.with_ctes(b.PRED_LOG) + "select request_id, y_true, prediction from pred_log where event_type <> 'view'")
def pair_predictions(spark, d):
    log = b.pred_log(spark, d)
    labels = log.filter(F.col("event_type") != "view").select("request_id", "y_true")
    return lookups.pair_predictions(labels, log.select("request_id", "prediction"), "request_id")


_LONG = """runs_long as (
  select run_id, 'param' as kind, 'date' as key, date as value from runs_log
  union all select run_id, 'metric', 'accuracy', cast(accuracy as varchar) from runs_log
  union all select run_id, 'metric', 'cost', cast(cost as varchar) from runs_log
  union all select run_id, 'tag', 'model', model from runs_log)"""


def _runs_long(spark, d):
    return runs.long_runs(b.runs_log(spark, d), "run_id", ["date"], ["accuracy", "cost"], ["model"])


@query("runs_long", b.with_ctes(b.RUNS_LOG, _LONG) + """
select run_id, kind, key, case when kind = 'metric' then round(cast(value as double), 8) end as number,
       case when kind <> 'metric' then value end as label
from runs_long where value is not null""")
def runs_long(spark, d):
    path = scratch_path(spark, "runs")
    runs.append_runs(_runs_long(spark, d), path)
    metric = F.col("kind") == "metric"
    return spark.read.parquet(path).select(
        "run_id", "kind", "key", F.when(metric, r(F.col("value").try_cast("double"), 8)).alias("number"),
        F.when(~metric, F.col("value")).alias("label"))


@query("runs_pivot", b.with_ctes(b.RUNS_LOG) + "select run_id, round(accuracy, 8) as accuracy, cost from runs_log")
def runs_pivot(spark, d):
    wide = runs.runs_pivot(_runs_long(spark, d), ["accuracy", "cost"])
    return wide.select("run_id", r("accuracy", 8).alias("accuracy"), "cost")


@query("experiment_diff", b.with_ctes(b.RUNS_LOG, """metrics as (
  select run_id, 'accuracy' as key, accuracy as value from runs_log
  union all select run_id, 'cost', cost from runs_log where cost is not null)""") + """
select o.run_id, key, round(o.value, 8) as run_value, round(b.value, 8) as baseline_value,
       round(o.value - b.value, 8) as delta
from (select * from metrics where run_id <> 2) o full join (select * from metrics where run_id = 2) b using (key)""")
def experiment_diff(spark, d):
    metrics = _runs_long(spark, d).filter(F.col("kind") == "metric").withColumn(
        "value", F.col("value").cast("double"))
    return lookups.diff_runs(metrics, 2).select(
        "run_id", "key", *[r(c, 8).alias(c) for c in ("run_value", "baseline_value", "delta")])


_REGISTRY = """registry as (
  select 'model_' || cast(o_custkey % 5 as varchar) as name, o_orderkey as version, o_custkey as run_id,
         case o_orderstatus when 'O' then 'Production' when 'P' then 'Staging' else 'None' end as stage from orders)"""


def _registry(spark, d):
    return b.table(spark, d, "orders").select(
        F.concat(F.lit("model_"), (F.col("o_custkey") % 5).cast("string")).alias("name"),
        F.col("o_orderkey").alias("version"), F.col("o_custkey").alias("run_id"),
        F.when(F.col("o_orderstatus") == "O", "Production").when(F.col("o_orderstatus") == "P", "Staging")
        .otherwise("None").alias("stage"))


@query("promote_model", b.with_ctes(_REGISTRY, """target as (
  select name, version from registry where run_id = 10 order by version, name limit 1)""") + """
select r.name, r.version, r.run_id,
       case when r.name = t.name and r.version = t.version then 'Production'
            when r.name = t.name and r.stage = 'Production' then 'Archived' else r.stage end as stage
from registry r left join target t on r.name = t.name""")
def promote_model(spark, d):
    return runs.promote_model(_registry(spark, d), 10, "Production")


@query("model_by_stage", b.with_ctes(_REGISTRY) + """
select name, max(version) as version, arg_max(run_id, version) as run_id from registry
where stage = 'Production' group by name""")
def model_by_stage(spark, d):
    return runs.model_by_stage(_registry(spark, d), "Production")


@query("snapshot_diff", """
select o_orderkey, case when o_orderpriority = '1-URGENT' then 'removed'
                        when o_orderpriority = '2-HIGH' then 'added' else 'changed' end as change
from orders where o_orderpriority in ('1-URGENT', '2-HIGH') or (o_orderstatus = 'F')""")
def snapshot_diff(spark, d):
    orders = b.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    old = orders.filter(F.col("o_orderpriority") != "2-HIGH")
    new = orders.filter(F.col("o_orderpriority") != "1-URGENT").withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return runs.snapshot_diff(old, new, "o_orderkey", ["o_totalprice"])


# --- summaries ---------------------------------------------------------------

MODEL_PERFORMANCE_SQL = b.with_ctes(b.RUNS_LOG) + """
select model, round(avg(accuracy), 8) as avg_accuracy, round(min(accuracy), 8) as min_accuracy, count(*) as n_runs,
       count(*) filter (where status = 'failure') as failures,
       round(count(*) filter (where status = 'failure') / count(*), 9) as failure_rate
from runs_log group by model order by avg(accuracy) desc, model"""


@query("model_performance", MODEL_PERFORMANCE_SQL)
def model_performance(spark, d):
    report = aggregates.model_performance(b.runs_log(spark, d))
    return report.withColumns(
        {"avg_accuracy": r("avg_accuracy", 8), "min_accuracy": r("min_accuracy", 8), "failure_rate": r("failure_rate")})


@query("describe_numeric", " union all ".join(
    f"""select '{c}' as "column", count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as stddev,
    min({c}) as "min", max({c}) as "max" from lineitem""" for c in b.DRIFT_COLUMNS))
def describe_numeric(spark, d):
    return aggregates.describe_numeric(b.table(spark, d, "lineitem"), b.DRIFT_COLUMNS).withColumns(
        {"mean": r("mean", 6), "stddev": r("stddev", 6)})


@query("value_counts", "select event_type, count(*) as n from events group by event_type")
def value_counts(spark, d):
    return aggregates.value_counts(b.table(spark, d, "events"), "event_type")


SUMMARY_SQL = b.with_ctes(b.PRED_LOG) + """
select prediction, count(*) as n, count(*) filter (where max_prob < 0.7) as low_confidence,
       round(avg(max_prob), 9) as avg_max_prob
from pred_log group by prediction"""


@query("prediction_summary", SUMMARY_SQL)
def prediction_summary(spark, d):
    summary = aggregates.prediction_summary(b.pred_log(spark, d), 0.7, ["prediction"])
    return summary.withColumn("avg_max_prob", r("avg_max_prob"))


@query("prediction_counter", b.with_ctes(b.PRED_LOG) + """
select model_version, prediction, status, count(*) as total from pred_log group by all""")
def prediction_counter(spark, d):
    return aggregates.counter(b.pred_log(spark, d), "model_version", "prediction", "status")


@query("request_metrics", b.with_ctes(b.PRED_LOG) + """
select model_version, count(*) as total_requests, count(*) filter (where status = 'success') as success_requests,
       count(*) filter (where status <> 'success') as error_requests,
       round(coalesce(sum(case when status = 'success' then latency_s * 1000 end) / count(*), 0), 2) as avg_latency_ms
from pred_log group by model_version""")
def request_metrics(spark, d):
    log = b.pred_log(spark, d).withColumn("latency_ms", F.col("latency_s") * 1000)
    return aggregates.request_metrics(log, keys=["model_version"])


@query("gauge_last", b.with_ctes(b.PRED_LOG) + """
select model_version, status, arg_max(max_prob, (ts, event_id)) as max_prob from pred_log group by all""")
def gauge_last(spark, d):
    return aggregates.last_value_by(b.pred_log(spark, d), ["model_version", "status"], ["ts", "event_id"], "max_prob")


# fixed values: bounds of the latency and confidence histograms
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]
CONFIDENCE_BOUNDS = [0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0]


def _le_sql(column, bounds):
    rows = [f"""select model_version, '{x}' as le, count(*) filter (where {column} <= {x}::double) as n, {i} as bound_index,
      round(sum({column}), 4) as total, count({column}) as count from pred_log group by model_version"""
            for i, x in enumerate(bounds)]
    rows.append(f"""select model_version, '+Inf', count({column}), {len(bounds)}, round(sum({column}), 4), count({column})
      from pred_log group by model_version""")
    return " union all ".join(rows)


@query("le_histogram", b.with_ctes(b.PRED_LOG) + _le_sql("latency_s", LATENCY_BOUNDS))
def le_histogram(spark, d):
    return quantiles.le_histogram(b.pred_log(spark, d), "latency_s", LATENCY_BOUNDS, ["model_version"]).withColumn(
        "total", r("total", 4))


@query("confidence_histogram", b.with_ctes(b.PRED_LOG) + _le_sql("max_prob", CONFIDENCE_BOUNDS))
def confidence_histogram(spark, d):
    return quantiles.le_histogram(b.pred_log(spark, d), "max_prob", CONFIDENCE_BOUNDS, ["model_version"]).withColumn(
        "total", r("total", 4))


@query("histogram_quantile", b.with_ctes(b.PRED_LOG, f"le as ({_le_sql('latency_s', LATENCY_BOUNDS)})",
       f"limits as (select unnest(range({len(LATENCY_BOUNDS)})) as i, unnest({LATENCY_BOUNDS}::double[]) as bound)",
       """steps as (
  select le.*, bound, coalesce(lag(n) over w, 0) as below_n, coalesce(lag(bound) over w, 0.0) as below_bound
  from le left join limits on bound_index = i
  window w as (partition by model_version order by bound_index))""") + """
select model_version, round(first(case when bound is null then below_bound
    else below_bound + (bound - below_bound) * (0.95 * count - below_n) / (n - below_n) end order by bound_index), 9) as quantile
from steps where n >= 0.95::double * count group by model_version""")
def histogram_quantile(spark, d):
    buckets = quantiles.le_histogram(b.pred_log(spark, d), "latency_s", LATENCY_BOUNDS, ["model_version"])
    return quantiles.histogram_quantile(buckets, 0.95, LATENCY_BOUNDS, ["model_version"]).withColumn(
        "quantile", r("quantile"))


_ALL_VALUES = f"""all_values as (
  select feature, value from (unpivot (select {', '.join(b.DRIFT_COLUMNS)} from lineitem)
    on {', '.join(b.DRIFT_COLUMNS)} into name feature value value))"""


@query("percentiles", b.with_ctes(_ALL_VALUES) + """
select feature, share, round(p, 6) as percentile from (
  select feature, unnest([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]::double[]) as share,
         unnest(quantile_cont(value, [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0])) as p
  from all_values group by feature)""")
def percentiles(spark, d):
    long = quantiles.to_long(b.table(spark, d, "lineitem"), b.DRIFT_COLUMNS)
    return quantiles.exact_percentiles(long, [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]).withColumn(
        "percentile", r("percentile", 6))


@query("histogram_edges", """
select cast(bin as integer) as bin, coalesce(n, 0) as n from (select unnest(range(6)) as bin) left join (
  select (l_quantity >= 10)::int + (l_quantity >= 20)::int * 2 + (l_quantity >= 45)::int + (l_quantity >= 60)::int as bin, count(*) as n
  from lineitem group by 1) using (bin)""")
def histogram_edges(spark, d):
    # 20 is repeated, so bin 2 stays empty
    return quantiles.histogram_edges(b.table(spark, d, "lineitem"), "l_quantity", [10, 20, 20, 45, 60])


@query("fold_summary", b.with_ctes(b.RUNS_LOG) + """
select model, count(accuracy) as folds, round(avg(accuracy), 9) as mean_score, round(stddev_pop(accuracy), 9) as std_score
from runs_log group by model""")
def fold_summary(spark, d):
    return aggregates.fold_summary(b.runs_log(spark, d), "accuracy", "model").withColumns(
        {"mean_score": r("mean_score"), "std_score": r("std_score")})


# --- ordered work ------------------------------------------------------------

@query("cumulative_share", """
select o_orderdate, round(o_totalprice, 2) as o_totalprice, round(sum(o_totalprice) over w, 2) as cumulative,
       round(sum(o_totalprice) over w / sum(o_totalprice) over (), 9) as share
from (select o_orderdate, sum(o_totalprice) as o_totalprice from orders group by o_orderdate)
window w as (order by o_orderdate)""")
def cumulative_share(spark, d):
    return ordered.cumulative_share(b.table(spark, d, "orders"), "o_orderdate", "o_totalprice").select(
        "o_orderdate", r("o_totalprice", 2).alias("o_totalprice"), r("cumulative", 2).alias("cumulative"),
        r("share").alias("share"))


@query("active_requests", b.with_ctes(b.PRED_LOG, """changes as (
  select model_version, ts as "at", 1 as change from pred_log
  union all select model_version, ts + to_minutes(cast(floor(value) as bigint)), -1 from pred_log)""") + """
select model_version, "at", change, cast(sum(change) over (partition by model_version order by "at") as bigint) as active
from (select model_version, "at", cast(sum(change) as bigint) as change from changes group by all)""")
def active_requests(spark, d):
    end = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor("value").cast("int"))
    return ordered.in_flight(b.pred_log(spark, d).withColumn("end_ts", end), "ts", "end_ts", ["model_version"])


@query("assign_batches", """
select event_id, row_number() over (order by ts, event_id) - 1 as row_index,
       (row_number() over (order by ts, event_id) - 1) // 32 as batch_id from events""")
def assign_batches(spark, d):
    return ordered.assign_batches(b.table(spark, d, "events").select("event_id", "ts"), ["ts", "event_id"], 32).select(
        "event_id", "row_index", "batch_id")


@query("slice_rows", """
select event_id, row_number() over (order by ts, event_id) - 1 as row_index from events
qualify row_number() over (order by ts, event_id) > 120""")
def slice_rows(spark, d):
    return ordered.slice_rows(b.table(spark, d, "events").select("event_id", "ts"), ["ts", "event_id"], 120).select(
        "event_id", "row_index")


@query("leaderboard", b.with_ctes(b.RUNS_LOG) + "select run_id, model, accuracy from runs_log")
def leaderboard(spark, d):
    return frames.leaderboard(b.runs_log(spark, d), "accuracy", "run_id").select("run_id", "model", "accuracy")


@query("head_n", "select event_id, ts, value from events order by ts, event_id limit 5")
def head_n(spark, d):
    return frames.head_n(b.table(spark, d, "events").select("event_id", "ts", "value"), 5, "ts", "event_id")


@query("best_run", b.with_ctes(b.RUNS_LOG) + """
select model, run_id, accuracy, date, status from runs_log
qualify row_number() over (partition by model order by accuracy desc, run_id) = 1""")
def best_run(spark, d):
    return frames.best_run(b.runs_log(spark, d), "accuracy", "run_id", ["date", "status"], ["model"])


# --- splits and sets ---------------------------------------------------------

@query("union_sets", "select c_custkey as id, c_acctbal as balance from customer union all select s_suppkey, s_acctbal from supplier")
def union_sets(spark, d):
    return frames.union_sets(
        frames.project_rename(b.table(spark, d, "customer"), {"c_custkey": "id", "c_acctbal": "balance"}),
        frames.project_rename(b.table(spark, d, "supplier"), {"s_suppkey": "id", "s_acctbal": "balance"}))


@query("replicate_rows", "select s_suppkey, cast(copy as integer) as copy from supplier, (select unnest(range(1, 21)) as copy)")
def replicate_rows(spark, d):
    return frames.replicate_rows(b.table(spark, d, "supplier").select("s_suppkey"), 20)


_DIGEST = "substr(md5(cast({0} as varchar) || '|42'), 1, 15)"


@query("hash_split", f"""
select o_orderkey, cast(('0x' || {_DIGEST.format('o_orderkey')}) as bigint)::double / 1152921504606846976::double < 0.2 as is_test
from orders""")
def hash_split(spark, d):
    return splits.hash_split(b.table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 0.2)


@query("exact_split", f"""
select o_orderkey, row_number() over (order by {_DIGEST.format('o_orderkey')}, o_orderkey) <= ceil(0.2 * count(*) over ()) as is_test
from orders""")
def exact_split(spark, d):
    return splits.exact_split(b.table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 0.2)


@query("stratified_split", b.with_ctes(
    "counts as (select event_type, count(*) as n, sum(count(*)) over () as total from events group by event_type)",
    "want as (select *, ceil(0.2 * total) as n_test, ceil(0.2 * total) * n / total as want from counts)",
    "base as (select *, floor(want) as base from want)",
    """takes as (select event_type, base + (row_number() over (order by round(want - base, 9) desc, event_type)
        <= n_test - sum(base) over ())::int as take from base)""") + f"""
select event_id, event_type,
       row_number() over (partition by event_type order by {_DIGEST.format('event_id')}, event_id) <= take as is_test
from events join takes using (event_type)""")
def stratified_split(spark, d):
    return splits.stratified_split(
        b.table(spark, d, "events").select("event_id", "event_type"), "event_id", "event_type", 0.2)


@query("kfold_assign", f"""
select event_id, event_type,
       cast((row_number() over (partition by event_type order by {_DIGEST.format('event_id')}, event_id) - 1) % 5 as integer) as fold
from events""")
def kfold_assign(spark, d):
    return splits.kfold_assign(
        b.table(spark, d, "events").select("event_id", "event_type"), "event_id", 5, label="event_type")


# --- scalar functions --------------------------------------------------------

_CLEAN = r"trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))"


@query("clean_text", f"select doc_id, {_CLEAN} as text_clean from documents")
def clean_text(spark, d):
    return b.table(spark, d, "documents").select("doc_id", text.clean_text(F.col("text")).alias("text_clean"))


@query("text_stats", f"""
select doc_id, cast(length(c) as integer) as text_len, cast(len(string_split(c, ' ')) as integer) as word_count
from (select doc_id, {_CLEAN} as c from documents) where c <> '' and len(string_split(c, ' ')) >= 3""")
def text_stats(spark, d):
    cleaned = b.table(spark, d, "documents").select("doc_id", text.clean_text(F.col("text")).alias("c"))
    return cleaned.select("doc_id", F.length("c").alias("text_len"), text.word_count(F.col("c")).alias("word_count")).filter(
        F.col("word_count") >= 3)


@query("truncate_text", """
select doc_id, case when length(text) > 60 then left(text, 60) || '...' else text end as preview from documents""")
def truncate_text(spark, d):
    return b.table(spark, d, "documents").select("doc_id", text.truncate(F.col("text"), 60).alias("preview"))


@query("array_argmax", """
select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as integer) as argmax,
       list_max(embedding)::double as peak from embeddings""")
def array_argmax(spark, d):
    return b.table(spark, d, "embeddings").select(
        "vec_id", arrays.argmax(F.col("embedding")).alias("argmax"),
        F.array_max("embedding").cast("double").alias("peak"))


@query("normalize_probs", b.with_ctes(b.PRED_LOG) + """
select request_id, round(a / (a + b + 1), 10) as p0, round(b / (a + b + 1), 10) as p1, round(1 / (a + b + 1), 10) as p2
from (select request_id, value as a, max_prob as b from pred_log)""")
def normalize_probs(spark, d):
    raw = F.array(F.col("value"), F.col("max_prob"), F.lit(1.0))
    return b.pred_log(spark, d).withColumn("p", arrays.normalize(raw)).select(
        "request_id", *[r(F.col("p")[i], 10).alias(f"p{i}") for i in range(3)])


@query("prob_map", b.with_ctes(b.PRED_LOG) + " union all ".join(
    f"select request_id, '{n}' as class_name, round({b.class_probability_sql(i)}, 4) as probability from pred_log"
    for i, n in CLASS_NAMES.items()))
def prob_map(spark, d):
    mapped = arrays.named_probabilities(list(CLASS_NAMES.values()), F.col("probabilities"))
    return b.class_probabilities(b.pred_log(spark, d)).select("request_id", F.explode(mapped).alias("class_name", "probability"))


@query("window_id", """
select event_id, strftime(ts, '%Y%m%d_%H%M') as window_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as iso,
       ts - interval 30 day as month_before from events""")
def window_id(spark, d):
    ts = F.col("ts")
    return b.table(spark, d, "events").select(
        "event_id", scalars.window_id(ts).alias("window_id"), scalars.iso_timestamp(ts).alias("iso"),
        scalars.days_before(ts, 30).alias("month_before"))


@query("one_hot", b.with_ctes(b.PRED_LOG) + "select request_id, " + ", ".join(
    f"(prediction = {c})::int as is_{c}" for c in range(3)) + " from pred_log")
def one_hot(spark, d):
    return b.pred_log(spark, d).select("request_id", *arrays.one_hot(F.col("prediction"), range(3)))
