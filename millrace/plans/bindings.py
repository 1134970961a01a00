"""The given tables seen as model logs, feature rows, runs and drift samples.

Every view has a Spark function and, under the same name in capitals, the SQL
common table expression that says the same.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_pred_log(events: DataFrame) -> DataFrame:
    """Prediction log from `events` rows (batch or stream)."""
    k = F.get_json_object("props", "$.k").cast("int")
    prediction = (F.col("event_id") % 3).cast("int")
    return events.select(
        F.col("event_id").cast("string").alias("request_id"), "event_id", "user_id", "ts", "event_type", "value",
        k.alias("k"),
        F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("model_version"),
        prediction.alias("prediction"),
        (k.cast("double") / 200 + 0.5).alias("max_prob"),
        F.when(k % 10 < 8, prediction).otherwise((prediction + 1) % 3).cast("int").alias("y_true"),
        (F.col("value") / 1000).alias("latency_s"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"))


def pred_log(spark, folder):
    return as_pred_log(table(spark, folder, "events"))


PRED_LOG = """pred_log as (
  select cast(event_id as varchar) as request_id, event_id, user_id, ts, event_type, value, k,
         'v' || cast(user_id % 3 as varchar) as model_version,
         cast(event_id % 3 as integer) as prediction,
         cast(k as double) / 200 + 0.5::double as max_prob,
         cast(case when k % 10 < 8 then event_id % 3 else (event_id % 3 + 1) % 3 end as integer) as y_true,
         value / 1000 as latency_s,
         case when event_type = 'error' then 'error' else 'success' end as status
  from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events))"""


def class_probabilities(df: DataFrame) -> DataFrame:
    """Adds `probabilities`: the predicted class has max_prob, the next 0.7 of the rest, the last 0.3."""
    rest = 1 - F.col("max_prob")
    cells = [F.when(F.col("prediction") == i, F.col("max_prob"))
             .when((F.col("prediction") + 1) % 3 == i, rest * 0.7).otherwise(rest * 0.3) for i in range(3)]
    return df.withColumn("probabilities", F.array(*cells))


def class_probability_sql(i):
    return (f"(case when prediction = {i} then max_prob when (prediction + 1) % 3 = {i} "
            "then (1 - max_prob) * 0.7::double else (1 - max_prob) * 0.3::double end)")


DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DRIFT_CUT = "1998-07-01"


def drift_samples(spark, folder):
    """(reference, current): lineitem before and after a date, quantities raised in the second."""
    rows = table(spark, folder, "lineitem").select("l_shipdate", *DRIFT_COLUMNS)
    cut = F.lit(DRIFT_CUT).cast("timestamp_ntz")
    current = rows.filter(F.col("l_shipdate") >= cut).withColumn("l_quantity", F.col("l_quantity") * 1.2)
    return rows.filter(F.col("l_shipdate") < cut).drop("l_shipdate"), current.drop("l_shipdate")


DRIFT = f"""drift_ref as (select l_quantity, l_extendedprice, l_discount, l_tax from lineitem
  where l_shipdate < timestamp '{DRIFT_CUT}'),
drift_cur as (select l_quantity * 1.2::double as l_quantity, l_extendedprice, l_discount, l_tax from lineitem
  where l_shipdate >= timestamp '{DRIFT_CUT}'),
drift_long as (
  select feature, value, true as is_ref from (unpivot drift_ref on l_quantity, l_extendedprice, l_discount, l_tax
    into name feature value value)
  union all
  select feature, value, false as is_ref from (unpivot drift_cur on l_quantity, l_extendedprice, l_discount, l_tax
    into name feature value value))"""


def runs_log(spark, folder):
    """Experiment runs from orders: one run per order, model by priority."""
    accuracy = F.least(F.col("o_totalprice") / 500000, F.lit(1.0))
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_orderpriority").alias("model"), accuracy.alias("accuracy"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("cost"),
        F.when(F.col("o_orderstatus") == "O", "success").when(F.col("o_orderstatus") == "P", "degraded")
        .otherwise("failure").alias("status"))


RUNS_LOG = """runs_log as (
  select o_orderkey as run_id, strftime(o_orderdate, '%Y-%m-%d') as date, o_orderpriority as model,
         least(o_totalprice / 500000, 1.0::double) as accuracy,
         case when o_orderstatus <> 'P' then o_totalprice end as cost,
         case o_orderstatus when 'O' then 'success' when 'P' then 'degraded' else 'failure' end as status
  from orders)"""


def feature_rows(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("entity_id"), F.col("o_orderdate").alias("event_ts"),
        F.col("o_orderkey").alias("created"), F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 2).alias("half_price"))


FEATURE_ROWS = """feature_rows as (
  select o_custkey as entity_id, o_orderdate as event_ts, o_orderkey as created, o_totalprice as price,
         case when o_orderstatus <> 'P' then o_totalprice / 2 end as half_price from orders)"""

ENTITY_DATES = ("1996-06-30", "1999-01-01", "2001-03-15")


def entity_rows(spark, folder):
    """Every customer at three dates."""
    dates = F.explode(F.array(*[F.lit(d).cast("timestamp_ntz") for d in ENTITY_DATES]))
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("entity_id"), dates.alias("entity_ts"))


ENTITY_ROWS = f"""entity_rows as (
  select c_custkey as entity_id, unnest([{', '.join(f"timestamp '{d}'" for d in ENTITY_DATES)}]) as entity_ts
  from customer)"""


def doc_scores(spark, folder):
    """Labelled documents with a score that follows length loosely and has many ties."""
    docs = table(spark, folder, "documents").select("doc_id", "n_chars", "lang")
    labels = table(spark, folder, "labels")
    score = ((F.col("n_chars") * 7 + F.col("quality") * 40) % 101).cast("double") / 100
    return docs.join(labels, "doc_id").select(
        "doc_id", "lang", F.col("quality").alias("y"), F.least(score, F.lit(1.0)).alias("score"))


DOC_SCORES = """doc_scores as (
  select doc_id, lang, quality as y,
         least(cast((n_chars * 7 + quality * 40) % 101 as double) / 100, 1.0::double) as score
  from documents join labels using (doc_id))"""


def measurements(spark, folder):
    """Four request features per order line; some break the rules."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").alias("sepal_length"), (F.col("l_extendedprice") / 10000).alias("sepal_width"),
        (F.col("l_quantity") / 5).alias("petal_length"), (F.col("l_tax") * 30).alias("petal_width"),
        F.col("l_returnflag").alias("flag"))


MEASUREMENTS = """measurements as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity as sepal_length,
         l_extendedprice / 10000 as sepal_width, l_quantity / 5 as petal_length, l_tax * 30 as petal_width,
         l_returnflag as flag from lineitem)"""


def with_ctes(*ctes):
    return "with " + ",\n".join(ctes) + "\n"


PROFILE_COLUMNS = ["n_orders", "mean_price", "max_price", "balance"]


def profiles(spark, folder):
    """One row per customer with orders: four measures, a class 0-2 that follows from them but for
    about one row in ten, and a number that is nearly linear in them."""
    orders = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"), F.avg("o_totalprice").alias("mean_price"),
        F.max("o_totalprice").alias("max_price"))
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    score = F.col("n_orders") / 10 + F.col("balance") / 5000
    exact = F.when(score < 1.5, 0).when(score < 2.2, 1).otherwise(2)
    return orders.join(customers, "id").select(
        "id", *PROFILE_COLUMNS, F.when(F.col("id") % 10 == 0, (exact + 1) % 3).otherwise(exact).alias("label"),
        (F.col("mean_price") * 2 + F.col("balance") * 3 + F.col("id") % 1000).alias("target"))
