"""Prediction and alert events, their JSON envelope, and the message-topic adapters."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

# fixed values: topic names
TOPIC_PREDICTIONS = "ml.predictions"
TOPIC_FEEDBACK = "ml.feedback"
TOPIC_ALERTS = "ml.alerts"

PREDICTION_EVENT = (
    "event_type STRING, request_id STRING, timestamp STRING, model_version STRING, "
    "features MAP<STRING, DOUBLE>, prediction INT, probabilities ARRAY<DOUBLE>, max_prob DOUBLE"
)
ALERT_EVENT = "event_type STRING, alert_type STRING, timestamp STRING, details MAP<STRING, STRING>"
ENVELOPE = "key STRING, value STRING, topic STRING, timestamp TIMESTAMP"

# fixed values: delivery and polling settings
SINK_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3", "kafka.linger.ms": "10"}
SOURCE_OPTIONS = {"startingOffsets": "earliest"}
POLL_RECORDS = 100


def encode(df: DataFrame, topic: str, key: str) -> DataFrame:
    """Rows to (key, value, topic): the value is the row as JSON, text is UTF-8."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"),
        F.lit(topic).alias("topic"))


def decode(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Envelope columns plus the parsed fields; `_corrupt` keeps what could not be parsed."""
    parsed = F.from_json(
        F.col(value).cast("string"), f"{schema}, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"})
    others = [c for c in df.columns if c not in (value, "timestamp", "topic")]
    return df.select(*others, parsed.alias("_e")).select(*others, "_e.*")


def split_corrupt(decoded: DataFrame):
    """(readable events, unreadable originals)."""
    good = decoded.filter(F.col("_corrupt").isNull()).drop("_corrupt")
    return good, decoded.filter(F.col("_corrupt").isNotNull()).select("_corrupt")


def read_events(spark: SparkSession, fmt: str = "kafka", path=None, per_trigger: int | None = POLL_RECORDS,
                **options) -> DataFrame:
    """Stream of message envelopes.

    "kafka" reads a topic from the earliest offset; the query's checkpoint takes
    the place of group offsets. `per_trigger` limits one micro-batch, to
    POLL_RECORDS records unless told otherwise; with None a batch takes all there is. Any file
    format reads a folder holding the same envelope (the limit counts files).
    """
    if per_trigger:
        options["maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger"] = str(per_trigger)
    if fmt == "kafka":
        return spark.readStream.format("kafka").options(**{**SOURCE_OPTIONS, **options}).load()
    return spark.readStream.format(fmt).schema(ENVELOPE).options(**options).load(path)


def write_events(df: DataFrame, topic: str, key: str, checkpoint: str, fmt: str = "kafka", **options) -> DataStreamWriter:
    """Writer of a stream as message envelopes: acknowledged by all replicas, three retries."""
    writer = encode(df, topic, key).writeStream.format(fmt).option("checkpointLocation", checkpoint)
    return writer.options(**({**SINK_OPTIONS, **options} if fmt == "kafka" else options))
