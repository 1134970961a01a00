"""File sources and sinks with explicit schemas."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema=schema)


def read_csv(spark: SparkSession, path, schema, **options) -> DataFrame:
    """CSV with a header; the schema is given, so no pass over the data infers it."""
    return spark.read.options(**options).csv(path, header=True, schema=schema)


def write_csv(df: DataFrame, path, mode="error", **options) -> None:
    df.write.options(**options).mode(mode).csv(path, header=True)


def write_features(df: DataFrame, path, event_time: str, mode="append") -> None:
    """Parquet laid out by event date, so time filters skip whole folders."""
    df.withColumn("event_date", F.to_date(event_time)).write.mode(mode).partitionBy("event_date").parquet(path)


def read_features(spark: SparkSession, path, schema=None, since=None, until=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if since is not None:
        df = df.filter(F.col("event_date") >= F.lit(since).cast("date"))
    if until is not None:
        df = df.filter(F.col("event_date") <= F.lit(until).cast("date"))
    return df


def write_json(df: DataFrame, path, mode="error") -> None:
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def count_lines(spark: SparkSession, path) -> int:
    return spark.read.text(path).count()
