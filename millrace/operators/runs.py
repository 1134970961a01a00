"""Experiment runs, the model registry, schemas and data-set fingerprints as tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def long_runs(df: DataFrame, run_id: str, params=(), metrics=(), tags=()) -> DataFrame:
    """(run_id, kind, key, value) rows, value as text; missing entries are left out."""
    rows = [F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
            for kind, columns in (("param", params), ("metric", metrics), ("tag", tags)) for c in columns]
    return (
        df.select(F.col(run_id).alias("run_id"), F.inline(F.array(*rows)))
        .filter(F.col("value").isNotNull())
    )


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").partitionBy("kind").parquet(path)


def runs_pivot(long: DataFrame, keys, kind: str = "metric") -> DataFrame:
    """One row per run, one double column per known key; no pass to discover keys."""
    return (
        long.filter(F.col("kind") == kind)
        .groupBy("run_id").pivot("key", list(keys)).agg(F.max(F.col("value").cast("double")))
    )


def promote_model(registry: DataFrame, run_id, stage: str, archive: str = "Archived") -> DataFrame:
    """Registry after moving the run's first version to `stage`.

    Other versions of the same model in that stage are archived. A run without a
    version changes nothing.
    """
    chosen = (
        registry.filter(F.col("run_id") == run_id)
        .agg(F.min(F.struct("version", "name")).alias("v"))
    )
    target = chosen.select("v").scalar()
    with_target = registry.withColumn("_t", target)
    same_model = F.col("name") == F.col("_t.name")
    is_target = same_model & (F.col("version") == F.col("_t.version"))
    return with_target.withColumn(
        "stage",
        F.when(F.coalesce(is_target, F.lit(False)), F.lit(stage))
        .when(F.coalesce(same_model, F.lit(False)) & (F.col("stage") == stage), F.lit(archive))
        .otherwise(F.col("stage"))).drop("_t")


def model_by_stage(registry: DataFrame, stage: str) -> DataFrame:
    """The newest version of every model in a stage."""
    return registry.filter(F.col("stage") == stage).groupBy("name").agg(
        F.max("version").alias("version"), F.max_by("run_id", "version").alias("run_id"))


def schema_signature(df: DataFrame, role: str = "input") -> DataFrame:
    """(role, position, name, type) of the columns."""
    rows = [(role, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "role string, position int, name string, type string")


def signature_diff(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Columns that were added, removed or changed type."""
    old = stored.select("name", F.col("type").alias("old_type"))
    new = current.select("name", F.col("type").alias("new_type"))
    return (
        old.join(new, "name", "full")
        .withColumn("change", F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed")
                    .when(F.col("old_type") != F.col("new_type"), "retyped"))
        .filter(F.col("change").isNotNull())
    )


def manifest(metrics: DataFrame, name: str, version: str, model_path: str, classes, inputs: dict) -> DataFrame:
    """Metrics row extended to a packaging manifest with nested fields."""
    return metrics.select(
        F.lit(name).alias("name"), F.lit(version).alias("version"), F.lit(model_path).alias("model_path"),
        F.struct(*metrics.columns).alias("metrics"), F.lit("spark").alias("framework"),
        F.array(*[F.lit(str(c)) for c in classes]).alias("classes"),
        F.struct(*[F.lit(t).alias(c) for c, t in inputs.items()]).alias("input_schema"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-independent digest of a data set: row count, xor and bounded sum of row hashes.

    The xor alone would miss pairs of equal rows; the sum keeps them.
    """
    row = F.xxhash64(*sorted(df.columns))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("hash_xor"),
        F.coalesce(F.sum(F.pmod(row, F.lit(2 ** 31))), F.lit(0)).alias("hash_sum"))


def stale_stages(stored: DataFrame, current: DataFrame, key: str = "stage") -> DataFrame:
    """Stages whose stored fingerprint is missing or differs from the current one."""
    old = stored.select(key, F.struct("n_rows", "hash_xor", "hash_sum").alias("_old"))
    new = current.select(key, F.struct("n_rows", "hash_xor", "hash_sum").alias("_new"))
    return new.join(old, key, "left").select(
        key, (~F.col("_new").eqNullSafe(F.col("_old"))).alias("stale"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, columns) -> DataFrame:
    """Rows added, removed or changed between two snapshots of a keyed table."""
    columns = list(columns)
    left = old.select(key, F.struct(*columns).alias("_old"))
    right = new.select(key, F.struct(*columns).alias("_new"))
    return (
        left.join(right, key, "full")
        .withColumn("change", F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed")
                    .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed"))
        .filter(F.col("change").isNotNull()).select(key, "change")
    )
