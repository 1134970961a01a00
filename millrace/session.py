"""Session set-up and the shared scratch folder used to cut lineage."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_local_fallback = {}


def build_session(app_name="millrace", master=None, **settings):
    """A session with adaptive execution on and the clock pinned to UTC.

    Nothing is sized here for one machine: memory, executors and
    ``spark.sql.shuffle.partitions`` belong to the cluster or to `settings`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # streaming state on disk, so that it may outgrow the executors' memory
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **settings,
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    A session without one may only fall back to a machine-local folder when it
    runs on one machine; on a cluster the missing setting is an error, because a
    lost executor would take its files with it.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    if "root" not in _local_fallback:
        _local_fallback["root"] = tempfile.mkdtemp(prefix="millrace-")
    return _local_fallback["root"]


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, tag: str) -> DataFrame:
    """Write `df` to the shared folder and continue from the written table.

    Parquet rather than an RDD checkpoint: later steps prune columns and the
    optimizer sees true sizes.
    """
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
