"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Settings the operators are designed for. A cluster sets the same keys in its own defaults.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

#: Sizes for a large cluster: many small shuffle partitions that adaptive execution merges to about
#: 128 MB, and stream state outside the JVM heap.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    app_name: str = "claimspan", master: str | None = None, cluster: bool = False, **extra: str
) -> SparkSession:
    """A session with ``SETTINGS``, and ``CLUSTER_SETTINGS`` if asked for.

    ``extra`` takes more settings with ``__`` for the dots.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sizes = CLUSTER_SETTINGS if cluster else {}
    for key, value in {**SETTINGS, **sizes, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A new folder below ``root``, the cluster's shared checkpoint folder, or the warehouse folder."""
    root = root or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/claimspan/{name}-{uuid.uuid4().hex[:12]}"


def beside(target: str) -> str:
    """The staging folder of a job, next to the folder that the job writes."""
    return f"{target.rstrip('/').rsplit('/', 1)[0]}/_staging"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a staged folder, on whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
