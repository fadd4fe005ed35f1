"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are designed for. AQE splits skewed join partitions and picks
# broadcast or shuffle joins from measured sizes, so no operator hints a broadcast itself.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_folders: dict[str, str] = {}


def build(app: str = "voltframe", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Every timestamp in the data model is UTC; pin the session to it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local folder is only ever used in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="voltframe-")
    return _local_folders[app]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
