"""Session settings the operators rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; ``conf`` adds or overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Python call sites for error messages cost several round trips per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        STATE_PROVIDER: ROCKSDB,
        **conf,
    }
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: event times without a zone are read and written as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_rocksdb(spark: SparkSession) -> SparkSession:
    """Keep streaming state in RocksDB, outside the JVM heap; stateful processors need it."""
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new path for a written table or a stream's checkpoint, in the cluster's shared folder.

    The folder is the one ``spark.checkpoint.dir`` names, or else the session's warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: what follows survives lost executors without computing it again."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
