"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DUPLICATES_KEY = "spark.sql.variant.allowDuplicateKeys"
STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    STATE_STORE_KEY: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Of a field that an object names twice the last value counts.
    DUPLICATES_KEY: "true",
}


def build_session(
    app: str = "millrace",
    master: str | None = None,
    tz: str = "UTC",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with one pinned zone, adaptive execution and RocksDB state.

    The zone decides every text/epoch conversion; the master, the shuffle width
    and memory come from ``spark-submit`` unless given here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, "spark.sql.session.timeZone": tz, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path every executor can reach, under ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local master with that setting unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="millrace-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
