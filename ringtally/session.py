"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Event times are UTC text, so days, hours and windows are cut in UTC. The state store
# keeps windows and seen ids on disk and uploads only changes at each commit.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Times with bounds per row group, so that filters on them skip parts of stored files.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows held would look every key up once more as it is written or removed.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "usage-events", **conf: str) -> SparkSession:
    """A session with these settings. Master, memory and shuffle width come from the
    caller or spark-submit: batch plans are coalesced at run time, while a stateful stream
    keeps the width of its first start for life."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach: under the cluster's checkpoint folder, or a
    local one where none is set (local mode)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="usage-events-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
