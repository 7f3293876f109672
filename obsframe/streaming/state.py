"""Keyed state kept by the engine: settings, and helpers of the stateful processors.

State lives in Spark's own store with an incremental change log, so a micro-batch writes
the keys it touched.  Times are BIGINT microseconds inside processors; timers are in
milliseconds, as the watermark is.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGE_LOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def keep_state(spark: SparkSession) -> SparkSession:
    """Choose the state store that keyed processors with timers need."""
    for key, value in ((STORE, ROCKSDB), (CHANGE_LOG, "true")):
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def wake_at(handle: StatefulProcessorHandle, at_us: int | None) -> None:
    """Keep one timer per key: at a time, or none."""
    wanted = None if at_us is None else -(-at_us // 1000)
    for timer in list(handle.listTimers()):
        if timer == wanted:
            return
        handle.deleteTimer(timer)
    if wanted is not None:
        handle.registerTimer(wanted)
