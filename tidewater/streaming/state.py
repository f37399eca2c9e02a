"""Where streams keep their state: the one place that every writer goes through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful(stream: DataFrame) -> DataStreamWriter:
    """The stream's writer, with state in RocksDB, which several states of one operator and timers need.

    The setting stays in the session, so streams that start side by side do not race for it. A stream that starts again keeps the store that its
    checkpoint names.
    """
    spark = stream.sparkSession
    if spark.conf.get(PROVIDER, None) != ROCKSDB:
        spark.conf.set(PROVIDER, ROCKSDB)
    return stream.writeStream
