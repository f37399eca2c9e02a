"""Folders for streams that run once: in the shared folder of the cluster, a temporary one only in a session of one machine that names none."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidewater.streaming.state import stateful


def folder(spark: SparkSession, name: str) -> str:
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    base = base or tempfile.mkdtemp(prefix="tidewater-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_partitions(spark: SparkSession, rows: int, per: int = 500_000, size: str = "16m") -> Iterator[None]:
    """Jobs that run within deal ``rows`` into shuffle partitions of some ``per``, and never fewer than the session's, so that a task's memory does not grow with the input; those that are small are merged up to ``size``."""
    settings = {"spark.sql.shuffle.partitions": str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per))), "spark.sql.adaptive.advisoryPartitionSizeInBytes": size}
    held = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_once(stream: DataFrame, name: str, each: Callable[[DataFrame], DataFrame] | None = None, where: str | None = None) -> DataFrame:
    """Run a stream over all there is, append its rows to a table and read that; ``where`` holds the table and the checkpoint."""
    where = where or folder(stream.sparkSession, name)
    writer = stateful(stream).option("checkpointLocation", f"{where}/checkpoint").trigger(availableNow=True)
    if each is None:
        query = writer.format("parquet").option("path", f"{where}/rows").start()
    else:
        query = writer.foreachBatch(lambda batch, _: each(batch).write.mode("append").parquet(f"{where}/rows")).start()
    query.awaitTermination()
    return stream.sparkSession.read.parquet(f"{where}/rows")
