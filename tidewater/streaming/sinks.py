"""Streaming sinks: message topics, bronze landing, served tables, mirrors, quarantine. Each is checkpointed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators import quality, serving
from tidewater.plans.dlq import split_bad
from tidewater.streaming.state import stateful


def json_values(df: DataFrame, *keys: str) -> DataFrame:
    """Rows as message values; the keys, if any, decide the partition."""
    key = [F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key")] if keys else []
    return df.select(*key, F.to_json(F.struct("*")).alias("value"))


def to_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, sink: str = "kafka", trigger: str = "30 seconds") -> StreamingQuery:
    return stateful(json_values(df)).format(sink).option("kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", checkpoint).trigger(processingTime=trigger).start()


def bronze(df: DataFrame, time: str = "event_time") -> DataFrame:
    """Partition columns from the record's own time in UTC, not from its arrival."""
    return df.withColumns({"year": F.date_format(time, "yyyy"), "month": F.date_format(time, "MM"), "day": F.date_format(time, "dd"), "hour": F.date_format(time, "HH")})


def land(df: DataFrame, path: str, checkpoint: str, time: str = "event_time", once: bool = False) -> StreamingQuery:
    """Parquet by hour; a new file per partition at most every five minutes."""
    writer = stateful(bronze(df, time)).format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("year", "month", "day", "hour")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 minutes")).start()


def each_batch(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False, mode: str = "append") -> StreamingQuery:
    writer = stateful(df).outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def serve(path: str, time_col: str) -> Callable[[DataFrame, int], None]:
    """Append each batch with its version. A batch that is retried writes its rows again; last_version() hides that."""
    return lambda batch, _: serving.append_served(batch, path, time_col)


def mirror(path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """Upsert each batch of unwrapped changes by key; applying a batch twice changes nothing."""
    return lambda batch, _: serving.upsert(batch.sparkSession, path, batch, keys)


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Append-only log. A batch that is retried replaces its own rows; readers see its number as column ``batch``."""
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")


def append_values(path: str) -> Callable[[DataFrame, int], None]:
    """Append-only sink of a topic without a key; null values are skipped."""
    return lambda batch, number: append_batches(path)(batch.where("value is not null"), number)


def running_totals(df: DataFrame, by: list[str], path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Counts of all rows so far by the columns: each batch writes the totals that it changes. ``current_totals`` reads them."""
    return each_batch(df.groupBy(*by).agg(F.count("*").alias("n")), append_batches(path), checkpoint, once, "update")


def current_totals(written: DataFrame, by: list[str]) -> DataFrame:
    """The newest total of each class; a total only grows, so its batch tells which is newest."""
    return serving.last_version(written, by, "batch").drop("batch")


def quarantined(casts: dict[str, str], good_path: str, bad_path: str, connector: str, topic: str) -> Callable[[DataFrame, int], None]:
    """Good rows to one table, bad ones as dead letters to another, from one read of the batch; the stream goes on.

    Each batch has a folder of its own, which a retry replaces; readers see its number as column ``batch``.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            good, letters = split_bad(batch, casts, connector, topic)
            good.write.mode("overwrite").parquet(f"{good_path}/batch={number}")
            letters.write.mode("overwrite").parquet(f"{bad_path}/batch={number}")
        finally:
            batch.unpersist()

    return write


def checked(path: str, results: str, table: str, rules: list[quality.Rule]) -> Callable[[DataFrame, int], None]:
    """Publish each batch that keeps the rules as a folder of its own, and write what was found of every batch; a bad batch is held back and the stream goes on."""
    return lambda batch, number: append_batches(results)(quality.write_checked(batch, table, rules, path, f"batch={number}"), number)


def fan_out(writes: list[Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """Several sinks of one read."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for w in writes:
                w(batch, number)
        finally:
            batch.unpersist()

    return write
