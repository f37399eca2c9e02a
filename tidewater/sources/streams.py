"""Streaming sources: options of message brokers, change streams, message headers. Parsing is plain DataFrame work and runs on any source."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: A registry's wire format puts a magic byte and a four-byte schema id before the Avro body.
AVRO_HEADER = 5


def topic_options(servers: str, topics: list[str], start: str = "earliest", headers: bool = False, most_per_trigger: int | None = None) -> dict[str, str]:
    """Options of a topic source. ``start`` is earliest for metrics, which replay, and latest for detectors."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": start, "includeHeaders": str(headers).lower(), "failOnDataLoss": "false"}
    return options | ({"maxOffsetsPerTrigger": str(most_per_trigger)} if most_per_trigger else {})


def topic_stream(spark: SparkSession, options: dict[str, str], source: str = "kafka") -> DataFrame:
    return spark.readStream.format(source).options(**options).load()


def envelope_schema(row: T.StructType, used: list[str] | None = None) -> T.StructType:
    """Change record of a table; ``used`` keeps only those columns of the row, so that no other is parsed."""
    kept = T.StructType([f for f in row.fields if used is None or f.name in used])
    return T.StructType([T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()), T.StructField("before", kept), T.StructField("after", kept)])


def json_envelopes(messages: DataFrame, schema: T.StructType, delay: str = "5 seconds") -> DataFrame:
    """Messages of JSON change records to envelopes with ``event_time``, the source's commit time, and its watermark."""
    parsed = messages.select(F.from_json(F.col("value").cast("string"), schema).alias("e")).select("e.*")
    return with_event_time(parsed, delay)


def avro_envelopes(messages: DataFrame, avro_schema: str, delay: str = "5 seconds") -> DataFrame:
    """As json_envelopes, for Avro bodies behind a registry header; needs the Avro package on the cluster."""
    from pyspark.sql.avro.functions import from_avro

    body = F.expr(f"substring(value, {AVRO_HEADER + 1})")
    return with_event_time(messages.select(from_avro(body, avro_schema, {"mode": "PERMISSIVE"}).alias("e")).select("e.*"), delay)


def with_event_time(envelopes: DataFrame, delay: str | None = "5 seconds") -> DataFrame:
    out = envelopes.withColumn("event_time", F.timestamp_millis("ts_ms"))
    return out.withWatermark("event_time", delay) if delay else out


class Overlap(StatefulProcessor):
    """The time of a key's newest change; a snapshot row that is older than it is left out."""

    def __init__(self, columns: list[str]):
        self.columns, self.row = columns, Row(*columns)

    def given(self, r: Row) -> Row:
        return self.row(*[r[c] for c in self.columns])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest, snapshot = self.seen.get()[0] if self.seen.exists() else None, []
        for r in rows:
            if r.op == "r":
                snapshot.append(r)
                continue
            newest = r.ts_ms if newest is None or (r.ts_ms is not None and r.ts_ms > newest) else newest
            yield self.given(r)
        yield from (self.given(r) for r in snapshot if newest is None or (r.ts_ms is not None and r.ts_ms >= newest))
        if newest is not None:
            self.seen.update((newest,))

    def close(self) -> None:
        pass


def snapshot_then_stream(snapshot: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """A bounded snapshot and the change stream as one stream of changes.

    Both are streams of the table's columns with ``ts_ms``: the snapshot is read as a source of its own, its rows marked ``op = 'r'`` and timed when it was taken,
    so one job reads both and goes on with the changes when it is done. Reads overlap: the change stream starts before the
    snapshot ends. A snapshot row that meets a newer change of its key is dropped, whichever comes first, so nothing newer is ever overwritten. A key holds one number.
    """
    marked = snapshot.withColumn("op", F.lit("r")).unionByName(changes, allowMissingColumns=True)
    by = [f"__key{k}" for k in range(len(keys))]
    keyed = marked.select(*[F.col(c).alias(n) for c, n in zip(keys, by)], *marked.columns)
    return keyed.groupBy(*by).transformWithState(Overlap(marked.columns), marked.schema, "Append", "None")


def app_json(messages: DataFrame, schema: T.StructType, keep_corrupt: bool = True) -> DataFrame:
    """Messages of application JSON to columns. Broken ones are not skipped: they keep their text in ``_corrupt``."""
    from tidewater.sources.tables import json_records

    out = json_records(messages, schema)
    return out if keep_corrupt else out.where("_corrupt is null").drop("_corrupt")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)
