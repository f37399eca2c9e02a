"""Dead letters: classification of error records, and a split of good and bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.functions.scalars import byte_length, header_map, milliseconds_text, safe_int, safe_text

PREFIX = "__connect.errors."
# fixed values: error classes that pass by themselves, and those that fail again on the same data
TRANSIENT = ["org.apache.kafka.connect.errors.RetriableException", "java.net.ConnectException", "java.net.SocketTimeoutException", "org.elasticsearch.client.ResponseException"]
PERMANENT = ["org.apache.kafka.connect.errors.DataException", "org.apache.kafka.common.errors.SerializationException", "org.apache.kafka.connect.errors.SchemaException"]


def category(error_class: Column) -> Column:
    return F.when(error_class.isin(TRANSIENT), "TRANSIENT").when(error_class.isin(PERMANENT), "PERMANENT").otherwise("UNKNOWN")


def dlq_events(records: DataFrame, now: Column | None = None) -> DataFrame:
    """One event per record: what failed, where it lies, and that it is parked. The key is kept, never the payload."""
    meta = records.withColumn("__meta", header_map(F.col("headers"), PREFIX))
    field = lambda name: F.coalesce(F.col("__meta")[name], F.lit("unknown"))
    return meta.select(
        milliseconds_text(F.current_timestamp() if now is None else now).alias("detected_at"),
        field("connector.name").alias("connector_name"),
        F.col("topic").alias("dlq_topic"),
        field("topic").alias("original_topic"),
        category(F.coalesce(F.col("__meta")["exception.class.name"], F.lit(""))).alias("category"),
        F.lit("PARKED").alias("action"),
        field("exception.class.name").alias("error_class"),
        field("stage").alias("error_stage"),
        F.left(F.coalesce(F.col("__meta")["exception.message"], F.lit("")), F.lit(2000)).alias("error_message"),
        F.coalesce(safe_text(F.col("key")), F.lit("")).alias("message_key"),
        F.col("partition").cast("int").alias("dlq_partition"),
        F.col("offset").cast("long").alias("dlq_offset"),
        safe_int(F.col("__meta")["partition"]).cast("int").alias("original_partition"),
        safe_int(F.col("__meta")["offset"]).alias("original_offset"),
        byte_length(F.col("value")).cast("long").alias("message_size"),
    )


def split_bad(df: DataFrame, casts: dict[str, str], connector: str, topic: str) -> tuple[DataFrame, DataFrame]:
    """Good rows with their columns cast, and bad rows as dead letters with their error in headers. Both come from one read."""
    bad = F.lit(False)
    for c, kind in casts.items():
        bad = bad | (F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull())
    marked = df.withColumn("__bad", bad)
    good = marked.where(~F.col("__bad")).drop("__bad").withColumns({c: F.col(c).try_cast(kind) for c, kind in casts.items()})
    header = lambda k, v: F.struct(F.lit(PREFIX + k).alias("key"), F.lit(v).cast("binary").alias("value"))
    headers = F.array(header("connector.name", connector), header("topic", topic), header("stage", "VALUE_CONVERTER"), header("exception.class.name", PERMANENT[0]), header("exception.message", "a column does not hold its declared type"))
    letters = marked.where("__bad").drop("__bad").select(F.lit(f"dlq.{topic}").alias("topic"), F.to_json(F.struct("*")).cast("binary").alias("value"), headers.alias("headers"))
    return good, letters
