"""Serving tables: last version wins, retention, upserts by key without a table format, snapshots."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater.functions.scalars import day_key

# fixed values: keys and retention of the served tables
KEYS = {"timeseries": ["window_start", "tx_type"], "kpi": ["window_start", "window_end"], "breakdown": ["window_start", "window_end", "tx_type"], "topn": ["window_start", "window_end", "rank_num"], "dlq_events": ["dlq_topic", "dlq_partition", "dlq_offset"]}
RETENTION_DAYS = {"kpi": 90, "timeseries": 30, "breakdown": 30, "topn": 30, "dlq_events": 30, "notification_events": 90}


def last_version(df: DataFrame, keys: list[str], version: str = "inserted_at") -> DataFrame:
    """Per key the row written last; versions are combined in each task before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("r")).select(*keys, "r.*").select(*df.columns)


def within_retention(df: DataFrame, time_col: str, days: int, now: Column | None = None) -> DataFrame:
    """Rows younger than ``days``. The bound is one constant, so it reaches the scan; of a table in day folders, only those it leaves are read."""
    least = (F.current_timestamp() if now is None else now) - F.expr(f"interval {days} days")
    kept = df.where(F.col(time_col) > least)
    return kept.where(F.col("__day") >= day_key(least).cast(df.schema["__day"].dataType)) if "__day" in df.columns else kept


def drop_expired(spark: SparkSession, path: str, days: int, now: str | None = None) -> list[str]:
    """Remove the day folders of a served table that hold only rows older than ``days``; gives their names. ``now`` is a time as text."""
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    least = spark.range(1).select(day_key(at - F.expr(f"interval {days} days")).cast("string")).first()[0]
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(Path(path))]
    gone = sorted(n for n in names if n.startswith("__day=") and n.removeprefix("__day=") < least)
    for name in gone:
        fs.delete(Path(f"{path}/{name}"), True)
    return gone


def append_served(df: DataFrame, path: str, time_col: str | None, now: Column | None = None) -> None:
    """Append with a version and a partition per day, whose rows are brought together first, so that it gets few files. Without a time column the table has no
    partitions: that is for tables of few rows a day, whose folders would be more work than their rows."""
    rows = df.withColumn("inserted_at", F.current_timestamp() if now is None else now)
    if time_col is None:
        rows.write.mode("append").parquet(path)
    else:
        rows.withColumn("__day", day_key(F.col(time_col))).hint("rebalance", F.col("__day")).write.mode("append").partitionBy("__day").parquet(path)


def replace_rows(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """Empty a table and fill it again; readers see the old rows or the new ones, never none. Gives the table."""
    held = Snapshots(spark, path)
    held.commit(df)
    return held.read()


def upsert(spark: SparkSession, path: str, changes: DataFrame, keys: list[str], buckets: int = 16) -> None:
    """Apply changes (columns of the table, ``__tombstone``, ``ts_ms``) to a Parquet table cut in hash buckets; ``current_rows`` reads it.

    The table keeps each key's last change with its time, also a delete, so a change that comes late never undoes a newer one.
    Only the buckets that hold a changed key are read and written again, each by one dynamic partition overwrite. With a
    table format, MERGE INTO does the same; this is for stores without one. New files are written beside the old ones first,
    and applying a batch again after a failed run gives the same table.
    """
    columns = [*keys, *[c for c in changes.columns if c not in (*keys, "op")]]
    newest = lambda df: df.groupBy(*keys).agg(F.max_by(F.struct(*columns[len(keys) :]), F.struct("ts_ms", "__tombstone")).alias("r")).select(*keys, "r.*")
    last = newest(changes)
    last = last.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    new = last.select(*columns, "bucket")
    if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
        touched = [r.bucket for r in last.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        old = spark.read.parquet(path).where(F.col("bucket").isin(touched))
        both = old.select(*columns).unionByName(new.select(*columns))
        new = newest(both).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        held = f"{path}.next-{time.time_ns()}"
        new.write.parquet(held)
        spark.read.parquet(held).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(held), True)
    else:
        new.repartition("bucket").write.partitionBy("bucket").parquet(path)


def current_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that ``upsert`` keeps, without those deleted last."""
    return spark.read.parquet(path).where(~F.col("__tombstone")).drop("__tombstone", "ts_ms", "bucket")


class Snapshots:
    """Versions of a table as Parquet folders and a log of them; for stores without a table format.

    Readers take the log's newest entry, so a version is seen only once it is whole. Rolling back writes a log entry.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def log(self) -> DataFrame:
        return self.spark.read.schema("snapshot_id long, committed_at timestamp, operation string, folder string").json(f"{self.path}/log")

    def commit(self, df: DataFrame, operation: str = "replace", at: str | None = None) -> int:
        number = self._next()
        df.write.parquet(f"{self.path}/snapshot_id={number}")
        self._record(number, operation, f"snapshot_id={number}", at)
        return number

    def rollback(self, snapshot_id: int, at: str | None = None) -> int:
        folder = self.log().where(F.col("snapshot_id") == snapshot_id).first().folder
        number = self._next()
        self._record(number, "rollback", folder, at)
        return number

    def read(self, version: int | None = None, as_of: str | None = None) -> DataFrame:
        entries = self.log()
        if version is not None:
            entries = entries.where(F.col("snapshot_id") == version)
        if as_of is not None:
            entries = entries.where(F.col("committed_at") <= F.lit(as_of).cast("timestamp"))
        last = entries.orderBy(F.desc("snapshot_id")).first()
        if last is None:
            raise ValueError("no such snapshot")
        return self.spark.read.parquet(f"{self.path}/{last.folder}")

    def files(self) -> DataFrame:
        """Files of the newest version with their sizes."""
        return self.read().select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")).distinct()

    def _next(self) -> int:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/log")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return 1
        return (self.log().agg(F.max("snapshot_id")).first()[0] or 0) + 1

    def _record(self, number: int, operation: str, folder: str, at: str | None) -> None:
        when = F.lit(at).cast("timestamp") if at else F.current_timestamp()
        self.spark.range(1).select(F.lit(number).cast("long").alias("snapshot_id"), when.alias("committed_at"), F.lit(operation).alias("operation"), F.lit(folder).alias("folder")).coalesce(1).write.mode("append").json(f"{self.path}/log")
