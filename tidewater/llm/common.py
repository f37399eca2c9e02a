"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names; a temporary one only in a session of one machine without that setting."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidewater-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The table as Parquet in the shared folder, read again: a checkpoint of columns, for wide rows."""
    path = f"{checkpoint_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that make a partition worth a task of its own, in tables of short rows.
FEW_ROWS = 4096


def counted(df: DataFrame, at_most: int | None = None, **sums: Column) -> tuple[DataFrame, dict[str, int]]:
    """``compact``, and what the job that writes the rows saw: their number as ``rows``, and sums over them by name. No job of its own counts."""
    if at_most is not None:
        df = df.coalesce(max(4, at_most // FEW_ROWS + 1))
    seen = Observation()
    out = checkpointed(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(k) for k, c in sums.items()]))
    found = {k: v or 0 for k, v in seen.get.items()}
    return out.coalesce(max(4, found["rows"] // FEW_ROWS + 1)), found


def compact(df: DataFrame, at_most: int | None = None) -> DataFrame:
    """Checkpoint short rows and read them in fewer partitions where they turn out few; ``at_most`` is a bound known before. Never in more."""
    return counted(df, at_most)[0]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into short ones, so that long texts are held a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A string column as bytes; null counts as empty."""
    return [b or b"" for b in batch.column(column).cast(pa.large_binary()).to_pylist()]


def lowered(data: bytes) -> bytes:
    """UTF-8 text in lower case, beyond ASCII too."""
    return data.lower() if data.isascii() else data.decode().lower().encode()


def lookup(rows: DataFrame, values: DataFrame, key: str, uses: str, total: int | None = None) -> DataFrame:
    """``rows`` with the columns of ``values``, which has each ``key`` once and in ``uses`` how many rows hold it; ``total`` is the sum of these, where it is known.

    Keys of more than a thousandth of all rows, so under a thousand of them, are broadcast, as a shuffle would send each to one task.
    """
    if total is None:
        total = values.agg(F.sum(uses)).first()[0] or 0
    hot = F.broadcast(values.where(F.col(uses) > total / 1000 + 100))
    cold = rows.join(hot.select(key), key, "left_anti").join(values, key, "left")
    return rows.join(hot, key).select(*cold.columns).unionByName(cold)
