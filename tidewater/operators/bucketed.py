"""Tables bucketed and sorted by key, so that reading the last versions or joining on the key moves no row.

The one shuffle is paid when the table is written. Two tables of the same number of buckets join bucket by bucket, and a group of the key is within one
bucket, so plans over them hold no exchange. A bucket is one task: ``buckets`` gives so many that a bucket's rows do not grow with the tables. Leave tables in
which one key holds a large share of the rows to the shuffled joins, which split such keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of a bucket, on average; sorted in memory they take some hundred megabytes at most where rows are narrow.
ROWS = 500_000


def buckets(*tables: DataFrame, rows: int = ROWS, least: int = 8) -> int:
    """Number of buckets for tables that are joined bucket by bucket, by the largest one's rows."""
    return max(least, *[-(-t.count() // rows) for t in tables])


def save(df: DataFrame, table: str, keys: list[str], buckets: int, path: str) -> DataFrame:
    """Write the table with one file a bucket and give it back."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)
