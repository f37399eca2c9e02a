"""Registration of queries beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return register


def doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, for engines that are compared by value."""
    return df.select(*[F.col(c).cast("double").alias(c) if kind.startswith("decimal") else F.col(c) for c, kind in df.dtypes])
