"""Column contracts: logical types, Spark schemas and output conformance."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

# fixed values: the closed set of logical types and what stands for them in Spark
LOGICAL = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(), "double": T.DoubleType()}


@dataclass(frozen=True)
class Column:
    """A declared column. A missing ``nullable`` means nullable; ``encoded_as="string"`` is text on the wire."""

    name: str
    type: str
    nullable: bool = True
    pk: bool = False
    encoded_as: str | None = None
    unsigned: bool = False
    pii: bool = False


def spark_type(logical: str) -> T.DataType:
    if m := re.fullmatch(r"decimal\((\d+)\s*,\s*(\d+)\)", logical):
        return T.DecimalType(int(m[1]), int(m[2]))
    if logical not in LOGICAL:
        raise ValueError(f"unknown logical type {logical!r}")
    return LOGICAL[logical]


def wire_type(column: Column) -> T.DataType:
    """Type in a change record: timestamps are ISO text, dates are day numbers, decimals must be encoded as text."""
    if column.type.startswith("decimal"):
        if column.encoded_as != "string":
            raise ValueError(f"{column.name}: a decimal must be encoded as string")
        return T.StringType()
    return T.StringType() if column.type == "timestamp" or column.encoded_as == "string" else T.IntegerType() if column.type == "date" else spark_type(column.type)


def table_schema(columns: list[Column], wire: bool = False) -> T.StructType:
    """Schema of a table; each field carries its ``pii`` and ``pk`` tags as metadata."""
    kind = wire_type if wire else lambda c: spark_type(c.type)
    return T.StructType([T.StructField(c.name, kind(c), c.nullable, {"pii": c.pii, "pk": c.pk}) for c in columns])


def conform(df: DataFrame, columns: list[Column]) -> DataFrame:
    """Cast to the contract and raise if names or their order differ."""
    if df.columns != [c.name for c in columns]:
        raise ValueError(f"columns {df.columns} do not match the contract {[c.name for c in columns]}")
    return df.select([F.col(c.name).cast(spark_type(c.type)).alias(c.name, metadata={"pii": c.pii, "pk": c.pk}) for c in columns])


def evolved(df: DataFrame, columns: list[Column], renamed: dict[str, str] | None = None) -> DataFrame:
    """An older version of a table under its present columns: those renamed since (old name to new) are found by their old names, those added are null, those dropped are left out."""
    df = df.withColumnsRenamed({old: new for old, new in (renamed or {}).items() if old in df.columns and new not in df.columns})
    return conform(df.select([F.col(c.name) if c.name in df.columns else F.lit(None).alias(c.name) for c in columns]), columns)


def without_pii(df: DataFrame) -> DataFrame:
    """Drop the columns that are tagged as personal data."""
    return df.drop(*[f.name for f in df.schema.fields if f.metadata.get("pii")])
