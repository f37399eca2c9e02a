"""Messages without a schema: JSON of any shape as VARIANT values, whose fields are found and typed when they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def schemaless(messages: DataFrame, column: str = "value") -> DataFrame:
    """Add ``v``, the message's value whatever its shape, and ``_corrupt``, the text of one that is not JSON. A field may have another type in each message."""
    text = F.col(column).cast("string")
    parsed = messages.withColumn("v", F.try_parse_json(text))
    return parsed.withColumn("_corrupt", F.when(F.col("v").isNull(), text))


def fields(rows: DataFrame, variant: str = "v") -> DataFrame:
    """One row per field of the outer object: ``key``, ``type`` as it stands in that message, and its ``value``, in place of columns of those names. Elements of an array have no key; messages without fields keep a row."""
    found = rows.alias("m").lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col(f"m.{variant}").outer()).alias("f"))
    kept = [F.col(f"m.{c}") for c in rows.columns if c not in ("key", "type", "value")]
    return found.select(*kept, "f.key", F.schema_of_variant("f.value").alias("type"), "f.value")


def typed(rows: DataFrame, wanted: dict[str, tuple[str, str]], variant: str = "v") -> DataFrame:
    """Columns by path and type (name to both); null where a message has no such field or it does not read as that type."""
    return rows.withColumns({name: F.try_variant_get(F.col(variant), path, kind) for name, (path, kind) in wanted.items()})
