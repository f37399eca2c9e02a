"""Change records: filters, unwrapping, current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def inserts(envelopes: DataFrame, condition: str = "op = 'c'") -> DataFrame:
    """Only new rows; snapshot rows (op = 'r') never count in metrics."""
    return envelopes.where(F.expr(condition))


def flatten(envelopes: DataFrame, *columns: str) -> DataFrame:
    """Columns of ``after`` beside op, ts_ms and event_time; a pruned list reads no other nested field."""
    own = [F.col(f"after.{c}") for c in columns] if columns else [F.col("after.*")]
    return envelopes.select(*[c for c in ("op", "ts_ms", "event_time") if c in envelopes.columns], *own)


def unwrap(envelopes: DataFrame, keys: list[str], deletes: str = "none") -> DataFrame:
    """``none``: ``after``, and for a delete the key with nulls and ``__tombstone``; ``rewrite``: for a delete ``before``, all rows with ``__deleted`` text."""
    fields = envelopes.schema["after"].dataType.names
    gone = F.col("op") == "d"
    if deletes == "rewrite":
        row = F.when(gone, F.col("before")).otherwise(F.col("after"))
        return envelopes.select("op", "ts_ms", row.alias("row")).select("op", "ts_ms", *[F.col(f"row.{f}") for f in fields], F.when(gone, "true").otherwise("false").alias("__deleted"))
    if deletes != "none":
        raise ValueError(f"deletes must be none or rewrite, not {deletes!r}")
    value = lambda f: F.when(gone, F.col(f"before.{f}") if f in keys else None).otherwise(F.col(f"after.{f}"))
    return envelopes.select("op", "ts_ms", *[value(f).alias(f) for f in fields], gone.alias("__tombstone"))


def latest(df: DataFrame, keys: list[str], order: str, ties: list[str] | None = None) -> DataFrame:
    """Newest row per key by ``order`` cast to a timestamp if it is text; ties are settled by ``ties``, greatest first.

    ``max_by`` combines before the shuffle, so a key with many versions sends one row per task. Rows without any value
    to order by lose to rows with one.
    """
    at: Column = F.col(order).cast("timestamp") if dict(df.dtypes)[order] == "string" else F.col(order)
    rank = F.struct(at.isNotNull(), at, *[F.col(t) for t in ties or []])
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("__row"))
    return best.select(*keys, "__row.*").select(*df.columns)


def latest_ranked(df: DataFrame, keys: list[str], *order: Column, keep: int = 1) -> DataFrame:
    """First ``keep`` rows per key in the given order; Spark cuts each task's groups before the shuffle."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("__n") <= keep).drop("__n")


def current_state(envelopes: DataFrame, keys: list[str]) -> DataFrame:
    """The table as the change stream leaves it: the last change per key, deleted keys gone."""
    keyed = envelopes.select("*", *[F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(f"__{k}") for k in keys])
    last = keyed.groupBy(*[f"__{k}" for k in keys]).agg(F.max_by(F.struct("op", "after"), F.struct("ts_ms", F.col("op") == "d")).alias("last"))
    return last.where("last.op <> 'd'").select("last.after.*")
