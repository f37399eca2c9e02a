"""Event-time windows in batch: tumbling, and cumulative windows that grow by a step until their day ends."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window as W, functions as F

SECONDS = {"SECOND": 1, "MINUTE": 60, "HOUR": 3600, "DAY": 86400}


def seconds(text: str) -> int:
    """``"5 MINUTE"`` as seconds."""
    m = re.fullmatch(r"\s*(\d+)\s+([A-Za-z]+?)[sS]?\s*", text)
    if not m or m[2].upper() not in SECONDS:
        raise ValueError(f"not a span of time: {text!r}")
    return int(m[1]) * SECONDS[m[2].upper()]


def floor_to(ts: Column, size: int) -> Column:
    """Start of the span of ``size`` seconds, counted from the epoch in UTC, that holds the time."""
    return F.timestamp_seconds(F.floor(F.unix_micros(ts) / (size * 1_000_000)) * size)


def tumbling(df: DataFrame, time: str, size: str) -> DataFrame:
    start = floor_to(F.col(time), seconds(size))
    return df.withColumn("window_start", start).withColumn("window_end", start + F.expr(f"interval {seconds(size)} seconds"))


def panes(df: DataFrame, time: str, step: str, size: str) -> DataFrame:
    """``window_start``, the start of the whole span, and ``pane_end``, the first window end that covers the row."""
    pane = floor_to(F.col(time), seconds(step))
    return df.withColumn("window_start", floor_to(F.col(time), seconds(size))).withColumn("pane_end", pane + F.expr(f"interval {seconds(step)} seconds"))


def every_window(keys: DataFrame, step: str, size: str) -> DataFrame:
    """From one row per (window_start, ..., first pane_end): a row for each window end until the span is over, with or without new rows."""
    last = F.col("window_start") + F.expr(f"interval {seconds(size)} seconds")
    return keys.withColumn("window_end", F.explode(F.sequence("pane_end", last, F.expr(f"interval {seconds(step)} seconds")))).drop("pane_end")


def running(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Running sums of the columns along window_end within the keys; nulls count as nothing."""
    over = W.partitionBy("window_start", *keys).orderBy("window_end").rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumns({c: F.sum(c).over(over) for c in columns})
