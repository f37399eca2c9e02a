"""Fraud detectors over inserted transactions, in batch; streaming/fraud.py runs the same detectors with state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidewater.operators import slices, windows


def velocity(rows: DataFrame, size: str = "1 MINUTE", above: int = 5, time: str = "event_time") -> DataFrame:
    """Accounts with more than ``above`` transactions of any status in one tumbling window."""
    counts = windows.tumbling(rows, time, size).groupBy("account_id", "window_start", "window_end").agg(F.count("*").alias("tx_count")).where(F.col("tx_count") > above)
    return counts.select(
        F.lit("VELOCITY_FRAUD").alias("alert_type"), F.lit("MEDIUM").alias("severity"), "account_id", "tx_count", F.lit(above).cast("long").alias("threshold"), F.unix_millis("window_start").alias("window_start_ms"), F.unix_millis("window_end").alias("window_end_ms")
    )


def failure_storm(rows: DataFrame, minutes: int = 5, least: int = 15) -> DataFrame:
    """An alert on every failed transaction that is at least the ``least``-th of its account in the trailing minutes.

    The range frame also holds later rows of the same millisecond; their number is taken off. ``recent_failures``
    are the last ``least`` ones, in order of time and id. An account is cut into slices of time, each with the trailing minutes before
    it, so the rows of one account are many groups.
    """
    failed = rows.where("status = 'failed'").select("account_id", "ts_ms", F.col("transaction_id").alias("tx_id"), "amount")
    group = ["account_id", "__slice"]
    trailing = W.partitionBy(*group).orderBy("ts_ms").rangeBetween(-minutes * 60_000, 0)
    peers = W.partitionBy(*group, "ts_ms")
    later = F.count("*").over(peers) - F.row_number().over(peers.orderBy("tx_id"))
    last = W.partitionBy(*group).orderBy("ts_ms", "tx_id").rowsBetween(1 - least, 0)  # at least so many are in the span, so these are
    cut = slices.with_tails(failed.where("account_id is not null and ts_ms is not null"), "ts_ms", minutes * 60_000)
    counted = cut.withColumn("failures", F.count("*").over(trailing) - later)
    recent = counted.withColumn("recent_failures", F.collect_list(F.struct("ts_ms", "tx_id", "amount")).over(last)).where((F.col("failures") >= least) & ~F.col("__tail"))
    return recent.select(
        F.lit("FAILED_STORM").alias("alert_type"), F.lit("HIGH").alias("severity"), "account_id", F.col("failures").alias("failure_count_window"), F.lit(least).cast("long").alias("threshold"), F.lit(minutes).cast("long").alias("window_minutes"), F.col("ts_ms").alias("detected_at_ms"), "recent_failures"
    )


def alert_json(alerts: DataFrame) -> DataFrame:
    """One JSON text per alert, without the fields that it lacks."""
    return alerts.select(F.to_json(F.struct("*")).alias("value"))


def all_alerts(rows: DataFrame, velocity_options: dict | None = None, storm_options: dict | None = None) -> DataFrame:
    return velocity(rows, **velocity_options or {}).unionByName(failure_storm(rows, **storm_options or {}), allowMissingColumns=True)
