"""Alert routing: severity fallback, which alerts notify, and a cooldown per account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewater.operators import slices

# fixed values: severity of an alert type that comes without one, and the severities that notify
SEVERITY = {"VELOCITY_FRAUD": "MEDIUM", "VELOCITY_ATTACK": "HIGH", "FAILED_STORM": "MEDIUM", "LARGE_AMOUNT": "HIGH"}
NOTIFIES = ["HIGH", "MEDIUM"]
COOLDOWN_S = 300


def with_severity(alerts: DataFrame) -> DataFrame:
    """The message's own severity, else the one of its type, else LOW."""
    known = F.create_map(*[F.lit(x) for pair in SEVERITY.items() for x in pair])
    return alerts.withColumn("severity", F.coalesce(F.nullif("severity", F.lit("")), known[F.col("alert_type")], F.lit("LOW")))


def describe(alerts: DataFrame) -> DataFrame:
    """Text of an alert; a storm has no tx_count, so its failures are named."""
    count = F.coalesce("tx_count", "failure_count_window") if "failure_count_window" in alerts.columns else F.col("tx_count")
    return alerts.withColumn("description", F.format_string("%s: account %s, %s transactions", "alert_type", F.col("account_id").cast("string"), F.coalesce(count.cast("string"), F.lit("N/A"))))


def notification_events(routed: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows of the notification log, one per routed alert; what an alert does not tell is written as None."""
    said = lambda c: F.coalesce(F.col(c).cast("string") if c in routed.columns else F.lit(None), F.lit("None"))
    return routed.select(
        (F.current_timestamp() if now is None else now).alias("detected_at"),
        F.coalesce("alert_type", F.lit("")).alias("rule_type"),
        account_key().alias("account_id"),
        "severity",
        "action",
        F.format_string("Account %s: %s tx (threshold %s) in window", said("account_id"), said("tx_count"), said("threshold")).alias("description"),
    )


def account_key() -> Column:
    """The account by which the cooldown counts; alerts without one count as one account."""
    return F.coalesce(F.col("account_id").cast("string"), F.lit(""))


def route(alerts: DataFrame, cooldown_s: int = COOLDOWN_S, at: str = "at_ms") -> DataFrame:
    """Add ``action``: LOGGED_ONLY, EMAIL_SENT, or EMAIL_THROTTLED within the cooldown after the account's last sent alert.

    Which alerts are sent depends on the last one sent, which no window frame tells; it is carried along slices of time, so an
    account with many alerts is many groups. Alerts of one time and account share a place in the order: the first by type is sent,
    and of equal ones only one. Alerts without an account are one account of their own, those without a time are throttled.
    """
    rows = with_severity(alerts).withColumns({"__key": account_key(), "__at": F.col(at).cast("bigint")})
    notifying = F.col("severity").isin(NOTIFIES)
    places = rows.where(notifying & F.col("__at").isNotNull()).groupBy("__key", "__at").agg(F.min("alert_type").alias("__kind"))
    sent = slices.let_through(places, "__key", "__at", cooldown_s * 1000).join(places, ["__key", "__at"]).withColumn("__sent", F.lit(True))
    joined = rows.join(sent, ["__key", "__at"], "left")
    others = sorted(c for c in alerts.columns if not alerts.schema[c].dataType.simpleString().startswith("map"))
    place = F.row_number().over(W.partitionBy("__key", "__at", "alert_type", notifying).orderBy(*[F.col(c).asc_nulls_last() for c in others]))
    due = F.col("__sent") & F.col("alert_type").eqNullSafe(F.col("__kind")) & (F.col("__place") == 1)
    action = F.when(~notifying, "LOGGED_ONLY").when(due, "EMAIL_SENT").otherwise("EMAIL_THROTTLED")
    return joined.withColumn("__place", place).withColumn("action", action).drop("__key", "__at", "__kind", "__sent", "__place")
