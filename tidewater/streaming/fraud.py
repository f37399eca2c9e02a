"""Detectors and alert routing on streams, with state per account."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewater.operators.windows import seconds
from tidewater.plans.alerts import COOLDOWN_S, NOTIFIES, account_key, with_severity

STORM_SCHEMA = "alert_type string, severity string, account_id long, failure_count_window long, threshold long, window_minutes long, detected_at_ms long, recent_failures array<struct<ts_ms:bigint,tx_id:bigint,amount:string>>"


def velocity(rows: DataFrame, size: str = "1 MINUTE", above: int = 5, time: str = "event_time") -> DataFrame:
    """More than ``above`` transactions of an account in a tumbling window; a plain window aggregate."""
    counts = rows.groupBy(F.window(time, f"{seconds(size)} seconds").alias("w"), "account_id").agg(F.count("*").alias("tx_count")).where(F.col("tx_count") > above)
    return counts.select(F.lit("VELOCITY_FRAUD").alias("alert_type"), F.lit("MEDIUM").alias("severity"), "account_id", "tx_count", F.lit(above).cast("long").alias("threshold"), F.unix_millis("w.start").alias("window_start_ms"), F.unix_millis("w.end").alias("window_end_ms"))


class Storm(StatefulProcessor):
    """Failures of the trailing minutes as list state, by the account's own clock, which is the greatest time it has seen.

    A failure that comes late takes its place among those held: it is judged by what stands before it, and those after it that count it are given out
    again with their new count. Failures are held for ``late`` minutes longer than they can count for one in order. A timer clears an
    account when the watermark has left all it holds behind.
    """

    def __init__(self, minutes: int, least: int, late: int):
        self.row = Row(*[c.split(" ")[0] for c in STORM_SCHEMA.split(", ")])
        self.span, self.hold, self.minutes, self.least = minutes * 60_000, (minutes + late) * 60_000, minutes, least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("failures", "ts_ms long, tx_id long, amount string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        order = lambda f: (f[0], f[1] is not None, f[1] or 0)
        marked = [(tuple(f), False) for f in self.held.get()] + [((r.ts_ms, r.transaction_id, r.amount), True) for r in rows]
        marked.sort(key=lambda m: order(m[0]))
        failures = [f for f, _ in marked]
        first, newest = 0, -1
        for k, (failure, new) in enumerate(marked):
            newest = k if new else newest
            while failures[first][0] < failure[0] - self.span:
                first += 1
            count = k - first + 1
            if newest >= first and count >= self.least:
                recent = [Row(ts_ms=t, tx_id=i, amount=a) for t, i, a in failures[k + 1 - self.least : k + 1]]
                yield self.row("FAILED_STORM", "HIGH", key[0], count, self.least, self.minutes, failure[0], recent)
        clock = failures[-1][0]
        self.held.put([f for f in failures if f[0] >= clock - self.hold])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(clock + self.hold + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.held.clear()
        yield from ()

    def close(self) -> None:
        pass


def failure_storm(rows: DataFrame, minutes: int = 5, least: int = 15, late: int | None = None) -> DataFrame:
    """``rows`` has a watermark, by which idle accounts are cleared; it drops no row, as the time column does not reach the state.

    ``late`` is ``minutes`` if left out. ``last_counts`` reads what a late failure has changed. Failures without account or time are left out, as in batch.
    """
    failed = rows.where("status = 'failed' and account_id is not null and ts_ms is not null").select("account_id", "ts_ms", "transaction_id", "amount")
    return failed.groupBy("account_id").transformWithState(Storm(minutes, least, minutes if late is None else late), STORM_SCHEMA, "Append", "EventTime")


def last_counts(alerts: DataFrame) -> DataFrame:
    """One alert a failure: that of the greatest count, as late failures only add to it."""
    newest = F.element_at("recent_failures", -1)["tx_id"]
    rest = [c for c in alerts.columns if c not in ("account_id", "detected_at_ms")]
    best = alerts.groupBy("account_id", "detected_at_ms", newest.alias("__tx")).agg(F.max_by(F.struct(*rest), "failure_count_window").alias("r"))
    return best.select("account_id", "detected_at_ms", "r.*").select(*alerts.columns)


class Cooldown(StatefulProcessor):
    """The time of the account's last sent alert. An account's rows of one micro-batch are put in order in memory; the source's limit per trigger bounds them."""

    def __init__(self, cooldown_s: int, columns: list[str]):
        self.wait, self.columns, self.row = cooldown_s * 1000, columns, Row(*columns, "action")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sent = handle.getValueState("sent", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.sent.get()[0] if self.sent.exists() else None
        for r in sorted(rows, key=lambda r: (r.at_ms is None, r.at_ms or 0, r.alert_type is None, r.alert_type or "")):
            if r.severity not in NOTIFIES:
                action = "LOGGED_ONLY"
            elif r.at_ms is not None and (last is None or r.at_ms - last >= self.wait):
                last, action = r.at_ms, "EMAIL_SENT"
            else:
                action = "EMAIL_THROTTLED"
            yield self.row(*[r[c] for c in self.columns], action)
        if last is not None:
            self.sent.update((last,))

    def close(self) -> None:
        pass


def route(alerts: DataFrame, cooldown_s: int = COOLDOWN_S) -> DataFrame:
    """Alerts (account_id, alert_type, severity, at_ms, ...) with their ``action``; the state holds one time per account. Alerts without a time are throttled, as in batch."""
    rows = with_severity(alerts)
    given = T.StructType([*rows.schema.fields, T.StructField("action", T.StringType())])
    return rows.withColumn("__key", account_key()).groupBy("__key").transformWithState(Cooldown(cooldown_s, rows.columns), given, "Append", "None")
