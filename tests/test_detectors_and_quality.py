import collections
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater.operators import quality
from tidewater.plans import alerts, dashboards, fraud
from tidewater.plans.scratch import run_once
from tidewater.schema import Column
from tidewater.streaming import fraud as streams

T0 = datetime(2024, 1, 1, 10, 0)


def tx(spark, times, status="failed", account=1):
    df = spark.createDataFrame([(i, account, "1.0", status, t) for i, t in enumerate(times)], "transaction_id long, account_id long, amount string, status string, event_time timestamp")
    return df.withColumn("ts_ms", F.unix_millis("event_time"))


def test_velocity_is_strict(spark):
    assert fraud.velocity(tx(spark, [T0] * 5)).count() == 0
    assert [r.tx_count for r in fraud.velocity(tx(spark, [T0] * 6)).collect()] == [6]
    assert [r.tx_count for r in fraud.velocity(tx(spark, [T0] * 8, "completed")).collect()] == [8]


STORM = [T0 + timedelta(seconds=59)] * 14 + [T0 + timedelta(seconds=61)] * 14


def test_storm_repeats_on_every_further_failure(spark):
    got = fraud.failure_storm(tx(spark, STORM)).orderBy("failure_count_window").collect()
    assert [r.failure_count_window for r in got] == list(range(15, 29))
    assert [x.tx_id for x in got[0].recent_failures] == list(range(15))


def test_storm_of_one_large_account_needs_no_join(spark):
    rng = random.Random(2)
    times = sorted(rng.randrange(3000) for _ in range(400))
    got = fraud.failure_storm(tx(spark, [T0 + timedelta(seconds=t) for t in times]), least=6)
    assert "Join" not in got._jdf.queryExecution().analyzed().toString()
    want = {k: list(range(k - 5, k + 1)) for k in range(5, 400) if times[k] - times[k - 5] <= 300}
    assert {r.recent_failures[-1].tx_id: [x.tx_id for x in r.recent_failures] for r in got.collect()} == want


def test_storm_window_is_closed_at_five_minutes(spark):
    times = [T0] * 14 + [T0 + timedelta(minutes=5)]
    assert fraud.failure_storm(tx(spark, times)).count() == 1
    assert fraud.failure_storm(tx(spark, times[:14] + [T0 + timedelta(minutes=5, milliseconds=1)])).count() == 0
    assert fraud.failure_storm(tx(spark, STORM, "completed")).count() == 0


def test_streaming_storm_equals_batch(spark, tmp_path):
    rows = tx(spark, STORM)
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")).withWatermark("event_time", "5 seconds")
    got, want = run_once(streams.failure_storm(stream), "storm"), fraud.failure_storm(rows)
    assert got.count() == 14 and got.exceptAll(want.select(*got.columns)).count() == 0


def test_cooldown_and_severity(spark):
    rows = [(1, "LARGE_AMOUNT", "HIGH", s * 1000) for s in (0, 100, 299, 300)] + [(1, "X", "LOW", 5000)]
    df = spark.createDataFrame(rows, "account_id long, alert_type string, severity string, at_ms long")
    got = {(r.at_ms // 1000): r.action for r in alerts.route(df).collect()}
    assert got == {0: "EMAIL_SENT", 100: "EMAIL_THROTTLED", 299: "EMAIL_THROTTLED", 300: "EMAIL_SENT", 5: "LOGGED_ONLY"}
    none = spark.createDataFrame([("VELOCITY_FRAUD", None), ("LARGE_AMOUNT", ""), ("FOO", None), ("FAILED_STORM", "HIGH")], "alert_type string, severity string")
    assert {r.alert_type: r.severity for r in alerts.with_severity(none).collect()} == {"VELOCITY_FRAUD": "MEDIUM", "LARGE_AMOUNT": "HIGH", "FOO": "LOW", "FAILED_STORM": "HIGH"}


def test_cooldown_of_one_large_account_is_folded_by_sessions(spark):
    rng = random.Random(5)
    rows = [(1 if rng.random() < 0.8 else rng.randrange(2, 5), rng.choice(["A", "B"]), "HIGH", rng.randrange(4000) * 1000) for _ in range(1500)]
    want, last = collections.Counter(), {}
    for account, at, kind in sorted({(a, t, k) for a, k, _, t in rows}):
        if account not in last or at - last[account] >= 7000:
            last[account] = at
            want[account, at, kind] = 1
    df = spark.createDataFrame(rows, "account_id long, alert_type string, severity string, at_ms long")
    routed = alerts.route(df, 7)
    got = {(r.account_id, r.at_ms, r.alert_type) for r in routed.where("action = 'EMAIL_SENT'").collect()}
    assert got == set(want) and routed.count() == len(rows)
    assert "collect_set" not in routed._jdf.queryExecution().toString()


def test_alert_json_leaves_out_what_is_missing(spark):
    text = fraud.alert_json(fraud.all_alerts(tx(spark, [T0] * 6))).first().value
    assert '"alert_type":"VELOCITY_FRAUD"' in text and "recent_failures" not in text


def seed(spark):
    i = F.col("id")
    return spark.range(1, 101).select(i.alias("customer_id"), (i * 7 % 101).cast("int").alias("risk_score"), F.when(i % 10 == 0, None).otherwise("verified").alias("kyc_status"))


def test_quality_counts(spark):
    rules = [quality.Rule("range", "risk_score", 0, 50), quality.Rule("accepted_values", "kyc_status", values=("verified",)), quality.Rule("not_null", "kyc_status"), quality.Rule("unique", "kyc_status"), quality.Rule("unique", "customer_id")]
    df = seed(spark)
    got = {r.case_name: r.violations for r in quality.check_table(df, "c", rules).collect()}
    want = df.where("risk_score > 50").count()
    assert got == {"c_risk_score_range": want, "c_kyc_status_accepted_values": 0, "c_kyc_status_not_null": 10, "c_kyc_status_unique": 2, "c_customer_id_unique": 0}
    with pytest.raises(quality.Violated):
        quality.gate(quality.check_table(df, "c", rules))
    assert quality.gate(quality.check_table(df, "c", [rules[-1]])) == 1
    series = quality.result_series(quality.check_table(df, "c", rules))
    assert {r.status for r in series.collect()} == {"Success", "Failed"}
    contract = [Column("customer_id", "long", nullable=False, pk=True), Column("risk_score", "int", unsigned=True)]
    assert [r.kind for r in quality.contract_rules(contract)] == ["not_null", "unique", "range"]


def test_backward_compatibility(spark):
    kind = "urn string, column string, type string, nullable boolean, encoded_as string"
    old = spark.createDataFrame([("u", "a", "long", True, None), ("u", "b", "int", None, None), ("u", "c", "string", True, None), ("u", "d", "decimal(19,4)", True, "string")], kind)
    new = spark.createDataFrame([("u", "a", "int", True, None), ("u", "b", "long", False, None), ("u", "d", "string", True, None), ("u", "e", "int", False, None), ("u", "f", "int", True, None)], kind)
    got = {(r.column, r.change, r.level) for r in quality.backward_diff(old, new).collect()}
    assert got == {("a", "type long to int", "break"), ("b", "optional to required", "break"), ("c", "removed", "note"), ("e", "new required column", "break")}


def test_conformance_finds_drift(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "1.5", "2024")], "id long, amount string, at string")
    columns = [Column("id", "int"), Column("amount", "decimal(19,4)", encoded_as="string"), Column("at", "timestamp", nullable=False), Column("gone", "string")]
    got = {(r.column, r.problem) for r in quality.conformance(df, columns).collect()}
    assert got == {("id", "type bigint"), ("amount", "does not read as decimal(19,4)"), ("at", "null in required column"), ("gone", "missing")}


def test_lookup_defaults_and_last_window(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (3, 20)], "k long, window_end long")
    look = spark.createDataFrame([(1, "x", 4)], "k long, domain string, n long")
    assert {(r.k, r.domain, r.n) for r in dashboards.with_lookup(left, look, "k", {"domain": "", "n": 0}).collect()} == {(1, "x", 4), (2, "", 0), (3, "", 0)}
    assert {r.k for r in dashboards.in_last_window(left).collect()} == {2, 3}
