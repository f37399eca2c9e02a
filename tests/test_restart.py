"""Streams that stop and start again, running totals, the notification log, and tables whose columns changed."""

import pytest
from pyspark.sql import functions as F

from tidewater import schema
from tidewater.operators import serving
from tidewater.plans import alerts, metrics
from tidewater.streaming import metrics as streams, sinks

ROW = "transaction_id long, account_id long, transaction_type string, amount string, status string, op string, event_time timestamp"


def batch(spark, first, minute):
    rows = [(first + k, k % 3, "deposit" if k % 2 else "withdrawal", "1.5000", "completed", "c", f"2024-01-01 00:{minute:02d}:{k:02d}") for k in range(20)]
    return spark.createDataFrame(rows, "transaction_id long, account_id long, transaction_type string, amount string, status string, op string, t string").withColumn("event_time", F.to_timestamp("t")).drop("t")


def read(spark, path):
    return spark.readStream.schema(ROW).parquet(path)


def test_a_metric_that_starts_again_gives_no_window_twice(spark, tmp_path):
    data, out, at = (str(tmp_path / d) for d in ("in", "out", "at"))
    for k in range(3):
        batch(spark, 100 * k, k).write.mode("append").parquet(data)
        stream = streams.tumbling_metric(read(spark, data).withWatermark("event_time", "5 seconds"), metrics.TIMESERIES)
        sinks.each_batch(stream, sinks.append_batches(out), at, once=True).awaitTermination()
    got = spark.read.parquet(out)
    want = metrics.metric(spark.read.parquet(data), metrics.TIMESERIES).where("window_end <= timestamp'2024-01-01 00:02:00'")
    key = lambda df: sorted((r.window_start, r.tx_type, r.tx_count, r.total_amount) for r in df.collect())
    assert key(got) == key(want) and len(key(got)) == 4


def test_a_replay_from_the_start_is_hidden_by_versions(spark, tmp_path):
    data, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(3):
        batch(spark, 100 * k, k).write.mode("append").parquet(data)
    for run in range(2):
        stream = streams.tumbling_metric(read(spark, data).withWatermark("event_time", "5 seconds"), metrics.TIMESERIES)
        sinks.each_batch(stream, sinks.serve(out, "window_start"), str(tmp_path / f"at{run}"), once=True).awaitTermination()
    held = spark.read.parquet(out)
    assert held.count() == 8 and serving.last_version(held, serving.KEYS["timeseries"]).count() == 4


def test_running_totals_over_several_batches_and_sinks(spark, tmp_path):
    data, by = str(tmp_path / "in"), ["transaction_type", "status"]
    for k in range(2):
        batch(spark, 100 * k, k).write.mode("append").parquet(data)
        sinks.running_totals(read(spark, data), by, str(tmp_path / "out"), str(tmp_path / "at"), once=True).awaitTermination()
    got = sinks.current_totals(spark.read.parquet(str(tmp_path / "out")), by)
    assert sorted(map(tuple, got.collect())) == [("deposit", "completed", 20), ("withdrawal", "completed", 20)]

    values = sinks.json_values(read(spark, data), "account_id").withColumn("value", F.when(F.col("key") != "0", F.col("value")))
    both = sinks.fan_out([sinks.append_values(str(tmp_path / "a")), sinks.append_batches(str(tmp_path / "b"))])
    sinks.each_batch(values, both, str(tmp_path / "at2"), once=True).awaitTermination()
    assert [spark.read.parquet(str(tmp_path / d)).count() for d in ("a", "b")] == [26, 40]


def test_a_retried_batch_replaces_its_rows(spark, tmp_path):
    write, rows = sinks.append_batches(str(tmp_path / "log")), spark.range(5)
    for number in (0, 1, 1):
        write(rows, number)
    assert spark.read.parquet(str(tmp_path / "log")).groupBy("batch").count().orderBy("batch").collect() == [(0, 5), (1, 5)]


def test_notification_rows(spark):
    rows = spark.createDataFrame([("VELOCITY_FRAUD", "", 7, 9, 5, 0), ("LARGE_AMOUNT", "", None, None, None, 0), ("OTHER", "", 7, 2, 5, 1)], "alert_type string, severity string, account_id long, tx_count long, threshold long, at_ms long")
    out = alerts.notification_events(alerts.route(rows))
    assert out.columns == ["detected_at", "rule_type", "account_id", "severity", "action", "description"]
    assert sorted(tuple(r)[1:] for r in out.collect()) == [
        ("LARGE_AMOUNT", "", "HIGH", "EMAIL_SENT", "Account None: None tx (threshold None) in window"),
        ("OTHER", "7", "LOW", "LOGGED_ONLY", "Account 7: 2 tx (threshold 5) in window"),
        ("VELOCITY_FRAUD", "7", "MEDIUM", "EMAIL_SENT", "Account 7: 9 tx (threshold 5) in window"),
    ]
    assert alerts.notification_events(alerts.route(rows.drop("tx_count").limit(0))).count() == 0


def test_older_versions_under_the_present_columns(spark):
    columns = [schema.Column("id", "long", pk=True), schema.Column("state", "string"), schema.Column("note", "string")]
    old = spark.createDataFrame([(1, "open", 5)], "id int, status string, dropped int")
    assert schema.evolved(old, columns, {"status": "state"}).collect() == [(1, "open", None)]
    assert schema.evolved(old.selectExpr("id", "status as state", "'x' as note"), columns, {"status": "state"}).collect() == [(1, "open", "x")]
    with pytest.raises(ValueError):
        schema.conform(old, columns)


def test_rows_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    serving.replace_rows(spark, path, spark.range(5))
    assert serving.replace_rows(spark, path, spark.range(2)).count() == 2
    assert serving.replace_rows(spark, path, spark.range(0)).count() == 0
