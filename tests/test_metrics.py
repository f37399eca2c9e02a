import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewater.operators import windows
from tidewater.plans import metrics, roles
from tidewater.plans.scratch import run_once
from tidewater.streaming import metrics as streams

T0 = datetime(2024, 1, 1, 10, 0, 5)


def tx(spark, rows):
    """rows: (id, account, type, amount, status, time, op)"""
    df = spark.createDataFrame(rows, "transaction_id long, account_id long, transaction_type string, amount string, status string, event_time timestamp, op string")
    return df.withColumn("ts_ms", F.unix_millis("event_time"))


def test_one_minute_ground_truth(spark):
    rows = [(i, i, "deposit", "100", "completed", T0, "c") for i in range(15)] + [(100 + i, i, "withdrawal", "50", "completed", T0, "c") for i in range(5)]
    got = {r.tx_type: (r.tx_count, r.total_amount) for r in metrics.metric(tx(spark, rows), metrics.TIMESERIES).collect()}
    assert got == {"deposit": (15, Decimal("1500.0000")), "withdrawal": (5, Decimal("250.0000"))}


def test_snapshot_rows_do_not_count(spark):
    assert metrics.metric(tx(spark, [(1, 1, "fee", "1", "completed", T0, "r")]), metrics.TIMESERIES).count() == 0


def test_one_row_is_in_every_later_window_of_its_day(spark):
    rows = metrics.metric(tx(spark, [(1, 1, "fee", "1", "completed", datetime(2024, 1, 1, 0, 7), "c")]), metrics.KPI).orderBy("window_end").collect()
    assert len(rows) == 287
    assert (rows[0].window_end, rows[-1].window_end) == (datetime(2024, 1, 1, 0, 10), datetime(2024, 1, 2))
    assert {(r.total_count, r.success_rate, r.active_users) for r in rows} == {(1, Decimal("100.00"), 1)}


def test_distinct_accounts_count_once_a_day_and_again_the_next(spark):
    times = [datetime(2024, 1, 1, 0, 1), datetime(2024, 1, 1, 23, 50), datetime(2024, 1, 2, 0, 1)]
    rows = metrics.metric(tx(spark, [(i, 7, "fee", "1", "failed", t, "c") for i, t in enumerate(times)]), metrics.KPI)
    assert {r.active_users for r in rows.collect()} == {1}
    assert rows.where("window_end = '2024-01-02'").first().total_count == 2


def test_declared_kinds_and_plain_sql_agree(spark):
    rows = tx(spark, [(i, i % 3, "ab"[i % 2], str(i), ["completed", "failed"][i % 4 == 0], T0 + timedelta(minutes=7 * i), "c") for i in range(60)])
    for spec in (metrics.KPI, metrics.BREAKDOWN, metrics.TOPN):
        plain = spec | {"aggregations": [{k: a[k] for k in ("as", "expr")} for a in spec["aggregations"]]}
        one, two = metrics.metric(rows, spec), metrics.metric(rows, plain)
        two = two.select(*[F.col(c).cast(t) for c, t in one.dtypes])
        assert one.count() and one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_null_dimension_keeps_its_group(spark):
    rows = metrics.metric(tx(spark, [(1, 1, None, "2", "completed", T0, "c"), (2, 1, None, "3", "completed", T0, "c")]), metrics.BREAKDOWN)
    assert {(r.tx_type, r.tx_count) for r in rows.collect()} == {(None, 2)}


def test_column_order_is_a_contract(spark):
    rows = tx(spark, [])
    names = metrics.output_columns(metrics.TOPN)
    assert names == ["window_start", "window_end", "rank_num", "account_id", "tx_count", "total_value"]
    assert metrics.metric(rows, metrics.TOPN, names).columns == names
    with pytest.raises(ValueError):
        metrics.metric(rows, metrics.TOPN, names[::-1])


def test_rank_ties_are_settled(spark):
    rows = metrics.metric(tx(spark, [(i, i, "fee", "5", "completed", T0, "c") for i in range(12)]), metrics.TOPN)
    assert [r.account_id for r in rows.where("window_end = '2024-01-01 10:05:00'").orderBy("rank_num").collect()] == list(range(10))


def test_spans(spark):
    assert [windows.seconds(t) for t in ("5 MINUTE", "1 DAY", "2 hours")] == [300, 86400, 7200]
    with pytest.raises(ValueError):
        windows.seconds("soon")


def test_stream_equals_batch_where_windows_closed(spark, tmp_path):
    rows = tx(spark, [(i, i % 4, "ab"[i % 2], str(i), ["completed", "failed"][i % 3 == 0], T0 + timedelta(minutes=11 * i), "c") for i in range(200)])
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")).withWatermark("event_time", "5 seconds")
    for spec, make in ((metrics.TIMESERIES, streams.tumbling_metric), (metrics.TOPN, streams.cumulative_metric)):
        each = (lambda b, s=spec: streams.first_ranked(b, s)) if spec.get("rank") else None
        got, want = run_once(make(stream, spec), spec["name"], each), metrics.metric(rows, spec)
        assert got.count() > 100
        assert got.select(*want.columns).exceptAll(want.select(*[F.col(c).cast(t) for c, t in got.select(*want.columns).dtypes])).count() == 0


def test_roles_read_the_tables(spark):
    assert roles.transactions(spark, "/root/testdata/sf0.001").where("op = 'r'").count() > 0


def test_rank_orders_that_do_not_parse(spark):
    assert len(metrics.sort_keys("n DESC, v, w asc")) == 3
    with pytest.raises(ValueError):
        metrics.sort_keys("sum(v) desc")


def test_leaders_equal_the_rank_over_all_windows(spark):
    rng = random.Random(4)
    rows = [(1_704_067_200_000 + rng.randrange(3 * 86_400_000), rng.randrange(30), str(rng.randrange(0, 4))) for _ in range(800)]
    for odd in ([], [(1_704_067_200_000, 1, "-5")]):  # with a negative amount, totals may fall
        df = spark.createDataFrame(rows + odd, "ts_ms long, account_id long, amount string").selectExpr("*", "timestamp_millis(ts_ms) as event_time", "'c' as op")
        spec = {**metrics.TOPN, "rank": {**metrics.TOPN["rank"], "keep": 3}}
        assert metrics.growing(spec) == "total_value"
        plain = {**spec, "aggregations": [{k: v for k, v in a.items() if k != "kind"} for a in spec["aggregations"]]}
        got, want = (sorted(tuple(map(str, r)) for r in metrics.metric(df, s).select("window_start", "window_end", "rank_num", "account_id", "tx_count", metrics.F.col("total_value").cast("double")).collect()) for s in (spec, plain))
        assert got == want and got
