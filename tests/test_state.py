"""State of streams over several batches and restarts, and scans along time in slices, against batch or brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater.operators import distinct, slices
from tidewater.plans import alerts, fraud, metrics
from tidewater.plans.scratch import run_once
from tidewater.sources.streams import snapshot_then_stream
from tidewater.streaming import fraud as fraud_streams, metrics as streams

T0 = datetime(2024, 1, 1, 22, 0)
TX = "transaction_id long, account_id long, transaction_type string, amount string, status string, op string, event_time timestamp"


def tx(spark, rows):
    return spark.createDataFrame(rows, TX).withColumn("ts_ms", F.unix_millis("event_time"))


def transactions(seed, count, spread_s=6 * 3600):
    """Over the end of a day; null accounts, types and amounts among them."""
    rng = random.Random(seed)
    times = sorted(rng.randrange(spread_s) for _ in range(count))
    return [(i, rng.choice([None, *range(1, 12)]), rng.choice([None, "a", "b"]), rng.choice([None, "1.5", "2.25", "0"]), rng.choice(["completed", "failed"]), "c", T0 + timedelta(seconds=t)) for i, t in enumerate(times)]


def runs(spark, parts, make, where, time="event_time"):
    """Each part as a file of its own, each in a run of its own over one checkpoint."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{where}/in")
        out = run_once(make(spark.readStream.schema(part.schema).parquet(f"{where}/in").withWatermark(time, "5 seconds")), "t", where=str(where))
    return out


def same(one, two):
    key = lambda df: sorted(map(repr, (tuple(r) for r in df.select(*[F.col(c).cast("string") for c in two.columns]).collect())))
    assert key(one) == key(two)


WORDS = {"as": "types", "expr": "count(distinct transaction_type)", "kind": "count_distinct", "of": "transaction_type"}


@pytest.mark.parametrize("spec", [metrics.KPI, metrics.BREAKDOWN, {**metrics.KPI, "aggregations": [*metrics.KPI["aggregations"], WORDS]}], ids=["kpi", "breakdown", "two distinct counts"])
def test_running_totals_over_restarts(spark, tmp_path, spec):
    """The day's totals, bitmaps and sets go on in the next run; the day ends within the data."""
    rows = tx(spark, transactions(1, 400))
    cuts = [0, 150, 151, 400]
    parts = [rows.where((F.col("transaction_id") >= a) & (F.col("transaction_id") < b)) for a, b in zip(cuts, cuts[1:])]
    got = runs(spark, parts, lambda s: streams.cumulative_metric(s, spec), tmp_path)
    closed = (T0 + timedelta(seconds=-5)).replace(microsecond=0)
    newest = rows.agg(F.max("event_time")).first()[0] + (closed - T0)
    want = metrics.metric(rows, spec).where(F.col("window_end") <= F.lit(newest))
    assert want.where("window_start = '2024-01-02'").count() and want.where("window_end = '2024-01-02'").count()
    same(got.select(*want.columns), want)


def test_state_has_no_copy_of_a_pane(spark, tmp_path):
    """After a run, the state of the totals has one row a group, not one a window to come."""
    rows = tx(spark, [(i, i % 3, "ab"[i % 2], "1", "completed", "c", T0 + timedelta(minutes=i)) for i in range(60)])
    runs(spark, [rows], lambda s: streams.cumulative_metric(s, metrics.BREAKDOWN), tmp_path)
    held = spark.read.format("statestore").option("path", f"{tmp_path}/checkpoint").option("operatorId", 0).option("stateVarName", "totals").load()
    assert held.count() == 2
    panes = spark.read.format("statestore").option("path", f"{tmp_path}/checkpoint").option("operatorId", 1).load()
    assert panes.count() <= 4


def test_leaders_over_restarts(spark, tmp_path):
    spec = {**metrics.TOPN, "rank": {**metrics.TOPN["rank"], "keep": 3}}
    rows = tx(spark, [(i, a, t, m or "0", s, o, at) for i, a, t, m, s, o, at in transactions(2, 300)])
    parts = [rows.where("transaction_id < 90"), rows.where("transaction_id >= 90 and transaction_id < 200"), rows.where("transaction_id >= 200")]
    got = runs(spark, parts, lambda s: streams.leaders_metric(s, spec, buckets=4), tmp_path)
    newest = rows.agg(F.max("event_time")).first()[0] - timedelta(seconds=5)
    want = metrics.metric(rows, spec).where(F.col("window_end") <= F.lit(newest))
    same(got.select(*want.columns), want)
    falling = tx(spark, [(1, 1, "a", "5", "completed", "c", T0), (2, 1, "a", "-1", "completed", "c", T0 + timedelta(minutes=9)), (3, 1, "a", "1", "completed", "c", T0 + timedelta(minutes=30))])
    with pytest.raises(Exception, match="declared to grow"):
        runs(spark, [falling], lambda s: streams.leaders_metric(s, spec), tmp_path / "falls")
    with pytest.raises(ValueError):
        streams.leaders_metric(rows, {**spec, "rank": {"as": "r", "order_by": "total_value desc", "keep": 3}})


def test_bitmaps_merge_exactly(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(4), rng.randrange(3), rng.choice([None, 0, -1, -40_000, 32_768, 10**12, rng.randrange(-70_000, 70_000)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "hour int, kind int, v long")
    hours = distinct.bitmaps(df, ["hour", "kind"], "v")
    assert "collect_set" not in hours._jdf.queryExecution().toString()
    got = {(r.kind, r.n) for r in distinct.counted(distinct.merged(hours, ["kind"]), ["kind"], "n").collect()}
    assert got == {(k, len({v for _, kk, v in rows if kk == k and v is not None})) for k in range(3)}
    with pytest.raises(TypeError):
        distinct.bitmaps(df.withColumn("v", F.col("v").cast("string")), ["kind"], "v")


def storms(rows, span_ms, least):
    out = {}
    by = {}
    for r in rows:
        if r[4] == "failed" and r[1] is not None:
            by.setdefault(r[1], []).append((int(r[6].timestamp() * 1000), r[0]))
    for account, own in by.items():
        own.sort()
        for k, (t, i) in enumerate(own):
            held = [j for (u, j) in own[: k + 1] if u >= t - span_ms]
            if len(held) >= least:
                out[account, i] = (len(held), held[-least:])
    return out


def found(df):
    return {(r.account_id, r.recent_failures[-1].tx_id): (r.failure_count_window, [x.tx_id for x in r.recent_failures]) for r in df.collect()}


def test_late_failures_count(spark, tmp_path):
    """Rows that come far behind the watermark are alerts of their own and raise the counts of those after them; the counts are those of batch."""
    rows = [(i, a if a != 3 else 1, t, m, s, o, at) for i, a, t, m, s, o, at in transactions(4, 300, 3600)] + [(None, 1, "a", "1", "failed", "c", T0), (7000, None, "a", "1", "failed", "c", T0)]
    rows = [r for r in rows if r[0] is not None]
    df = tx(spark, rows)
    late = F.coalesce(F.col("transaction_id"), F.lit(0)) % 4 == 1
    got = runs(spark, [df.where(~late), df.where(late), df.limit(0)], lambda s: fraud_streams.failure_storm(s, 5, 3, late=120), tmp_path)
    want = storms(rows, 300_000, 3)
    assert found(fraud_streams.last_counts(got)) == want and found(fraud.failure_storm(df, 5, 3)) == want
    assert got.count() > len(want)  # some were counted again


def test_storm_with_null_ids(spark, tmp_path):
    df = tx(spark, [(None, 1, "a", "1", "failed", "c", T0 + timedelta(seconds=k)) for k in range(3)] + [(5, None, "a", "1", "failed", "c", T0)])
    got = runs(spark, [df], lambda s: fraud_streams.failure_storm(s, 5, 3), tmp_path)
    assert [(r.account_id, r.failure_count_window) for r in got.collect()] == [(1, 3)] == [(r.account_id, r.failure_count_window) for r in fraud.failure_storm(df, 5, 3).collect()]


ALERT = "account_id long, alert_type string, severity string, at_ms long, event_id long"


def odd_alerts(seed, count):
    rng = random.Random(seed)
    return [(rng.choice([None, 1, 1, 1, 2]), rng.choice(["VELOCITY_FRAUD", "LARGE_AMOUNT", "OTHER", None]), rng.choice(["", None, "HIGH", "LOW"]), rng.choice([None, rng.randrange(0, 3_000_000) // 1000 * 1000]), i) for i in range(count)]


def test_streaming_routing_equals_batch_on_odd_rows(spark, tmp_path):
    df = spark.createDataFrame(odd_alerts(6, 400), ALERT)
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    got = run_once(fraud_streams.route(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")), "t", where=str(tmp_path))
    group = lambda d: sorted(map(repr, d.groupBy(alerts.account_key(), "alert_type", "severity", "at_ms", "action").count().collect()))
    assert group(got) == group(alerts.route(df)) and got.where("at_ms is null and action = 'EMAIL_SENT'").count() == 0 and got.where("action = 'EMAIL_SENT'").count() > 10


@pytest.mark.parametrize("wait", [0, 1, 700, 5000, 10**7])
def test_let_through_in_slices(spark, wait):
    rng = random.Random(wait)
    events = sorted({(rng.choice(["", "x", "y"]) if rng.random() < 0.1 else "hot", rng.randrange(-60_000, 90_000) if rng.random() < 0.8 else rng.randrange(10**6)) for _ in range(1500)})
    want, last = set(), {}
    for key, at in events:
        if key not in last or at - last[key] >= wait:
            last[key] = at
            want.add((key, at))
    got = slices.let_through(spark.createDataFrame(events, "key string, at long").repartition(5), "key", "at", wait, slices=3).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_let_through_where_the_join_becomes_a_broadcast(spark):
    """The join of slices and states is planned as a sorted one and found small enough to broadcast as it runs; a slice still stays in one piece."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "100k", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    held = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        events = spark.range(40_000, numPartitions=6).select(F.format_string("hot%d", F.floor(F.col("id") / 40_000)).alias("key"), (F.pmod(F.col("id") * 7919, F.lit(40_000)) * 7).alias("at"))
        got = sorted(r.at for r in slices.let_through(events, "key", "at", 1000).collect())
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == list(range(0, 280_000, 1001))


def test_one_huge_account_is_many_tasks(spark):
    """All rows in one account: storms and routing give the same rows, and more than one task has rows."""
    rows = [(i, 1, "a", "1", "failed", "c", T0 + timedelta(seconds=7 * i)) for i in range(3000)]
    df = tx(spark, rows)
    got = fraud.failure_storm(df, 5, 15)
    assert found(got) == storms(rows, 300_000, 15)
    cut = slices.with_tails(df, "ts_ms", 300_000)
    tasks = cut.where("not __tail").repartition(8, "account_id", "__slice").groupBy(F.spark_partition_id()).count()
    assert tasks.count() > 1 and cut.where("not __tail").count() == 3000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(account_id" in plan and ", __slice" in plan
    alert = spark.createDataFrame([(1, "LARGE_AMOUNT", "HIGH", 1000 * i, i) for i in range(3000)], ALERT)
    sent = {r.event_id for r in alerts.route(alert).where("action = 'EMAIL_SENT'").collect()}
    assert sent == set(range(0, 3000, 300))


def test_snapshot_and_changes_overlap(spark, tmp_path):
    """Snapshot and changes in one job, then changes alone; nothing newer is overwritten, and changes seen first hold a late snapshot row back."""
    row = "k long, v string, ts_ms long"
    snap = lambda rows, n: spark.createDataFrame(rows, row).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{n}")
    snap([(1, "s1", 100), (2, "s2", 100), (3, "s3", 100), (None, "s0", 100)], "snapshot")
    changes = lambda rows: spark.createDataFrame(rows, row + ", op string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/changes")
    changes([(1, "old", 50, "u"), (2, "new", 150, "u"), (4, None, 160, "d")])

    def run():
        read = lambda n, s: spark.readStream.schema(s).parquet(f"{tmp_path}/{n}")
        return run_once(snapshot_then_stream(read("snapshot", row), read("changes", row + ", op string"), ["k"]), "t", where=str(tmp_path))

    first = {(r.k, r.v, r.op) for r in run().collect()}
    assert first == {(1, "s1", "r"), (1, "old", "u"), (2, "new", "u"), (3, "s3", "r"), (4, None, "d"), (None, "s0", "r")}
    changes([(3, "newer", 300, "u")])
    snap([(4, "back from the dead", 100), (5, "s5", 100), (2, "as new", 150)], "snapshot")
    second = {(r.k, r.v, r.op) for r in run().collect()}
    assert second - first == {(3, "newer", "u"), (5, "s5", "r"), (2, "as new", "r")}
