"""Queries that run the streaming jobs over all there is, once, and read what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater import schema
from tidewater.functions.scalars import cycled
from tidewater.operators import cdc, serving
from tidewater.plans import dlq, metrics, roles
from tidewater.plans.alerts import notification_events
from tidewater.plans.queries_batch import ENVELOPE, LETTERS, STATES, STORM, TOPN, TX, VALUE, _flat_storm, cumulated
from tidewater.plans.registry import Registry, doubles
from tidewater.plans.scratch import folder, run_once
from tidewater.sources.streams import file_stream, snapshot_then_stream
from tidewater.streaming import fraud as fraud_streams, metrics as metric_streams, sinks

R = Registry()
DONE = "'completed'"
QUERIES, ORACLES = R.queries, R.sql

#: Windows that the watermark, five seconds behind the newest row, has closed.
CLOSED = "window_end <= (select max(event_time) - interval 5 second from tx where op = 'c')"


def stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return file_stream(spark, f"{path[:-1]}[{path[-1]}]", spark.read.parquet(path).schema)  # a pattern, as a stream takes no single file by name


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.as_transactions(stream_of(spark, sf_dir, "events")).withWatermark("event_time", "5 seconds")


@R.add(f"with {TX}, w as (select date_trunc('minute', event_time) as window_start, date_trunc('minute', event_time) + interval 1 minute as window_end, transaction_type as tx_type, count(*) as tx_count, {VALUE} as total_amount from tx where op = 'c' group by all) select * from w where {CLOSED}")
def stream_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(run_once(metric_streams.tumbling_metric(transactions(spark, sf_dir), metrics.TIMESERIES), "timeseries"))


@R.add(f"with {TX}, w as ({cumulated('transaction_type', f'count(*) as tx_count, {VALUE} as total_value, {STATES}').replace('select window_start, window_end, transaction_type,', 'select window_start, window_end, transaction_type as tx_type,')}) select * from w where {CLOSED}")
def stream_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(run_once(metric_streams.cumulative_metric(transactions(spark, sf_dir), metrics.BREAKDOWN), "breakdown"))


@R.add(f"with {TX}, w as ({cumulated('', f'count(*) as total_count, {VALUE} as total_value, {STATES}, cast(count(*) filter (where status = {DONE}) * 100.0 / nullif(count(*), 0) as decimal(5,2))::double as success_rate, count(distinct account_id) as active_users')}) select * from w where {CLOSED}")
def stream_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(run_once(metric_streams.cumulative_metric(transactions(spark, sf_dir), metrics.KPI), "kpi"))


@R.add(f"with {TX}, w as ({TOPN}) select * from w where {CLOSED}")
def stream_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten of the day are held as state, from the first ten of the accounts that change in each pane."""
    return doubles(run_once(metric_streams.leaders_metric(transactions(spark, sf_dir), metrics.TOPN), "topn"))


@R.add(f"with {TX}, v as (select 'VELOCITY_FRAUD' as alert_type, 'MEDIUM' as severity, account_id, count(*) as tx_count, 2::bigint as threshold, date_trunc('hour', event_time) as s from tx group by account_id, s having count(*) > 2) select alert_type, severity, account_id, tx_count, threshold, epoch_ms(s) as window_start_ms, epoch_ms(s) + 3600000 as window_end_ms from v where s + interval 1 hour <= (select max(event_time) - interval 5 second from tx)")
def stream_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_once(fraud_streams.velocity(transactions(spark, sf_dir), "1 HOUR", 2), "velocity")


@R.add(STORM)
def stream_failure_storm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_storm(run_once(fraud_streams.failure_storm(transactions(spark, sf_dir), 4320, 4), "storm"))


@R.add(STORM)
def stream_late_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third transaction comes in a second run, far behind the watermark of the first; the state of the checkpoint takes it in, and the last counts are those of batch."""
    where, rows = folder(spark, "late"), roles.transactions(spark, sf_dir)
    for late in (False, True):
        rows.where((F.col("transaction_id") % 3 == 0) == late).write.mode("append").parquet(f"{where}/in")
        alerts = fraud_streams.failure_storm(file_stream(spark, f"{where}/in", rows.schema).withWatermark("event_time", "5 seconds"), 4320, 4, late=64800)
        out = run_once(alerts, "late", where=where)
    return _flat_storm(fraud_streams.last_counts(out))


@R.add(f"""with {TX}, f as (select account_id, ts_ms, transaction_id from tx where status = 'failed'), c as (select account_id, max(ts_ms) as clock from f group by 1)
    select account_id, clock, count(*) as held from f join c using (account_id) where ts_ms >= clock - 86400000 and clock + 86400001 > (select max(ts_ms) - 5000 from f) group by all""")
def stream_storm_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the storm detector holds after its timers: accounts that failed within the span, and of these the failures within it."""
    where = folder(spark, "storm-state")
    run_once(fraud_streams.failure_storm(transactions(spark, sf_dir), 1440, 4, late=0), "storm-state", where=where)
    held = spark.read.format("statestore").option("path", f"{where}/checkpoint").option("stateVarName", "failures").load()
    return held.select("key.account_id", "list_element.ts_ms").groupBy("account_id").agg(F.max("ts_ms").alias("clock"), F.count("*").alias("held"))


#: A snapshot of accounts as of the start of 1996, and the changes since the middle of 1995.
TAKEN, OVERLAP = "1996-01-01", "1995-07-01"


@R.add(f"""with s as (select o_custkey as account_id, 'r' as op, o_totalprice::double as balance, epoch_ms(timestamp '{TAKEN}') as ts_ms from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as k from orders where o_orderdate < '{TAKEN}') where k = 1),
    c as (select o_custkey as account_id, case when o_orderkey % 9 = 0 then 'd' else 'u' end as op, case when o_orderkey % 9 <> 0 then o_totalprice end as balance, epoch_ms(o_orderdate) + o_orderkey % 1000 * 60000 as ts_ms from orders where o_orderdate >= '{OVERLAP}'),
    a as (select * from c union all select * from s where not exists (select 1 from c where c.account_id = s.account_id and c.ts_ms > s.ts_ms))
    select account_id, op, balance, ts_ms from a""")
def stream_snapshot_then_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot ahead of a change stream that starts before it was taken, in one job; snapshot rows that a newer change has overtaken are not there."""
    where, orders = folder(spark, "overlap"), roles.table(spark, sf_dir, "orders")
    taken = F.unix_millis(F.lit(TAKEN).cast("timestamp"))
    held = cdc.latest(orders.where(F.col("o_orderdate") < F.lit(TAKEN).cast("timestamp_ntz")), ["o_custkey"], "o_orderdate", ["o_orderkey"])
    held.select(F.col("o_custkey").alias("account_id"), F.col("o_totalprice").alias("balance"), taken.alias("ts_ms")).write.parquet(f"{where}/snapshot")
    snapshot = file_stream(spark, f"{where}/snapshot", spark.read.parquet(f"{where}/snapshot").schema)
    gone = F.col("o_orderkey") % 9 == 0
    at = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 1000 * 60000
    since = stream_of(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.lit(OVERLAP).cast("timestamp_ntz"))
    changes = since.select(F.col("o_custkey").alias("account_id"), F.when(~gone, F.col("o_totalprice")).alias("balance"), at.alias("ts_ms"), F.when(gone, "d").otherwise("u").alias("op"))
    return run_once(snapshot_then_stream(snapshot, changes, ["account_id"]), "overlap", where=where).select("account_id", "op", "balance", "ts_ms")


def _alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 3 == 0, "LARGE_AMOUNT").when(F.col("event_id") % 3 == 1, "VELOCITY_FRAUD").otherwise("OTHER")
    return stream_of(spark, sf_dir, "events").select(F.col("user_id").alias("account_id"), kind.alias("alert_type"), F.when(F.col("event_id") % 2 == 0, "").otherwise("LOW").alias("severity"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"), "event_id")


@R.add("""with recursive a as (select user_id as account_id, case when event_id % 3 = 0 then 'LARGE_AMOUNT' when event_id % 3 = 1 then 'VELOCITY_FRAUD' else 'OTHER' end as alert_type, case when event_id % 2 = 0 then '' else 'LOW' end as severity, epoch_us(ts) // 1000 as at_ms, event_id from events),
    s as (select *, case when severity <> '' then severity when alert_type = 'LARGE_AMOUNT' then 'HIGH' when alert_type = 'VELOCITY_FRAUD' then 'MEDIUM' else 'LOW' end as sev from a),
    o as (select *, row_number() over (partition by account_id order by at_ms, alert_type) as k from s where sev <> 'LOW'),
    fold as (select *, at_ms as sent, 'EMAIL_SENT' as action from o where k = 1
        union all select o.*, case when o.at_ms - f.sent >= 86400000 then o.at_ms else f.sent end, case when o.at_ms - f.sent >= 86400000 then 'EMAIL_SENT' else 'EMAIL_THROTTLED' end from fold f join o on o.account_id = f.account_id and o.k = f.k + 1)
    select event_id, account_id, sev as severity, action from fold union all select event_id, account_id, sev, 'LOGGED_ONLY' from s where sev = 'LOW'""")
def stream_alert_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = _alert_stream(spark, sf_dir)
    return run_once(fraud_streams.route(alerts, 86400), "routing").select("event_id", "account_id", "severity", "action")


@R.add(f"""select case when event_id % 3 = 0 then 'LARGE_AMOUNT' when event_id % 3 = 1 then 'VELOCITY_FRAUD' else 'OTHER' end as rule_type, cast(account_id as varchar) as account_id, severity, action,
    'Account ' || account_id || ': ' || event_id % 50 || ' tx (threshold None) in window' as description from ({R.sql["stream_alert_routing"]}) as routed""")
def stream_notification_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed alerts in the notification log."""
    where = folder(spark, "notifications")
    counted = _alert_stream(spark, sf_dir).withColumn("tx_count", F.col("event_id") % 50)
    sinks.each_batch(notification_events(fraud_streams.route(counted, 86400)), sinks.append_batches(f"{where}/rows"), f"{where}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{where}/rows").select("rule_type", "account_id", "severity", "action", "description")


def _letter_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = lambda k, v: F.struct(F.lit(dlq.PREFIX + k).alias("key"), v.cast("binary").alias("value"))
    n = F.col("event_id")
    headers = F.array(h("offset", F.when(n % 5 == 0, "x").otherwise(n.cast("string"))), h("exception.class.name", cycled(roles.ERRORS, n)))
    return stream_of(spark, sf_dir, "events").where("event_type = 'error'").select(F.lit("dlq.sink-a").alias("topic"), F.lit(0).alias("partition"), n.alias("offset"), F.col("user_id").cast("string").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"), F.when(n % 4 != 0, headers).alias("headers"))


@R.add(f"with {LETTERS} select dlq_offset, category, original_offset, message_key from d")
def stream_dlq_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _letter_stream(spark, sf_dir)
    return run_once(dlq.dlq_events(records), "dlq").select("dlq_offset", "category", "original_offset", "message_key")


@R.add(f"with {LETTERS} select dlq_topic, category, count(*) as n from d group by all")
def stream_dlq_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals of dead letters by topic and category."""
    where, by = folder(spark, "totals"), ["dlq_topic", "category"]
    sinks.running_totals(dlq.dlq_events(_letter_stream(spark, sf_dir)), by, f"{where}/rows", f"{where}/checkpoint", once=True).awaitTermination()
    return sinks.current_totals(spark.read.parquet(f"{where}/rows"), by)


@R.add("select strftime(ts, '%Y')::int as year, strftime(ts, '%m')::int as month, strftime(ts, '%d')::int as day, strftime(ts, '%H')::int as hour, count(*) as n, sum(event_id)::bigint as ids from events group by all")
def stream_bronze_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = folder(spark, "bronze")
    rows = stream_of(spark, sf_dir, "events").withColumn("event_time", F.col("ts").cast("timestamp"))
    sinks.land(rows, f"{where}/rows", f"{where}/checkpoint", once=True).awaitTermination()
    landed = spark.read.parquet(f"{where}/rows")
    return landed.groupBy(*[F.col(c).cast("int").alias(c) for c in ("year", "month", "day", "hour")]).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@R.add(f"with {ENVELOPE}, r as (select *, row_number() over (partition by account_id order by ts_ms desc, (op = 'd')::int desc) as rn from e) select account_id, account_type, balance from r where rn = 1 and op <> 'd'")
def stream_current_state_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change stream of accounts, upserted by key; two runs of the same changes leave the same table."""
    where = folder(spark, "mirror")
    row = F.struct(F.col("o_custkey").alias("account_id"), F.col("o_orderpriority").alias("account_type"), F.col("o_totalprice").cast("decimal(19,4)").cast("string").alias("balance"))
    op = F.when(F.col("o_orderkey") % 9 == 0, "d").when(F.col("o_orderkey") % 3 == 0, "u").otherwise("c")
    changes = stream_of(spark, sf_dir, "orders").select(op.alias("op"), (F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")).alias("ts_ms"), F.when(F.col("o_orderkey") % 3 == 0, row).alias("before"), F.when(F.col("o_orderkey") % 9 != 0, row).alias("after"))
    for run in (1, 2):
        sinks.each_batch(cdc.unwrap(changes, ["account_id"], "none"), sinks.mirror(f"{where}/rows", ["account_id"]), f"{where}/checkpoint{run}", once=True).awaitTermination()
    return serving.current_rows(spark, f"{where}/rows")


@R.add(f"select account_id, account_type, balance from (select o_custkey as account_id, o_orderpriority as account_type, cast(cast(o_totalprice as decimal(19,4)) as varchar) as balance, o_orderkey % 9 = 0 as gone, row_number() over (partition by o_custkey order by epoch_us(o_orderdate) // 1000 + o_orderkey desc, o_orderkey % 9 = 0 desc) as k from orders) where k = 1 and not gone")
def upsert_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer half of the changes first, then the older half: late changes undo nothing, deletes included."""
    where = folder(spark, "upsert")
    at = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")
    changes = roles.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("account_id"), F.col("o_orderpriority").alias("account_type"), F.col("o_totalprice").cast("decimal(19,4)").cast("string").alias("balance"), (F.col("o_orderkey") % 9 == 0).alias("__tombstone"), at.alias("ts_ms"), (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).alias("newer"))
    for newer in (True, False):
        serving.upsert(spark, f"{where}/rows", changes.where(F.col("newer") == newer).drop("newer"), ["account_id"])
    return serving.current_rows(spark, f"{where}/rows")


@R.add("select event_id % 7 = 0 as bad, count(*) as n from events group by 1")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = folder(spark, "quarantine")
    rows = roles.as_transactions(stream_of(spark, sf_dir, "events")).select("transaction_id", F.when(F.col("transaction_id") % 7 == 0, "abc").otherwise(F.col("amount")).alias("amount"))
    sinks.each_batch(rows, sinks.quarantined({"amount": "decimal(19,4)"}, f"{where}/good", f"{where}/bad", "sink-a", "bank.transactions"), f"{where}/checkpoint", once=True).awaitTermination()
    count = lambda name, bad: spark.read.parquet(f"{where}/{name}").agg(F.count("*").alias("n")).select(F.lit(bad).alias("bad"), "n")
    return count("good", False).union(count("bad", True))


@R.add(f"with {TX}, w as (select date_trunc('minute', event_time) as window_start, transaction_type as tx_type, count(*) as tx_count, date_trunc('minute', event_time) + interval 1 minute as window_end from tx where op = 'c' group by all) select window_start, tx_type, tx_count from w where {CLOSED}")
def stream_served_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric ingested twice, as a replay does; the read keeps one version of each key."""
    where = folder(spark, "served")
    for run in (1, 2):
        stream = metric_streams.tumbling_metric(transactions(spark, sf_dir), metrics.TIMESERIES)
        sinks.each_batch(stream, sinks.serve(f"{where}/rows", "window_start"), f"{where}/checkpoint{run}", once=True).awaitTermination()
    return serving.last_version(spark.read.parquet(f"{where}/rows"), serving.KEYS["timeseries"]).select("window_start", "tx_type", "tx_count")


@R.add("select o_custkey as account_id, count(*) as n from orders where o_orderstatus = 'F' group by 1")
def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of a table; the second, as of its time, after a rollback to the first."""
    where = folder(spark, "snapshots")
    accounts = roles.accounts(spark, sf_dir)
    held = serving.Snapshots(spark, where)
    held.commit(accounts.where("account_status = 'O'"), at="2024-01-01")
    held.commit(accounts.where("account_status = 'F'"), at="2024-01-02")
    held.rollback(1, at="2024-01-03")
    return held.read(as_of="2024-01-02 12:00:00").groupBy(F.col("customer_id").alias("account_id")).agg(F.count("*").alias("n"))


@R.add("select o_orderkey as account_id, o_orderstatus as account_status, case when o_orderkey % 2 = 0 then o_orderpriority end as priority from orders")
def snapshot_old_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version from before a column was renamed, one added and one dropped, beside a version of the present columns."""
    where, orders = folder(spark, "columns"), roles.table(spark, sf_dir, "orders")
    held = serving.Snapshots(spark, where)
    held.commit(orders.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("account_id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("opened_by")))
    held.commit(orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("account_id"), F.col("o_orderstatus").alias("account_status"), F.col("o_orderpriority").alias("priority")))
    columns = [schema.Column("account_id", "long", pk=True), schema.Column("account_status", "string"), schema.Column("priority", "string")]
    old, new = (schema.evolved(held.read(version=v), columns, {"status": "account_status"}) for v in (1, 2))
    return old.unionByName(new)
