"""Queries: metrics, medallion, detectors, routing, dead letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.operators import cdc, distinct, windows
from tidewater.plans import alerts, dlq, fraud, medallion, metrics, roles
from tidewater.plans.registry import Registry, doubles
from tidewater.plans.scratch import folder, small_partitions

R = Registry()
QUERIES, ORACLES = R.queries, R.sql

TX = """tx as (select event_id as transaction_id, user_id as account_id, event_type as transaction_type, cast(cast(value as decimal(19,4)) as varchar) as amount,
    case when event_type = 'error' then 'failed' else 'completed' end as status, epoch_us(ts) // 1000 as ts_ms, case when event_id % 10 = 0 then 'r' else 'c' end as op, date_trunc('millisecond', ts) as event_time from events)"""
PANES = f"""{TX}, panes as (select *, date_trunc('day', event_time) as window_start, time_bucket(interval 5 minute, event_time) + interval 5 minute as pane_end from tx where op = 'c')"""


def cumulated(keys: str, measures: str) -> str:
    k = f", {keys}" if keys else ""
    return f"""with {PANES}, spread as (select p.*, unnest(generate_series(pane_end, window_start + interval 1 day, interval 5 minute)) as window_end from panes p)
        select window_start, window_end{k}, {measures} from spread group by window_start, window_end{k}"""


VALUE = "cast(cast(sum(cast(amount as decimal(19,4))) as decimal(19,4)) as double)"
STATES = "count(*) filter (where status = 'completed') as success_count, count(*) filter (where status = 'failed') as failed_count"


@R.add(f"with {TX} select date_trunc('minute', event_time) as window_start, date_trunc('minute', event_time) + interval 1 minute as window_end, transaction_type as tx_type, count(*) as tx_count, {VALUE} as total_amount from tx where op = 'c' group by all")
def metric_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(metrics.metric(roles.transactions(spark, sf_dir), metrics.TIMESERIES, ["window_start", "window_end", "tx_type", "tx_count", "total_amount"]))


@R.add(cumulated("", f"count(*) as total_count, {VALUE} as total_value, {STATES}, cast(count(*) filter (where status = 'completed') * 100.0 / nullif(count(*), 0) as decimal(5,2))::double as success_rate, count(distinct account_id) as active_users"))
def metric_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(metrics.metric(roles.transactions(spark, sf_dir), metrics.KPI))


@R.add(cumulated("transaction_type", f"count(*) as tx_count, {VALUE} as total_value, {STATES}").replace("select window_start, window_end, transaction_type,", "select window_start, window_end, transaction_type as tx_type,"))
def metric_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(metrics.metric(roles.transactions(spark, sf_dir), metrics.BREAKDOWN))


TOPN = f"with c as ({cumulated('account_id', f'count(*) as tx_count, {VALUE} as total_value')}), r as (select window_start, window_end, row_number() over (partition by window_start, window_end order by total_value desc, account_id) as rank_num, account_id, tx_count, total_value from c) select * from r where rank_num <= 10"


@R.add(TOPN)
def metric_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(metrics.metric(roles.transactions(spark, sf_dir), metrics.TOPN))


@R.add(f"with {TX}, w as (select date_trunc('day', event_time) as window_start, date_trunc('day', event_time) + interval 1 day as window_end, transaction_type as tx_type, account_id, count(*) as n, {VALUE} as v from tx group by all), r as (select *, row_number() over (partition by window_start, window_end, tx_type order by n desc, v desc, account_id) as place from w) select window_start, window_end, place, tx_type, account_id, n, v from r where place <= 3")
def metric_rank_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three accounts of each day and type, by two keys."""
    spec = {"name": "by_type", "window": {"type": "tumble", "time_col": "event_time", "size": "1 DAY"}, "dimensions": [{"as": "tx_type", "expr": "transaction_type"}, {"as": "account_id", "expr": "account_id"}], "aggregations": [metrics.counted("n"), metrics.summed("v")], "rank": {"as": "place", "partition_by": ["window_start", "window_end", "tx_type"], "order_by": "n DESC, v DESC", "keep": 3}}
    return doubles(metrics.metric(roles.transactions(spark, sf_dir), spec))


@R.add(f"with {TX} select time_bucket(interval 1 hour, event_time) as window_start, time_bucket(interval 1 hour, event_time) + interval 1 hour as window_end, count(*) as n, count(distinct account_id) as accounts, avg(cast(amount as double)) as mean_amount from tx where status = 'failed' group by all")
def metric_custom_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own spec, in SQL text only."""
    spec = {"name": "errors", "filter": "status = 'failed'", "window": {"type": "tumble", "time_col": "event_time", "size": "1 HOUR"}, "dimensions": [], "aggregations": [{"as": "n", "expr": "count(*)"}, {"as": "accounts", "expr": "count(distinct account_id)"}, {"as": "mean_amount", "expr": "avg(cast(amount as double))"}]}
    return metrics.metric(roles.transactions(spark, sf_dir), spec)


BRONZE = """t as (select l_orderkey * 10 + l_linenumber as transaction_id, l_orderkey as account_id, l_returnflag as transaction_type, cast(cast(l_extendedprice as decimal(19,4)) as varchar) as amount, 'USD' as currency,
    case when l_linestatus = 'F' then 'failed' else 'completed' end as status, l_shipdate as posted_at from lineitem),
    silver as (select t.transaction_id, t.transaction_type, t.amount, t.currency, t.status, t.posted_at, o.o_orderkey as account_id, o.o_orderpriority as account_type, 'AC' || lpad(o.o_orderkey::varchar, 10, '0') as account_number,
    c.c_custkey as customer_id, c.c_name as customer_name, n.n_name as country_code, c.c_mktsegment as kyc_status, (c.c_custkey * 7 % 101)::int as risk_score, year(t.posted_at)::int as year, month(t.posted_at)::int as month, day(t.posted_at)::int as day
    from t join orders o on t.account_id = o.o_orderkey join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey)"""


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.silver_enriched(roles.bronze_transactions(spark, sf_dir), roles.bronze_accounts(spark, sf_dir), roles.customers(spark, sf_dir))


def _gold(spark: SparkSession, sf_dir: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A gold table made of silver, written and read; its shuffles have partitions by the number of transactions."""
    where = f"{folder(spark, 'gold')}/rows"
    with small_partitions(spark, roles.table(spark, sf_dir, "lineitem").count()):
        medallion.write_table(make(_silver(spark, sf_dir)), where)
    return spark.read.parquet(where)


@R.add(f"with {BRONZE} select * from silver")
def silver_enriched_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@R.add(f"with {BRONZE} select year, month, day, country_code, transaction_type, count(transaction_id) as txn_count, sum(amount::decimal(19,4))::double as total_volume, sum(amount::decimal(19,4))::double / count(amount) as avg_amount, count(distinct customer_id) as unique_customers, sum(case when status = 'failed' then 1 else 0 end)::bigint as failed_count from silver group by year, month, day, country_code, transaction_type")
def gold_daily_transaction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, medallion.daily_summary)


@R.add(f"with {BRONZE} select customer_id, customer_name, country_code, kyc_status, risk_score, count(transaction_id) as total_txn_count, sum(amount::decimal(19,4))::double as lifetime_value, sum(amount::decimal(19,4))::double / count(amount) as avg_txn_amount, max(posted_at) as last_activity, min(posted_at) as first_activity, count(distinct account_id) as account_count from silver group by all")
def gold_customer_lifetime_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, medallion.lifetime_metrics)


@R.add(f"with {BRONZE} select transaction_id, posted_at, amount, currency, transaction_type, status, customer_id, customer_name, country_code, risk_score, account_id, account_type, year, month, day from silver where risk_score > 60")
def gold_high_risk_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.high_risk(_silver(spark, sf_dir))


@R.add("with a as (select l_orderkey * 10 + l_linenumber as transaction_id, l_orderkey as account_id from lineitem) select a.transaction_id, a.account_id from a where not exists (select 1 from orders o where o.o_orderkey = a.account_id and o.o_orderstatus <> 'P')")
def silver_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions of accounts that are not there: here, orders of status P are left out."""
    accounts = roles.accounts(spark, sf_dir).where("account_status <> 'P'")
    return medallion.orphans(roles.bronze_transactions(spark, sf_dir), accounts).select("transaction_id", "account_id")


@R.add("select o_custkey as account_id, o_orderkey as version, o_orderdate as updated_at, o_totalprice as balance from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("account_id"), F.col("o_orderkey").alias("version"), F.col("o_orderdate").alias("updated_at"), F.col("o_totalprice").alias("balance"))
    return cdc.latest(rows, ["account_id"], "updated_at", ["version"])


@R.add("select o_custkey as account_id, o_orderkey as version, rn as place from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn <= 3")
def last_versions_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    rows = roles.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("account_id"), F.col("o_orderkey").alias("version"), "o_orderdate")
    order = (F.desc("o_orderdate"), F.desc("version"))
    return cdc.latest_ranked(rows, ["account_id"], *order, keep=3).withColumn("place", F.row_number().over(W.partitionBy("account_id").orderBy(*order)).cast("long")).drop("o_orderdate")


ENVELOPE = """e as (select case when o_orderkey % 9 = 0 then 'd' when o_orderkey % 3 = 0 then 'u' else 'c' end as op, epoch_ms(o_orderdate) + o_orderkey as ts_ms, o_custkey as account_id, o_orderpriority as account_type, cast(cast(o_totalprice as decimal(19,4)) as varchar) as balance from orders)"""


@R.add(f"with {ENVELOPE} select op, ts_ms, account_id, account_type, balance, case when op = 'd' then 'true' else 'false' end as __deleted from e")
def cdc_unwrap_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.unwrap(roles.envelopes(spark, sf_dir), ["account_id"], "rewrite")


@R.add(f"with {ENVELOPE} select op, ts_ms, account_id, case when op <> 'd' then account_type end as account_type, case when op <> 'd' then balance end as balance, op = 'd' as __tombstone from e")
def cdc_unwrap_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.unwrap(roles.envelopes(spark, sf_dir), ["account_id"], "none")


@R.add(f"with {ENVELOPE}, r as (select *, row_number() over (partition by account_id order by ts_ms desc, (op = 'd')::int desc) as rn from e) select account_id, account_type, balance from r where rn = 1 and op <> 'd'")
def cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.current_state(roles.envelopes(spark, sf_dir), ["account_id"])


@R.add(f"with {ENVELOPE} select op, ts_ms, account_id, balance from e where op = 'c'")
def cdc_inserts_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows with the two columns that are used; the scan reads no other."""
    return cdc.flatten(cdc.inserts(roles.envelopes(spark, sf_dir)), "account_id", "balance")


@R.add(f"with {TX} select 'VELOCITY_FRAUD' as alert_type, 'MEDIUM' as severity, account_id, count(*) as tx_count, 2::bigint as threshold, epoch_ms(date_trunc('hour', event_time)) as window_start_ms, epoch_ms(date_trunc('hour', event_time)) + 3600000 as window_end_ms from tx group by account_id, date_trunc('hour', event_time) having count(*) > 2")
def fraud_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.velocity(roles.transactions(spark, sf_dir), "1 HOUR", 2)


STORM = f"""with {TX}, f as (select account_id, ts_ms, transaction_id, amount from tx where status = 'failed'),
    w as (select *, count(*) over (partition by account_id order by ts_ms range between 259200000 preceding and current row) as n,
        list(ts_ms || '/' || transaction_id || '/' || amount) over (partition by account_id order by ts_ms, transaction_id rows between 3 preceding and current row) as recent from f)
    select 'FAILED_STORM' as alert_type, 'HIGH' as severity, account_id, n as failure_count_window, 4::bigint as threshold, 4320::bigint as window_minutes, ts_ms as detected_at_ms, array_to_string(recent, ',') as recent_failures from w where n >= 4"""


def _flat_storm(storm: DataFrame) -> DataFrame:
    text = F.concat_ws(",", F.transform("recent_failures", lambda r: F.concat_ws("/", r["ts_ms"].cast("string"), r["tx_id"].cast("string"), r["amount"])))
    return storm.withColumn("recent_failures", text)


@R.add(STORM)
def fraud_failure_storm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_storm(fraud.failure_storm(roles.transactions(spark, sf_dir), 4320, 4))


ALERTS = f"""{TX}, v as (select 'VELOCITY_FRAUD' as alert_type, account_id, epoch_ms(date_trunc('hour', event_time)) + 3600000 as at_ms, count(*) as n from tx group by account_id, date_trunc('hour', event_time) having count(*) > 1),
    s as (select 'FAILED_STORM' as alert_type, account_id, ts_ms as at_ms, count(*) over (partition by account_id order by ts_ms range between 259200000 preceding and current row) as n from tx where status = 'failed'),
    alerts as (select * from v union all select * from s where n >= 4)"""


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fraud.all_alerts(roles.transactions(spark, sf_dir), {"size": "1 HOUR", "above": 1}, {"minutes": 4320, "least": 4})
    return found.withColumn("at_ms", F.coalesce("detected_at_ms", "window_end_ms")).withColumn("n", F.coalesce("tx_count", "failure_count_window"))


@R.add(f"with {ALERTS} select alert_type, account_id, at_ms, n from alerts")
def fraud_all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir).select("alert_type", "account_id", "at_ms", "n")


@R.add(f"""with recursive {ALERTS}, o as (select *, row_number() over (partition by account_id order by at_ms, alert_type) as k from alerts),
    fold as (select account_id, alert_type, at_ms, n, k, at_ms as sent, 'EMAIL_SENT' as action from o where k = 1
        union all select o.account_id, o.alert_type, o.at_ms, o.n, o.k, case when o.at_ms - f.sent >= 86400000 then o.at_ms else f.sent end, case when o.at_ms - f.sent >= 86400000 then 'EMAIL_SENT' else 'EMAIL_THROTTLED' end
        from fold f join o on o.account_id = f.account_id and o.k = f.k + 1)
    select alert_type, account_id, at_ms, action, alert_type || ': account ' || account_id || ', ' || n || ' transactions' as description from fold""")
def alert_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.describe(alerts.route(_alerts(spark, sf_dir), 86400)).select("alert_type", "account_id", "at_ms", "action", "description")


@R.add("""with recursive a as (select case when event_id % 11 = 0 then null else user_id end as account_id, case when event_id % 3 = 0 then 'VELOCITY_ATTACK' else 'VELOCITY_FRAUD' end as alert_type, epoch_us(ts) // 1000 as at_ms from events),
    b as (select *, 1 as copy from a union all select *, 2 as copy from a where at_ms % 2 = 0),
    o as (select *, coalesce(account_id::varchar, '') as key, row_number() over (partition by coalesce(account_id::varchar, '') order by at_ms, alert_type, copy) as k from b),
    fold as (select *, at_ms as sent, 'EMAIL_SENT' as action from o where k = 1
        union all select o.*, case when o.at_ms - f.sent >= 86400000 then o.at_ms else f.sent end, case when o.at_ms - f.sent >= 86400000 then 'EMAIL_SENT' else 'EMAIL_THROTTLED' end from fold f join o on o.key = f.key and o.k = f.k + 1)
    select key as account, alert_type, case when alert_type = 'VELOCITY_ATTACK' then 'HIGH' else 'MEDIUM' end as severity, at_ms, action, count(*) as n from fold group by all""")
def alert_routing_odd_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts without an account, without a severity, and twice."""
    once = roles.table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 11 != 0, F.col("user_id")).alias("account_id"), F.when(F.col("event_id") % 3 == 0, "VELOCITY_ATTACK").otherwise("VELOCITY_FRAUD").alias("alert_type"), F.lit("").alias("severity"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"))
    routed = alerts.route(once.unionAll(once.where("at_ms % 2 = 0")), 86400)
    return routed.groupBy(alerts.account_key().alias("account"), "alert_type", "severity", "at_ms", "action").agg(F.count("*").alias("n"))


@R.add(f"with {ALERTS} select alert_type, count(*) as n from alerts group by 1")
def alert_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir).groupBy("alert_type").agg(F.count("*").alias("n"))


LETTERS = """l as (select event_id as n, user_id, props, ['java.net.ConnectException', 'org.apache.kafka.connect.errors.DataException', 'java.lang.IllegalStateException'][event_id % 3 + 1] as cls, event_id % 4 <> 0 as told from events where event_type = 'error'),
    d as (select case when told then 'sink-a' else 'unknown' end as connector_name, 'dlq.sink-a' as dlq_topic, case when told then 'bank.transactions' else 'unknown' end as original_topic,
        case when not told then 'UNKNOWN' when n % 3 = 0 then 'TRANSIENT' when n % 3 = 1 then 'PERMANENT' else 'UNKNOWN' end as category, 'PARKED' as action, case when told then cls else 'unknown' end as error_class,
        case when told then 'VALUE_CONVERTER' else 'unknown' end as error_stage, case when told then left(repeat('bad value ', (n % 300)::int), 2000) else '' end as error_message, user_id::varchar as message_key, 0 as dlq_partition, n as dlq_offset,
        case when told then (n % 3)::int else -1 end as original_partition, case when told and n % 5 <> 0 then n else -1 end as original_offset, strlen(props)::bigint as message_size from l)"""


@R.add(f"with {LETTERS} select * from d")
def dlq_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dlq.dlq_events(roles.dead_letters(spark, sf_dir)).drop("detected_at")


@R.add(f"with {LETTERS} select dlq_topic, category, count(*) as n from d group by all")
def dlq_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dlq.dlq_events(roles.dead_letters(spark, sf_dir)).groupBy("dlq_topic", "category").agg(F.count("*").alias("n"))


@R.add("select date_trunc('day', ts) as day, event_type, count(distinct user_id) as users from events where user_id is not null group by all union all select null, event_type, count(distinct user_id) from events where user_id is not null group by all")
def distinct_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct accounts by day, and of all time, both merged from one table of hourly bitmaps; no row is read twice and no set is made."""
    rows = roles.transactions(spark, sf_dir)
    hours = distinct.bitmaps(rows, [F.date_trunc("hour", "event_time").alias("hour"), F.col("transaction_type").alias("event_type")], "account_id")
    days = distinct.merged(hours.withColumn("day", F.date_trunc("day", "hour")), ["day", "event_type"])
    ever = distinct.merged(days, ["event_type"]).withColumn("day", F.lit(None).cast("timestamp"))
    return distinct.counted(days, ["day", "event_type"], "users").unionByName(distinct.counted(ever, ["day", "event_type"], "users"))


def _mixed_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.transactions(spark, sf_dir).select("transaction_id", F.when(F.col("transaction_id") % 7 == 0, "abc").otherwise(F.col("amount")).alias("amount"))


@R.add(f"with {TX} select transaction_id, cast(amount as decimal(19,4))::double as amount from tx where transaction_id % 7 <> 0")
def quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(dlq.split_bad(_mixed_amounts(spark, sf_dir), {"amount": "decimal(19,4)"}, "sink-a", "bank.transactions")[0])


@R.add("""select 'dlq.bank.transactions' as topic, '{"transaction_id":' || event_id || ',"amount":"abc"}' as value, 'PERMANENT' as category from events where event_id % 7 = 0""")
def quarantine_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = dlq.split_bad(_mixed_amounts(spark, sf_dir), {"amount": "decimal(19,4)"}, "sink-a", "bank.transactions")[1]
    found = dlq.header_map(F.col("headers"), dlq.PREFIX)["exception.class.name"]
    return letters.select("topic", F.col("value").cast("string").alias("value"), dlq.category(found).alias("category"))


@R.add("select time_bucket(interval 15 minute, date_trunc('millisecond', ts)) as window_start, time_bucket(interval 15 minute, date_trunc('millisecond', ts)) + interval 15 minute as window_end, event_type as transaction_type, count(*) as n from events group by all")
def interval_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windows.tumbling(roles.transactions(spark, sf_dir), "event_time", "15 MINUTE")
    return rows.groupBy("window_start", "window_end", "transaction_type").agg(F.count("*").alias("n"))
