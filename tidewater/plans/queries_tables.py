"""Queries over tables in catalogs and stores: federation with push-down, replaced tables, buckets, checked publishing, messages without a schema, retention."""

from __future__ import annotations

import re
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewater.operators import bucketed, cdc, quality, serving
from tidewater.plans import dashboards, fraud, medallion, metrics, queries_batch, roles
from tidewater.plans.queries_batch import BRONZE, TX
from tidewater.plans.queries_streams import stream_of
from tidewater.plans.registry import Registry, doubles
from tidewater.plans.scratch import folder
from tidewater.sources import tables, variant
from tidewater.sources.streams import app_json, file_stream
from tidewater.streaming import fraud as fraud_streams, sinks

R = Registry()
QUERIES, ORACLES = R.queries, R.sql


def store(spark: SparkSession) -> str:
    """The catalog of the store that plays the operational database: that of ``spark.tidewater.jdbc.url``, an embedded one only in a session of one machine."""
    url, driver = spark.conf.get("spark.tidewater.jdbc.url", None), None
    if not url:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.tidewater.jdbc.url must name a store that all executors reach")
        url, driver = "jdbc:derby:memory:bank;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    tables.jdbc_catalog(spark, "bank", url, driver)
    return "bank"


def in_store(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table loaded into the store, replaced as a whole, and read from there."""
    return tables.create_or_replace(roles.table(spark, sf_dir, name).select(*columns), f"{store(spark)}.public_{uuid.uuid4().hex[:8]}.{name}", kind=None)


@R.add("select c_nationkey, count(*) as n, max(c_custkey) as newest, round(sum(c_acctbal), 2) as balance from customer where c_custkey > 100 and c_acctbal > 0 group by 1")
def federated_pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters and the aggregate are done by the store; Spark reads one row a nation."""
    held = in_store(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    totals = held.where("c_custkey > 100 and c_acctbal > 0").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.max("c_custkey").alias("newest"), F.sum("c_acctbal").alias("balance"))
    return totals.withColumn("balance", F.round("balance", 2))


@R.add("with o as (select o_custkey, count(*) as n, sum(o_totalprice::decimal(19,4))::double as spent from orders group by 1) select c_custkey, n, spent from customer join o on c_custkey = o_custkey where c_acctbal > 5000")
def federated_lake_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the store, filtered there, joined with what the lake knows of them."""
    rich = in_store(spark, sf_dir, "customer", "c_custkey", "c_acctbal").where("c_acctbal > 5000").select("c_custkey")
    spent = roles.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(19,4)")).cast("double").alias("spent"))
    return rich.join(spent, "c_custkey")


@R.add("select n_name as country_code, count(*) as n from customer join nation on c_nationkey = n_nationkey where c_custkey % 2 = 0 group by 1")
def catalog_table_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A namespace made when it is first needed, a table created in it and then replaced as a whole."""
    where, table = folder(spark, "catalog"), f"gold_{uuid.uuid4().hex[:8]}.customers"
    rows = roles.customers(spark, sf_dir)
    tables.create_or_replace(rows, table, location=where)
    return tables.create_or_replace(rows.where("customer_id % 2 = 0"), table).groupBy("country_code").agg(F.count("*").alias("n"))


@R.add(f"with {BRONZE} select 'daily_transaction_summary' as name, count(*) as n from (select distinct year, month, day, country_code, transaction_type from silver) union all select 'customer_lifetime_metrics', count(distinct customer_id) from silver union all select 'high_risk_transactions', count(*) from silver where risk_score > 60 union all select 'enriched_transactions', count(*) from silver")
def medallion_as_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain from bronze to gold as tables of a catalog, each read from its table by the next."""
    where, names = folder(spark, "medallion"), ["silver", "gold"]
    bronze = {"transactions": roles.bronze_transactions(spark, sf_dir), "accounts": roles.bronze_accounts(spark, sf_dir), "customers": roles.customers(spark, sf_dir)}
    run = uuid.uuid4().hex[:8]
    made = medallion.run_tables(bronze, {n: f"{n}_{run}" for n in names}, location=where)
    out = None
    for name, table in made.items():
        one = table.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@R.add(f"with {BRONZE} select t.account_id, o.o_orderpriority as account_type, 'active' as status, count(*) as n, sum(t.amount::decimal(19,4))::double as volume from t join orders o on o.o_orderkey = t.account_id group by all")
def bucketed_versions_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last version of each account joined with its transactions and summed, from tables bucketed by account: the plan has no exchange."""
    where, run = folder(spark, "buckets"), uuid.uuid4().hex[:8]
    owners, rows = roles.bronze_accounts(spark, sf_dir), roles.bronze_transactions(spark, sf_dir)
    buckets = bucketed.buckets(owners, rows)
    accounts = bucketed.save(owners, f"accounts_{run}", ["account_id"], buckets, f"{where}/accounts")
    moves = bucketed.save(rows, f"transactions_{run}", ["account_id"], buckets, f"{where}/transactions")
    current = cdc.latest(accounts, ["account_id"], "updated_at").select("account_id", "account_type", "status")
    joined = moves.select("account_id", "amount").join(current.hint("merge"), "account_id")
    return joined.groupBy("account_id", "account_type", "status").agg(F.count("*").alias("n"), F.sum(F.col("amount").cast("decimal(19,4)")).cast("double").alias("volume"))


CHECKED = [quality.Rule("not_null", "account_id"), quality.Rule("accepted_values", "status", values=("completed", "failed")), quality.Rule("unique", "transaction_id")]


def _with_faults(rows: DataFrame) -> DataFrame:
    """The third quarter lacks accounts of failed rows."""
    return rows.withColumn("account_id", F.when(~((F.col("transaction_id") % 4 == 3) & (F.col("status") == "failed")), F.col("account_id")))


@R.add("""with e as (select event_id % 4 as part, event_type, case when event_id % 4 = 3 and event_type = 'error' then null else user_id end as account_id from events),
    b as (select part, count(*) filter (where account_id is null) as bad, count(*) as n from e group by 1)
    select part, bad as no_account, 0::bigint as twice, bad = 0 as published, case when bad = 0 then n else 0 end as n from b""")
def checked_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches, counted against the rules as they are written; one that breaks a rule is not published."""
    where, rows = folder(spark, "checked"), _with_faults(roles.transactions(spark, sf_dir))
    found = None
    for part in range(4):
        results = quality.write_checked(rows.where(F.col("transaction_id") % 4 == part), "transactions", CHECKED, f"{where}/rows", f"part={part}").withColumn("part", F.lit(part).cast("long"))
        found = results if found is None else found.unionByName(results)
    told = found.groupBy("part").agg(F.sum(F.when(F.col("case_name").endswith("not_null"), F.col("violations"))).alias("no_account"), F.sum(F.when(F.col("case_name").endswith("unique"), F.col("violations"))).alias("twice"), F.first("published").alias("published"))
    held = spark.read.parquet(f"{where}/rows").groupBy(F.col("part").cast("long").alias("part")).agg(F.count("*").alias("n"))
    return told.join(held, "part", "left").select("part", "no_account", "twice", "published", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@R.add("select count(*) as n, count(*) filter (where event_id % 4 <> 3) as n_other from events where event_id % 4 <> 3 or event_type <> 'error'")
def stream_checked_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same while a stream writes: a run whose batch is bad publishes nothing, the next one does."""
    where, rows = folder(spark, "checked-stream"), roles.transactions(spark, sf_dir)
    write = sinks.checked(f"{where}/rows", f"{where}/results", "transactions", CHECKED)
    good = rows.where("transaction_id % 4 <> 3 or status <> 'failed'")
    for part in (_with_faults(rows).where("account_id is null"), good):
        part.write.mode("append").parquet(f"{where}/in")
        sinks.each_batch(file_stream(spark, f"{where}/in", rows.schema), write, f"{where}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{where}/rows").agg(F.count("*").alias("n"), F.count_if(F.col("transaction_id") % 4 != 3).alias("n_other"))


@R.add("""with m as (select case when event_id % 50 = 0 then '{"k":' when event_id % 4 = 0 then props when event_id % 4 = 1 then '{"k": "' || event_id || '"}' when event_id % 4 = 2 then '{"k": ' || event_id || '.5, "extra": true}' else '{"k": {"n": ' || event_id || '}, "extra": [1, 2]}' end as value, event_id from events),
    f as (select 'k' as key, case event_id % 4 when 0 then 'BIGINT' when 1 then 'STRING' when 2 then 'DECIMAL' else 'OBJECT' end as type, case event_id % 4 when 0 then (props::json->>'k')::double when 1 then event_id when 2 then event_id + 0.5 end as number, case when event_id % 4 = 3 then event_id end as nested from events where event_id % 50 <> 0
        union all select 'extra', case event_id % 4 when 2 then 'BOOLEAN' else 'ARRAY' end, null, null from events where event_id % 50 <> 0 and event_id % 4 >= 2
        union all select null, 'broken', null, null from events where event_id % 50 = 0)
    select key, type, count(*) as n, sum(case when key = 'k' then number end) as numbers, coalesce(sum(nested), 0)::bigint as nested from f join (select 1) on true group by all""")
def schemaless_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose fields change type from one to the next: which fields they have, of which types, and what reads as a number."""
    n = F.col("event_id")
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    value = F.when(n % 50 == 0, '{"k":').when(n % 4 == 0, F.col("props")).when(n % 4 == 1, text('{"k": "', n.cast("string"), '"}')).when(n % 4 == 2, text('{"k": ', n.cast("string"), '.5, "extra": true}')).otherwise(text('{"k": {"n": ', n.cast("string"), '}, "extra": [1, 2]}'))
    rows = variant.typed(variant.schemaless(roles.table(spark, sf_dir, "events").select(value.alias("value"))), {"number": ("$.k", "double"), "nested": ("$.k.n", "long")})
    found = variant.fields(rows)
    kind = F.when(F.col("_corrupt").isNotNull(), "broken").otherwise(F.regexp_extract("type", "^[A-Z]+", 0))
    mine = lambda c: F.when(F.col("key") == "k", F.col(c))
    return found.groupBy("key", kind.alias("type")).agg(F.count("*").alias("n"), F.sum(mine("number")).alias("numbers"), F.coalesce(F.sum(mine("nested")), F.lit(0)).alias("nested"))


NOW = "2024-01-25 12:00:00"


@R.add(f"select strftime(ts, '%Y%m%d')::int as day, count(*) as n, count(*) filter (where ts > timestamp '{NOW}' - interval 10 day) as young from events where strftime(ts, '%Y%m%d') >= strftime(timestamp '{NOW}' - interval 10 day, '%Y%m%d') group by 1")
def serving_expired_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A served table after its expired days were removed; of the day that the bound cuts, a read leaves out the old rows."""
    where, now = folder(spark, "expired"), F.lit(NOW).cast("timestamp")
    serving.append_served(roles.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id"), where, "ts", now)
    serving.drop_expired(spark, where, 10, NOW)
    held = spark.read.parquet(where)
    young = serving.within_retention(held, "ts", 10, now).groupBy("__day").agg(F.count("*").alias("young"))
    return held.groupBy("__day").agg(F.count("*").alias("n")).join(young, "__day", "left").select(F.col("__day").alias("day"), "n", F.coalesce("young", F.lit(0)).cast("long").alias("young"))


@R.add("select c_nationkey, count(*) as n, max(c_custkey) as newest from customer group by 1")
def store_read_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the store read by ranges of its key, each range a task of its own."""
    catalog, space = store(spark), f"ranges_{uuid.uuid4().hex[:8]}"
    tables.create_or_replace(roles.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), f"{catalog}.{space}.customer", kind=None)
    url, driver = (spark.conf.get(f"spark.sql.catalog.{catalog}.{k}", None) for k in ("url", "driver"))
    last = roles.table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0] or 0
    rows = tables.jdbc_table(spark, url, f'"{space}"."customer"', split="c_custkey", bounds=(0, last + 1), parts=4, **({"driver": driver} if driver else {}))
    return rows.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.max("c_custkey").alias("newest"))


@R.add("""select event_id % 5 = 0 as broken, count(*) as n, count(case when event_id % 5 <> 0 then user_id end) as users, sum(case when event_id % 5 <> 0 then user_id else 0 end)::bigint as total from events group by 1""")
def broken_messages_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a declared schema; those that do not parse keep their text instead of ending the job or going unseen."""
    text = F.to_json(F.struct("event_id", "user_id"))
    messages = roles.table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 5 == 0, F.expr("substr(to_json(struct(event_id, user_id)), 1, 12)")).otherwise(text).alias("value"))
    rows = app_json(messages, T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())]))
    kept = F.when(F.col("_corrupt").isNull(), F.col("user_id"))
    return rows.groupBy(F.col("_corrupt").isNotNull().alias("broken")).agg(F.count("*").alias("n"), F.count(kept).alias("users"), F.coalesce(F.sum(kept), F.lit(0)).alias("total"))


@R.add("select 'nulls skipped' as kind, count(*) as n from events where event_id % 3 = 0 union all select 'both', 2 * count(*) from events where event_id % 3 <> 0")
def stream_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read of a stream feeds an append-only log, which skips null values, and a table of all rows."""
    where, rows = folder(spark, "sinks"), stream_of(spark, sf_dir, "events")
    values = sinks.json_values(rows.select("event_id", "user_id"), "event_id").withColumn("value", F.when(F.col("key").cast("long") % 3 != 0, F.col("value")))
    both = sinks.fan_out([sinks.append_values(f"{where}/log"), sinks.append_batches(f"{where}/all")])
    sinks.each_batch(values, both, f"{where}/checkpoint", once=True).awaitTermination()
    held = spark.read.parquet(f"{where}/log").select("key").unionAll(spark.read.parquet(f"{where}/all").select("key"))
    kind = F.when(F.col("key").cast("long") % 3 == 0, "nulls skipped").otherwise("both")
    return held.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@R.add(f"with {TX}, v as (select account_id, count(*) as tx_count, epoch_ms(date_trunc('hour', event_time)) as window_start_ms from tx group by account_id, date_trunc('hour', event_time) having count(*) > 1) select account_id, tx_count, window_start_ms from v where window_start_ms + 3600000 <= (select max(ts_ms) - 5000 from tx)")
def stream_alert_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a stream as JSON messages in an append-only log, read back by a consumer."""
    where = folder(spark, "alerts")
    found = fraud_streams.velocity(roles.as_transactions(stream_of(spark, sf_dir, "events")).withWatermark("event_time", "5 seconds"), "1 HOUR", 1)
    sinks.each_batch(fraud.alert_json(found), sinks.append_values(f"{where}/log"), f"{where}/checkpoint", once=True).awaitTermination()
    read = variant.typed(variant.schemaless(spark.read.parquet(f"{where}/log")), {c: (f"$.{c}", "long") for c in ("account_id", "tx_count", "window_start_ms")})
    return read.select("account_id", "tx_count", "window_start_ms")


@R.add("select o_orderstatus as status, year(o_orderdate)::int as year, count(*) as n from orders where o_orderkey % 2 = 0 group by all")
def partitions_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table written twice: the second write leaves nothing of the first."""
    where, rows = folder(spark, "refreshed"), roles.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"))
    for part in (rows, rows.where("o_orderkey % 2 = 0")):
        medallion.write_table(part, f"{where}/rows", partition_by=["status", "year"])
    return spark.read.parquet(f"{where}/rows").groupBy("status", "year").agg(F.count("*").alias("n"))


@R.add("select * from nation")
def table_passed_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of one table as another table of the catalog."""
    where = folder(spark, "through")
    return tables.create_or_replace(roles.table(spark, sf_dir, "nation"), f"through_{uuid.uuid4().hex[:8]}.nation", location=where)


@R.add("select 'kept' as rules, 'passed' as outcome, 2::bigint as n from (select 1) union all select 'broken', 'violated', count(*) from customer where c_custkey * 7 % 101 > 50 having count(*) > 0 union all select 'unreachable', 'aborted', 0")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over kept rules, over a broken one, and over a source that cannot be read, which is no pass."""
    rows, told = roles.customers(spark, sf_dir), []
    missing = roles.table(spark, sf_dir, "customer").select(F.raise_error(F.lit("unreachable")).cast("long").alias("customer_id"))
    checks = {"kept": (rows, [quality.Rule("not_null", "customer_id"), quality.Rule("unique", "customer_id")]), "broken": (rows, [quality.Rule("range", "risk_score", 0, 50)]), "unreachable": (missing, [quality.Rule("range", "customer_id", 0)])}
    for name, (source, rules) in checks.items():
        try:
            told.append((name, "passed", quality.gate(quality.check_table(source, "customers", rules))))
        except quality.Violated as bad:
            told.append((name, "violated", int(str(bad).rsplit(": ", 1)[1])))
        except quality.Aborted:
            told.append((name, "aborted", 0))
    return spark.createDataFrame(told, "rules string, outcome string, n long")


@R.add("select count(*) as n, count(*) as stamped, 1::bigint as versions from events")
def served_rows_are_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows get the time at which their batch was written as their version."""
    where, began = folder(spark, "stamped"), F.lit(datetime.now())
    serving.append_served(roles.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id"), where, "ts")
    return spark.read.parquet(where).agg(F.count("*").alias("n"), F.count_if(F.col("inserted_at").between(began - F.expr("interval 1 day"), F.current_timestamp() + F.expr("interval 1 day"))).alias("stamped"), F.count_distinct("inserted_at").alias("versions"))


@R.add(f"with k as ({queries_batch.ORACLES['metric_kpi']}) select * from k order by window_end desc limit 1")
def newest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of the day as of the newest window; a sort that keeps one row a task."""
    return doubles(dashboards.newest(metrics.metric(roles.transactions(spark, sf_dir), metrics.KPI), "window_end", 1))
