"""The engine's inputs made from the tables at hand: which table plays transactions, accounts, customers, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater.functions.scalars import MONEY, cycled


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transaction_columns() -> list[Column]:
    return [
        F.col("event_id").alias("transaction_id"), F.col("user_id").alias("account_id"), F.col("event_type").alias("transaction_type"), F.col("value").cast(MONEY).cast("string").alias("amount"),
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), F.when(F.col("event_id") % 10 == 0, "r").otherwise("c").alias("op"),
    ]


def as_transactions(events: DataFrame) -> DataFrame:
    return events.select(*transaction_columns()).withColumn("event_time", F.timestamp_millis("ts_ms"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat change records of the transactions table, from events; every tenth is a snapshot row."""
    return as_transactions(table(spark, sf_dir, "events"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of accounts: each order is an insert of its customer's account, every third later an update, every ninth a delete."""
    row = F.struct(F.col("o_custkey").alias("account_id"), F.col("o_orderpriority").alias("account_type"), F.col("o_totalprice").cast("decimal(19,4)").cast("string").alias("balance"))
    op = F.when(F.col("o_orderkey") % 9 == 0, "d").when(F.col("o_orderkey") % 3 == 0, "u").otherwise("c")
    at = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(op.alias("op"), at.alias("ts_ms"), row.alias("row"))
    none = F.lit(None).cast(rows.schema["row"].dataType)
    return rows.select("op", "ts_ms", F.when(F.col("op") == "c", none).otherwise(F.col("row")).alias("before"), F.when(F.col("op") == "d", none).otherwise(F.col("row")).alias("after"))


def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From lineitem; the account is the order."""
    status = F.when(F.col("l_linestatus") == "F", "failed").otherwise("completed")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"), F.col("l_orderkey").alias("account_id"), F.col("l_returnflag").alias("transaction_type"), F.col("l_extendedprice").cast(MONEY).cast("string").alias("amount"),
        F.lit("USD").alias("currency"), status.alias("status"), F.col("l_shipdate").alias("posted_at"),
    )


def bronze_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From orders; every third has an older version of another type. ``updated_at`` is ISO text, with and without a fraction."""
    orders = table(spark, sf_dir, "orders")
    at = F.col("o_orderdate").cast("timestamp")
    text = lambda t, p: F.date_format(t, p)
    now = orders.select(F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("account_type"), F.concat(F.lit("AC"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("account_number"), F.lit("active").alias("status"), text(at + F.expr("interval 1500 milliseconds"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("updated_at"))
    old = orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias("customer_id"), F.lit("OLD").alias("account_type"), F.lit("AC").alias("account_number"), F.lit("frozen").alias("status"), text(at + F.expr("interval 1 second"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"))
    return now.unionByName(old)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country_code"))
    rows = table(spark, sf_dir, "customer").join(nation, "c_nationkey")
    return rows.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"), "country_code", F.col("c_mktsegment").alias("kyc_status"), (F.col("c_custkey") * 7 % 101).cast("int").alias("risk_score"), F.lit("2024-01-01T00:00:00Z").alias("updated_at"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current accounts, one per order."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("account_type"), F.col("o_orderstatus").alias("account_status"), F.col("o_totalprice").alias("balance"))


ERRORS = ["java.net.ConnectException", "org.apache.kafka.connect.errors.DataException", "java.lang.IllegalStateException"]


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error records from the error events; every fourth comes without headers."""
    h = lambda k, v: F.struct(F.lit("__connect.errors." + k).alias("key"), v.cast("binary").alias("value"))
    n = F.col("event_id")
    headers = F.array(h("connector.name", F.lit("sink-a")), h("topic", F.lit("bank.transactions")), h("partition", (n % 3).cast("string")), h("offset", F.when(n % 5 == 0, "x").otherwise(n.cast("string"))), h("stage", F.lit("VALUE_CONVERTER")), h("exception.class.name", cycled(ERRORS, n)), h("exception.message", F.repeat(F.lit("bad value "), (n % 300).cast("int"))))
    return table(spark, sf_dir, "events").where("event_type = 'error'").select(
        F.lit("dlq.sink-a").alias("topic"), F.lit(0).alias("partition"), n.alias("offset"), F.col("user_id").cast("string").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"), F.when(n % 4 != 0, headers).alias("headers")
    )
