"""Bronze to silver to gold."""

from __future__ import annotations

from pyspark.sql import Column as C, DataFrame, SparkSession, functions as F

from tidewater.functions.scalars import MONEY
from tidewater.operators.cdc import latest
from tidewater.schema import Column, conform
from tidewater.sources.tables import create_or_replace

SILVER = [
    Column("transaction_id", "long"), Column("transaction_type", "string"), Column("amount", "string"), Column("currency", "string"), Column("status", "string"), Column("posted_at", "timestamp"),
    Column("account_id", "long"), Column("account_type", "string"), Column("account_number", "string", pii=True), Column("customer_id", "long"), Column("customer_name", "string", pii=True), Column("country_code", "string"),
    Column("kyc_status", "string"), Column("risk_score", "int"), Column("year", "int"), Column("month", "int"), Column("day", "int"),
]


def without_deleted(df: DataFrame) -> DataFrame:
    return df.where("coalesce(__deleted, 'false') <> 'true'") if "__deleted" in df.columns else df


def silver_enriched(transactions: DataFrame, accounts: DataFrame, customers: DataFrame, drop_deleted: bool = False) -> DataFrame:
    """Transactions with their current account and customer; those without are dropped, see ``orphans``. Deleted rows still join unless asked otherwise.

    No side is broadcast by hand: the optimizer does so where a side is measured small.
    """
    # only the columns that silver reads go through the shuffle
    only = lambda df, *names: df.select(*names, *(c for c in ("updated_at", "__deleted") if c in df.columns))
    current_accounts = latest(only(accounts, "account_id", "account_type", "account_number", "customer_id", "status"), ["account_id"], "updated_at", ["status"])
    current_customers = latest(only(customers, "customer_id", "full_name", "country_code", "kyc_status", "risk_score"), ["customer_id"], "updated_at", ["kyc_status"])
    if drop_deleted:
        current_accounts, current_customers = without_deleted(current_accounts), without_deleted(current_customers)
    a = current_accounts.select("account_id", "account_type", "account_number", "customer_id")
    c = current_customers.select("customer_id", F.col("full_name").alias("customer_name"), "country_code", "kyc_status", "risk_score")
    posted = F.col("posted_at").cast("timestamp")
    rows = transactions.select("transaction_id", "account_id", "transaction_type", F.col("amount").cast("string").alias("amount"), "currency", "status", posted.alias("posted_at"))
    out = rows.join(a, "account_id").join(c, "customer_id").withColumns({"year": F.year("posted_at"), "month": F.month("posted_at"), "day": F.dayofmonth("posted_at")})
    return conform(out.select(*[x.name for x in SILVER]), SILVER)


def orphans(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transactions that silver drops for want of an account."""
    return transactions.join(accounts.select("account_id").distinct(), "account_id", "left_anti")


def money_totals() -> tuple[C, C]:
    """Sum and mean of the amounts as doubles, summed as decimals so that the order of rows does not show."""
    total = F.sum(F.col("amount").cast(MONEY)).cast("double")
    return total, total / F.nullif(F.count("amount"), F.lit(0))


def daily_summary(silver: DataFrame) -> DataFrame:
    total, mean = money_totals()
    return silver.groupBy("year", "month", "day", "country_code", "transaction_type").agg(
        F.count("transaction_id").alias("txn_count"), total.alias("total_volume"), mean.alias("avg_amount"), F.countDistinct("customer_id").alias("unique_customers"), F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).alias("failed_count")
    )


def lifetime_metrics(silver: DataFrame) -> DataFrame:
    total, mean = money_totals()
    return silver.groupBy("customer_id", "customer_name", "country_code", "kyc_status", "risk_score").agg(
        F.count("transaction_id").alias("total_txn_count"), total.alias("lifetime_value"), mean.alias("avg_txn_amount"), F.max("posted_at").alias("last_activity"), F.min("posted_at").alias("first_activity"), F.countDistinct("account_id").alias("account_count")
    )


def high_risk(silver: DataFrame, above: int = 60) -> DataFrame:
    columns = ["transaction_id", "posted_at", "amount", "currency", "transaction_type", "status", "customer_id", "customer_name", "country_code", "risk_score", "account_id", "account_type", "year", "month", "day"]
    return silver.where(F.col("risk_score") > above).select(*columns)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet; rows of a partition folder are brought together first, so it gets few files."""
    if partition_by:
        # split where a folder has many rows, merged where it has few
        df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def run_all(spark: SparkSession, bronze: str, lake: str) -> None:
    """The chain in order; an error stops it."""
    read = lambda name: spark.read.parquet(f"{bronze}/{name}")
    days = ["year", "month", "day"]
    write_table(silver_enriched(read("transactions"), read("accounts"), read("customers")), f"{lake}/silver/enriched_transactions", partition_by=days)
    silver = spark.read.parquet(f"{lake}/silver/enriched_transactions")
    write_table(daily_summary(silver), f"{lake}/gold/daily_transaction_summary", partition_by=days)
    write_table(lifetime_metrics(silver), f"{lake}/gold/customer_lifetime_metrics")
    write_table(high_risk(silver), f"{lake}/gold/high_risk_transactions", partition_by=days)


def run_tables(bronze: dict[str, DataFrame], namespaces: dict[str, str], kind: str = "parquet", location: str | None = None) -> dict[str, DataFrame]:
    """The chain as tables of a catalog, created or replaced, with the table format as a parameter: ``namespaces`` says where silver and gold are. Each step reads the table before it."""
    put = lambda df, layer, name: create_or_replace(df, f"{namespaces[layer]}.{name}", kind, f"{location}/{layer}" if location else None)
    silver = put(silver_enriched(bronze["transactions"], bronze["accounts"], bronze["customers"]), "silver", "enriched_transactions")
    gold = {"daily_transaction_summary": daily_summary, "customer_lifetime_metrics": lifetime_metrics, "high_risk_transactions": high_risk}
    return {"enriched_transactions": silver} | {name: put(make(silver), "gold", name) for name, make in gold.items()}
