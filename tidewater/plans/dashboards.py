"""Read-side queries: banking dashboard, reconciliation, searches, leaderboards, governance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.functions.scalars import tag_under


def headline(transactions: DataFrame) -> DataFrame:
    """Count, total, average and success percentage, in one pass."""
    done = F.count_if(F.col("status") == "completed")
    return transactions.agg(F.count("*").alias("n_transactions"), F.sum("amount").alias("total_amount"), F.avg("amount").alias("average_amount"), F.round(F.lit(100.0) * done / F.count("*"), 1).alias("success_percent"))


def by_time(df: DataFrame, time: str, grain: str, measures: dict[str, Column], *series: str) -> DataFrame:
    """Measures per time bucket (day, hour, ...), split by series."""
    return df.groupBy(F.date_trunc(grain, time).alias("bucket"), *series).agg(*[v.alias(k) for k, v in measures.items()])


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def stacked(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """Counts of one column's declared values side by side, per value of the other."""
    return df.groupBy(rows).agg(*[F.count_if(F.col(columns) == v).alias(f"n_{v.lower()}") for v in values])


def enriched(transactions: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Live enrichment of a store that holds current rows only; no dedup."""
    return transactions.join(accounts, "account_id").join(customers, "customer_id")


def risky_customers(customers: DataFrame, lake: DataFrame, least: int = 80, top: int = 20) -> DataFrame:
    """The risky customers with most activity in the lake; the lake is summed by customer before it is joined."""
    risky = customers.where(F.col("risk_score") >= least).select("customer_id", "full_name", "risk_score")
    counts = lake.groupBy("customer_id").agg(F.count("transaction_id").alias("n_transactions"))
    return risky.join(counts, "customer_id").orderBy(F.desc("n_transactions"), "customer_id").limit(top)


def side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row results in one row."""
    return left.crossJoin(right)


def in_last_window(df: DataFrame, time: str = "window_end") -> DataFrame:
    """Rows of the newest window; the newest time is one broadcast row."""
    last = df.agg(F.max(time).alias("__last"))
    return df.join(F.broadcast(last), F.col(time) == F.col("__last")).drop("__last")


def newest(df: DataFrame, time: str, n: int, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(time), *ties).limit(n)


def between(df: DataFrame, time: str, low: str, high: str) -> DataFrame:
    return df.where(F.col(time).between(F.lit(low).cast("timestamp"), F.lit(high).cast("timestamp")))


def with_lookup(df: DataFrame, lookup: DataFrame, key: str, defaults: dict) -> DataFrame:
    """Left lookup; what is not found gets the defaults."""
    return df.join(lookup, key, "left").fillna(defaults)


def catalog_tables(tables: DataFrame, cases: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per table, as of ``now``, from nested records (fqn, name, domain, owners, tags, description, columns of name and tags), with its number of test cases."""
    n_tests = cases.groupBy(F.regexp_replace("case_fqn", r"\.[^.]*\.[^.]*$", "").alias("fqn")).agg(F.count("*").alias("n_tests"))
    flat = tables.select(
        "fqn",
        F.when(F.size(F.split("fqn", r"\.")) >= 4, F.get(F.split("fqn", r"\."), F.lit(2))).otherwise("").alias("schema_name"),
        F.col("name").alias("table_name"),
        F.coalesce("domain", F.lit("")).alias("domain"),
        tag_under(F.col("tags"), "Tier").alias("tier"),
        tag_under(F.col("tags"), "Sensitivity").alias("sensitivity"),
        F.coalesce(F.get("owners", F.lit(0)), F.lit("")).alias("owner"),
        F.when(F.trim(F.coalesce("description", F.lit(""))) != "", 1).otherwise(0).alias("has_description"),
        F.size("columns").alias("n_columns"),
        F.size(F.filter("columns", lambda c: tag_under(c["tags"], "PII") != "")).alias("n_pii"),
    )
    return with_lookup(flat, n_tests, "fqn", {"n_tests": 0}).withColumn("snapshot_ts", F.current_timestamp() if now is None else now)


def test_results(results: DataFrame, tables: DataFrame) -> DataFrame:
    """Flat results (case_fqn, case_name, definition, ts_ms, status, message) with the parts of the case's name and the domain of its table."""
    part = lambda n: F.get(F.split("case_fqn", r"\."), F.lit(n))
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    column = F.when(F.size(F.split("case_fqn", r"\.")) > 5, part(4)).otherwise("").alias("column_name")
    flat = results.select("case_fqn", "case_name", text("definition"), F.timestamp_millis("ts_ms").alias("ts"), "status", text("message"), column, part(2).alias("schema_name"), part(3).alias("table_name"), F.concat_ws(".", F.slice(F.split("case_fqn", r"\."), 1, 4)).alias("fqn"))
    return with_lookup(flat, tables.select("fqn", "domain"), "fqn", {"domain": ""})


def pii_reach(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Per dataset with personal data: its direct destinations."""
    return edges.join(nodes.where("n_pii > 0").select(F.col("node").alias("source")), "source").groupBy("source").agg(F.sort_array(F.collect_set("target")).alias("targets"))


def governance_headline(results: DataFrame, catalog: DataFrame) -> DataFrame:
    r = results.agg(F.countDistinct("case_fqn").alias("n_cases"), F.round(F.count_if(F.col("status") == "Success") * 100.0 / F.count("*"), 1).alias("pass_percent"))
    return side_by_side(r, catalog.agg(F.round(F.avg("has_description") * 100.0, 1).alias("described_percent")))


def governance_table(catalog: DataFrame, most: int = 50) -> DataFrame:
    rows = catalog.where("domain <> ''").groupBy("schema_name", "table_name", "tier", "owner").agg(F.sum("n_pii").alias("n_pii"), F.sum("n_tests").alias("n_tests"))
    return rows.orderBy("schema_name", "table_name", "tier", "owner").limit(most)
