"""Catalogs, buckets, checked publishing, messages without a schema, retention: rows and plans."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidewater.operators import bucketed, cdc, quality, serving
from tidewater.plans import medallion, queries_batch, queries_tables, roles, scratch
from tidewater.plans.queries_tables import in_store, store
from tidewater.sources import streams, tables, variant
from tidewater.streaming import sinks

SF = "/root/testdata/sf0.001"


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_store_does_the_aggregate(spark):
    held = in_store(spark, SF, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    totals = held.where("c_custkey > 10").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.max("c_acctbal").alias("most"))
    text = plan(totals)
    assert "PushedAggregates: [COUNT(*), MAX(c_acctbal)]" in text.replace("C_ACCTBAL", "c_acctbal") and "PushedGroupByExpressions: [c_nationkey]" in text and "c_custkey > 10" in text
    assert "HashAggregate" not in text
    want = roles.table(spark, SF, "customer").where("c_custkey > 10").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.max("c_acctbal").alias("most"))
    assert sorted(totals.collect()) == sorted(want.collect())


def test_create_or_replace(spark, tmp_path):
    for table, kind, where in (("lake_t.gold", "parquet", str(tmp_path / "lake")), ("lake_t.gold", "orc", None), (f"{store(spark)}.replaced.gold", None, None)):
        for rows in (spark.range(5), spark.range(2).withColumn("v", F.col("id") * 2)):
            got = tables.create_or_replace(rows, table, kind, where)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect())) and got.columns == rows.columns
    assert spark.catalog.databaseExists("lake_t") and (tmp_path / "lake").exists()
    assert tables.iceberg_table(spark, "lake_t.gold").count() == tables.iceberg_table(spark, "lake_t", metadata="gold").count() == 2
    with pytest.raises(AnalysisException):  # time travel is the format's
        tables.iceberg_table(spark, "lake_t.gold", version=1).collect()
    spark.sql("DROP DATABASE lake_t CASCADE")


def test_buckets_need_no_exchange(spark, tmp_path):
    accounts = bucketed.save(roles.bronze_accounts(spark, SF), "t_accounts", ["account_id"], 4, str(tmp_path / "a"))
    moves = bucketed.save(roles.bronze_transactions(spark, SF), "t_moves", ["account_id"], 4, str(tmp_path / "m"))
    current = cdc.latest(accounts, ["account_id"], "updated_at")
    joined = moves.select("account_id", "amount").join(current.select("account_id", "account_type").hint("merge"), "account_id").groupBy("account_id").agg(F.count("*").alias("n"), F.first("account_type").alias("kind"))
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    want = roles.bronze_transactions(spark, SF).join(cdc.latest(roles.bronze_accounts(spark, SF), ["account_id"], "updated_at"), "account_id").groupBy("account_id").agg(F.count("*").alias("n"), F.first("account_type").alias("kind"))
    assert sorted(joined.collect()) == sorted(want.collect())
    versions = serving.last_version(accounts, ["account_id"], "updated_at")
    assert "Exchange" not in plan(versions) and versions.count() == accounts.select("account_id").distinct().count()
    for t in ("t_accounts", "t_moves"):
        spark.sql(f"DROP TABLE {t}")


RULES = [quality.Rule("not_null", "k"), quality.Rule("range", "v", 0, 9), quality.Rule("accepted_values", "s", values=("a", "b")), quality.Rule("unique", "k")]
ROW = "k long, v long, s string"


def test_a_bad_batch_is_not_published(spark, tmp_path):
    path, reads = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    def write(rows, folder):
        return {r.case_name: (r.violations, r.published) for r in quality.write_checked(spark.createDataFrame(rows, ROW).mapInPandas(counted, ROW), "t", RULES, path, folder).collect()}

    good = [(1, 0, "a"), (2, 9, "b"), (3, None, None)]
    assert write(good, "batch=0") == {f"t_{c}": (0, True) for c in ("k_not_null", "v_range", "s_accepted_values", "k_unique")} and reads.value == 3
    bad = write([(None, -1, "a"), (7, 10, "z"), (7, 1, "a")], "batch=1")
    assert bad == {"t_k_not_null": (1, False), "t_v_range": (2, False), "t_s_accepted_values": (1, False), "t_k_unique": (1, False)}
    assert {r.k for r in spark.read.parquet(path).collect()} == {1, 2, 3} and sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")) == ["batch=0"]
    write(good[:1], "batch=0")  # a batch that comes again replaces its own rows
    assert spark.read.parquet(path).count() == 1
    assert write([], "batch=2")["t_k_not_null"] == (0, True) and spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        quality.write_checked(spark.range(1), "t", [quality.Rule("odd", "id")], path, "batch=3")


def test_a_stream_goes_on_after_a_bad_batch(spark, tmp_path):
    data, out, found = (str(tmp_path / n) for n in ("in", "out", "found"))
    for k, rows in enumerate(([(1, 1, "a")], [(2, 99, "a")], [(3, 3, "b")])):
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(data)
        sinks.each_batch(streams.file_stream(spark, data, spark.createDataFrame([], ROW).schema), sinks.checked(out, found, "t", RULES), str(tmp_path / "at"), once=True).awaitTermination()
    assert sorted((r.k, r.batch) for r in spark.read.parquet(out).collect()) == [(1, 0), (3, 2)]
    told = spark.read.parquet(found)
    assert told.count() == 12 and [(r.case_name, r.violations, r.batch) for r in told.where("violations > 0").collect()] == [("t_v_range", 1, 1)] and told.where("not published").count() == 4


def test_messages_without_a_schema(spark):
    texts = ['{"k": 1, "n": {"a": [1, 2]}}', '{"k": "1"}', '{"k": 1.5, "more": null}', '{"k":', "[1]", "7", None, '{"k": true, "value": "x"}', ""]
    rows = variant.schemaless(spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "id int, value string, type string"))
    assert {r.id for r in rows.where("_corrupt is not null").collect()} == {3, 8}
    found = {(r.id, r.key, r.type) for r in variant.fields(rows).select("id", "key", "type").collect()}
    assert found == {(0, "k", "BIGINT"), (0, "n", "OBJECT<a: ARRAY<BIGINT>>"), (1, "k", "STRING"), (2, "k", "DECIMAL(2,1)"), (2, "more", "VOID"), (3, None, None), (4, None, "BIGINT"), (5, None, None), (6, None, None), (7, "k", "BOOLEAN"), (7, "value", "STRING"), (8, None, None)}
    read = variant.typed(rows, {"k": ("$.k", "double"), "second": ("$.n.a[1]", "int"), "missing": ("$.none", "date")})
    assert {r.id: (r.k, r.second, r.missing) for r in read.collect()} == {i: (k, 2 if i == 0 else None, None) for i, k in enumerate([1.0, 1.0, 1.5, None, None, None, None, 1.0, None])}
    assert variant.fields(rows.limit(0)).count() == 0


def test_retention_reaches_the_scan_and_days_are_dropped(spark, tmp_path):
    path, now = str(tmp_path / "t"), F.lit("2024-03-10 12:00:00").cast("timestamp")
    rows = spark.range(20).select(F.timestamp_seconds(F.lit(1_709_251_200) + F.col("id") * 43_200).alias("ts"), "id")  # half days from 2024-03-01 on
    serving.append_served(rows, path, "ts", now)
    held = serving.within_retention(spark.read.parquet(path), "ts", 5, now)
    text = plan(held)
    assert "GreaterThan(ts," in text and "PartitionFilters: [isnotnull(__day" in text and ">= 20240305" in text
    assert held.count() == rows.where("ts > timestamp'2024-03-05 12:00:00'").count() == 10
    assert serving.drop_expired(spark, path, 5, "2024-03-10 12:00:00") == [f"__day=2024030{d}" for d in range(1, 5)]
    assert spark.read.parquet(path).count() == 12 and serving.drop_expired(spark, path, 5, "2024-03-10 12:00:00") == []
    assert serving.within_retention(rows, "ts", 10_000).count() == 20


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    """The query's tables get as many buckets as keep one at a bounded number of rows."""
    assert bucketed.buckets(spark.range(100), spark.range(1001), rows=100) == 11 and bucketed.buckets(spark.range(0)) == 8
    made, save = [], bucketed.save
    monkeypatch.setattr(bucketed.buckets, "__kwdefaults__", {"rows": 500, "least": 8})
    monkeypatch.setattr(bucketed, "save", lambda df, table, keys, n, path: made.append((n, df.count())) or save(df, table, keys, n, path))
    got = queries_tables.bucketed_versions_joined(spark, SF)
    assert len({n for n, _ in made}) == 1 and max(rows for _, rows in made) <= 500 * made[0][0] and made[0][0] > 8
    assert got.agg(F.sum("n")).first()[0] == roles.bronze_transactions(spark, SF).count() and "Exchange" not in plan(got)


def test_gold_is_made_in_partitions_by_size(spark, monkeypatch):
    """Partitions grow with the transactions while gold is made, the session has its own again afterwards, and the rows are those of the plan without."""
    seen, write, session = [], medallion.write_table, spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(scratch.small_partitions.__wrapped__, "__defaults__", (700, "16m"))
    monkeypatch.setattr(medallion, "write_table", lambda df, path: seen.append(int(spark.conf.get("spark.sql.shuffle.partitions"))) or write(df, path))
    for query, make in ((queries_batch.gold_daily_transaction_summary, medallion.daily_summary), (queries_batch.gold_customer_lifetime_metrics, medallion.lifetime_metrics)):
        got, want = query(spark, SF), make(queries_batch._silver(spark, SF))
        assert got.dtypes == want.dtypes and got.count() == want.count() and got.exceptAll(want).count() == 0
    assert seen == [-(-roles.table(spark, SF, "lineitem").count() // 700)] * 2 and seen[0] > int(session) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_served_tables_get_few_files(spark, tmp_path):
    """Rows of a day stand together in one file, wherever they come from; a table without a time column has no folders at all."""
    rows = spark.range(0, 240, 1, 6).select(F.timestamp_seconds(F.lit(1_709_251_200) + (F.col("id") % 12) * 86_400).alias("ts"), "id")
    serving.append_served(rows, f"{tmp_path}/days", "ts")
    serving.append_served(rows, f"{tmp_path}/whole", None)
    days, whole = spark.read.parquet(f"{tmp_path}/days"), spark.read.parquet(f"{tmp_path}/whole")
    assert len(days.inputFiles()) == 12 and days.count() == 240 == days.select("id").distinct().count()
    assert len(whole.inputFiles()) == 6 and whole.columns == ["ts", "id", "inserted_at"] and whole.count() == 240


def test_topics_by_other_sources_and_sinks(spark, tmp_path):
    """The topic source and sink are Spark's own with a name and options; here other built-in ones stand in for the broker."""
    live = streams.topic_stream(spark, {"rowsPerSecond": "50"}, source="rate")
    assert live.isStreaming and live.columns == ["timestamp", "value"]
    query = sinks.to_topic(live, "h:1", "out", str(tmp_path / "at"), sink="noop", trigger="1 second")
    try:
        query.processAllAvailable()
        assert query.exception() is None
    finally:
        query.stop()


def test_avro_bodies(spark):
    """Behind the registry's five bytes; runs where the Avro package is on the cluster."""
    schema = '{"type":"record","name":"e","fields":[{"name":"op","type":"string"},{"name":"ts_ms","type":"long"}]}'
    messages = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07" + b"\x02c" + b"\xd0\x0f"),)], "value binary")
    try:
        got = streams.avro_envelopes(messages, schema, None).collect()
    except AnalysisException:
        pytest.skip("no Avro package")
    assert [(r.op, r.ts_ms) for r in got] == [("c", 1000)]
