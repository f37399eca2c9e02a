import pytest
from pyspark.sql import functions as F, types as T

from tidewater.operators import cdc, serving
from tidewater.plans import dlq, medallion
from tidewater.schema import Column, conform, table_schema, without_pii
from tidewater.sources import streams, tables

ROW = "struct<k:bigint,v:string>"


def changes(spark, rows):
    return spark.createDataFrame(rows, f"op string, ts_ms long, before {ROW}, after {ROW}")


HISTORY = [("c", 1, None, (1, "a")), ("u", 2, (1, "a"), (1, "b")), ("d", 3, (1, "b"), None), ("c", 1, None, (2, "x")), ("r", 0, None, (3, "s"))]


def test_delete_is_gone_from_state_and_marked_in_bronze(spark):
    df = changes(spark, HISTORY)
    assert {tuple(r) for r in cdc.current_state(df, ["k"]).collect()} == {(2, "x"), (3, "s")}
    gone = cdc.unwrap(df, ["k"], "rewrite").where("__deleted = 'true'").collect()
    assert [(r.k, r.v) for r in gone] == [(1, "b")]
    tomb = cdc.unwrap(df, ["k"], "none").where("__tombstone").collect()
    assert [(r.k, r.v) for r in tomb] == [(1, None)]
    with pytest.raises(ValueError):
        cdc.unwrap(df, ["k"], "other")


def test_upsert_equals_current_state_and_may_run_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = changes(spark, HISTORY[:2] + HISTORY[3:]), changes(spark, [HISTORY[2], ("c", 9, None, (4, "n"))])
    for batch in (first, second, second):
        serving.upsert(spark, path, cdc.unwrap(batch, ["k"], "none"), ["k"], buckets=2)
    assert {(r.k, r.v) for r in serving.current_rows(spark, path).collect()} == {(2, "x"), (3, "s"), (4, "n")}


def test_late_changes_undo_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for op, at, v in (("u", 200, "new"), ("u", 100, "old"), ("d", 300, None), ("u", 250, "late")):
        batch = spark.createDataFrame([(1, v, op == "d", at)], "k long, v string, __tombstone boolean, ts_ms long")
        serving.upsert(spark, path, batch, ["k"], buckets=2)
        assert [r.v for r in serving.current_rows(spark, path).collect()] == ([] if at > 200 else ["new"])


def test_newest_is_by_time_not_by_text(spark):
    df = spark.createDataFrame([(1, "2024-01-01T00:00:01Z", "old"), (1, "2024-01-01T00:00:01.5Z", "new"), (1, None, "none")], "k long, updated_at string, v string")
    assert cdc.latest(df, ["k"], "updated_at").first().v == "new"


def test_silver_drops_and_counts_orphans_and_keeps_unposted(spark):
    t = spark.createDataFrame([(1, 1, "fee", "1", "USD", "completed", None), (2, 9, "fee", "1", "USD", "completed", "2024-01-01T00:00:00Z")], "transaction_id long, account_id long, transaction_type string, amount string, currency string, status string, posted_at string")
    a = spark.createDataFrame([(1, 5, "checking", "n", "active", "2024-01-01T00:00:00Z", "true")], "account_id long, customer_id long, account_type string, account_number string, status string, updated_at string, __deleted string")
    c = spark.createDataFrame([(5, "Ann", "DE", "verified", 70, "2024-01-01T00:00:00Z")], "customer_id long, full_name string, country_code string, kyc_status string, risk_score int, updated_at string")
    silver = medallion.silver_enriched(t, a, c)
    assert [(r.transaction_id, r.year) for r in silver.collect()] == [(1, None)]
    assert [r.transaction_id for r in medallion.orphans(t, a).collect()] == [2]
    assert medallion.silver_enriched(t, a, c, drop_deleted=True).count() == 0
    assert medallion.high_risk(silver).count() == 1 and medallion.high_risk(silver, 80).count() == 0
    assert "customer_name" not in without_pii(silver).columns


def test_chain_writes_and_reads_partitions(spark, tmp_path):
    from tidewater.plans import roles

    sf = "/root/testdata/sf0.001"
    for name, make in (("transactions", roles.bronze_transactions), ("accounts", roles.bronze_accounts), ("customers", roles.customers)):
        make(spark, sf).write.parquet(str(tmp_path / "bronze" / name))
    medallion.run_all(spark, str(tmp_path / "bronze"), str(tmp_path / "lake"))
    tables.parquet_views(spark, [{"view": "daily", "path": str(tmp_path / "lake/gold/daily_transaction_summary")}])
    assert spark.sql("select sum(txn_count) from daily").first()[0] == spark.read.parquet(str(tmp_path / "lake/silver/enriched_transactions")).count()


def letters(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset long, key binary, value binary, headers array<struct<key:string,value:binary>>")


def test_dead_letters(spark):
    h = lambda name, value: ("__connect.errors." + name, value)
    rows = [
        ("d", 0, 1, b"k\xff", b"abc", [h("exception.class.name", b"java.net.ConnectException"), h("partition", b"2"), h("offset", b"77"), ("other", b"x"), h("exception.message", b"e" * 3000)]),
        ("d", 0, 2, None, None, [h("exception.class.name", b"org.apache.kafka.connect.errors.DataException"), h("exception.class.name", b"last.wins")]),
        ("d", 0, 3, None, None, None),
    ]
    a, b, c = dlq.dlq_events(letters(spark, rows)).orderBy("dlq_offset").collect()
    assert (a.category, a.original_partition, a.original_offset, len(a.error_message), a.message_key, a.message_size) == ("TRANSIENT", 2, 77, 2000, "k�", 3)
    assert (b.category, b.error_class) == ("UNKNOWN", "last.wins")
    assert (c.category, c.original_partition, c.original_offset, c.connector_name, c.error_message, c.action) == ("UNKNOWN", -1, -1, "unknown", "", "PARKED")
    thrice = dlq.dlq_events(letters(spark, rows[:1] * 3)).withColumn("inserted_at", F.current_timestamp())
    assert serving.last_version(thrice, serving.KEYS["dlq_events"]).count() == 1


def test_bad_amount_is_parked(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "2.5"), (3, None)], "id long, amount string")
    good, bad = dlq.split_bad(df, {"amount": "decimal(19,4)"}, "c", "t")
    assert {r.id for r in good.collect()} == {2, 3}
    assert [r.category for r in dlq.dlq_events(bad.withColumns({"partition": F.lit(0), "offset": F.lit(0), "key": F.lit(None).cast("binary")})).collect()] == ["PERMANENT"]


def test_contracts(spark):
    columns = [Column("id", "long", nullable=False, pk=True), Column("amount", "decimal(19,4)", encoded_as="string"), Column("at", "timestamp"), Column("day", "date")]
    assert [f.dataType.simpleString() for f in table_schema(columns, wire=True)] == ["bigint", "string", "string", "int"]
    with pytest.raises(ValueError):
        table_schema([Column("m", "decimal(5,2)")], wire=True)
    with pytest.raises(ValueError):
        conform(spark.createDataFrame([(1, 2)], "b int, a int"), [Column("a", "long"), Column("b", "long")])


def test_json_envelopes_prune_and_keep_corrupt(spark):
    row = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    schema = streams.envelope_schema(row, ["k"])
    message = spark.createDataFrame([('{"op":"c","ts_ms":1500,"after":{"k":1,"v":"x"}}',)], "value string")
    out = streams.json_envelopes(message, schema).first()
    assert out.after.asDict() == {"k": 1} and out.event_time.microsecond == 500000
    broken = spark.createDataFrame([('{"k":',), ('{"k":2}',)], "value string")
    assert [r._corrupt for r in streams.app_json(broken, row).collect()] == ['{"k":', None]
    assert streams.app_json(broken, row, keep_corrupt=False).count() == 1
    assert streams.topic_options("h:1", ["a", "b"], "latest", headers=True)["subscribe"] == "a,b"


def test_snapshots(spark, tmp_path):
    held = serving.Snapshots(spark, str(tmp_path / "s"))
    one, two = spark.range(3), spark.range(5)
    assert (held.commit(one, at="2024-01-01"), held.commit(two, at="2024-01-02"), held.rollback(1, at="2024-01-03")) == (1, 2, 3)
    assert [held.read().count(), held.read(version=2).count(), held.read(as_of="2024-01-02 10:00:00").count()] == [3, 5, 5]
    assert [r.operation for r in held.log().orderBy("snapshot_id").collect()] == ["replace", "replace", "rollback"]
    assert held.files().count() >= 1
    with pytest.raises(ValueError):
        held.read(as_of="2023-01-01")


def test_jdbc_table_in_ranges(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    spark.range(100).withColumn("v", F.col("id") * 2).write.format("jdbc").option("url", url).option("dbtable", "T").option("driver", "org.apache.derby.jdbc.EmbeddedDriver").save()
    got = tables.jdbc_table(spark, url, "T", split="id", bounds=(0, 100), parts=4, driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert got.where('v >= 100').count() == 50 and got.rdd.getNumPartitions() == 4
