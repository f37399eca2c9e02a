"""Data quality: rules as one aggregate per table, a gate, result series, wire conformance, schema compatibility."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column as C, DataFrame, Observation, functions as F

from tidewater.schema import Column, spark_type, wire_type


@dataclass(frozen=True)
class Rule:
    kind: str  # not_null, unique, range, accepted_values
    column: str
    low: float | None = None
    high: float | None = None
    values: tuple = ()

    def case(self, table: str) -> str:
        return f"{table}_{self.column}_{self.kind}"


class Aborted(Exception):
    """The source could not be read, so nothing is known about its quality."""


class Violated(Exception):
    """At least one rule is broken."""


def contract_rules(columns: list[Column], extra: list[Rule] | None = None) -> list[Rule]:
    """not_null of required columns, unique of the key, no negative value of unsigned columns, then the declared ones."""
    own = [Rule("not_null", c.name) for c in columns if not c.nullable] + [Rule("unique", c.name) for c in columns if c.pk]
    return own + [Rule("range", c.name, 0) for c in columns if c.unsigned] + list(extra or [])


def broken(rule: Rule) -> C:
    """Rows that break the rule; null breaks not_null only."""
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "range":
        low = c < rule.low if rule.low is not None else F.lit(False)
        high = c > rule.high if rule.high is not None else F.lit(False)
        return low | high
    if rule.kind == "accepted_values":
        return ~c.isin(*rule.values)
    raise ValueError(f"unknown rule {rule.kind!r}")


def check_table(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """(case_name, violations): all row rules in one pass, and one grouping per unique column, which counts the repeated values, null among them."""
    rows = [r for r in rules if r.kind != "unique"]
    out = None
    if rows:
        counts = df.agg(*[F.count_if(broken(r)).alias(r.case(table)) for r in rows])
        out = counts.select(F.explode(F.array(*[F.struct(F.lit(r.case(table)).alias("case_name"), F.col(r.case(table)).alias("violations")) for r in rows])).alias("r")).select("r.*")
    for r in (r for r in rules if r.kind == "unique"):
        twice = df.groupBy(r.column).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("violations")).select(F.lit(r.case(table)).alias("case_name"), "violations")
        out = twice if out is None else out.unionByName(twice)
    return out


def gate(results: DataFrame) -> int:
    """Raise if any rule is broken; a source that cannot be read aborts, which is not a pass. Returns the number of rules."""
    from pyspark.errors import PySparkException

    try:
        found = results.collect()  # one row per rule
    except PySparkException as error:
        raise Aborted(str(error)) from error
    if bad := [f"{r.case_name}: {r.violations}" for r in found if r.violations]:
        raise Violated("; ".join(bad))
    return len(found)


def write_checked(df: DataFrame, table: str, rules: list[Rule], path: str, folder: str) -> DataFrame:
    """Write a batch to ``path/folder`` only if it keeps the rules; (case_name, violations), and ``published`` tells what became of it.

    The rules of rows are counted by the writing job itself, so the source is read once; ``unique`` is counted from the key column of what was
    written. The batch is staged under a name that readers skip, and is renamed or removed when the counts are known.
    A batch that is written again replaces its folder.
    """
    spark, rows = df.sparkSession, [r for r in rules if r.kind != "unique"]
    staged, seen = f"{path}/_staged-{uuid.uuid4().hex}", Observation()
    watched = df.observe(seen, *[F.count_if(broken(r)).alias(r.case(table)) for r in rows]) if rows else df
    watched.write.parquet(staged)
    found = {r.case(table): seen.get[r.case(table)] for r in rows}
    if keys := [r for r in rules if r.kind == "unique"]:
        found |= {r.case_name: r.violations for r in check_table(spark.read.schema(df.schema).parquet(staged), table, keys).collect()}  # one row a rule
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs, good = Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), not any(found.values())
    if good:
        fs.delete(Path(f"{path}/{folder}"), True)
        fs.rename(Path(staged), Path(f"{path}/{folder}"))
    else:
        fs.delete(Path(staged), True)
    return spark.createDataFrame([(c, v, good) for c, v in found.items()], "case_name string, violations long, published boolean")


def result_series(results: DataFrame, now: C | None = None) -> DataFrame:
    """(ts, case_name, status, message) to append to the series of results."""
    ok = F.col("violations") == 0
    return results.select((F.current_timestamp() if now is None else now).alias("ts"), "case_name", F.when(ok, "Success").otherwise("Failed").alias("status"), F.concat(F.col("violations").cast("string"), F.lit(" violations")).alias("message"))


def conformance(df: DataFrame, columns: list[Column]) -> DataFrame:
    """(column, problem, level, n) where data on the wire differ from the contract: missing or unexpected columns, types, values that do not read as declared, nulls.

    Types come from the schema; values and nulls from one pass over the data.
    """
    spark, have = df.sparkSession, {f.name: f.dataType for f in df.schema.fields}
    found = [(c.name, "missing", "error") for c in columns if c.name not in have] + [(n, "unexpected", "warning") for n in have if n not in {c.name for c in columns}]
    shared = [c for c in columns if c.name in have]
    for c in shared:
        text_decimal = c.type.startswith("decimal") and c.encoded_as is None and have[c.name].simpleString() == "string"
        if text_decimal:
            found.append((c.name, "decimal as undeclared text", "warning"))
        elif have[c.name] != (wire_type(c) if c.encoded_as or not c.type.startswith("decimal") else spark_type(c.type)):
            found.append((c.name, f"type {have[c.name].simpleString()}", "error"))
    checks = {}
    for c in shared:
        if not c.nullable:
            checks[c.name, "null in required column", "warning"] = F.count_if(F.col(c.name).isNull())
        if have[c.name].simpleString() == "string" and c.type != "string":
            checks[c.name, f"does not read as {c.type}", "error"] = F.count_if(F.col(c.name).isNotNull() & F.col(c.name).try_cast(spark_type(c.type)).isNull())
    static = spark.createDataFrame([(*x, 1) for x in found], "column string, problem string, level string, n long")
    if not checks:
        return static
    counts = df.agg(*[v.alias(f"c{k}") for k, v in enumerate(checks.values())])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(p).alias("problem"), F.lit(lv).alias("level"), F.col(f"c{k}").alias("n")) for k, (c, p, lv) in enumerate(checks)])
    return static.unionByName(counts.select(F.explode(cells).alias("r")).select("r.*").where("n > 0"))


# fixed values: type changes that old readers' data survive
PROMOTIONS = {"int": ["long", "float", "double"], "long": ["float", "double"], "float": ["double"], "string": ["bytes"], "bytes": ["string"]}


def backward_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(urn, column, change, level) between two catalogs of (urn, column, type, nullable, encoded_as), joined by column."""
    wire = F.when(F.col("encoded_as") == "string", "string").otherwise(F.trim("type"))
    o = old.select("urn", "column", wire.alias("old_type"), F.coalesce("nullable", F.lit(True)).alias("old_null"), F.lit(True).alias("in_old"))
    n = new.select("urn", "column", wire.alias("new_type"), F.coalesce("nullable", F.lit(True)).alias("new_null"), F.lit(True).alias("in_new"))
    both = o.join(n, ["urn", "column"], "full_outer")
    allowed = F.create_map(*[x for k, v in PROMOTIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    widened = F.coalesce(F.array_contains(allowed[F.col("old_type")], F.col("new_type")), F.lit(False))
    kept = F.col("in_old") & F.col("in_new")
    change = F.array_compact(
        F.array(
            F.when(F.col("in_old").isNull() & ~F.col("new_null"), F.struct(F.lit("new required column").alias("change"), F.lit("break").alias("level"))),
            F.when(kept & (F.col("old_type") != F.col("new_type")) & ~widened, F.struct(F.concat_ws(" ", F.lit("type"), "old_type", F.lit("to"), "new_type").alias("change"), F.lit("break").alias("level"))),
            F.when(kept & F.col("old_null") & ~F.col("new_null"), F.struct(F.lit("optional to required").alias("change"), F.lit("break").alias("level"))),
            F.when(F.col("in_new").isNull(), F.struct(F.lit("removed").alias("change"), F.lit("note").alias("level"))),
        )
    )
    return both.select("urn", "column", F.explode(change).alias("c")).select("urn", "column", "c.*")


def key_difference(want: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: (key, side), side ``missing`` or ``unexpected``."""
    w, h = want.select(key).distinct(), have.select(key).distinct()
    return w.join(h, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(h.join(w, key, "left_anti").withColumn("side", F.lit("unexpected")))
