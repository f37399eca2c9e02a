"""Scalar expressions of the engine; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(19,4)"


def money(text: Column) -> Column:
    """Decimal text as money; bad text is null, for the quarantine to find."""
    return text.try_cast(MONEY)


def day_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def milliseconds_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def epoch_text(ms: Column) -> Column:
    """Epoch milliseconds as UTC text; N/A for 0 and null."""
    return F.coalesce(F.when(ms != 0, F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")), F.lit("N/A"))


def safe_text(binary: Column) -> Column:
    """Bytes as text; bytes that are not UTF-8 become the replacement character."""
    return F.make_valid_utf8(binary.cast("string"))


def safe_int(text: Column, default: int = -1) -> Column:
    return F.coalesce(text.try_cast("bigint"), F.lit(default))


def byte_length(value: Column) -> Column:
    return F.coalesce(F.octet_length(value), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent as decimal(5,2); null over nothing."""
    return (part * F.lit(100.0) / F.nullif(whole, F.lit(0))).cast("decimal(5,2)")


def header_map(headers: Column, prefix: str) -> Column:
    """Headers (key, value) under a prefix as a map; of a repeated key the last value stays."""
    own = F.filter(headers, lambda h: h["key"].startswith(prefix))
    pairs = F.transform(own, lambda h: F.struct(F.substr(h["key"], F.lit(len(prefix) + 1)).alias("key"), F.coalesce(safe_text(h["value"]), F.lit("")).alias("value")))
    empty = F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))
    return F.coalesce(F.aggregate(pairs, empty, lambda m, p: F.map_concat(F.map_filter(m, lambda k, v: k != p["key"]), F.map_from_entries(F.array(p)))), empty)


def name_part(name: Column, n: int) -> Column:
    """Part n, from 1, of a dotted name; empty if there is none."""
    return F.coalesce(F.get(F.split(name, r"\."), F.lit(n - 1)), F.lit(""))


def tag_under(tags: Column, prefix: str) -> Column:
    """The first tag under ``prefix.``, without it; empty if there is none."""
    own = F.filter(tags, lambda t: t.startswith(prefix + "."))
    return F.coalesce(F.substr(F.get(own, F.lit(0)), F.lit(len(prefix) + 2)), F.lit(""))


def cycled(values: list[str], n: Column) -> Column:
    """values[n mod len], the pattern of seed formulas."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(n, F.lit(len(values))) + 1).cast("int"))
