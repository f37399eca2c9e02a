"""Windowed metrics from a declared spec.

A spec is a dict: ``name``, ``filter`` (SQL text), ``window`` (``type`` tumble or cumulate, ``time_col``, ``size``,
``step``), ``dimensions`` and ``aggregations`` (``as`` and ``expr``), and ``rank`` (``as``, ``order_by``, ``keep``, ``partition_by``, the window if it is left out, and ``grows``, which streams need: the order can only grow along the day). Columns come out
as window_start, window_end, the rank, the dimensions, the aggregations.

An aggregation's ``expr`` is SQL text. In cumulative windows, rows are first summed by pane and the sums run along the
day, if each aggregation also names its ``kind``: count, sum, count_if, ratio or count_distinct, with ``of``, its argument. Without
kinds each row is counted in every window that holds it, which costs up to a day's steps per row. An exact distinct
count runs too: a value counts from the pane of the day in which it is first seen.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewater.functions.scalars import MONEY
from tidewater.operators import windows

WINDOW = ["window_start", "window_end"]
AMOUNT = f"cast(amount as {MONEY})"
DAY = {"type": "cumulate", "time_col": "event_time", "step": "5 MINUTE", "size": "1 DAY"}


def counted(name: str) -> dict:
    return {"as": name, "expr": "count(*)", "kind": "count"}


def summed(name: str, of: str = AMOUNT) -> dict:
    return {"as": name, "expr": f"sum({of})", "kind": "sum", "of": of}


def counted_if(name: str, of: str) -> dict:
    return {"as": name, "expr": f"count_if({of})", "kind": "count_if", "of": of}


TIMESERIES = {"name": "timeseries", "filter": "op = 'c'", "window": {"type": "tumble", "time_col": "event_time", "size": "1 MINUTE"}, "dimensions": [{"as": "tx_type", "expr": "transaction_type"}], "aggregations": [counted("tx_count"), summed("total_amount")]}
KPI = {
    "name": "kpi", "filter": "op = 'c'", "window": DAY, "dimensions": [],
    "aggregations": [counted("total_count"), summed("total_value"), counted_if("success_count", "status = 'completed'"), counted_if("failed_count", "status = 'failed'"), {"as": "success_rate", "expr": "cast(count_if(status = 'completed') * 100.0 / nullif(count(*), 0) as decimal(5,2))", "kind": "ratio", "of": "status = 'completed'"}, {"as": "active_users", "expr": "count(distinct account_id)", "kind": "count_distinct", "of": "account_id"}],
}
BREAKDOWN = {"name": "breakdown", "filter": "op = 'c'", "window": DAY, "dimensions": [{"as": "tx_type", "expr": "transaction_type"}], "aggregations": [counted("tx_count"), summed("total_value"), counted_if("success_count", "status = 'completed'"), counted_if("failed_count", "status = 'failed'")]}
TOPN = {"name": "topn", "filter": "op = 'c'", "window": DAY, "dimensions": [{"as": "account_id", "expr": "account_id"}], "aggregations": [counted("tx_count"), summed("total_value")], "rank": {"as": "rank_num", "order_by": "total_value desc", "keep": 10, "grows": True}}


def output_columns(spec: dict) -> list[str]:
    rank = [spec["rank"]["as"]] if spec.get("rank") else []
    return ["window_start", "window_end", *rank, *[d["as"] for d in spec["dimensions"]], *[a["as"] for a in spec["aggregations"]]]


def settled(c: Column, kind: str | None) -> Column:
    """Sums of money keep its type; Spark widens them."""
    return c.cast(MONEY) if kind == "sum" else c


def metric(df: DataFrame, spec: dict, contract: list[str] | None = None) -> DataFrame:
    """The metric over a batch; ``contract`` is the sink's columns, which must be the same in the same order."""
    names = output_columns(spec)
    if contract is not None and contract != names:
        raise ValueError(f"{spec['name']}: columns {names} do not match the contract {contract}")
    rows = df.where(F.expr(spec["filter"])) if spec.get("filter") else df
    rows = rows.withColumns({d["as"]: F.expr(d["expr"]) for d in spec["dimensions"]})
    keys, win = [d["as"] for d in spec["dimensions"]], spec["window"]
    if win["type"] == "tumble":
        out = windows.tumbling(rows, win["time_col"], win["size"]).groupBy("window_start", "window_end", *keys).agg(*[settled(F.expr(a["expr"]), a.get("kind")).alias(a["as"]) for a in spec["aggregations"]])
    elif win["type"] == "cumulate" and (by := growing(spec)) is not None:
        return first_of_windows(windows.panes(rows, win["time_col"], win["step"], win["size"]), keys, win, spec, by).select(*names)
    elif win["type"] == "cumulate":
        out = cumulative(windows.panes(rows, win["time_col"], win["step"], win["size"]), keys, win, spec["aggregations"])
    else:
        raise ValueError(f"unknown window type {win['type']!r}")
    return ranked(out, spec["rank"], keys).select(*names) if spec.get("rank") else out.select(*names)


def summed_panes(rows: DataFrame, keys: list[str], aggregations: list[dict], *more: Column) -> DataFrame:
    """The parts of each pane: counts and sums of the aggregations that have them, and ``__rows``."""
    part = {"sum": lambda a: F.sum(F.expr(a["of"])), "count": lambda a: F.count("*"), "count_if": lambda a: F.count_if(F.expr(a["of"])), "ratio": lambda a: F.count_if(F.expr(a["of"]))}
    return rows.groupBy("window_start", "pane_end", *keys).agg(*[part[a["kind"]](a).alias(a["as"]) for a in aggregations if a["kind"] in part], F.count("*").alias("__rows"), *more)


def cumulative(rows: DataFrame, keys: list[str], win: dict, aggregations: list[dict]) -> DataFrame:
    if not all(a.get("kind") for a in aggregations):
        wide = windows.every_window(rows, win["step"], win["size"])
        return wide.groupBy("window_start", "window_end", *keys).agg(*[settled(F.expr(a["expr"]), a.get("kind")).alias(a["as"]) for a in aggregations])
    held = summed_panes(rows, keys, aggregations)
    for a in (a for a in aggregations if a["kind"] == "count_distinct"):
        first = rows.where(F.expr(a["of"]).isNotNull()).groupBy("window_start", *keys, F.expr(a["of"]).alias("__v")).agg(F.min("pane_end").alias("pane_end"))
        new = first.groupBy("window_start", "pane_end", *keys).agg(F.count("*").alias(a["as"]))
        held = joined_on(held, new, ["window_start", "pane_end", *keys])
    return along_the_day(held, keys, win, aggregations)


def along_the_day(held: DataFrame, keys: list[str], win: dict, aggregations: list[dict]) -> DataFrame:
    """Sums of panes as running sums at every window end from a group's first pane on."""
    spine = windows.every_window(held.groupBy("window_start", *keys).agg(F.min("pane_end").alias("pane_end")), win["step"], win["size"])
    out = windows.running(joined_on(spine, held.withColumnRenamed("pane_end", "window_end"), ["window_start", "window_end", *keys]), keys, [*[a["as"] for a in aggregations], "__rows"])
    return settle(out, aggregations)


def growing(spec: dict) -> str | None:
    """The aggregation by which a cumulative rank is ordered, largest first, if it is a count or a sum, which only grows along a day without negative parts."""
    rank = spec.get("rank") or {}
    found = re.fullmatch(r"\s*(\w+)\s+desc\s*", rank.get("order_by", ""), re.I)
    by = next((a for a in spec["aggregations"] if found and a["as"] == found[1]), None)
    if by is None or rank.get("partition_by", WINDOW) != WINDOW or not all(a.get("kind") in ("count", "sum", "count_if", "ratio") for a in spec["aggregations"]):
        return None
    return by["as"] if by["kind"] != "ratio" else None


def first_of_windows(rows: DataFrame, keys: list[str], win: dict, spec: dict, by: str) -> DataFrame:
    """The first rows of each cumulative window. Rows are summed by pane once, which also tells the days on which a sum falls somewhere: those are ranked over all keys, the others by their leaders."""
    of = next(a for a in spec["aggregations"] if a["as"] == by)
    least = F.min(F.expr(of["of"])) if of["kind"] == "sum" else F.lit(0)
    panes = summed_panes(rows, keys, spec["aggregations"], least.alias("__least"))
    if of["kind"] != "sum":
        return leaders(panes.drop("__least"), keys, win, spec, by)
    falls = panes.where("__least < 0").select(F.col("window_start").alias("__day")).distinct()
    days = F.col("window_start") == F.col("__day")
    grow, fall = (panes.drop("__least").join(falls, days, how) for how in ("left_anti", "left_semi"))
    every = ranked(along_the_day(fall, keys, win, spec["aggregations"]), spec["rank"], keys)
    return leaders(grow, keys, win, spec, by).unionByName(every)


def leaders(panes: DataFrame, keys: list[str], win: dict, spec: dict, by: str) -> DataFrame:
    """The first ``keep`` of each cumulative window, where the order can only grow.

    Totals change only in panes with rows. A key that is not among the first of the keys that change in its pane is behind
    as many keys whose totals never fall, so it can't lead before it changes again. So the candidates are the first of each pane, whatever the
    number of keys; a day's candidates, ``keep`` a pane, are merged in one group.
    """
    rank = spec["rank"]
    totals = settle(windows.running(panes.withColumnRenamed("pane_end", "window_end"), keys, [*[a["as"] for a in spec["aggregations"]], "__rows"]), spec["aggregations"])
    first = [F.col(by).desc_nulls_last(), *keys]
    told = totals.withColumn("__k", F.row_number().over(W.partitionBy(*WINDOW).orderBy(*first))).where(F.col("__k") <= rank["keep"]).drop("__k")
    own = [c for c in told.columns if c not in WINDOW]
    order, step, size = in_order(own.index(by), [own.index(k) for k in keys]), *(timedelta(seconds=windows.seconds(win[n])) for n in ("step", "size"))
    n_keys, keep = [own.index(k) for k in keys], rank["keep"]

    def run(table: pa.Table) -> pa.Table:
        """The day's first rows at each window's end, from the first rows of each pane: at most ``keep`` a window in and out."""
        panes: dict[datetime, list[tuple]] = {}
        for end, *row in zip(*(table.column(c).to_pylist() for c in ("window_end", *own))):
            panes.setdefault(end, []).append(tuple(row))
        start, end, held, out = table.column("window_start")[0].as_py(), min(panes), {}, []
        while end <= start + size:
            if end in panes:
                held |= {tuple(r[k] for k in n_keys): r for r in panes[end]}
                held = {tuple(r[k] for k in n_keys): r for r in sorted(held.values(), key=order)[:keep]}
            out += [(start, end, place, *r) for place, r in enumerate(held.values(), 1)]
            end += step
        types = [table.schema.field(c).type for c in WINDOW] + [pa.int64()] + [table.schema.field(c).type for c in own]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[*WINDOW, rank["as"], *own])

    kinds = {f.name: f.dataType.simpleString() for f in told.schema.fields}
    given = ", ".join([*(f"{c} {kinds[c]}" for c in WINDOW), f"{rank['as']} long", *(f"{c} {kinds[c]}" for c in own)])
    return told.groupBy("window_start").applyInArrow(run, given)


def in_order(by: int, keys: list[int]):
    """Sort key of rows: by one column, largest first and nulls last, then by the keys, nulls first."""
    return lambda r: (r[by] is None, -(r[by] or 0), *[(r[k] is not None, r[k] if r[k] is not None else 0) for k in keys])


def settle(out: DataFrame, aggregations: list[dict]) -> DataFrame:
    """Running parts as the aggregations' values."""
    for a in aggregations:
        value = F.col(a["as"])
        if a["kind"] == "ratio":
            value = (value * F.lit(100.0) / F.nullif(F.col("__rows"), F.lit(0))).cast("decimal(5,2)")
        out = out.withColumn(a["as"], F.coalesce(value, F.lit(0)) if a["kind"] == "count_distinct" else settled(value, a["kind"]))
    return out.drop("__rows")


def last_day(rows: DataFrame, spec: dict) -> DataFrame:
    """The rows of the newest span of the spec's windows; its start is one broadcast row."""
    kept = rows.where(F.expr(spec["filter"])) if spec.get("filter") else rows
    start = windows.floor_to(F.col(spec["window"]["time_col"]), windows.seconds(spec["window"]["size"]))
    return kept.join(F.broadcast(kept.agg(F.max(start).alias("__last"))), start >= F.col("__last")).drop("__last")


def joined_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys of which null equals null."""
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return left.join(r, on, "left").drop(*[f"__r_{k}" for k in keys])


def sort_keys(text: str) -> list[Column]:
    """``"total_value DESC, account_id"`` as columns; what does not parse is an error."""
    found = [re.fullmatch(r"\s*(\w+)(?:\s+(asc|desc))?\s*", part, re.I) for part in text.split(",")]
    if not all(found):
        raise ValueError(f"not an order: {text!r}")
    return [F.col(m[1]).desc() if (m[2] or "").lower() == "desc" else F.col(m[1]).asc() for m in found]


def ranked(df: DataFrame, rank: dict, keys: list[str]) -> DataFrame:
    """Rank inside each window, or ``partition_by``, and keep the first; ties are settled by the dimensions, so reruns agree."""
    over = W.partitionBy(*rank.get("partition_by", WINDOW)).orderBy(*sort_keys(rank["order_by"]), *keys)
    return df.withColumn(rank["as"], F.row_number().over(over).cast("long")).where(F.col(rank["as"]) <= rank["keep"])
