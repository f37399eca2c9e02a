"""Windowed metrics on streams.

A cumulative window is kept as state: rows are summed by pane, and each group of a day (its keys) holds one running total and the end up to
which it was given out. A pane that closes moves the total on; an event-time timer gives out the windows in which nothing came. So state
has open panes and one row a group, not a copy of each pane in every window that is still to come.

Exact distinct counts of whole numbers are bitmaps: a pane has one a bucket of values, the day ORs them. Other values are held as a set.
Ranks whose order can only grow hold the first rows of the day: a key leads only after it changed, so the first of those that change in a
pane are enough, found by buckets of keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewater.functions.scalars import MONEY
from tidewater.operators.distinct import WHOLE, place
from tidewater.operators.windows import floor_to, seconds
from tidewater.plans.metrics import in_order, output_columns, ranked

#: Buckets of a set of values that are not whole numbers, and of the keys of a rank.
SET_BUCKETS, KEY_BUCKETS = 64, 16


def tumbling_metric(rows: DataFrame, spec: dict) -> DataFrame:
    """``rows`` has a watermark on the spec's time column. Append mode gives each window once, when it closes."""
    kept = rows.where(F.expr(spec["filter"])) if spec.get("filter") else rows
    keys = [F.expr(d["expr"]).alias(d["as"]) for d in spec["dimensions"]]
    win = F.window(spec["window"]["time_col"], f"{seconds(spec['window']['size'])} seconds").alias("w")
    value = lambda a: F.expr(a["expr"]).cast(MONEY) if a.get("kind") == "sum" else F.expr(a["expr"])
    out = kept.groupBy(win, *keys).agg(*[value(a).alias(a["as"]) for a in spec["aggregations"]])
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[d["as"] for d in spec["dimensions"]], *[a["as"] for a in spec["aggregations"]])


class Day(StatefulProcessor):
    """What the states of a day share: panes come once each, in order, when they close; a timer stands at the next window's end."""

    def __init__(self, step_ms: int, size_ms: int):
        self.step, self.size = step_ms, size_ms

    def ends(self, day: int, last: int, watermark: int) -> range:
        """Window ends after ``last`` that the watermark has passed."""
        return range(last + self.step, min(day + self.size, watermark // self.step * self.step) + 1, self.step)

    def wait(self, end: int | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if end is not None:
            self.handle.registerTimer(end)

    def close(self) -> None:
        pass


def plus(total, more):
    """A running sum; null stays until there is a value, and counts as nothing."""
    return total if more is None else more if total is None else total + more


class RunningTotals(Day):
    """The running totals of one group of a day."""

    def __init__(self, step_ms: int, size_ms: int, given: list[str], parts: T.StructType, distinct: list[str]):
        super().__init__(step_ms, size_ms)
        self.row, self.parts, self.distinct = Row(*given), parts, distinct

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("totals", T.StructType([T.StructField("until", T.LongType()), *self.parts.fields, *[T.StructField(f"d_{d}", T.LongType()) for d in self.distinct]]))
        self.bits = handle.getMapState("bits", "which int, bucket long", "bits binary")
        self.values = handle.getMapState("values", "which int, value string", "held boolean")

    def new_values(self, r: Row) -> int:
        """How many values of a pane's bucket the day had not seen."""
        if r["__bits"] is not None:
            at, bits = (r["__which"], r["__bucket"]), np.frombuffer(bytes(r["__bits"]), np.uint8)
            old = np.frombuffer(bytes(self.bits.getValue(at)[0]), np.uint8) if self.bits.containsKey(at) else np.zeros_like(bits)
            both = bits | old
            self.bits.updateValue(at, (both.tobytes(),))
            return int(np.bitwise_count(both).sum()) - int(np.bitwise_count(old).sum())
        new = [v for v in r["__values"] or () if not self.values.containsKey((r["__which"], v))]
        for v in new:
            self.values.updateValue((r["__which"], v), (True,))
        return len(new)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        panes: dict[int, list[Row]] = {}
        for r in rows:
            panes.setdefault(r["__pane"], []).append(r)
        yield from self.given(key, panes, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.given(key, {}, timerValues.getCurrentWatermarkInMs())

    def given(self, key, panes: dict[int, list[Row]], watermark: int) -> list[Row]:
        day, n = key[0], len(self.parts.fields)
        if self.held.exists():
            until, *totals = self.held.get()
        elif panes:
            until, totals = min(panes) - self.step, [None] * n + [0] * len(self.distinct)
        else:
            return []
        out = []
        for end in self.ends(day, until, watermark):
            for r in panes.pop(end, ()):
                totals[:n] = [plus(t, r[f.name]) for t, f in zip(totals, self.parts.fields)]
                if self.distinct:
                    totals[n + r["__which"]] += self.new_values(r)
            out.append(self.row(day, end, *key[1:], *totals))
            until = end
        if panes:
            raise ValueError(f"panes {sorted(panes)} came before they closed")
        if until < day + self.size:
            self.held.update((until, *totals))
            self.wait(until + self.step)
        else:
            for state in (self.held, self.bits, self.values):
                state.clear()
            self.wait(None)
        return out


def closed_panes(rows: DataFrame, spec: dict, *more) -> tuple[DataFrame, T.StructType, list[dict]]:
    """Sums of panes as they close: __day, __pane (its end), the keys and parts; bitmaps or sets of the distinct values where the spec counts them."""
    win = spec["window"]
    kept = rows.where(F.expr(spec["filter"])) if spec.get("filter") else rows
    distinct = [a for a in spec["aggregations"] if a["kind"] == "count_distinct"]
    first, by, held = F.lit(True), [], []
    if distinct:
        whole = [kept.select(F.expr(a["of"])).dtypes[0][1] in WHOLE for a in distinct]
        one = []
        for k, a in enumerate(distinct):
            bucket, bit = place(a["of"]) if whole[k] else (F.pmod(F.xxhash64(F.expr(a["of"]).cast("string")), F.lit(SET_BUCKETS)), F.lit(None).cast("long"))
            one.append(F.struct(F.lit(k).alias("which"), bucket.alias("bucket"), bit.alias("bit"), (F.lit(None) if whole[k] else F.expr(a["of"])).cast("string").alias("value")))
        kept = kept.withColumn("__d", F.explode(F.array(*one)) if len(one) > 1 else one[0])
        first, by = F.col("__d.which") == 0, [F.col("__d.which").alias("__which"), F.col("__d.bucket").alias("__bucket")]
        plain = F.col("__d.which").isin([k for k, w in enumerate(whole) if not w]) if not all(whole) else F.lit(False)
        held = [F.when(F.count("__d.bit") > 0, F.bitmap_construct_agg("__d.bit")).alias("__bits"), F.collect_set(F.when(plain, F.col("__d.value"))).alias("__values") if not all(whole) else F.lit(None).cast("array<string>").alias("__values")]
    counts = {"count": lambda a: F.count_if(first), "count_if": lambda a: F.count_if(first & F.expr(a["of"])), "ratio": lambda a: F.count_if(first & F.expr(a["of"])), "sum": lambda a: F.sum(F.when(first, F.expr(a["of"])))}
    parts = {a["as"]: counts[a["kind"]](a) for a in spec["aggregations"] if a["kind"] in counts} | {"__rows": F.count_if(first)}
    keys = [F.expr(d["expr"]).alias(d["as"]) for d in spec["dimensions"]]
    panes = kept.groupBy(F.window(win["time_col"], f"{seconds(win['step'])} seconds").alias("__w"), *keys, *by).agg(*[c.alias(k) for k, c in parts.items()], *held)
    at = F.window_time("__w")
    names = [d["as"] for d in spec["dimensions"]]
    kinds = {f.name: f.dataType for f in panes.schema.fields}
    wide = lambda k: F.col(k).cast(T.DecimalType(38, kinds[k].scale)) if isinstance(kinds[k], T.DecimalType) else F.col(k)
    out = panes.select(at.alias("__at"), F.unix_millis(floor_to(at, seconds(win["size"]))).alias("__day"), F.unix_millis("__w.end").alias("__pane"), *names, *[wide(k).alias(k) for k in parts], *[c for c in ("__which", "__bucket", "__bits", "__values") if distinct], *more)
    return out, T.StructType([out.schema[k] for k in parts]), distinct


def cumulative_metric(rows: DataFrame, spec: dict) -> DataFrame:
    """Cumulative windows in append mode; every aggregation needs its kind. Ranks are made of whole windows: by ``first_ranked`` in each batch, or by ``leaders_metric``."""
    panes, parts, distinct = closed_panes(rows, spec)
    keys, win = [d["as"] for d in spec["dimensions"]], spec["window"]
    counts = [a["as"] for a in distinct]
    given = T.StructType([T.StructField("__start", T.LongType()), T.StructField("__end", T.LongType()), *[panes.schema[k] for k in keys], *parts.fields, *[T.StructField(c, T.LongType()) for c in counts]])
    totals = RunningTotals(seconds(win["step"]) * 1000, seconds(win["size"]) * 1000, given.names, parts, counts)
    out = panes.groupBy("__day", *keys).transformWithState(totals, given, "Append", "EventTime")
    return settled(out, spec)


def settled(out: DataFrame, spec: dict) -> DataFrame:
    """Running parts as the spec's columns."""
    ratio = lambda c: (c * F.lit(100.0) / F.nullif(F.col("__rows"), F.lit(0))).cast("decimal(5,2)")
    value = {"sum": lambda c: c.cast(MONEY), "ratio": ratio}
    ranks = [spec["rank"]["as"]] if spec.get("rank") and spec["rank"]["as"] in out.columns else []
    return out.select(F.timestamp_millis("__start").alias("window_start"), F.timestamp_millis("__end").alias("window_end"), *ranks, *[d["as"] for d in spec["dimensions"]], *[value.get(a["kind"], lambda c: c)(F.col(a["as"])).alias(a["as"]) for a in spec["aggregations"]])


def first_ranked(batch: DataFrame, spec: dict) -> DataFrame:
    """Rank of a micro-batch's closed windows: in append mode all groups of a window arrive in one batch."""
    return ranked(batch, spec["rank"], [d["as"] for d in spec["dimensions"]]).select(*output_columns(spec))


class BucketLeaders(StatefulProcessor):
    """Totals of the keys of one bucket of a day; gives the first of those that change in a pane."""

    def __init__(self, given: list[str], kinds: T.StructType, parts: T.StructType, by: str, keep: int, size_ms: int):
        self.row, self.keys, self.kinds, self.parts, self.by, self.keep, self.size = Row(*given), kinds.names, kinds, parts, parts.names.index(by), keep, size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getMapState("totals", self.kinds, self.parts)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        panes: dict[int, list[tuple]] = {}
        for r in rows:
            panes.setdefault(r["__pane"], []).append((tuple(r[k] for k in self.keys), tuple(r[p] for p in self.parts.names), r["__end"]))
        changed: dict[tuple, list] = {}
        n, width = len(self.keys), len(self.keys) + len(self.parts.fields)
        order = in_order(n + self.by, range(n))
        for pane in sorted(panes):
            moved = []
            for own, more, end in panes[pane]:
                if more[self.by] is not None and more[self.by] < 0:
                    raise ValueError(f"{self.parts.names[self.by]} fell in a pane; a rank by it cannot be declared to grow")
                if own not in changed:
                    changed[own] = list(self.totals.getValue(own)) if self.totals.containsKey(own) else [None] * len(more)
                changed[own] = [plus(t, m) for t, m in zip(changed[own], more)]
                moved.append((*own, *changed[own], end))
            yield from (self.row(key[0], pane, r[width], *r[:width]) for r in sorted(moved, key=order)[: self.keep])
        for own, total in changed.items():
            self.totals.updateValue(own, tuple(total))
        if not list(self.handle.listTimers()):
            self.handle.registerTimer(key[0] + self.size)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.totals.clear()
        yield from ()

    def close(self) -> None:
        pass


class Leaders(Day):
    """The first rows of a day, at most ``keep``, given out for each window."""

    def __init__(self, step_ms: int, size_ms: int, given: list[str], columns: T.StructType, n_keys: int, by: str, keep: int):
        super().__init__(step_ms, size_ms)
        self.row, self.columns, self.n, self.keep = Row(*given), columns, n_keys, keep
        self.order = in_order(columns.names.index(by), range(n_keys))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until, self.first = handle.getValueState("until", "at long"), handle.getListState("first", self.columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        panes: dict[int, list[tuple]] = {}
        for r in rows:
            panes.setdefault(r["__pane"], []).append(tuple(r[c] for c in self.columns.names))
        yield from self.given(key[0], panes, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.given(key[0], {}, timerValues.getCurrentWatermarkInMs())

    def given(self, day: int, panes: dict[int, list[tuple]], watermark: int) -> list[Row]:
        if self.until.exists():
            until, first = self.until.get()[0], {tuple(r)[: self.n]: tuple(r) for r in self.first.get()}
        elif panes:
            until, first = min(panes) - self.step, {}
        else:
            return []
        out = []
        for end in self.ends(day, until, watermark):
            if end in panes:
                first |= {r[: self.n]: r for r in panes[end]}
                first = {r[: self.n]: r for r in sorted(first.values(), key=self.order)[: self.keep]}
            out += [self.row(day, end, place, *r) for place, r in enumerate(first.values(), 1)]
            until = end
        if until < day + self.size:
            self.until.update((until,))
            self.first.put(list(first.values()))
            self.wait(until + self.step)
        else:
            self.until.clear()
            self.first.clear()
            self.wait(None)
        return out


def leaders_metric(rows: DataFrame, spec: dict, buckets: int = KEY_BUCKETS) -> DataFrame:
    """Ranked cumulative windows whose order can only grow, which the spec declares (``rank: grows``); a part that falls is an error.

    Keys are dealt to buckets, which hold their totals and give at most ``keep`` rows a pane; the day merges those and holds ``keep`` rows.
    """
    keys, win, rank = [d["as"] for d in spec["dimensions"]], spec["window"], spec["rank"]
    by = rank["order_by"].split()[0]
    panes, parts, distinct = closed_panes(rows, spec, F.col("__w.end").alias("__end"))
    if distinct or not rank.get("grows"):
        raise ValueError(f"{spec['name']}: leaders need an order that is declared to grow and no distinct counts")
    size, kinds = seconds(win["size"]) * 1000, T.StructType([panes.schema[k] for k in keys])
    dealt = panes.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    moved = T.StructType([T.StructField("__day", T.LongType()), T.StructField("__pane", T.LongType()), T.StructField("__at", T.TimestampType()), *kinds.fields, *parts.fields])
    candidates = dealt.groupBy("__day", "__bucket").transformWithState(BucketLeaders(moved.names, kinds, parts, by, rank["keep"], size), moved, "Append", "EventTime", eventTimeColumnName="__at")
    held = T.StructType([*kinds.fields, *parts.fields])
    given = T.StructType([T.StructField("__start", T.LongType()), T.StructField("__end", T.LongType()), T.StructField(rank["as"], T.LongType()), *held.fields])
    out = candidates.groupBy("__day").transformWithState(Leaders(seconds(win["step"]) * 1000, size, given.names, held, len(keys), by, rank["keep"]), given, "Append", "EventTime")
    return settled(out, spec)
