"""Scans along time in two levels: a key's rows are cut into slices of time, so that one key with a large share of all rows is many groups.

A frame that reaches back a fixed span needs only the end of the slice before, which is copied (``with_tails``). A state that runs through all rows, as the time of
the last event let through, is a function of what it was before the slice: each slice tells that function, a pass over one row a slice
carries the state along, and each slice then knows what came in (``let_through``).
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Length of a slice in spans or waits.
SLICE = 16


def with_tails(rows: DataFrame, at: str, span: int, slices: int = SLICE) -> DataFrame:
    """Rows with ``__slice`` and ``__tail``; those of a slice's last ``span`` stand in the next one too, as its tail. Frames of trailing ``span`` within (key, slice) are whole."""
    long = max(span, 1) * slices
    own = F.floor(F.col(at) / F.lit(long)).cast("long")
    place = lambda s, tail: F.struct(s.alias("slice"), F.lit(tail).alias("tail"))
    places = F.when(F.pmod(F.col(at), F.lit(long)) >= long - span, F.array(place(own, False), place(own + 1, True))).otherwise(F.array(place(own, False)))
    return rows.withColumn("__p", F.explode(places)).withColumns({"__slice": F.col("__p.slice"), "__tail": F.col("__p.tail")}).drop("__p")


def chain(times: np.ndarray, wait: int) -> tuple[np.ndarray, np.ndarray]:
    """For events in order: the next one that is let through after each, and the last one of the chain that starts there."""
    after = np.searchsorted(times, times + max(wait, 1))
    last = times.copy()
    for k in range(len(times) - 1, -1, -1):
        if after[k] < len(times):
            last[k] = last[after[k]]
    return after, last


def sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray]]:
    """((k, s, came), times) of rows in order of key, slice and time; holds the times of one slice, which are distinct and so bounded by its length."""
    now, held = None, []
    for batch in batches:
        rows = list(zip(batch.column("k").to_pylist(), batch.column("s").to_pylist(), batch.column("came").to_pylist()))
        times, at = batch.column("t").to_numpy(), 0
        while at < len(rows):
            end = bisect.bisect_right(rows, rows[at][:2], lo=at, key=lambda r: r[:2])
            if rows[at] != now:
                if held:
                    yield now, np.concatenate(held)
                now, held = rows[at], []
            held.append(times[at:end])
            at = end
    if held:
        yield now, np.concatenate(held)


def in_batches(groups: Iterator, size: int = 1000) -> Iterator[list]:
    while found := list(itertools.islice(groups, size)):
        yield found


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys in one partition. They are dealt by a hash of the keys: a shuffle by the keys themselves is left out of the plan where a join on them stands before,
    and once that join turns out to be a broadcast, its side is read piece by piece and no longer by key."""
    return rows.repartition(F.xxhash64(*keys))


def let_through(events: DataFrame, key: str, at: str, wait: int, slices: int = SLICE) -> DataFrame:
    """The events (key, at, distinct; neither null) that come ``wait`` or more after the last one of the key that was let through; the first always is."""
    long = max(wait, 1) * slices
    kind = events.schema[key].dataType.simpleString()
    cut = events.select(F.col(key).alias("k"), F.floor(F.col(at) / F.lit(long)).cast("long").alias("s"), F.col(at).cast("long").alias("t"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each time from which an event may go through, up to the first that nothing before the slice can hold back: the last time of the slice's chain."""
        for found in in_batches(sorted_groups(batches)):
            rows = []
            for (k, s, _), times in found:
                _, last = chain(times, wait)
                reach = min(int(np.searchsorted(times, s * long - 1 + wait)), len(times) - 1) + 1
                ends = np.append(last[: reach - 1] != last[1:reach], True)  # of equal outcomes the latest
                rows.append((k, s, times[:reach][ends], last[:reach][ends]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (key_type, pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))], ["k", "s", "upto", "out"])

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last = None, None
        for batch in batches:
            came = []
            for k, upto, out in zip(*(batch.column(c).to_pylist() for c in ("k", "upto", "out"))):
                now, last = k, last if k == now else None
                came.append(last)
                at_ = 0 if last is None else bisect.bisect_left(upto, last + wait)
                last = out[at_] if at_ < len(out) else last
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("s"), pa.array(came, pa.int64())], ["k", "s", "came"])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in in_batches(sorted_groups(batches)):
            keys, chosen = [], []
            for (k, _, came), times in found:
                (after, _), at_ = chain(times, wait), 0 if came is None else int(np.searchsorted(times, came + wait))
                while at_ < len(times):
                    keys.append(k)
                    chosen.append(times[at_])
                    at_ = int(after[at_])
            yield pa.RecordBatch.from_arrays([pa.array(keys, key_type), pa.array(chosen, pa.int64())], ["k", "t"])

    key_type = to_arrow_type(events.schema[key].dataType)
    pieces = dealt(cut.withColumn("came", F.lit(None).cast("long")), "k", "s").sortWithinPartitions("k", "s", "t").mapInArrow(told, f"k {kind}, s long, upto array<long>, out array<long>")
    states = dealt(pieces, "k").sortWithinPartitions("k", "s").mapInArrow(carried, f"k {kind}, s long, came long")
    return dealt(cut.join(states, ["k", "s"]), "k", "s").sortWithinPartitions("k", "s", "t").mapInArrow(passed, f"k {kind}, t long").select(F.col("k").alias(key), F.col("t").alias(at))
