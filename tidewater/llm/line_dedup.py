"""Lines that many documents share, kept in one of them: reversible, incremental line dedup.

The state is an index of lines. Its reference table counts exactly, for each line's key (the 128-bit digest of the line without white space at its ends, in
lower case), the documents that hold it; so a deleted document is taken out by subtraction, and what it hid comes back. Over the table lie cuckoo filters, one a shard of
the keys, that hold the keys which as many documents share as make a line repeated. A filter takes and gives back single keys, so a batch changes
only those that cross that number. When documents are cleaned, their lines are dealt to the shards and tested there, and
only what passes meets the exact table; the filter has no false negative, and a false positive ends there.

Filters and lines reach a shard in one sorted partition, so a task holds one filter at a time and streams the lines past it. Lines are salted by their document, as one
line may be in a third of all documents. The number of shards follows the number of repeated keys, so a filter stays small.

Null text counts as empty: one empty line. Rows with the same id are one document, null ids too, which is less than all others; a line is kept in the largest document that holds it.
Deleting a document that was not inserted is an error. Repeated rows give repeated results. Empty tables give empty results. Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import checkpointed, lookup, slices, utf8

SPACE = b" \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 20, 3
SLOTS, KICKS = 4, 500
#: Keys of a shard's filter, about; filters are made anew when shards hold four times as many.
SHARD_KEYS, LEAST_SHARDS, SALTS = 1 << 16, 64, 64


def line_key(line: bytes, least_chars: int) -> bytes | None:
    """Digest of a line's key; None if the key is too short to count."""
    key = line.strip(SPACE).lower()
    if len(key) < least_chars or (not key.isascii() and len(key.decode(errors="replace")) < least_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class Cuckoo:
    """A filter of 16-bit fingerprints in buckets of four; a key's other bucket follows from one bucket and the fingerprint."""

    def __init__(self, buckets: int, slots: bytes | None = None):
        self.buckets = buckets
        self.slots = np.frombuffer(slots, np.uint16).reshape(buckets, SLOTS).copy() if slots else np.zeros((buckets, SLOTS), np.uint16)

    def places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = np.frombuffer(b"".join(keys), np.uint32).reshape(-1, 4)
        prints = np.maximum(words[:, 1] & 0xFFFF, 1)
        one = words[:, 2] & (self.buckets - 1)
        return prints, one, one ^ self.turn(prints)

    def turn(self, prints):
        return (prints.astype(np.uint64) * 0x5BD1E995 >> 7).astype(np.uint32) & np.uint32(self.buckets - 1)

    def holds(self, keys: list[bytes]) -> np.ndarray:
        prints, one, two = self.places(keys)
        return ((self.slots[one] == prints[:, None]) | (self.slots[two] == prints[:, None])).any(1)

    def add(self, keys: list[bytes]) -> bool:
        """False if there is no room for all; the filter is of no use then."""
        for mark, one, two in zip(*(a.tolist() for a in self.places(keys))):
            at = one if (self.slots[one] == 0).any() else two
            for kick in range(KICKS):
                free = np.flatnonzero(self.slots[at] == 0)
                if len(free):
                    self.slots[at, free[0]] = mark
                    break
                mark, self.slots[at, kick % SLOTS] = int(self.slots[at, kick % SLOTS]), mark
                at = int(at ^ self.turn(np.array([mark]))[0])
            else:
                return False
        return True

    def remove(self, keys: list[bytes]) -> None:
        """Only keys that were added."""
        for mark, one, two in zip(*(a.tolist() for a in self.places(keys))):
            at = one if (self.slots[one] == mark).any() else two
            self.slots[at, np.flatnonzero(self.slots[at] == mark)[0]] = 0

    @classmethod
    def of(cls, keys: list[bytes]) -> Cuckoo:
        buckets = 4
        while buckets * SLOTS * 0.9 < len(keys):
            buckets *= 2
        while True:
            made = cls(buckets)
            if made.add(keys):
                return made
            buckets *= 2


@dataclass(frozen=True)
class LineIndex:
    """``refs`` (key, docs): exact reference counts. ``filters`` (shard, buckets, slots): keys of ``least_docs`` documents or more."""

    refs: DataFrame
    filters: DataFrame
    shards: int
    least_docs: int


FILTER = "shard int, buckets int, slots binary"


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """(key, id): each line's key once a document. Checkpointed, as all else is read from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, at = [], []
            for row, text in enumerate(utf8(batch, "__text")):
                found = {line_key(line, least_chars) for line in text.split(b"\n")} - {None}
                keys += found
                at += [row] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column("__id").take(pa.array(at, pa.int64()))], ["key", "id"])

    kind = docs.schema[id_col].dataType.simpleString()
    return checkpointed(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, f"key binary, id {kind}").distinct())


def shard_of(shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long"), F.lit(shards)).cast("int").alias("shard")


def filters_of(refs: DataFrame, shards: int, least_docs: int) -> DataFrame:
    def fill(table: pa.Table) -> pa.Table:
        made = Cuckoo.of(sorted(table.column("key").to_pylist()))
        return pa.table({"shard": table.column("shard").slice(0, 1), "buckets": pa.array([made.buckets], pa.int32()), "slots": pa.array([made.slots.tobytes()], pa.binary())})

    return refs.where(F.col("docs") >= least_docs).select(shard_of(shards), "key").groupBy("shard").applyInArrow(fill, FILTER)


def build(lines: DataFrame, least_docs: int = LEAST_DOCS, shard_keys: int = SHARD_KEYS) -> LineIndex:
    """The index of documents' lines. A key's documents are counted within tasks before they are added up."""
    return refilled(checkpointed(lines.groupBy("key").agg(F.count("*").alias("docs"))), least_docs, shard_keys)


def refilled(refs: DataFrame, least_docs: int, shard_keys: int = SHARD_KEYS) -> LineIndex:
    repeated, shards = refs.where(F.col("docs") >= least_docs).count(), LEAST_SHARDS
    while shards * shard_keys < repeated:
        shards *= 2
    return LineIndex(refs, checkpointed(filters_of(refs, shards, least_docs)), shards, least_docs)


def insert(index: LineIndex, lines: DataFrame, shard_keys: int = SHARD_KEYS) -> LineIndex:
    """The index with more documents; none of them may be in it."""
    return changed(index, lines, 1, shard_keys)


def delete(index: LineIndex, lines: DataFrame, shard_keys: int = SHARD_KEYS) -> LineIndex:
    """The index without documents that are in it."""
    return changed(index, lines, -1, shard_keys)


def changed(index: LineIndex, lines: DataFrame, sign: int, shard_keys: int) -> LineIndex:
    more = lines.groupBy("key").agg((F.count("*") * sign).alias("more"))
    summed = index.refs.select("key", F.col("docs").alias("was"), F.lit(0).cast("long").alias("more")).unionByName(more.select("key", F.lit(0).cast("long").alias("was"), "more")).groupBy("key").agg(F.sum("was").alias("was"), (F.sum("was") + F.sum("more")).alias("docs"))
    both = checkpointed(summed.select("key", "was", F.when(F.col("docs") < 0, F.raise_error(F.lit("a deleted document was not in the index"))).otherwise(F.col("docs")).alias("docs")))
    refs, least = both.where("docs > 0").select("key", "docs"), F.lit(index.least_docs)
    out = replace(index, refs=refs)
    if refs.where(F.col("docs") >= least).count() > 4 * index.shards * shard_keys:
        return refilled(refs, index.least_docs, shard_keys)
    crossing = both.where((F.col("was") < least) != (F.col("docs") < least)).select(shard_of(index.shards), "key", (F.col("docs") >= least).alias("up"))

    def update(held: pa.Table, keys: pa.Table) -> pa.Table:
        shard = (held if held.num_rows else keys).column("shard")[0].as_py()
        up, crossed = np.array(keys.column("up").to_pylist(), bool), np.array(keys.column("key").to_pylist(), object)
        if held.num_rows:
            filt = Cuckoo(held.column("buckets")[0].as_py(), held.column("slots")[0].as_py())
        else:
            filt = Cuckoo.of([])
        filt.remove(list(crossed[~up]))
        fits = filt.add(sorted(crossed[up]))
        return pa.table({"shard": pa.array([shard], pa.int32()), "buckets": pa.array([filt.buckets if fits else 0], pa.int32()), "slots": pa.array([filt.slots.tobytes() if fits else b""], pa.binary())})

    filters = checkpointed(index.filters.groupBy("shard").cogroup(crossing.groupBy("shard")).applyInArrow(update, FILTER))
    full = filters.where("buckets = 0").select("shard")
    if full.limit(1).count():  # shards that have outgrown their filter get one twice as large
        anew = filters_of(refs.join(F.broadcast(full.withColumnRenamed("shard", "__full")), shard_of(index.shards) == F.col("__full"), "left_semi"), index.shards, index.least_docs)
        filters = checkpointed(filters.where("buckets > 0").unionByName(anew))
    return replace(out, filters=filters)


def probed(lines: DataFrame, index: LineIndex) -> DataFrame:
    """The lines whose key a filter holds: all repeated ones, and few others."""
    kind = lines.schema["id"].dataType.simpleString()
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    tested = lines.select(shard_of(index.shards), salt.alias("salt"), F.lit(1).alias("turn"), "key", "id", F.lit(0).alias("buckets"), F.lit(None).cast("binary").alias("slots"))
    filters = index.filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(0).alias("turn"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast(kind).alias("id"), "buckets", "slots")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = None, None
        for batch in slices(batches, 8192):
            places = list(zip(batch.column("shard").to_pylist(), batch.column("salt").to_pylist()))
            turns, keys, passed = batch.column("turn").to_pylist(), batch.column("key"), []
            at = 0
            while at < len(places):
                end = at + 1
                while end < len(places) and places[end] == places[at] and turns[end] == turns[at]:
                    end += 1
                if turns[at] == 0:
                    held, of = Cuckoo(batch.column("buckets")[at].as_py(), batch.column("slots")[at].as_py()), places[at]
                elif of == places[at]:
                    passed += (at + np.flatnonzero(held.holds(keys.slice(at, end - at).to_pylist()))).tolist()
                at = end
            chosen = pa.array(passed, pa.int64())
            yield pa.RecordBatch.from_arrays([keys.take(chosen), batch.column("id").take(chosen)], ["key", "id"])

    return tested.unionByName(filters).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "turn").mapInArrow(run, f"key binary, id {kind}")


def doomed(lines: DataFrame, index: LineIndex) -> DataFrame:
    """(id, keys): the repeated lines of each document that a larger document holds too."""
    maybe = checkpointed(probed(lines, index))
    owners = maybe.groupBy("key").agg(F.max("id").alias("owner"), F.count("*").alias("uses"))
    owners = checkpointed(owners.join(index.refs.where(F.col("docs") >= index.least_docs).select("key"), "key"))
    return lookup(maybe, owners, "key", "uses").where(F.col("uses").isNotNull() & F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))).groupBy("id").agg(F.collect_set("key").alias("keys"))


def dedup_lines(docs: DataFrame, lines: DataFrame, index: LineIndex, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """Per row of ``docs``: id, ``n_lines``, ``n_dropped`` and ``kept``, the text without the lines that it loses.

    ``lines`` are those of the documents that stand beside each other, of which the largest keeps a repeated line; ``index`` has counted them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            rows = []
            for text, keys in zip(utf8(batch, "__text"), batch.column("keys").to_pylist()):
                parts = text.split(b"\n")
                gone = set(keys or ())
                kept = [p for p in parts if line_key(p, least_chars) not in gone] if gone else parts
                rows.append((len(parts), len(parts) - len(kept), b"\n".join(kept)))
            n, dropped, kept = (list(c) for c in zip(*rows)) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["__id", "n_lines", "n_dropped", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = doomed(lines, index)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    joined = rows.join(found, F.col("__id").eqNullSafe(F.col("id")), "left").select("__id", "__text", "keys")
    return joined.mapInArrow(run, f"__id {kind}, n_lines long, n_dropped long, kept string").withColumnRenamed("__id", id_col)
