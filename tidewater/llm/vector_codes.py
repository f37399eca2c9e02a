"""Vectors compressed to codes of parts, with codebooks trained by ball k-means over all rows.

Components become integers, vectors are cut into equal consecutive parts, and each part position has its own codebook. In each round
every entry's parts form a ball: its radius is the largest distance of a part from it. Entries at twice the radius or less are its neighbours;
a part nearer to its entry than half way to the nearest other entry is in the stable core and is not looked at again, and another part is compared only with
the entries of the ring that its distance reaches (triangle inequality). All comparisons are of exact integer squared distances, so the assignment is that of
a full search, ties to the lower index. Radii are taken per batch of rows, which is at most the ball's and still bounds all parts it is used for.

Each round reads and writes one table of rows with their codes, and sums are added up within tasks before they are shuffled. The driver sees
only codebooks: ``entries`` vectors, whatever the number of rows.

Rows are dropped whose vector is null, empty, holds null or non-finite components, or is of another length than the first kept one, in order
of id. Lengths that ``parts`` does not divide are filled up with zeros. Components beyond ``most`` in size (131,072 before scaling, for parts of 16) count as that, so that no sum
of squares passes 64 bits. Ids that repeat, or are null, are
rows of their own; null ids come last when the first codebook is picked, and equal ids are picked by their vectors. With fewer rows than ``entries`` the codebook
is as short; an empty table gives no rows. Only id, vector and label are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import checkpointed, lookup, slices, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
ROWS = 2048


def most(width: int) -> int:
    """The largest size of a component of parts that long."""
    return math.isqrt(2**60 // (4 * width))


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows and entries, as integers."""
    x, entries = np.ascontiguousarray(x), np.ascontiguousarray(entries)
    if not len(x) or not len(entries):
        return np.zeros((len(x), len(entries)), np.int64)
    top = int(max(np.abs(x).max(), np.abs(entries).max(), 1))
    if 4 * top * top * max(x.shape[1], 1) < 2**53:  # every sum below is a whole number that a double holds
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        d = x[:, k, None] - entries[None, :, k]
        out += d * d
    return out


class Balls:
    """The balls of one part's codebook: for each entry the others in order of their squared distance from it."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        between = squared(entries, entries)
        np.fill_diagonal(between, -1)  # the entry itself comes first
        self.order = np.argsort(between, axis=1, kind="stable")
        self.away = np.take_along_axis(between, self.order, 1)

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = squared(x, self.entries)
        code = d.argmin(1)
        return code, d[np.arange(len(x)), code]

    def again(self, x: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entries of parts whose nearest ones of the round before are ``held``."""
        off = x - self.entries[held]
        own = (off * off).sum(1)
        code, best = held.copy(), own.copy()
        ranks = np.argsort(held, kind="stable")
        starts = np.searchsorted(held[ranks], np.arange(len(self.entries) + 1))
        for ball in np.flatnonzero(np.diff(starts)):
            rows = ranks[starts[ball] : starts[ball + 1]]
            away = self.away[ball]
            neighbours = np.searchsorted(away, 4 * own[rows].max(), "right")  # itself and those at twice the radius or less
            reach = np.searchsorted(away[:neighbours], 4 * own[rows], "right")
            rows, reach = rows[reach > 1], reach[reach > 1]  # the others are in the stable core
            ring = np.ceil(np.log2(np.maximum(reach, 1))).astype(int)
            for r in np.unique(ring):
                here = rows[ring == r]
                near = np.sort(self.order[ball, : min(1 << int(r), neighbours)])  # in order of index, so that the first least is the lower one
                d = squared(x[here], self.entries[near])
                k = d.argmin(1)
                code[here], best[here] = near[k], d[np.arange(len(here)), k]
        return code, best


def whole_parts(vector: Column, parts: int, dim: int, scale: int) -> Column:
    """Components as integers, filled up with zeros to a multiple of ``parts``."""
    end = float(most(-(-dim // parts)))
    ints = F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-end)), F.lit(end))).cast("int"))
    return F.concat(ints, F.array_repeat(F.lit(0), -dim % parts)) if dim % parts else ints


def finite(vector: Column) -> Column:
    one = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(one(x), F.lit(False)))


def matrix(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def assigned(rows: DataFrame, books: list[np.ndarray], dim: int) -> DataFrame:
    """``rows`` (__id, __label, __v and, from the second round, __codes) with each part's nearest entry and squared distance."""
    parts = len(books)
    again = "__codes" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [Balls(b) for b in books]
        for batch in slices(batches, ROWS):
            x = matrix(batch, "__v", dim)
            held = matrix(batch, "__codes", parts) if again else None
            codes, errors = np.zeros((len(x), parts), np.int32), np.zeros((len(x), parts), np.int64)
            for k, part in enumerate(np.split(x, parts, axis=1)):
                codes[:, k], errors[:, k] = balls[k].again(part, held[:, k]) if again else balls[k].first(part)
            at = np.arange(0, codes.size + 1, parts, dtype=np.int32)
            told = [pa.ListArray.from_arrays(at, pa.array(v.ravel())) for v in (codes, errors)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("__id", "__label", "__v")), *told], ["__id", "__label", "__v", "__codes", "__errors"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, f"__id {kinds['__id']}, __label {kinds['__label']}, __v array<int>, __codes array<int>, __errors array<long>")


def moved(rows: DataFrame, books: list[np.ndarray], dim: int) -> list[np.ndarray]:
    """The codebooks after one update: the floor of each entry's mean; entries without parts stay."""
    parts, entries, width = len(books), len(books[0]), dim // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in slices(batches, ROWS):
            slot = (matrix(batch, "__codes", parts) + np.arange(parts) * entries).ravel()
            np.add.at(sums, slot, matrix(batch, "__v", dim).reshape(-1, width))
            counts += np.bincount(slot, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), *(pa.array(sums[used, k]) for k in range(width))], ["slot", "n", *(f"s{k}" for k in range(width))])

    partial = rows.select("__v", "__codes").mapInArrow(run, ", ".join(f"{c} long" for c in ["slot", "n", *(f"s{k}" for k in range(width))]))
    totals = partial.groupBy("slot").agg(F.sum("n"), *[F.sum(f"s{k}") for k in range(width)]).collect()  # one row an entry at most
    out = [b.copy() for b in books]
    for slot, n, *sums in totals:
        out[slot // entries][slot % entries] = [s // n for s in sums]
    return out


def book_text(books: list[np.ndarray]) -> str:
    return ",".join(str(c) for book in books for entry in book for c in entry)


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """Per kept row: id, label, ``code``, ``error``, ``label_error``; and the codebooks, one array of entries a part."""
    kept = vectors.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label"), F.col(vector_col).alias("__raw")).where(finite(F.col("__raw")))
    seeds = kept.orderBy(F.col("__id").asc_nulls_last(), F.transform("__raw", lambda x: x.cast("double"))).limit(1).select(F.size("__raw").alias("dim")).collect()
    length = seeds[0]["dim"] if seeds else parts
    rows = kept.where(F.size("__raw") == length).select("__id", "__label", whole_parts(F.col("__raw"), parts, length, scale).alias("__v"))
    dim = length + -length % parts
    seeds = [r["__v"] for r in rows.select("__id", "__v").orderBy(F.col("__id").asc_nulls_last(), "__v").limit(entries).collect()]
    books = np.split(np.array(seeds, np.int64).reshape(-1, dim), parts, axis=1)
    state = rows
    if seeds:
        for _ in range(rounds):
            state = written(assigned(state, books, dim).drop("__errors"), "vector-codes")
            books = moved(state, books, dim)
    code = F.array_join(F.transform("__codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    same = F.coalesce(F.concat(F.lit("="), F.col("__label").cast("string")), F.lit("")).alias("__same")
    scored = checkpointed(assigned(state, books, dim).select("__id", "__label", same, code.alias("code"), F.aggregate("__errors", F.lit(0).cast("long"), lambda a, b: a + b).alias("error")))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    labels = scored.groupBy("__same").agg(total.try_cast("long").alias("label_error"), F.count("*").alias("__uses"))
    return lookup(scored, labels, "__same", "__uses").select(F.col("__id").alias(id_col), F.col("__label").alias(label_col), "code", "error", "label_error"), books


def codebooks_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(book_text(books).encode()).hexdigest()
