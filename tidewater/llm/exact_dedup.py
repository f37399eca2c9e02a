"""Exact duplicates by recipes of content-defined chunks.

Each text, its white space normalised, is cut where a rolling hash of the last 32 bytes says so, so equal
stretches give equal chunks wherever they stand. A chunk has a 64-bit fingerprint and the SHA-256 of its bytes.
The catalogue of distinct chunks verifies each fingerprint: one that stands for two different contents is told
apart by the digest. A text's recipe is the ordered list of its chunks' identifiers; texts are equal when their
recipes are. Only fingerprints, digests and recipes are shuffled, never the texts.

Null text counts as empty; all empty texts are equal. Rows with the same id and text are one group, of which the
first row read stays. Empty tables give empty results. Columns of the input that clash with the results are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import checkpointed, lookup, slices, utf8

LEAST, MOST, MASK = 1024, 16384, np.uint32(0x0FFF)
GEAR = np.random.default_rng(2024).integers(0, 2**32, 256, dtype=np.uint32)


def normalised(data: bytes) -> bytes:
    """Each run of ASCII white space becomes one space, also at the ends."""
    words = data.split()
    if not words:
        return b" " if data else b""
    return (b" " if data[:1].isspace() else b"") + b" ".join(words) + (b" " if data[-1:].isspace() else b"")


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks: LEAST to MOST bytes each, but the last."""
    n = len(data)
    if n <= LEAST:
        return [n]
    h = GEAR[np.frombuffer(data, np.uint8)]
    for k in (1, 2, 4, 8, 16):  # each step doubles the bytes that a position's hash holds
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    marks = np.flatnonzero((h & MASK) == 0) + 1
    ends, at = [], 0
    while n - at > LEAST:
        k = np.searchsorted(marks, at + LEAST)
        end = min(int(marks[k]) if k < len(marks) else n, at + MOST, n)
        ends.append(end)
        at = end
    if at < n:
        ends.append(n)
    return ends


def chunk(data: bytes) -> tuple[list[int], list[bytes]]:
    prints, digests, at = [], [], 0
    for end in cuts(data):
        piece = data[at:end]
        prints.append(xxhash.xxh3_64_intdigest(piece) - 2**63)
        digests.append(hashlib.sha256(piece).digest())
        at = end
    return prints, digests


def chunked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``__row`` (a number of its own), ``__id``, ``text_sha256``, ``__prints`` and ``__digests``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [normalised(b) for b in utf8(batch, "__text")]
            found = [chunk(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([hashlib.sha256(t).hexdigest() for t in texts]), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.binary()))],
                ["__row", "__id", "text_sha256", "__prints", "__digests"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return narrow.mapInArrow(run, f"__row long, __id {kind}, text_sha256 string, __prints array<long>, __digests array<binary>")


def catalogue(rows: DataFrame) -> DataFrame:
    """Distinct chunks: fingerprint, its least digest, whether the fingerprint stands for one content, and uses."""
    pairs = rows.select(F.explode(F.arrays_zip("__prints", "__digests")).alias("c")).select(F.col("c.__prints").alias("print"), F.col("c.__digests").alias("digest"))
    return pairs.groupBy("print").agg(F.min("digest").alias("digest"), (F.min("digest") == F.max("digest")).alias("verified"), F.count("*").alias("uses"))


def recipes(rows: DataFrame) -> DataFrame:
    """Add ``__recipe``: the ordered identifiers of each row's chunks, as text of bounded digest length for keys.

    An identifier is the fingerprint where the catalogue verifies it, else the chunk's digest. Only the
    unverified fingerprints join the rows; there is none unless two contents share 64 bits.
    """
    bad = catalogue(rows).where(~F.col("verified")).select("print")
    clashing = rows.select("__row", F.explode("__prints").alias("print")).join(bad, "print").groupBy("__row").agg(F.collect_set("print").alias("__bad"))
    joined = rows.join(clashing, "__row", "left")
    ids = F.transform(F.arrays_zip("__prints", "__digests"), lambda c: F.when(F.array_contains(F.col("__bad"), c["__prints"]), F.hex(c["__digests"])).otherwise(F.hex(c["__prints"])))
    return joined.withColumn("__recipe", F.sha2(F.concat_ws(",", ids), 256)).drop("__bad", "__prints", "__digests")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of the input: ``__row``, id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    rows = checkpointed(recipes(checkpointed(chunked(docs, id_col, text_col))))
    best = F.min(F.struct(F.col("__id").isNull().alias("null"), F.col("__id").alias("id"), F.col("__row").alias("row")))
    groups = checkpointed(rows.groupBy("__recipe").agg(best.alias("__best"), F.count("*").alias("__n")).where("__n > 1"))
    out = lookup(rows, groups, "__recipe", "__n")  # blank texts may be a third of all rows
    return out.select(
        "__row",
        F.col("__id").alias(id_col),
        F.when(F.col("__n") > 1, F.col("__best.id")).otherwise(F.col("__id")).alias("keep_id"),
        F.coalesce("__n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("__best.row") == F.col("__row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the input that stay, with the input's columns."""
    dropped = exact_groups(docs, id_col, text_col).where(~F.col("kept")).select(F.col("__row").alias("__tw_row"))
    return docs.withColumn("__tw_row", F.monotonically_increasing_id()).join(dropped, "__tw_row", "left_anti").drop("__tw_row")
