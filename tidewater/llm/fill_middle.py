"""Fill-in-the-middle: texts cut into prefix, middle and suffix, and put in another order for training.

A text is read as units (white space and the run after it, or the white space at the end). It is laid in blocks of fixed size, and a
Fenwick tree over the blocks holds how many units end and how many code points begin in each. A cut after k units is found by
descending the tree by powers of two to the block that holds the k-th end; only that block is then searched. Texts
never leave their row, so nothing is shuffled, and a task holds a few texts at a time.

Null text counts as empty; empty texts, and those that hold a marker, stay plain. A null id draws as an empty one. Repeated rows
give repeated results; an empty table gives an empty one. Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import slices, utf8

BLOCK = 4096
#: Rows of a batch of results; a text is at most held twice.
ROWS = 64
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def unit_ends(data: np.ndarray, after: int | None) -> np.ndarray:
    """True on the last byte of each unit; ``after`` is the byte that follows the stretch, None at the end of the text."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    ends = np.empty(len(data), bool)
    ends[:-1] = ~space[:-1] & space[1:]
    ends[-1] = after is None or (not space[-1] and (after == 32 or 9 <= after <= 13))
    return ends


def fenwick(marked: np.ndarray, starts: np.ndarray) -> list[int]:
    """Node i, from 1, sums the i & -i blocks that end with block i."""
    sums = np.zeros(len(starts) + 1, np.int64)
    if len(starts):
        np.cumsum(np.add.reduceat(marked, starts, dtype=np.int64), out=sums[1:])
    at = np.arange(len(sums))
    return (sums - sums[at - (at & -at)]).tolist()


class TextTree:
    """Units and code points of a text's blocks in two Fenwick trees."""

    def __init__(self, text: bytes, block: int = BLOCK):
        self.data, self.block = np.frombuffer(text, np.uint8), block
        starts = np.arange(0, len(text), block)
        self.blocks = len(starts)
        ends = unit_ends(self.data, None) if self.blocks else np.zeros(0, bool)
        self.units = int(np.count_nonzero(ends))
        self.nodes = [fenwick(marked, starts) for marked in (ends, (self.data & 0xC0) != 0x80)]

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points up to the end of the k-th unit."""
        if k <= 0:
            return 0, 0
        at, left, chars, step = 0, k, 0, 1 << (self.blocks.bit_length() - 1)
        while step:
            if at + step <= self.blocks and self.nodes[0][at + step] < left:
                at += step
                left -= self.nodes[0][at]
                chars += self.nodes[1][at]
            step >>= 1
        start = at * self.block
        held = self.data[start : start + self.block]
        after = int(self.data[start + self.block]) if start + self.block < len(self.data) else None
        end = int(np.flatnonzero(unit_ends(held, after))[left - 1]) + 1
        return start + end, chars + int(np.count_nonzero((held[:end] & 0xC0) != 0x80))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, spm: int = 80, block: int = BLOCK) -> DataFrame:
    """Per row: id, ``n`` units, ``form`` (plain, psm, spm), code points of the three parts (null if plain) and the ``output``.

    ``rate`` and ``spm`` are per cent: of texts that are cut, and of these the ones whose suffix comes first. All draws come from the
    SHA-256 of seed and id, so they hold wherever a row is read.
    """
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            draws = np.stack([batch.column(f"__h{k}").to_numpy(zero_copy_only=False) for k in range(4)], 1).tolist() if batch.num_rows else []
            rows = []
            for text, (h1, h2, h3, h4) in zip(utf8(batch, "__text"), draws):
                tree = TextTree(text, block)
                n = tree.units
                if not text or h3 % 100 >= rate or any(mark in text for mark in marks):
                    rows.append((n, "plain", None, None, None, text))
                    continue
                (a, a_chars), (b, b_chars) = (tree.cut(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
                chars = int(np.count_nonzero((tree.data[b:] & 0xC0) != 0x80))
                if h4 % 100 < spm:
                    rows.append((n, "spm", a_chars, b_chars - a_chars, chars, b"".join([s, text[b:], p, text[:a], m, text[a:b]])))
                else:
                    rows.append((n, "psm", a_chars, b_chars - a_chars, chars, b"".join([p, text[:a], s, text[b:], m, text[a:b]])))
            columns = [list(c) for c in zip(*rows)] or [[]] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.large_binary()]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), *arrays[:5], arrays[5].cast(pa.large_string()).cast(pa.string())], ["__id", "n", "form", "prefix_chars", "middle_chars", "suffix_chars", "output"])

    kind = docs.schema[id_col].dataType.simpleString()
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    narrow = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), hexed.alias("__hex"))
    drawn = narrow.select("__id", "__text", *[F.conv(F.substring("__hex", 8 * k + 1, 8), 16, 10).cast("long").alias(f"__h{k}") for k in range(4)])
    return drawn.mapInArrow(run, f"__id {kind}, n long, form string, prefix_chars long, middle_chars long, suffix_chars long, output string").withColumnRenamed("__id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. A cut text holds no marker, and markers can't overlap, so the first of each is the one that was set."""
    width = len(PREFIX)
    suffix, prefix, middle = (F.instr(output, mark) for mark in (SUFFIX, PREFIX, MIDDLE))
    between = lambda a, b: F.substr(output, a + width, b - a - width)
    last = F.substr(output, middle + width)
    return F.when(form == "psm", F.concat(between(prefix, suffix), last, between(suffix, middle))).when(form == "spm", F.concat(between(prefix, middle), last, between(suffix, prefix))).otherwise(output)
