"""Benchmark decontamination by latent semantic retrieval.

Words are lower-cased, stripped of ASCII punctuation and hashed, to 64 bits for comparison and to ``2**15`` terms for retrieval. Inverse document frequencies are
counted over all documents. The index is the matrix of the benchmark items' TF-IDF rows, brought to ``rank``
dimensions by a randomised SVD: its products with the matrix run in Spark tasks, which send sums per term; only
matrices bounded by terms x rank reach the driver. Every document is read as passages of 32 words, 16 apart. Each passage
is projected, and an item is a candidate where the cosine is ``cosine`` or more (against the passage's whole TF-IDF
norm, so that unknown words count). ``rank`` dimensions hold a benchmark of so many items in full and ever less of a larger one:
an item of whose squared length they hold less than ``held`` is searched by its terms' lists of items instead, which give
the cosine itself. For the others, what the dimensions dropped could add to the cosine is taken off the limit, so no
passage over it is lost. The candidate is checked on the words:
the longest common subsequence of the item and the passage with an item's length around it must hold ``sure`` of the
item's words, or ``likely`` of them and as much of its answer, its last six words.

Terms of half of all texts would cost most and tell least: what they could add to a cosine is bounded by the product of
their norms, and they are added where that bound leaves a pair open, so the cosine is that of all terms.

Items of fewer than ``least`` words match where a text holds their words in a row. Null and empty texts and items without words
match nothing. Rows are told apart by id and text: repeated rows, and rows of one id or none, each give their own row. Items with
equal text are each reported, items without id are not read. Long texts are read whole, some thousand words at a time. Columns
of other names are not read. Empty tables give empty results. The items are read by the driver in blocks of at most ``block`` items and ``block_bytes`` of
text (or one longer item), each searched in all documents and its finds written before the next is read, so the index is bounded on the driver and in a task, whatever the benchmark's size.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import checkpointed, lowered, slices, utf8

TERMS = 1 << 15
STRIDE = 16
ANSWER = 6
#: Inverse document frequency under which a term is in half of all texts; such terms are added last.
COMMON = 0.7
#: Blocks of STRIDE words that are scored together.
PART = 256
PUNCTUATION = string.punctuation.encode()


class Vocabulary(dict):
    """Hash of a word; forgets when it grows large and keeps no long ones."""

    def __missing__(self, word: bytes) -> int:
        hashed = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) > 500_000:
                self.clear()
            self[word] = hashed
        return hashed

    def words(self, data: bytes) -> np.ndarray:
        words = lowered(data).translate(None, PUNCTUATION).split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def terms_of(words: np.ndarray) -> np.ndarray:
    return (words & np.uint64(TERMS - 1)).astype(np.int32)


def hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``__row`` (a number of its own), ``__id``, ``__mark`` (a hash of the text) and ``words``, their hashes in order; texts are cut into words once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary()
        for batch in slices(batches):
            words = pa.array([known.words(t).tobytes() for t in utf8(batch, "__text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], words], ["__row", "__id", "__mark", "words"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__mark"), F.col(text_col).alias("__text"))
    return rows.mapInArrow(run, f"__row long, __id {kind}, __mark long, words binary")


def document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Rows of the table and, for each term, the rows that hold it; over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(TERMS + 1, np.int64), 0
        for batch in slices(batches):
            for words in batch.column("words").to_pylist():
                held[np.unique(terms_of(np.frombuffer(words, np.uint64)))] += 1
                n += 1
        held[TERMS] = n
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(held[used], pa.int64())], ["term", "n"])

    counted = rows.select("words").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()  # at most TERMS + 1 rows
    out = np.zeros(TERMS + 1, np.int64)
    out[counted["term"].to_numpy(int)] = counted["n"].to_numpy(np.int64)
    return int(out[TERMS]), out[:TERMS]


def randomised_svd(rows: DataFrame, rank: int, seed: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors, at most ``rank``, of the matrix whose rows have ``terms`` and ``weights``: (terms in use, vectors).

    One power step finds the range of the transpose from random projections; the Gram matrix in that range gives the vectors.
    """
    context = rows.sparkSession.sparkContext
    wide = rank + 8

    def products(basis) -> DataFrame:
        """Sums over the rows a of a' (a basis), by term; part keeps each sum small."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for terms, weights in zip(batch.column("terms").to_pylist(), batch.column("weights").to_pylist(), strict=True):
                    held = basis() if held is None else held
                    terms, weights = np.array(terms, int), np.array(weights, np.float64)
                    y = weights @ held[terms]
                    for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
                        sums[t] = sums[t] + w * y if t in sums else w * y
            yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["term", "sums"])

        def add(frame):
            total = frame.groupby("term")["sums"].agg(lambda own: np.sum([np.frombuffer(b, np.float64) for b in own], axis=0).tobytes())
            return total.reset_index()

        return rows.mapInArrow(run, "term int, sums binary").groupBy(F.col("term") % 64).applyInPandas(add, "term int, sums binary")

    found = products(lambda: np.random.default_rng(seed).standard_normal((TERMS, wide))).toPandas().sort_values("term")  # at most TERMS rows
    used = found["term"].to_numpy(int)
    if not len(used):
        return used, np.zeros((0, 1))
    q, _ = np.linalg.qr(np.array([np.frombuffer(b, np.float64) for b in found["sums"]]))
    shared = context.broadcast((used, q))  # terms in use x (rank + 8)

    def held() -> np.ndarray:
        terms, vectors = shared.value
        out = np.zeros((TERMS, vectors.shape[1]))
        out[terms] = vectors
        return out

    again = products(held).toPandas().sort_values("term")
    gram = q.T @ np.array([np.frombuffer(b, np.float64) for b in again["sums"]])
    values, turns = np.linalg.eigh((gram + gram.T) / 2)
    best = np.argsort(-values)[:rank]
    best = best[values[best] > 1e-9 * max(values.max(), 1e-30)]
    return used, q @ turns[:, best]


def word_bits(item: list[int]) -> dict[int, int]:
    """For each word of an item, a bit for each place where it stands."""
    where: dict[int, int] = {}
    for k, t in enumerate(item):
        where[t] = where.get(t, 0) | 1 << k
    return where


def common_subsequence(where: dict[int, int], size: int, text: list[int]) -> int:
    """Length of the longest common subsequence of an item, given by its word bits, and a text."""
    row = full = (1 << size) - 1
    for hit in filter(None, map(where.get, text)):
        both = row & hit
        row = ((row + both) | (row - both)) & full
    return size - row.bit_count()


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """Per row of the documents: id, ``items`` (item, best cosine, share of its words, share of its answer) and ``contaminated``."""
    return found_items(docs, benchmark, id_col=id_col, **settings).select(F.col("__id").alias(id_col), "items", "contaminated")


def found_items(docs: DataFrame, benchmark: DataFrame, rank: int = 200, cosine: float = 0.3, sure: float = 0.8, likely: float = 0.6, least: int = 5, block: int = 20_000, held: float = 0.99, block_bytes: int = 1 << 26, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row: ``__id``, ``__mark``, ``items`` and ``contaminated``."""
    spark = docs.sparkSession
    known = Vocabulary()
    given = benchmark.select(F.col(item_col), F.col(item_text_col)).where(F.col(item_col).isNotNull())
    texts = checkpointed(hashed(docs, id_col, text_col))
    n, df = document_frequencies(texts)
    idf = np.maximum(np.log((n + 1) / (df + 1)), 0.05).astype(np.float32)
    item_kind = benchmark.schema[item_col].dataType
    found = f"array<struct<item:{item_kind.simpleString()},cosine:double,words:double,answer:double>>"
    id_kind = docs.schema[id_col].dataType.simpleString()
    kind = found if item_kind.typeName() in ("long", "string") else found.replace(item_kind.simpleString(), "bigint", 1)
    arrow_item = pa.int64() if item_kind.typeName() in ("long", "integer") else pa.string()
    blocks = in_blocks(given, known, block, block_bytes)
    out, several, after = None, False, next(blocks, [])
    while after is not None:
        part, after = after, next(blocks, None)
        several = several or after is not None
        short, part = [(i, w) for i, w in part if len(w) < least], [(i, w) for i, w in part if len(w) >= least]
        rows = []
        for _, words in part:
            own, counts = np.unique(terms_of(words), return_counts=True)
            weights = counts * idf[own]
            rows.append(([int(t) for t in own], [float(w) for w in weights / np.linalg.norm(weights)]))
        matrix = spark.createDataFrame(rows, "terms array<int>, weights array<double>").repartition(max(1, len(rows) // 500))
        used, vectors = randomised_svd(matrix, rank) if rows else (np.zeros(0, int), np.zeros((0, 1)))
        basis = np.zeros((TERMS, vectors.shape[1]), np.float32)
        basis[used] = vectors
        latent = np.array([np.array(w, np.float32) @ basis[t] for t, w in rows], np.float32).reshape(len(rows), vectors.shape[1])
        told = idf >= COMMON
        kept = (latent.astype(np.float64) ** 2).sum(axis=1)  # of 1, the squared length of an item
        order = np.argsort(kept < held, kind="stable")  # first the items that the dimensions hold, then those searched by terms
        index, lists = latent[kept >= held], term_lists([rows[j] for j in order[len(rows) - int((kept < held).sum()) :]], told, idf)
        limits = np.append(cosine - np.sqrt(np.maximum(1 - kept[kept >= held], 0)), np.full(int((kept < held).sum()), cosine))
        used = used[told[used]] if len(index) else used[:0]
        scaled = basis[used] * idf[used, None]
        few = len(index) <= rank
        common = [{t: w * float(idf[t]) for t, w in zip(*rows[j], strict=True) if not told[t]} for j in order]
        norms = np.array([sum((w / float(idf[t])) ** 2 for t, w in c.items()) ** 0.5 for c in common])
        wanted = [(i, w.tolist(), word_bits(w.tolist()), word_bits(w.tolist()[-ANSWER:])) for i, w in (part[j] for j in order)]
        shared = spark.sparkContext.broadcast((scaled @ index.T if few else scaled, used, idf, None if few else index, lists, limits, wanted, (common, norms), short))  # terms in use x rank

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            table, own, weight, index, lists, limits, wanted, common, short = shared.value
            place = np.full(TERMS, -1, np.int32)
            place[own] = np.arange(len(own))
            for batch in slices(batches):
                hits = []
                for words in batch.column("words").to_pylist():
                    words = np.frombuffer(words, np.uint64)
                    hits.append(search(words, table, place, weight, index, lists, limits, wanted, common, sure, likely) + in_a_row(words, short))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(hits, pa.list_(pa.struct([("item", arrow_item), ("cosine", pa.float64()), ("words", pa.float64()), ("answer", pa.float64())])))], ["__row", "__id", "__mark", "items"])

        own = texts.mapInArrow(run, f"__row long, __id {id_kind}, __mark long, items {kind}")
        if several:
            own = checkpointed(own.where(F.size("items") > 0).select("__row", "items"))
            shared.destroy()
        out = own if out is None else out.unionByName(own)
    if several:
        out = texts.drop("words").join(out.groupBy("__row").agg(F.flatten(F.collect_list("items")).alias("items")), "__row", "left").withColumn("items", F.coalesce("items", F.array().cast(kind)))
    return out.select("__id", "__mark", "items", (F.size("items") > 0).alias("contaminated"))


def in_blocks(given: DataFrame, known: Vocabulary, block: int, block_bytes: int) -> Iterator[list[tuple]]:
    """The items that have words, with these, as the driver comes to them."""
    held, size = [], 0
    for item, text in given.toLocalIterator():
        data = (text or "").encode()
        words = known.words(data)
        if len(words):
            held.append((item, words))
            size += len(data)
        if len(held) >= block or size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def in_a_row(words: np.ndarray, short: list) -> list[dict]:
    """The short items whose words stand in a row in the text."""
    found = []
    for item, own in short:
        at = np.flatnonzero(words[: len(words) - len(own) + 1] == own[0]) if len(words) >= len(own) else words[:0].astype(int)
        if any((words[k : k + len(own)] == own).all() for k in at):
            found.append({"item": item, "cosine": 1.0, "words": 1.0, "answer": 1.0})
    return found


def term_lists(rows: list[tuple[list[int], list[float]]], told: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """For each term, where its items' numbers and weights begin, those numbers and weights, and how many items there are."""
    terms = np.array([t for own, _ in rows for t in own], int)
    values = np.array([w for _, own in rows for w in own], np.float64) * idf[terms]
    numbers = np.repeat(np.arange(len(rows)), [len(own) for own, _ in rows])
    order = np.flatnonzero(told[terms])
    order = order[np.argsort(terms[order], kind="stable")]
    return np.searchsorted(terms[order], np.arange(TERMS + 1)), numbers[order], values[order], len(rows)


def listed(terms: np.ndarray, norms: np.ndarray, lists: tuple, limits: np.ndarray, room: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages, items and cosines of the pairs over the items' limits, in order; the items are those of ``term_lists``."""
    starts, numbers, values, many = lists
    sizes = starts[terms.astype(int) + 1] - starts[terms]
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    at = np.arange(ends[-1]) + np.repeat(starts[terms] - (ends - sizes), sizes)
    block = np.repeat(np.arange(len(terms)) // STRIDE, sizes)
    # a block of words is the first half of its passage and the second of the one before
    keys = np.concatenate([block * many + numbers[at], (block - 1) * many + numbers[at]])
    inside = (keys >= 0) & (keys < len(norms) * many)
    keys, added = keys[inside], np.tile(values[at], 2)[inside]
    if len(norms) * many <= 8 * len(keys):
        sums = np.bincount(keys, added, len(norms) * many)
        keys = np.flatnonzero(sums)
        sums = sums[keys]
    else:
        keys, own = np.unique(keys, return_inverse=True)
        sums = np.bincount(own, added)
    scores = sums / np.sqrt(norms[keys // many])
    over = scores >= limits[keys % many] - room[keys // many] * shares[keys % many]
    return keys[over] // many, keys[over] % many, scores[over]


def search(words: np.ndarray, table: np.ndarray, place: np.ndarray, weight: np.ndarray, index: np.ndarray | None, lists: tuple, limits: np.ndarray, wanted: list, common: tuple[list, np.ndarray], sure: float, likely: float) -> list[dict]:
    """Items that a text holds; all its passages are looked at, some thousand words at a time.

    ``table`` has the latent rows of the terms in use, or, if ``index`` is None, their products with the first items;
    ``lists`` has the other items, by term. Both leave out common terms, whose share ``common`` has, by item, with its norms.
    """
    best: dict[int, dict] = {}
    if len(words) == 0 or not wanted:
        return []
    terms = terms_of(words)
    plain = weight[terms] < COMMON
    shares, shares_norm = common
    widest = float(shares_norm.max())
    places = place[terms]
    blocks = -(-len(terms) // STRIDE)
    squares = weight[terms].astype(np.float64) ** 2
    for first in range(0, blocks, PART):
        low, high = first * STRIDE, min(len(terms), (first + PART + 1) * STRIDE)
        used = np.flatnonzero(places[low:high] >= 0)
        if not len(used) and not lists[3] and widest < limits.min():
            continue
        n = -(-(high - low) // STRIDE)
        norms = np.add.reduceat(squares[low:high], np.arange(n) * STRIDE)
        rest = np.add.reduceat(np.where(plain[low:high], squares[low:high], 0.0), np.arange(n) * STRIDE)
        if n > 1:
            norms, rest = norms[:-1] + norms[1:], rest[:-1] + rest[1:]
        # what common terms could add at most, by Cauchy and Schwarz: this for each passage times the item's norm of them
        room = np.sqrt(rest / norms)
        found: list[tuple[int, int, float]] = []
        if index is not None or table.shape[1]:
            edges = np.searchsorted(used, np.arange(n) * STRIDE)
            held = edges < np.append(edges[1:], len(used))
            sums = np.zeros((n, table.shape[1]), np.float32)
            sums[held] = np.add.reduceat(table[places[low:high][used]], edges[held], axis=0)
            if n > 1:
                sums = sums[:-1] + sums[1:]
            scores = (sums if index is None else sums @ index.T) / np.sqrt(norms)[:, None]
            over = np.nonzero(scores >= limits[: scores.shape[1]] - room[:, None] * shares_norm[: scores.shape[1]])
            found += zip(*(a.tolist() for a in over), scores[over].tolist(), strict=True)
        if lists[3]:
            first_listed = len(wanted) - lists[3]
            k, j, scored = listed(terms[low:high], norms, lists, limits[first_listed:], room, shares_norm[first_listed:])
            found += zip(k.tolist(), (j + first_listed).tolist(), scored.tolist(), strict=True)
        last: dict[int, int] = {}
        for k, j, score in found:
            start = low + k * STRIDE
            if shares[j]:
                score += sum(map(shares[j].get, terms[start : min(high, start + 2 * STRIDE)].tolist(), itertools.repeat(0.0))) / norms[k] ** 0.5
            if score < limits[j]:
                continue
            item, own, bits, answer = wanted[j]
            size = len(own)
            if last.get(j) == k - 1 or (j in best and best[j]["words"] == 1.0):  # what was looked at around the passage before holds this one too
                if j in best:
                    best[j]["cosine"] = max(best[j]["cosine"], score)
                continue
            last[j] = k
            region = words[max(0, start - size) : start + 3 * STRIDE + size].tolist()
            share = common_subsequence(bits, size, region) / size
            if share < likely:
                continue
            tail = min(ANSWER, size)
            end = common_subsequence(answer, tail, region) / tail
            if (share >= sure or end >= likely) and (j not in best or best[j]["words"] < share):
                best[j] = {"item": item, "cosine": max(score, best.get(j, {}).get("cosine", 0.0)), "words": share, "answer": end}
    return [best[j] for j in sorted(best)]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows that hold no item, with the input's columns; rows are told apart by id, which may be null, and text."""
    found = found_items(docs, benchmark, id_col=id_col, text_col=text_col, **settings).where("contaminated")
    dropped = found.select(F.col("__id").alias("__tw_id"), F.col("__mark").alias("__tw_mark"))
    return docs.join(dropped, F.col(id_col).eqNullSafe(F.col("__tw_id")) & (F.xxhash64(text_col) == F.col("__tw_mark")), "left_anti")
