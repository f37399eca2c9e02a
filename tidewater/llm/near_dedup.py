"""Near-duplicate documents: a multi-index Hamming join over b-bit MinHash signatures.

A text's set holds the hashes of its distinct ``shingle``-word shingles (ASCII letters in lower case; with fewer
words, the whole sequence is one). Its signature is 60 symbols of 16 bits, one for each MinHash. Two signatures at
distance d differ in d symbols. They are split into 12 chunks of 5 symbols and each chunk may hold one error, which
is enumerated as 5 keys that each leave one symbol out. By the pigeonhole principle every pair at distance 23 or
less meets in some key; of pairs at similarity 0.8 all but one in ten million do. Pairs that meet are tested on a longer
sketch (AGREE of 192 symbols equal, which all but one in a million pairs at 0.8 reach) and then on their full sets.

Only components are asked for, so a bucket never gives all its pairs. First each member is tested against the bucket's
least member. Buckets that still hold several components are open: members outside the largest one could join it or each
other. Members of open buckets of at most ``few`` are tested against all of other components. Larger open
buckets are split first: two sets with the asked share of common shingles share one of their rarest shingles
(so many that the others are too few to reach it), so members meet again only at such a shingle, or, if their sets
have more than ``LONG`` shingles, at their chunks' keys. There, too, the least member comes first, then members drawn from the
largest component, and last all pairs that could still join two components. These are looked at in tiles, block of
members against block, so a group of any size is spread over tasks; a task compares sketches and gives out only the
likely pairs, each at the least key that its two members share. No pair that could join two components goes untested.

Equal sets are one node. Null and blank texts have empty sets, are linked with nothing and are
their own component. Rows of one id are linked through their own texts only, and an id that stands before two texts
links neither to the other. A null id is linked with nothing, gives a null component and is kept. Repeated rows share their
fate. Long texts are read whole, one at a time. Columns of other names are not read. Empty tables give empty results.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import checkpointed, compact, counted, lookup, slices, utf8

CHUNKS, WIDE = 12, 5
SYMBOLS = CHUNKS * WIDE
#: More MinHashes of 8 bits each, with the first 60 packed into words of 8, tell unlike pairs before their sets are read.
SKETCH = 192
#: Five standard deviations under the mean agreement of pairs at similarity 0.8, 153.6 of 192.
AGREE = 126
#: Ids of texts to read again are broadcast up to this number, some 30 bytes each; beyond it both sides are shuffled.
BROADCAST_IDS = 200_000
#: Members outside a group's largest component that make a block (it meets blocks of eight times as many), and members drawn from it.
BLOCK, DRAWS = 512, 4
#: Bytes of all sets that a block of a tile may hold, about.
TILE = 32 << 20
#: Symbols of the sketches in crowded buckets, where most pairs are near the limit.
WIDER = 640
#: Sets of more shingles than this meet at chunk keys, of which there are few; those from four fifths of it to five fourths do both.
LONG = 1000
#: Counters by which shingles in crowded buckets are put in order.
SLOTS = 1 << 19
DRAWN = np.random.default_rng(60)
SLOPES = DRAWN.integers(0, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = DRAWN.integers(0, 2**63, SKETCH, dtype=np.uint64)
MORE_SLOPES = DRAWN.integers(0, 2**63, WIDER, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MORE_SHIFTS = DRAWN.integers(0, 2**63, WIDER, dtype=np.uint64)
PLACES = DRAWN.integers(0, 2**63, (CHUNKS, WIDE), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LEFT_OUT = DRAWN.integers(0, 2**63, (CHUNKS, WIDE), dtype=np.uint64)
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def grown(rows: DataFrame) -> DataFrame:
    """A join's side that grows with the input: shuffled at any size.

    The many joins here would each turn into a broadcast where the input is small, after their shuffles, and each of these leaves megabytes with the driver.
    """
    return rows.hint("merge")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(data: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = data.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(shingle, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out * STEP) ^ hashes[k : k + n]
        out = mixed(out) if k < size - 1 else out
    return np.unique(mixed(out))


def signature(own: np.ndarray, slopes: np.ndarray = SLOPES, shifts: np.ndarray = SHIFTS) -> np.ndarray:
    least = np.full(len(slopes), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 2048):
        least = np.minimum(least, (slopes[:, None] * own[None, at : at + 2048] + shifts[:, None]).min(axis=1))
    return mixed(least) >> np.uint64(48)


def packed(symbols: np.ndarray) -> np.ndarray:
    """The low bytes of all symbols, 8 to a word."""
    return symbols.astype(np.uint8).view(np.int64)


def agreement(a: str, b: str):
    """Column: how many bytes of two packed sketches are equal; bit operations only."""
    different = F.lit(0)
    for k in range(SKETCH // 8):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        different = different + F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return F.lit(SKETCH) - different


def alike(percent: int):
    """Column over n_a, n_b, s_a and s_b: what sizes and sketches do not rule out."""
    return (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (agreement("s_a", "s_b") >= AGREE)


def chunk_keys(symbols: np.ndarray) -> np.ndarray:
    """The keys of all chunks: each chunk's symbols but one."""
    parts = symbols[:SYMBOLS].reshape(CHUNKS, WIDE) * PLACES
    parts = mixed(parts)
    return mixed(parts.sum(axis=1, keepdims=True) - parts + LEFT_OUT).reshape(-1).view(np.int64)


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """From (__id, __text): ``same`` (the digest of the set) and ``own``, the set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            own = [shingle_set(t, shingle).tobytes() for t in utf8(batch, "__text")]
            yield pa.RecordBatch.from_arrays([pa.array(map(xxhash.xxh3_128_digest, own), pa.binary()), pa.array(own, pa.binary())], ["same", "own"])

    return docs.select("__text").mapInArrow(run, "same binary, own binary")


def signed(docs: DataFrame, shingle: int) -> DataFrame:
    """From (__id, __mark, __text): id, mark, ``n`` (set size), ``same`` (a digest of the set), ``symbols`` (the packed sketch) and ``keys``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            sizes, same, symbols, keys = [], [], [], []
            for text in utf8(batch, "__text"):
                own = shingle_set(text, shingle)
                sizes.append(len(own))
                same.append(xxhash.xxh3_128_digest(own.tobytes()))
                held = signature(own) if len(own) else None
                symbols.append(None if held is None else packed(held))
                keys.append(None if held is None else chunk_keys(held))
            columns = [pa.array(sizes, pa.int64()), pa.array(same, pa.binary()), pa.array(symbols, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__mark"), *columns], ["__id", "__mark", "n", "same", "symbols", "keys"])

    return docs.mapInArrow(run, f"__id {docs.schema['__id'].dataType.simpleString()}, __mark long, n long, same binary, symbols array<long>, keys array<long>")


def sets_of(nodes: DataFrame, reps: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, own) of the nodes named; their texts are read again by id and told apart by the digest of their sets."""
    needed, seen = counted(nodes.select("node").distinct().join(grown(reps.select("node", "rep", "same")), "node"))
    few = seen["rows"] <= BROADCAST_IDS
    ids = needed.select(F.col("rep").alias("__id")).distinct()
    own = _sets(docs.join(F.broadcast(ids) if few else ids, "__id", "left_semi"), shingle)
    return compact(own.join(F.broadcast(needed) if few else needed, "same").select("node", "own").dropDuplicates(["node"]))


def likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that sizes and sketches do not rule out, with their sizes n_a and n_b."""
    a = reps.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("symbols").alias("s_a"))
    b = reps.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("symbols").alias("s_b"))
    return pairs.join(grown(a), "a").join(grown(b), "b").where(alike(percent)).select("a", "b", "n_a", "n_b")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, int]:
    """Of the pairs (a, b) of nodes, of sizes n_a and n_b, those whose full sets are alike, and their number.

    Nodes are dealt into blocks by hash and pairs into tiles, so a set goes once to each tile that needs it, whatever the number of its pairs.
    """
    pairs, seen = counted(pairs, total=8 * (F.col("n_a") + F.col("n_b")))  # a set has 8 bytes a shingle
    if not seen["rows"]:
        return pairs.select("a", "b"), 0
    total = seen["total"]
    if total // TILE >= 6:  # a set counts once, whatever the number of its pairs
        total = pairs.select("a", "n_a").union(pairs.select("b", "n_b")).distinct().agg(F.sum(8 * F.col("n_a"))).first()[0]
    blocks = max(6, total // TILE + 1)
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    pairs = pairs.select(block("a").alias("at_a"), block("b").alias("at_b"), "a", "b")
    uses = pairs.select("at_a", "at_b", F.col("a").alias("node")).union(pairs.select("at_a", "at_b", F.col("b").alias("node"))).distinct()
    nothing = F.lit(None)
    rows = pairs.select("at_a", "at_b", "a", "b", nothing.cast("binary").alias("own")).unionByName(uses.join(grown(sets), "node").select("at_a", "at_b", F.col("node").alias("a"), nothing.cast("long").alias("b"), "own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, ["at_a", "at_b"]):
            a, b, own = (tile.column(c).to_pylist() for c in ("a", "b", "own"))
            sets = {x: np.frombuffer(o, np.uint64) for x, y, o in zip(a, b, own, strict=True) if y is None}
            found = []
            for i, j in zip(a, b, strict=True):
                if j is not None:
                    x, y = sets[i], sets[j]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        found.append((i, j))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    links, seen = counted(rows.repartition("at_a", "at_b").sortWithinPartitions("at_a", "at_b").mapInArrow(run, "a long, b long"))
    return links, seen["rows"]


def slot_counts(sets: DataFrame) -> np.ndarray:
    """How many shingles of the sets fall into each of ``SLOTS`` counters; tasks send packed parts of the counters, which are added by part."""
    part = SLOTS // 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for own in batch.column("own").to_pylist():
                np.add.at(held, (np.frombuffer(own, np.uint64) % np.uint64(SLOTS)).astype(np.int64), 1)
        used = [k for k in range(64) if held[k * part : (k + 1) * part].any()]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([zlib.compress(held[k * part : (k + 1) * part].tobytes(), 1) for k in used], pa.binary())], ["part", "held"])

    def add(frame):
        total = np.sum([np.frombuffer(zlib.decompress(b), np.int64) for b in frame["held"]], axis=0)
        return frame.head(1)[["part"]].assign(held=[zlib.compress(total.tobytes(), 1)])

    out = np.zeros(SLOTS, np.int64)
    for r in sets.select("own").mapInArrow(run, "part int, held binary").groupBy("part").applyInPandas(add, "part int, held binary").collect():  # at most 64 rows
        out[r.part * part : (r.part + 1) * part] = np.frombuffer(zlib.decompress(r.held), np.int64)
    return out


def split_buckets(sets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(key, node): each node's rarest shingles among the nodes, as many as one of them must be shared by any set alike; of long sets the chunk keys.

    Rarity is that of the shingle's counter, which only orders: any order is right if it is one for all.
    """
    uses = sets.sparkSession.sparkContext.broadcast(slot_counts(sets))  # 8 bytes x SLOTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found = []
            for own in (np.frombuffer(b, np.uint64) for b in batch.column("own").to_pylist()):
                room = len(own) + (-len(own) * percent) // 100 + 1 if 80 * len(own) <= 100 * LONG else 0
                held = uses.value[(own % np.uint64(SLOTS)).astype(np.int64)]
                first = np.lexsort((own, held))[:room]
                found.append(own[first][held[first] > 1].view(np.int64))  # what one node holds brings nobody together
            nodes = np.repeat(batch.column("node").to_numpy(), list(map(len, found)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *found])), pa.array(nodes, pa.int64())], ["key", "node"])

    long_ = reps.where(100 * F.col("n") > 80 * LONG).join(grown(sets.select("node")), "node", "left_semi")
    return compact(sets.mapInArrow(run, "key long, node long").unionByName(long_.select(F.explode("keys").alias("key"), "node")))


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, component) of the edges (a, b) of one task."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    found = [(x, top(x)) for x in list(up)]
    found = [f for f in found if f[0] != f[1]]
    yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["id", "component"])


def components(edges: DataFrame, alone: int = 200_000, most: int | None = None) -> DataFrame:
    """From edges (a, b): (id, component), the least id that each node reaches; large star and small star until all are stars.

    At most ``alone`` edges, some MB, are joined up in one task, which gives the same without the rounds. ``most`` is a bound of the edges' number, where one is known.
    """
    return bounded_components(edges, alone, most)[0]


def bounded_components(edges: DataFrame, alone: int = 200_000, most: int | None = None) -> tuple[DataFrame, int]:
    """``components``, and a bound of their rows' number."""
    held = edges
    if most is None or most > alone:
        held, seen = counted(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        most = seen["rows"]
    if most <= alone:
        found, seen = counted(held.coalesce(1).mapInArrow(forest, "id long, component long"))
        return found, seen["rows"]
    while True:
        roles = held.select(F.col("a").alias("id"), F.lit(0).alias("leaf")).union(held.select(F.col("b").alias("id"), F.lit(1).alias("leaf")))
        if roles.groupBy("id").agg(F.sum("leaf").alias("leaf"), F.min("leaf").alias("least")).where("leaf > 1 or (leaf = 1 and least = 0)").isEmpty():
            return held.select(F.col("b").alias("id"), F.col("a").alias("component")), most
        # large star: each node points its larger neighbours at the least node around it
        ways = held.unionByName(held.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = ways.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").distinct()
        # small star: each node points its smaller neighbours and itself at the least of them
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")).union(least.select(F.col("m").alias("a"), "b"))
        held = checkpointed(small.distinct())


def to_hubs(held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (key, node): the members of keys of several nodes, and the pairs (a, b) of each with its key's least node."""
    hubs = held.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("hub")).where("members > 1")
    members = compact(held.join(grown(hubs), "key"))
    return members, members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()


def open_members(members: DataFrame, groups: DataFrame) -> DataFrame | None:
    """Members, with their component, of keys of several components, if there are any; ``top`` is the largest of these, ``outside`` the number of members not in it."""
    placed = members.select("key", "node", "members").join(grown(groups), F.col("node") == F.col("id"), "left").select("key", "node", "members", F.coalesce("component", "node").alias("component"))
    placed = compact(placed)
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("key").agg(F.count("*").alias("components"), F.sum("size").alias("all"), F.max(F.struct("size", "component")).alias("t")).where("components > 1")
    placed, seen = counted(placed.join(grown(largest.select("key", F.col("t.component").alias("top"), (F.col("all") - F.col("t.size")).alias("outside"))), "key"))
    return placed if seen["rows"] else None


def to_draws(placed: DataFrame) -> DataFrame:
    """Pairs of each member outside the largest component with ``DRAWS`` members of it, drawn for that key."""
    order = F.struct(F.xxhash64("key", "node").alias("draw"), "node")
    drawn = placed.where("component = top").groupBy("key").agg(*[F.min(F.when(F.pmod(F.xxhash64("node", F.lit(9)), F.lit(DRAWS)) == k, order)).alias(f"d{k}") for k in range(DRAWS)])
    drawn = drawn.select("key", F.explode(F.filter(F.array(*[F.col(f"d{k}") for k in range(DRAWS)]), lambda d: d.isNotNull())).alias("d")).select("key", F.col("d.node").alias("a"))
    return placed.where("component <> top").select("key", F.col("node").alias("b")).join(grown(drawn), "key").select("a", "b").distinct()


def wide_sketches(sets: DataFrame) -> DataFrame:
    """(node, sketch): WIDER symbols, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found = [packed(signature(np.frombuffer(b, np.uint64), MORE_SLOPES, MORE_SHIFTS)) for b in batch.column("own").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.list_(pa.int64()))], ["node", "sketch"])

    return sets.mapInArrow(run, "node long, sketch array<long>")


def across(placed: DataFrame, sketches: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs, with their sizes, of members outside a key's largest component with all members of other components that size and sketch do not rule out."""
    own = placed.join(grown(placed.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("held"))), "node").join(grown(sketches), "node").join(grown(reps.select("node", "n")), "node")
    own = own.withColumn("blocks_a", F.ceil(F.col("outside") / BLOCK).cast("int")).withColumn("blocks_b", F.ceil(F.col("members") / (8 * BLOCK)).cast("int"))
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cells, columns = ["key", "at_a", "at_b"], ["node", "component", F.col("component") == F.col("top"), "n", "held", "sketch"]
    columns[2] = columns[2].alias("in_top")
    left = own.where("component <> top").select("key", block("blocks_a").alias("at_a"), every("blocks_b").alias("at_b"), F.lit(0).alias("side"), *columns)
    right = own.select("key", every("blocks_a").alias("at_a"), block("blocks_b").alias("at_b"), F.lit(1).alias("side"), *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, cells):
            a, b = likely_pairs(cell, percent)
            yield pa.RecordBatch.from_arrays([pa.array(cell.column(c).to_numpy()[k], pa.int64()) for c in ("node", "n") for k in (a, b)], ["a", "b", "n_a", "n_b"])

    return left.unionByName(right).repartition(*cells).sortWithinPartitions(*cells).mapInArrow(run, "a long, b long, n_a long, n_b long")


def runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Stretches of equal values of sorted columns, each as one table."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        marks = np.column_stack([batch.column(c).to_numpy() for c in by])
        edges = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
        for at, end in itertools.pairwise(edges):
            if held and tuple(marks[at]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(at, end - at))
            last = tuple(marks[at])
    if held:
        yield pa.Table.from_batches(held)


def likely_pairs(cell: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a tile, the pairs of rows, left and right members, that may be alike and whose least shared key this is."""
    cell = cell.combine_chunks()
    side, component, n, top = (cell.column(c).to_numpy() for c in ("side", "component", "n", "in_top"))
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    # of two members outside the largest component, the one with the lesser component is on the left
    open_ = (component[left, None] < component[None, right]) | ((component[left, None] != component[None, right]) & top[None, right])
    open_ &= 100 * np.minimum(n[left, None], n[None, right]) >= percent * np.maximum(n[left, None], n[None, right])
    if not open_.any():
        return left[:0], left[:0]
    lists = cell.column("held").chunk(0)
    keys, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
    owner = np.repeat(np.arange(len(side)), sizes)
    lesser = keys < cell.column("key")[0].as_py()
    if lesser.any():
        own, place = np.unique(keys[lesser], return_inverse=True)
        held = np.zeros((len(side), len(own)), np.float32)
        held[owner[lesser], place] = 1
        both = held[left].any(axis=0) & held[right].any(axis=0)
        open_ &= held[left][:, both] @ held[right][:, both].T == 0
    i, j = np.nonzero(open_)
    i, j = left[i], right[j]
    symbols = cell.column("sketch").chunk(0).flatten().to_numpy().view(np.uint8).reshape(len(side), -1)
    total, share = symbols.shape[1], percent / 100
    least = total * share - 5 * (total * share * (1 - share)) ** 0.5
    fits = np.zeros(len(i), bool)
    for at in range(0, len(i), 8192):
        k = slice(at, at + 8192)
        fits[k] = (symbols[i[k]] == symbols[j[k]]).sum(axis=1) >= least
    return i[fits], j[fits]


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", few: int = 32) -> DataFrame:
    """Per row of the input: id, ``n_shingles``, ``component_id`` and ``kept``."""
    return classes(docs, shingle, percent, id_col, text_col, few).select(F.col("__id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")


def classes(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str, few: int = 32) -> DataFrame:
    """Per row: ``__id``, ``__mark`` (a hash of the text), ``n``, ``component_id`` and ``kept``."""
    texts = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__mark"), F.col(text_col).alias("__text"))
    rows = checkpointed(signed(texts, shingle))
    # equal sets have equal sketches, so any of them will do; the number of a node is fixed by the checkpoint
    reps = rows.where("n > 0 and __id is not null").groupBy("same").agg(F.min("__id").alias("rep"), F.count("*").alias("copies"), *[F.any_value(c).alias(c) for c in ("n", "symbols", "keys")])
    reps = compact(reps.withColumn("node", F.monotonically_increasing_id()))
    texts = texts.where(F.col("__id").isNotNull())

    members, pairs = to_hubs(reps.select(F.explode("keys").alias("key"), "node"))
    # all sets that any test below needs, read once more
    sets = sets_of(members.select("node"), reps, texts, shingle)
    found = lambda pairs: linked(pairs, sets, percent)
    fit = lambda pairs: found(likely(pairs, reps, percent))

    def joined(groups: DataFrame, size: int, links: DataFrame, number: int) -> tuple[DataFrame, int]:
        if not number:
            return groups, size
        return bounded_components(links.unionByName(groups.select(F.col("component").alias("a"), F.col("id").alias("b"))), most=size + number)

    links, number = fit(pairs)
    groups, size = bounded_components(links, most=number)
    crowded, seen = None, {"rows": 0}
    if (placed := open_members(members, groups)) is not None:
        crowded, seen = counted(placed.where(F.col("members") > few).select("node").distinct())
        sketches = reps.select("node", F.col("symbols").alias("sketch"))
        groups, size = joined(groups, size, *found(across(placed.where(F.col("members") <= few), sketches, reps, percent)))
    if seen["rows"]:
        own = compact(sets.join(grown(crowded), "node", "left_semi"))
        members, pairs = to_hubs(split_buckets(own, reps, percent))
        groups, size = joined(groups, size, *fit(pairs))
        if (placed := open_members(members, groups)) is not None:
            links, number = fit(to_draws(placed))
            if number:
                groups, size = joined(groups, size, links, number)
                placed = open_members(members, groups)
        if placed is not None:
            groups, size = joined(groups, size, *found(across(placed, compact(wide_sketches(own)), reps, percent)))

    named = reps.select("same", "node", "rep", "copies").join(grown(groups), F.col("node") == F.col("id"), "left").select("same", "rep", "copies", F.coalesce("component", "node").alias("component"))
    final = named.join(grown(named.groupBy("component").agg(F.min("rep").alias("component_id"))), "component").select("same", "component_id", "copies")
    linkable = F.col("__id").isNotNull() & (F.col("n") > 0)
    final, seen = counted(final, copies=F.col("copies"))
    with_class = lookup(rows.where(linkable).select("__id", "__mark", "n", "same"), final, "same", "copies", seen["copies"])
    alone = rows.where(~linkable).select("__id", "__mark", "n", F.col("__id").alias("component_id"))
    out = with_class.select("__id", "__mark", "n", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("__id"), F.lit(True)))


def drop_near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the input that stay: the one of least id of each component, and all rows that are linked with nothing.

    Rows are told apart by id and text.
    """
    dropped = classes(docs, shingle, percent, id_col, text_col).where(~F.col("kept")).select(F.col("__id").alias("__tw_id"), F.col("__mark").alias("__tw_mark"))
    return docs.join(dropped, (F.col(id_col) == F.col("__tw_id")) & (F.xxhash64(text_col) == F.col("__tw_mark")), "left_anti")
