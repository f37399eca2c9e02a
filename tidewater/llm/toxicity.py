"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

A window is one word with the space before it, in lower case and without ASCII punctuation at its ends. It is compressed once with each
dictionary. Zstandard pays a fixed price for a block and a match, which would hide the gain on so short a window;
so each byte stands twice and a lead that both dictionaries hold comes before it. The gain of a window is its
length under the ordinary dictionary less that under the toxic one. A text's evidence is how many of its windows
gain 2, 3, ... 8 bytes, as counts and as shares of all windows. A logistic calibration turns that into a score.

What is learnt comes from a bounded sample of the labelled rows: at most ``toxic_docs`` and ``ordinary_docs``,
those whose hashed id is least. Every text is scored over all its windows. Null and empty texts have no windows and
get the score of no evidence. Labels with a null id or label are not used. Without both labels every score is the share of toxic labels, or 0.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import checkpointed, lowered, slices, utf8

LEAD = bytes(range(1, 25))
LEVEL = 19
STEPS = range(2, 9)
MEMO = 800_000
FOLDS = 3
EDGES = string.punctuation.encode()


def windows(data: bytes) -> list[bytes]:
    return [own for w in lowered(data).split() if (own := w.strip(EDGES))]


def wide(data: bytes) -> bytes:
    return np.repeat(np.frombuffer(data, np.uint8), 2).tobytes()


def dictionary(words: list[bytes], size: int) -> bytes:
    """Content of a dictionary: the words in front of the list stand last, where matches are cheapest."""
    taken, total = [LEAD], 0
    for w in words:
        total += 2 * len(w) + 2
        if total > size:
            break
        taken.append(wide(b" " + w))
    return b"".join(reversed(taken))


class Gains:
    """The gain in bytes of each window, kept for the windows seen lately."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = self.compressor(toxic), self.compressor(ordinary)
        self.memo: dict[bytes, int] = {}

    @staticmethod
    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)

    def gain(self, word: bytes) -> int:
        window = LEAD + wide(b" " + word)
        return len(self.ordinary.compress(window)) - len(self.toxic.compress(window))

    def of(self, words: list[bytes]) -> list[int]:
        memo = self.memo
        try:
            return list(map(memo.__getitem__, words))
        except KeyError:
            if len(memo) > MEMO:
                memo.clear()
            own = {w: self.gain(w) for w in set(words).difference(memo)}
            memo.update((w, g) for w, g in own.items() if len(w) <= 64)  # long ones would fill the memory
            return [memo[w] if w in memo else own[w] for w in words]


def evidence(gains: list[int]) -> np.ndarray:
    """For each step: the log of one plus the windows that gain so much, and the root of their share."""
    if not gains:
        return np.zeros(2 * len(STEPS))
    held = np.bincount(np.clip(np.array(gains), 0, STEPS[-1]), minlength=STEPS[-1] + 1)[::-1].cumsum()[::-1]
    counts = held[STEPS[0] :].astype(float)
    return np.concatenate([np.log1p(counts), np.sqrt(counts / len(gains))])


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]  # of the evidence; the last is the intercept

    def scores(self, rows: np.ndarray) -> np.ndarray:
        z = rows @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def calibrated(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method with a ridge; the intercept is last and free."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x1.shape[1]), np.full(x1.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(penalty), x1.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _evidence_rows(docs: DataFrame, toxic: bytes, ordinary: bytes, keep: list[str]) -> DataFrame:
    """``keep`` columns of each row, then ``evidence array<double>`` of its column ``__text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(toxic, ordinary)
        for batch in slices(batches):
            found = pa.array([evidence(gains.of(windows(t))) for t in utf8(batch, "__text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), found], [*keep, "evidence"])

    fields = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return docs.mapInArrow(run, f"{fields}, evidence array<double>")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", toxic_docs: int = 1200, ordinary_docs: int = 3000, toxic_bytes: int = 32768, ordinary_bytes: int = 200_000, toxic_least: int = 4, ordinary_least: int = 2, excess: float = 6.0) -> ToxicityModel:
    """Learn from a bounded sample of the labelled rows; ``labels`` must hold only rows one may learn from.

    A word enters a dictionary if at least ``*_least`` of the sampled texts of its class hold it, the toxic one if its share of
    toxic texts is also ``excess`` times its share of ordinary ones, else the ordinary one; the words of most texts go in first, up to ``*_bytes``. The calibration weighs each of
    ``FOLDS`` parts of the texts, by hash, with dictionaries of the other parts.
    """
    marked = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).where("__id is not null and __y in (0, 1)")
    order = [F.xxhash64("__id"), F.col("__id")]
    sample = marked.where("__y = 1").orderBy(*order).limit(toxic_docs).unionByName(marked.where("__y = 0").orderBy(*order).limit(ordinary_docs))
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(sample), "__id")  # bounded by toxic_docs + ordinary_docs
    sampled = checkpointed(texts.select("__y", "__text").distinct().withColumn("__fold", F.pmod(F.xxhash64("__text", F.lit(3)), F.lit(FOLDS)).cast("int")))
    sizes = {(r["__y"], r["__fold"]): r["count"] for r in sampled.groupBy("__y", "__fold").count().collect()}

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for y, fold, t in zip(batch.column("__y").to_pylist(), batch.column("__fold").to_pylist(), utf8(batch, "__text"), strict=True):
                if own := sorted(set(windows(t))):
                    yield pa.RecordBatch.from_arrays([pa.array([y] * len(own), pa.int32()), pa.array([fold] * len(own), pa.int32()), pa.array(own, pa.binary())], ["y", "fold", "word"])

    words = sampled.select("__y", "__fold", "__text").mapInArrow(used, "y int, fold int, word binary")
    uses = checkpointed(words.groupBy("word").agg(*[F.count_if((F.col("y") == y) & (F.col("fold") == k)).alias(f"n{y}{k}") for y in (0, 1) for k in range(FOLDS)]))

    def dictionaries(without: int | None) -> tuple[bytes, bytes]:
        """Both dictionaries, from all folds but one."""
        folds = [k for k in range(FOLDS) if k != without]
        ordinary, toxic = (sum(F.col(f"n{y}{k}") for k in folds) for y in (0, 1))
        n = [sum(sizes.get((y, k), 0) for k in folds) for y in (0, 1)]
        # a toxic text is mostly ordinary words; those that it shares with ordinary texts would fill the dictionary and tell nothing
        rows = uses.select("word", ordinary.alias("ordinary"), toxic.alias("toxic")).withColumn("marks", F.col("toxic") * n[0] > excess * (F.col("ordinary") + 1) * n[1])
        most = lambda own, c, least, size: [bytes(r.word) for r in own.where(F.col(c) >= least).orderBy(F.desc(c), "word").limit(size // 4).collect()]
        return dictionary(most(rows.where("marks"), "toxic", toxic_least, toxic_bytes), toxic_bytes), dictionary(most(rows.where("not marks"), "ordinary", ordinary_least, ordinary_bytes), ordinary_bytes)

    # each text is weighed by dictionaries that have not seen it; at most toxic_docs + ordinary_docs short rows
    found = pd.concat([_evidence_rows(sampled.where(F.col("__fold") == k), *dictionaries(k), ["__y"]).toPandas() for k in range(FOLDS)])
    toxic, ordinary = dictionaries(None)
    y = found["__y"].to_numpy(float)
    n = 2 * len(STEPS)
    if len(set(y)) < 2:
        share = float(np.clip(y.mean(), 1e-9, 1 - 1e-9)) if len(y) else 1e-9
        return ToxicityModel(toxic, ordinary, (*[0.0] * n, float(np.log(share / (1 - share)))))
    return ToxicityModel(toxic, ordinary, tuple(map(float, calibrated(np.array(found["evidence"].tolist()), y))))


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``score`` between 0 and 1."""
    rows = _evidence_rows(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), model.toxic, model.ordinary, ["__id"])
    z = F.aggregate(F.zip_with("evidence", F.array(*map(F.lit, model.weights[:-1])), lambda e, w: e * w), F.lit(model.weights[-1]), lambda a, v: a + v)
    return rows.select(F.col("__id").alias(id_col), (1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))).alias("score"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose score is under the threshold, with the input's columns; texts pass through once, unshuffled."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(model.toxic, model.ordinary)
        for batch in slices(batches):
            rows = np.array([evidence(gains.of(windows(t))) for t in utf8(batch, text_col)]).reshape(batch.num_rows, 2 * len(STEPS))
            yield batch.filter(pa.array(model.scores(rows) < threshold))

    return docs.mapInArrow(run, docs.schema).select(*names)
