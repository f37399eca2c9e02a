"""Quality by ordinal regression: one set of hashed-text weights, ordered thresholds between the grades.

P(grade >= k) = sigmoid(w x - t_k) with t_1 <= t_2 <= ...: a cumulative-link model. x holds the logs of one plus the
counts of the text's byte trigrams, hashed to ``DIMS`` places and brought to length 1. It gives a text's expected grade and
the tail probability of the grade one selects from. It is learnt from at most ``most`` rated documents of least hash. The tail probability from which a
document is selected is set so that ``keep`` of the rated documents of that grade or more are selected, each weighed by a fit to the half that does not hold it.

Null and empty texts have x = 0. Ratings that are null or have no document are not used. Without two grades the expected
grade is the one rating, or 0. Repeated rows each give a row. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import slices, utf8

DIMS = 2048


def features(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(DIMS, np.float32)
    grams = ((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(2654435761)
    x = np.log1p(np.bincount(grams >> np.uint32(21), minlength=DIMS)).astype(np.float32)
    return x / np.linalg.norm(x)


@dataclass(frozen=True)
class OrdinalModel:
    grades: tuple[float, ...]
    weights: np.ndarray
    thresholds: np.ndarray
    least: float = 0.5

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= grades[k]) for k = 1, 2, ..., of each row of x."""
        z = (x @ self.weights)[:, None] - self.thresholds[None, :]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def descend(x: np.ndarray, y: np.ndarray, n: int, rounds: int = 400, ridge: float = 2e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds for grade numbers y in 0..n-1, by Adam on the likelihood; steps between thresholds stay positive."""
    w = np.zeros(x.shape[1])
    share = np.clip([(y >= k).mean() for k in range(1, n)], 1e-4, 1 - 1e-4)
    first = -np.log(share / (1 - share))
    free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    m, v = np.zeros(len(w) + len(free)), np.zeros(len(w) + len(free))
    rows = np.arange(len(y))
    for k in range(1, rounds + 1):
        t = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
        p = 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - t[None, :], -40, 40)))
        edge = np.concatenate([np.ones((len(y), 1)), p, np.zeros((len(y), 1))], axis=1)
        slope = edge * (1 - edge)
        own = np.maximum(edge[rows, y] - edge[rows, y + 1], 1e-9)
        up, down = slope[rows, y] / own, slope[rows, y + 1] / own
        g_w = -(x.T @ (up - down)) / len(y) + ridge * w
        g_t = np.array([((up * (y == j + 1)) - (down * (y == j))).sum() for j in range(n - 1)]) / len(y)
        g_free = np.concatenate([[g_t.sum()], [g_t[j:].sum() * np.exp(free[j]) for j in range(1, n - 1)]])
        g = np.concatenate([g_w, g_free])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.3 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8) * (1 - k / (rounds + 1))
        w, free = w - step[: len(w)], free - step[len(w) :]
    return w, free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])


def fit(docs: DataFrame, ratings: DataFrame, most: int = 4000, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", select_from: float | None = None, keep: float = 0.97) -> OrdinalModel:
    """``ratings`` has the id and a numeric grade; ``select_from`` is the grade for which the model's ``least`` is set. At most ``most`` rows of features reach the driver, 8 KB each."""
    rated = ratings.select(F.col(id_col).alias("__id"), F.col(grade_col).cast("double").alias("grade")).where("__id is not null and grade is not null")
    sample = rated.orderBy(F.xxhash64("__id"), "__id").limit(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("hash"), batch.column("grade"), pa.array([features(t).tobytes() for t in utf8(batch, "__text")], pa.binary())], ["hash", "grade", "x"])

    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(sample), "__id")  # at most ``most`` rows
    found = texts.withColumn("hash", F.xxhash64("__id")).mapInArrow(run, "hash long, grade double, x binary").toPandas().sort_values(["hash", "grade"])
    grades = sorted(set(found["grade"]))
    if len(grades) < 2:
        return OrdinalModel(tuple(grades) or (0.0,), np.zeros(DIMS), np.zeros(0))
    x = np.array([np.frombuffer(b, np.float32) for b in found["x"]], np.float64)  # once, not in each of the rounds' products
    y = np.searchsorted(grades, found["grade"].to_numpy())
    w, t = descend(x, y, len(grades))
    k = int(np.searchsorted(grades, select_from)) if select_from is not None else 0
    if not 0 < k < len(grades):
        return OrdinalModel(tuple(grades), w, t)
    tails, half = np.zeros(len(y)), np.arange(len(y)) % 2 == 0
    for own in (half, ~half):
        if len(set(y[~own])) == len(grades):
            tails[own] = OrdinalModel(tuple(grades), *descend(x[~own], y[~own], len(grades))).tails(x[own])[:, k - 1]
        else:
            tails[own] = 0.5
    return OrdinalModel(tuple(grades), w, t, float(np.quantile(tails[y >= k], 1 - keep)))


def grade_documents(docs: DataFrame, model: OrdinalModel, select_from: float, least: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``expected_grade``, ``tail_probability`` of a grade of ``select_from`` or more, and ``kept``, from ``least`` on, the model's own if left out."""
    steps, k = np.diff(model.grades), int(np.searchsorted(model.grades, select_from)) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([features(t) for t in utf8(batch, "__text")]).reshape(batch.num_rows, DIMS)
            tails = model.tails(x)
            tail = np.ones(len(x)) if k < 0 else tails[:, k] if k < tails.shape[1] else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.grades[0] + tails @ steps), pa.array(tail)], ["__id", "expected_grade", "tail_probability"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, f"__id {kind}, expected_grade double, tail_probability double")
    return out.select(F.col("__id").alias(id_col), "expected_grade", "tail_probability", (F.col("tail_probability") >= (model.least if least is None else least)).alias("kept"))
