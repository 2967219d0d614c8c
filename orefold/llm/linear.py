"""Linear classifiers over n-gram indicators that are scaled by naive Bayes log-count ratios.

Labelled rows are a bounded sample (``SAMPLE`` rows and ``SAMPLE_BYTES`` of text, by a hash of the id): their ids and labels are
broadcast, their texts are staged once. Executors count in how many sampled texts of either class each hashed n-gram occurs; Spark
adds these counts up by blocks of buckets, and every feature whose counts differ clearly gets its log-count ratio.
A second pass over the sample brings the driver each text's features; there a linear model is fitted by dual coordinate
descent, with hinge loss (a support vector machine) or logistic loss, and its margins are turned into
probabilities on a held-out part of the sample. Scoring is one pass over all documents without a shuffle.

Cases: null text is empty text, which has no features and gets the score of the bias alone; without labels of both
classes the score is the share of label 1 after adding one of each; repeated rows are so many rows, and a row that is labelled both ways
is one of each class; null ids are never learned from; only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .base import slices, staged, trim

BITS = 20
BLOCK = 1 << 14
#: Tasks that count; each gives counts of all buckets, so few of them are enough for the bounded sample.
TASKS = 16
SAMPLE = 24_000
#: Text of the sample; its features, of about the same size, come to the driver.
SAMPLE_BYTES = 80 << 20
#: Least number of sampled texts with a feature, and least distance, in standard deviations, of its share in a class from what chance gives.
LEAST, CLEARLY = 3, 2.5

#: From texts to (number of the text, bucket) of each n-gram in them, repeats included.
Cells = Callable[[list[str | None]], tuple[np.ndarray, np.ndarray]]


def bucket(h: np.ndarray) -> np.ndarray:
    """Of 64-bit hashes."""
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def distinct(doc: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's different cells, text by text, without sorting them: the last place of a cell in its text stands for it."""
    if not len(doc):
        return doc, cell
    order = np.argsort(doc.astype(np.uint16) if doc.max() < 1 << 16 else doc, kind="stable")
    doc, cell = doc[order], cell[order]
    ends = np.flatnonzero(np.append(doc[1:] != doc[:-1], True)) + 1
    last, keep = np.empty(1 << BITS, np.int32), np.empty(len(doc), bool)
    place = np.arange(int(np.diff(ends, prepend=0).max()), dtype=np.int32)
    start = 0
    for end in ends.tolist():
        own, at = cell[start:end], place[: end - start]
        last[own] = at
        keep[start:end] = last[own] == at
        start = end
    return doc[keep], cell[keep]


def descend(
    rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, cost: np.ndarray, *, logistic: bool, rounds: int = 1000, seed: int = 0, start: np.ndarray | None = None
) -> tuple[np.ndarray, float, np.ndarray]:
    """Dual coordinate descent for  min |w|^2 / 2 + sum cost_i loss(y_i (w.x_i + b)): w, b and the dual's alpha.

    x_i has ``values[j]`` at each j in rows[i], and 1 for the bias, which is learned like any other weight. Rounds go over what still moves; when
    none of it makes a step above a thousandth of its cost, a round over all rows must say the same. ``start``: an alpha to begin with.
    """
    w, b = np.zeros(len(values)), 0.0
    norm = np.array([float((values[r] ** 2).sum()) + 1 for r in rows])
    alpha = np.zeros(len(rows)) if start is None else np.minimum(start, cost)
    if logistic:
        alpha = np.clip(alpha, np.minimum(1e-3, cost / 2), cost * (1 - 1e-9))
    for i in np.flatnonzero(alpha):
        w[rows[i]] += alpha[i] * y[i] * values[rows[i]]
        b += alpha[i] * y[i]
    order = np.random.default_rng(seed)
    everyone = np.arange(len(rows))
    active = everyone
    for _ in range(rounds):
        largest, still = 0.0, []
        for i in order.permutation(active):
            r, t = rows[i], y[i]
            x = values[r]
            margin = t * (float(w[r] @ x) + b)
            if logistic:  # one Newton step on alpha log alpha + (C - alpha) log(C - alpha) + ...
                a = alpha[i]
                slope = margin + math.log(a / (cost[i] - a))
                curve = norm[i] + cost[i] / (a * (cost[i] - a))
                new = min(max(a - slope / curve, 0.1 * a), a + 0.9 * (cost[i] - a))
            else:
                new = min(max(alpha[i] - (margin - 1) / norm[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                w[r] += step * t * x
                b += step * t
                alpha[i] = new
                largest = max(largest, abs(step) / cost[i])
            if logistic and abs(step) > 1e-4 * cost[i] or not logistic and (step or 0 < new < cost[i]):
                still.append(i)
        if largest < 1e-3:
            if len(active) == len(rows):
                break
            active = everyone
        else:
            active = np.array(still)
    return w, b, alpha


def sigmoid_fit(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's (a, b): the probability of label 1 is 1 / (1 + exp(-(a margin + b)))."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    if not pos or not neg:
        return 1.0, 0.0
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        z = np.clip(a * margins + b, -30, 30)
        p = 1 / (1 + np.exp(-z))
        g = np.array([((p - t) * margins).sum() + 1e-3 * (a - 1), (p - t).sum() + 1e-3 * b])
        v = p * (1 - p)
        h = np.array([[(v * margins**2).sum() + 1e-3, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        scale = min(1.0, 5 / max(abs(step).max(), 1e-9))
        a, b = a - scale * step[0], b - scale * step[1]
        if abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b


class Model:
    def __init__(self, cells: Cells, weights: np.ndarray, bias: float, a: float, b: float):
        self.cells, self.weights, self.bias, self.a, self.b = cells, weights, bias, a, b

    def margins(self, texts: list[str | None]) -> np.ndarray:
        doc, cell = self.cells(texts)
        hit = np.flatnonzero(self.weights[cell])
        doc, cell = distinct(doc[hit], cell[hit])
        return np.bincount(doc, weights=self.weights[cell], minlength=len(texts)) + self.bias

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * self.margins(texts) + self.b, -30, 30)))


def sampled(docs: DataFrame, labels: DataFrame, *, doc_col: str, text_col: str, label_col: str, sample: int, sample_bytes: int) -> tuple[DataFrame, np.ndarray]:
    """``text, y`` of at most about ``sample`` labelled rows with ``sample_bytes`` of text, which ones depends on a hash of the id; and the rows of each class."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(doc_col).alias("__id"), F.col(label_col).cast("int").alias("y")).distinct()
    n = known.count()
    share = F.lit(math.ceil(1e6 * min(1.0, sample / max(n, 1))))
    at = F.pmod(F.xxhash64(F.col("__id"), F.lit(17)), F.lit(1_000_000)).alias("at")
    few = known.select("*", at).where(F.col("at") < share)  # about ``sample`` rows of three numbers
    own = docs.select(F.col(doc_col).alias("__doc"), F.col(text_col).alias("text"))
    rows = staged(own.join(F.broadcast(few), F.col("__doc") == F.col("__id")).select("text", "y", "at"), "labelled")
    text_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if text_bytes > sample_bytes:
        rows = rows.where(F.col("at") < F.ceil(share * F.lit(sample_bytes / text_bytes)))
    size = np.zeros(2, np.int64)
    for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect():
        size[r.y] = r.n
    return rows.select("text", "y"), size


def features(rows: DataFrame, cells: Cells, size: np.ndarray, least: int = LEAST, clearly: float = CLEARLY) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that ``least`` texts have and whose share of either class is ``clearly`` apart, and their log-count ratios.

    Counts are added up in Spark, by blocks of buckets; only what is chosen comes to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, 1 << BITS), np.int32)
        for batch in slices(batches, "text"):
            y = np.array(batch.column("y").to_pylist(), np.int64)
            doc, cell = distinct(*cells(batch.column("text").to_pylist()))
            for k in (0, 1):
                n[k] += np.bincount(cell[y[doc] == k], minlength=1 << BITS).astype(np.int32)
        for first in range(0, 1 << BITS, BLOCK):
            part = n[:, first : first + BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([first], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["first", "n"])

    def choose(block: pa.Table) -> pa.Table:
        n = np.zeros((2, BLOCK), np.int64)
        for part in block.column("n").to_pylist():
            n += np.frombuffer(part, np.int32).reshape(2, -1)
        total, p = n.sum(0), size[1] / size.sum()
        z = np.abs(n[1] - total * p) / np.sqrt(np.maximum(total * p * (1 - p) * (1 - total / (size.sum() + 1)), 1e-9))
        own = np.flatnonzero((total >= least) & (z >= clearly))
        ratio = np.log((n[1, own] + 1) / (size[1] + 2)) - np.log((n[0, own] + 1) / (size[0] + 2))
        return pa.table({"cell": pa.array(own + block.column("first")[0].as_py(), pa.int64()), "ratio": pa.array(ratio)})

    got = rows.coalesce(TASKS).mapInArrow(count, "first int, n binary").groupBy("first").applyInArrow(choose, "cell bigint, ratio double").toArrow().sort_by("cell")
    return got.column("cell").to_numpy(), got.column("ratio").to_numpy()


def encoded(rows: DataFrame, cells: Cells, chosen: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Numbers of the chosen features in each text, and its label (1 or -1); in an order that doesn't depend on the tasks."""
    number = np.full(1 << BITS, -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    shared = rows.sparkSession.sparkContext.broadcast(number)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            doc, cell = cells(batch.column("text").to_pylist())
            hit = shared.value[cell] >= 0
            doc, cell = distinct(doc[hit], cell[hit])
            ends = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            own = shared.value[cell]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array([own[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], names=["y", "x"])

    x, labels = [], []
    for r in rows.mapInArrow(encode, "y int, x binary").toLocalIterator():  # one task's rows at a time are with the JVM
        x.append(np.frombuffer(bytes(r.x), np.int32))
        labels.append(r.y)
    shared.destroy()
    y = np.array(labels)
    order = sorted(range(len(x)), key=lambda i: (xxhash.xxh3_128_digest(x[i]), y[i]))
    return [x[i] for i in order], np.where(y[order] > 0, 1.0, -1.0)


def train(
    docs: DataFrame,
    labels: DataFrame,
    cells: Cells,
    *,
    label_col: str,
    doc_col: str = "doc_id",
    text_col: str = "text",
    logistic: bool = False,
    sample: int = SAMPLE,
    sample_bytes: int = SAMPLE_BYTES,
    strength: float = 1.0,
    least: int = LEAST,
    clearly: float = CLEARLY,
) -> Model:
    """``docs`` must hold only the documents whose labels may be learned from. ``least=1, clearly=0`` takes every feature of the sample."""
    rows, size = sampled(docs, labels, doc_col=doc_col, text_col=text_col, label_col=label_col, sample=sample, sample_bytes=sample_bytes)
    weights = np.zeros(1 << BITS, np.float32)
    if not size.all():
        return Model(cells, weights, math.log((size[1] + 1) / (size[0] + 1)), 1.0, 0.0)
    chosen, values = features(rows, cells, size, least, clearly)
    x, y = encoded(rows, cells, chosen)
    values = values / max(np.sqrt(np.mean([float((values[r] ** 2).sum()) for r in x])), 1e-9)
    part = np.random.default_rng(1).permutation(len(x)) % 5
    cost = np.where(y > 0, size.sum() / (2 * size[1]), size.sum() / (2 * size[0])) * strength
    rest, held = np.flatnonzero(part != 0), np.flatnonzero(part == 0)
    w, b, alpha = descend([x[i] for i in rest], values, y[rest], cost[rest], logistic=logistic)
    a, c = sigmoid_fit(np.array([float(w[x[i]] @ values[x[i]]) + b for i in held]), y[held]) if len(held) else (1.0, 0.0)
    start = np.zeros(len(x))
    start[rest] = alpha
    w, b, _ = descend(x, values, y, cost, logistic=logistic, start=start)
    weights[chosen] = w * values
    del x
    trim()
    return Model(cells, weights, b, a, c)


def apply(docs: DataFrame, model: Model, *keep: Column, text_col: str = "text", at: float = 0.5) -> DataFrame:
    """The kept columns, score and predicted (1 if score >= ``at``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(*keep, F.col(text_col).alias("__text"))
    names = own.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            score = shared.value.scores(batch.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(score), pa.array((score >= at).astype(np.int32))], names=[*names, "score", "predicted"])

    return own.mapInArrow(run, StructType([*own.schema.fields[:-1], *StructType.fromDDL("score double, predicted int").fields]))
