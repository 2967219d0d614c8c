"""Quality: naive Bayes support vectors over word n-gram indicators.

A word is a run of characters other than white space. Features are indicators of
* words and pairs of words;
* n-grams of one to three word shapes, where a shape is the word with runs of lower-case letters, capitals, digits and
  each other character cut to one, and a mark if the word equals the one before it.
Shapes make repetition, shouting and symbol noise visible in words never seen before. See linear.py for the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linear
from .base import slices

_U = np.uint64
_P, _Q = _U(0x100000001B3), _U(0xC2B2AE3D27D4EB4F)


@lru_cache(1)
def _classes() -> np.ndarray:
    """0: white space; 1: lower case or other letter; 2: capital; 3: digit; else the code point plus 16."""
    out = np.arange(16, 0x110010, dtype=np.int64)
    for i in range(0x110000):
        c = chr(i)
        if c.isspace():
            out[i] = 0
        elif c.isupper():
            out[i] = 2
        elif c.isalpha():
            out[i] = 1
        elif c.isdigit():
            out[i] = 3
    return out.astype(_U)


@lru_cache(1)
def _powers() -> np.ndarray:
    return np.array([pow(int(_P), i, 1 << 64) for i in range(1 << 12)], _U)


def cells(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    whole = "".join(f"\0{(t or '').replace(chr(0), ' ')} " for t in texts)
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _classes()[np.minimum(codes, 0x10FFFF)]
    edge = codes == 0
    kind[edge] = 0
    inside = kind != 0
    first = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc_at = np.cumsum(edge) - 1
    doc = doc_at[first]
    at = np.arange(len(codes)) - np.repeat(np.append(0, first), np.diff(np.append(np.append(0, first), len(codes))))
    power = _powers()[at & 0xFFF]
    word = np.add.reduceat(np.where(inside, codes.astype(_U) * power, _U(0)), first)
    change = inside & (kind != np.append(_U(0), kind[:-1]))
    rank = np.cumsum(change)
    rank -= np.repeat(np.append(0, rank[first]), np.diff(np.append(np.append(0, first), len(codes))))
    shape = np.add.reduceat(np.where(change, (kind + _U(1)) * _powers()[rank & 0xFFF], _U(0)), first) * _Q
    together = doc[1:] == doc[:-1]
    same = np.append(False, together & (word[1:] == word[:-1]))
    shape = shape + same.astype(_U)
    third = together[1:] & together[:-1]
    w2, s2 = word[:-1] * _P + word[1:], shape[:-1] * _P + shape[1:]
    s3 = s2[:-1] * _P + shape[2:]
    parts = [(doc, word + _U(1)), (doc[1:][together], w2[together] + _U(2)), (doc, shape + _U(3)), (doc[1:][together], s2[together] + _U(4)), (doc[2:][third], s3[third] + _U(5))]
    return np.concatenate([d for d, _ in parts]), np.concatenate([linear.bucket(h) for _, h in parts])


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", **how) -> linear.Model:
    return linear.train(docs, labels, cells, label_col=label_col, **how)


def score(docs: DataFrame, model: linear.Model, *keep: Column, at: float = 0.3, text_col: str = "text") -> DataFrame:
    return linear.apply(docs, model, *keep, at=at, text_col=text_col)


def keep_good(docs: DataFrame, model: linear.Model, *, at: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents with a score of at least ``at``, with the columns they came with; no row leaves its task."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            yield batch.filter(pa.array(shared.value.scores(batch.column(text_col).to_pylist()) >= at))

    return docs.mapInArrow(run, docs.schema).select(*[F.col(f"`{c}`") for c in docs.columns])
