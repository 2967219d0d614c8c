"""Toxicity: a logistic model over character n-gram indicators scaled by naive Bayes log-count ratios.

Text is lower-cased and any run of characters that are neither letters nor digits is one space, as are both ends.
Features are the distinct n-grams of 3 to 6 characters. See linear.py for sampling, fitting and the cases.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame

from . import linear

SIZES = (3, 4, 5, 6)
_U = np.uint64


@lru_cache(1)
def _kept() -> np.ndarray:
    return np.array([chr(i).isalnum() for i in range(0x110000)])


def cells(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    whole = "".join(f"\0 {(t or '').replace(chr(0), ' ')} " for t in texts).lower()
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    word, edge = _kept()[np.minimum(codes, 0x10FFFF)], codes == 0
    keep = word | edge
    keep[1:] |= word[:-1] | edge[:-1]
    code = np.where(word, codes, 0x20)
    code[edge] = 0
    code = code[keep].astype(_U)
    doc = np.cumsum(code == 0) - 1
    docs, cols = [], []
    h = code.copy()
    for n in range(1, max(SIZES)):
        h = h[:-1] * _U(0x100000001B3) + code[n:]
        if n + 1 in SIZES:
            inside = doc[: len(h)] == doc[n:]
            inside &= code[: len(h)] != 0
            docs.append(doc[: len(h)][inside])
            cols.append(linear.bucket(h[inside] + _U(n)))
    return np.concatenate(docs) if docs else np.zeros(0, int), np.concatenate(cols) if cols else np.zeros(0, int)


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", **how) -> linear.Model:
    return linear.train(docs, labels, cells, label_col=label_col, logistic=True, **how)


def score(docs: DataFrame, model: linear.Model, *keep: Column, at: float = 0.5, text_col: str = "text") -> DataFrame:
    return linear.apply(docs, model, *keep, at=at, text_col=text_col)
