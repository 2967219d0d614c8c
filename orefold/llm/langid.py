"""Language identification with interpolated Kneser-Ney character models.

Text is lower-cased, every run of non-letters becomes one space, and a document is the sequence of its characters
after three spaces. Four characters, 16 bits each, make a key; characters beyond the basic plane count as one symbol.

Training counts the four-grams of all training documents per language (a sum by key in Spark, after each task has
summed what it read); nothing is left out, so the model grows with the different four-grams of the input. Continuation counts, discounts
and interpolated probabilities of all orders follow from these counts, in one of two ways with the same results but for rounding:
* ``Model``: where different four-grams times languages are at most ``CELLS``, the driver makes sorted arrays of hashed keys with one column
  of log probabilities for each language, which are broadcast, and scoring needs no shuffle;
* ``Joined``: beyond that nothing of the model comes to the driver. Orders, contexts and discounted shares are tables, the different four-grams of the
  documents are looked up by joins, and a document's sums by one more.

A document gets the language with the lowest cross-entropy per character. ``score`` is a softmax of the entropies,
its sharpness fitted on a bounded sample of training documents (``SAMPLE`` rows, a tenth of all at most), and ``rejected`` says that the
winning entropy is above what all but ``REJECT`` of that language's sampled documents have. For both the sampled rows meet a model
that was counted without them; the model that is returned has them in.

Cases: null text or text without a letter gives ``und`` with score 0; no training rows gives ``und`` everywhere; an empty table gives an empty
result; ties go to the first language in order; repeated rows are counted and predicted one by one; only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .base import slices, staged

ORDER = 4
SAMPLE = 4096
REJECT = 0.005
CELLS = 4_000_000

_U = np.uint64


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def keys_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Four-gram keys of the texts one after the other, and how many each text has (0: no letter)."""
    whole = "\0".join((t or "").replace("\0", " ") for t in texts).lower()
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[np.minimum(codes, 0x10FFFF)]
    edge = codes == 0
    keep = letter | edge
    after = np.empty(len(codes), bool)
    after[:1] = True
    after[1:] = keep[:-1]
    keep |= after  # the first of a run of others stands for the run
    code = np.where(letter, np.minimum(codes, 0xFFFF), 0x20)
    code[edge] = 0
    code = code[keep].astype(_U)
    ends = np.flatnonzero(code == 0)
    first = np.concatenate([[0], ends + 1])
    last = np.concatenate([ends, [len(code)]])
    # three spaces stand before each document; a separator and what it touches is masked out below
    pad = np.full(3, 0x20, _U)
    code[ends] = 0x20
    full = np.concatenate([pad, code])
    c3, c2, c1, c0 = full[:-3], full[1:-2], full[2:-1], full[3:]
    at = np.arange(len(code)) - np.repeat(first, last - first + np.append(np.ones(len(ends), int), 0))
    c3 = np.where(at < 3, _U(0x20), c3)
    c2 = np.where(at < 2, _U(0x20), c2)
    c1 = np.where(at < 1, _U(0x20), c1)
    key = (c3 << _U(48)) | (c2 << _U(32)) | (c1 << _U(16)) | c0
    real = np.ones(len(code), bool)
    real[ends] = False
    has = np.add.reduceat(np.append((code != 0x20).astype(np.int64), 0), first) if len(code) else np.zeros(len(first), np.int64)
    counts = np.where((last > first) & (has > 0), last - first, 0)
    real &= np.repeat(counts > 0, last - first + np.append(np.ones(len(ends), int), 0))
    return key[real], counts


def mix(keys: np.ndarray) -> np.ndarray:
    h = keys.astype(_U) * _U(0x9E3779B97F4A7C15)
    h ^= h >> _U(29)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    return h


class HashArray:
    """Sorted hashes; a lookup starts at the hash's proportional place and goes on to the right."""

    def __init__(self, keys: np.ndarray):
        hashes = mix(keys)
        self.order = np.argsort(hashes)
        self.hashes = np.append(hashes[self.order], np.full(1, 0xFFFFFFFFFFFFFFFF, _U))
        self.shift = _U(64 - max(1, math.ceil(math.log2(len(keys) + 1)) + 1))
        n = 1 << (64 - int(self.shift))
        self.start = np.searchsorted(hashes[self.order] >> self.shift, np.arange(n, dtype=_U)).astype(np.int32)
        self.most = int(np.bincount((hashes >> self.shift).astype(np.int64), minlength=1).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places in the sorted array; -1 where there is none."""
        h = mix(keys)
        at = self.start[(h >> self.shift).astype(np.int64)]
        out = np.where(self.hashes[at] == h, at, -1)
        left = np.flatnonzero((out < 0) & (self.hashes[at] < h))
        for step in range(1, self.most):
            if not len(left):
                break
            here = np.minimum(at[left] + step, len(self.hashes) - 1)
            got = self.hashes[here]
            out[left[got == h[left]]] = here[got == h[left]]
            left = left[got < h[left]]
        return out


class Model:
    """tables[n]: hash array of the n-grams, log probabilities; backoff[n]: hash array of contexts, log weights."""

    def __init__(self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        self.sharpness, self.bounds = 20.0, np.full(len(langs), np.inf)
        self.tables, self.backoff = [], []
        if not langs:
            return
        orders: list[list[tuple[np.ndarray, np.ndarray]]] = [list(counts)]  # highest order first
        for n in range(ORDER - 1, 0, -1):
            shorter = []
            for keys, _ in orders[-1]:
                shorter.append(np.unique(keys & _U((1 << 16 * n) - 1), return_counts=True))
            orders.append(shorter)
        orders.reverse()
        alphabet = max(1, len(np.unique(np.concatenate([k for k, _ in orders[0]] or [np.zeros(0, _U)]))))
        self.floor = math.log(1 / (alphabet + 1))
        for n, grams in enumerate(orders, 1):
            union = np.unique(np.concatenate([k for k, _ in grams]))
            contexts = np.unique(np.concatenate([k >> _U(16) for k, _ in grams]))
            below = np.full((len(union), len(langs)), 1 / (alphabet + 1)) if n == 1 else np.exp(self._log(union & _U((1 << 16 * (n - 1)) - 1), n - 1))
            weights = np.ones((len(contexts), len(langs)))
            prob = np.zeros((len(union), len(langs)))
            for j, (keys, count) in enumerate(grams):
                if not len(keys):
                    prob[:, j] = below[:, j]
                    continue
                cut = discount(int((count == 1).sum()), int((count == 2).sum()))
                ctx, back, kinds = np.unique(keys >> _U(16), return_inverse=True, return_counts=True)
                total = np.bincount(back, weights=count.astype(float))
                at = np.searchsorted(contexts, ctx)
                weights[at, j] = cut * kinds / total
                own = np.searchsorted(union, keys)
                prob[own, j] = np.maximum(count - cut, 0) / total[back]
                prob[:, j] += weights[np.searchsorted(contexts, union >> _U(16)), j] * below[:, j]
            table, context = HashArray(union), HashArray(contexts)
            self.tables.append((table, np.log(prob[table.order]).astype(np.float32)))
            self.backoff.append((context, np.log(weights[context.order]).astype(np.float32)))

    def _log(self, keys: np.ndarray, n: int) -> np.ndarray:
        table, logs = self.tables[n - 1]
        at = table.find(keys)
        out = logs[at] if len(logs) else np.zeros((len(keys), len(self.langs)), np.float32)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            k = keys[missing]
            lower = np.full((len(k), len(self.langs)), self.floor, np.float32) if n == 1 else self._log(k & _U((1 << 16 * (n - 1)) - 1), n - 1)
            context, weights = self.backoff[n - 1]
            where = context.find(k >> _U(16))
            if len(weights):
                lower = lower + np.where((where >= 0)[:, None], weights[where], 0)
            out[missing] = lower
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text in each language, and the number of characters."""
        keys, counts = keys_of(texts)
        out = np.zeros((len(texts), len(self.langs)))
        has = np.flatnonzero(counts)
        if len(has):
            first = np.concatenate([[0], np.cumsum(counts[has])[:-1]])
            out[has] = -np.add.reduceat(self._log(keys, ORDER), first, axis=0, dtype=np.float64) / counts[has][:, None]
        return out, counts

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        return decide(self, *self.entropies(texts)) if self.langs else [("und", 0.0, True)] * len(texts)

    @classmethod
    def of(cls, langs: list[str], counts: DataFrame) -> Model:
        """Of a ``lang, gram, n`` table of a checked size."""
        got = counts.toArrow()
        of, keys, n = pc.index_in(got.column("lang"), pa.array(langs, pa.string())).to_numpy(), got.column("gram").to_numpy().view(_U), got.column("n").to_numpy()
        by = np.lexsort((keys, of))
        ends = np.searchsorted(of[by], np.arange(len(langs) + 1))
        return cls(langs, [(keys[by[a:b]], n[by[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)])

    def table(self, rows: DataFrame) -> DataFrame:
        """``row, text`` to row, h (entropies by language), n (characters; 0 without a letter)."""
        shared = rows.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                h, n = shared.value.entropies(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(list(h), pa.list_(pa.float64())), pa.array(n, pa.int64())], names=["row", "h", "n"])

        return rows.mapInArrow(run, "row bigint, h array<double>, n bigint")


def discount(once: int, twice: int) -> float:
    return min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.75


def decide(model: Model | Joined, entropy: np.ndarray, counts: np.ndarray) -> list[tuple[str, float, bool]]:
    best = entropy.argmin(1)
    soft = np.exp(-model.sharpness * (entropy - entropy.min(1, keepdims=True)))
    score = 1 / soft.sum(1)
    high = entropy[np.arange(len(entropy)), best] > model.bounds[best]
    return [(model.langs[b], float(s), bool(r)) if n else ("und", 0.0, True) for b, s, r, n in zip(best, score, high, counts, strict=True)]


class Joined:
    """The model as tables, for any number of four-grams."""

    def __init__(self, langs: list[str], counts: DataFrame):
        self.langs = langs
        self.sharpness, self.bounds = 20.0, np.full(len(langs), np.inf)
        self.shares, self.weights = {}, {}
        rows = counts
        for n in range(ORDER, 0, -1):
            if n < ORDER:
                rows = staged(rows.groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << 16 * n) - 1)).alias("gram")).agg(F.count("*").alias("n")), f"grams{n}")
            seen = rows.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect()
            cuts = F.create_map(*[F.lit(x) for r in seen for x in (r.lang, discount(r.once, r.twice))])
            own = rows.select("lang", "gram", "n", F.shiftrightunsigned("gram", 16).alias("context"))
            contexts = own.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
            share = own.join(contexts, ["lang", "context"]).select("lang", "gram", (F.greatest(F.col("n") - cuts[F.col("lang")], F.lit(0.0)) / F.col("total")).alias("v"))
            weight = contexts.select("lang", "context", (cuts[F.col("lang")] * F.col("kinds") / F.col("total")).alias("v"))
            self.shares[n], self.weights[n] = staged(_by_language(share, "gram"), f"shares{n}"), staged(_by_language(weight, "context"), f"weights{n}")
        self.floor = 1 / (max(1, rows.select("gram").distinct().count()) + 1)

    def table(self, rows: DataFrame) -> DataFrame:
        """``row, text`` to row, h (entropies by language), n (characters); texts without a letter have no row."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                keys, counts = keys_of(batch.column("text").to_pylist())
                of = np.repeat(batch.column("row").to_numpy(), counts)
                by = np.lexsort((keys, of))
                of, keys = of[by], keys[by]
                first = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (keys[1:] != keys[:-1]))) if len(of) else by
                yield pa.RecordBatch.from_arrays([pa.array(of[first]), pa.array(keys[first].view(np.int64)), pa.array(np.diff(np.append(first, len(of))))], names=["row", "gram", "times"])

        each = staged(rows.mapInArrow(run, "row bigint, gram bigint, times bigint"), "document-grams")
        p = F.array(*[F.lit(self.floor)] * len(self.langs))
        looked = each.select("gram").distinct()
        for n in range(1, ORDER + 1):
            gram = F.col("gram").bitwiseAND(F.lit((1 << 16 * n) - 1)) if n < ORDER else F.col("gram")
            looked = looked.join(self.shares[n].withColumnsRenamed({"gram": "g", "v": "share"}), gram == F.col("g"), "left")
            looked = looked.join(self.weights[n].withColumnsRenamed({"context": "c", "v": "weight"}), F.shiftrightunsigned(gram, 16) == F.col("c"), "left")
            below = p if n == 1 else F.col("p")
            values = [F.coalesce(F.col("share")[k], F.lit(0.0)) + F.coalesce(F.col("weight")[k], F.lit(1.0)) * below[i] for i, k in enumerate(self.langs)]
            looked = looked.select("gram", F.array(*values).alias("p"))
        logs = staged(looked.select("gram", F.transform("p", lambda x: F.log(x)).alias("logs")), "gram-logs")
        sums = [F.sum(F.col("logs")[i] * F.col("times")) for i in range(len(self.langs))]
        total = F.sum("times")
        return each.join(logs, "gram").groupBy("row").agg(F.array(*[-s / total for s in sums]).alias("h"), total.alias("n"))


def _by_language(rows: DataFrame, key: str) -> DataFrame:
    """key, v: a map from language to value."""
    return rows.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("lang", "v"))).alias("v"))


def count_grams(rows: DataFrame) -> DataFrame:
    """Four-gram counts of ``lang, text, apart`` rows: lang, gram, n, n_rest (without the rows that stand apart)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, bool], list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, apart), parts in seen.items():
                uniq, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(uniq)), pa.array(uniq.view(np.int64)), pa.array(n), pa.array(n * (not apart))], names=["lang", "gram", "n", "n_rest"])
            seen.clear()

        for batch in slices(batches, "text"):
            groups: dict[tuple[str, bool], list] = {}
            for lang, apart, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "apart", "text")), strict=True):
                groups.setdefault((lang, apart), []).append(text)
            for group, texts in groups.items():
                got = np.unique(keys_of(texts)[0], return_counts=True)
                size += len(got[0])
                seen.setdefault(group, []).append(got)
            if size > 4_000_000:
                yield from flush()
                size = 0
        yield from flush()

    return rows.select("lang", "apart", "text").mapInArrow(run, "lang string, gram bigint, n bigint, n_rest bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("n_rest").alias("n_rest"))


def train(rows: DataFrame, *, id_col: str | None = None, sample: int = SAMPLE, cells: int = CELLS) -> Model | Joined:
    """A model of ``lang, text`` rows; by ``id_col``, or by their place where there is none, rows are sampled for calibration."""
    known = rows.where("lang is not null and text is not null")
    share = math.ceil(1e6 * min(0.1, sample / max(known.count(), 1)))
    number = F.col(id_col) if id_col else F.monotonically_increasing_id()  # copies of a text are rows of their own
    marked = known.select(F.col("lang").cast("string").alias("lang"), "text", (F.pmod(F.xxhash64("text", number), F.lit(1_000_000)) < share).alias("apart"))
    counts = staged(count_grams(marked), "grams")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if not langs:
        return Model([], [])
    build = Model.of if counts.select("gram").distinct().count() * len(langs) <= cells else Joined
    trial = build(langs, counts.where("n_rest > 0").select("lang", "gram", F.col("n_rest").alias("n")))
    model = build(langs, counts.select("lang", "gram", "n"))
    model.sharpness, model.bounds = calibrate(trial, marked.where("apart").select("lang", "text"))
    return model


def calibrate(model: Model | Joined, rows: DataFrame) -> tuple[float, np.ndarray]:
    """Sharpness and bounds, from rows that the model was not counted on."""
    numbered = staged(rows.withColumn("row", F.monotonically_increasing_id()), "calibration")
    got = numbered.drop("text").join(model.table(numbered.select("row", "text")).where("n > 0"), "row").select("lang", "h").toArrow()
    bounds = model.bounds.copy()
    true = np.array([model.langs.index(k) for k in got.column("lang").to_pylist()], np.int64)
    if not len(true):
        return model.sharpness, bounds
    h = np.array(got.column("h").to_pylist())
    for j in set(true.tolist()):
        bounds[j] = float(np.quantile(h[true == j, j], 1 - REJECT)) + 0.05
    h = h - h.min(1, keepdims=True)

    def loss(beta: float) -> float:
        return float((beta * h[np.arange(len(h)), true] + np.log(np.exp(-beta * h).sum(1))).mean())

    return float(min(np.geomspace(0.5, 200, 60), key=loss)), bounds


def identify(docs: DataFrame, model: Model | Joined, *, text: Column | str = "text", keep: tuple[Column, ...] = ()) -> DataFrame:
    """The kept columns, lang_pred, score, rejected. Nothing but the text is looked at."""
    own = docs.select(*keep, (F.col(text) if isinstance(text, str) else text).alias("__text"))
    names = own.columns[:-1]
    schema = StructType([*own.schema.fields[:-1], *StructType.fromDDL("lang_pred string, score double, rejected boolean").fields])

    def answer(batch: pa.RecordBatch, got: list[tuple[str, float, bool]]) -> pa.RecordBatch:
        cols = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *cols], names=[*names, "lang_pred", "score", "rejected"])

    if isinstance(model, Joined):
        numbered = staged(own.withColumn("__row", F.monotonically_increasing_id()), "numbered")
        found = model.table(numbered.select(F.col("__row").alias("row"), F.col("__text").alias("text"))).withColumnsRenamed({"row": "__of", "h": "__h", "n": "__n"})
        plain = Decision(model.langs, model.sharpness, model.bounds)

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            none = [0.0] * len(plain.langs)
            for batch in batches:
                h = np.array([x or none for x in batch.column("__h").to_pylist()]).reshape(batch.num_rows, len(none))
                yield answer(batch, decide(plain, h, pc.fill_null(batch.column("__n"), 0).to_numpy()))

        return numbered.drop("__text").join(found, F.col("__row") == F.col("__of"), "left").select(*[F.col(f"`{n}`") for n in names], "__h", "__n").mapInArrow(judge, schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            yield answer(batch, shared.value.predict(batch.column("__text").to_pylist()))

    return own.mapInArrow(run, schema)


@dataclass(frozen=True)
class Decision:
    """What deciding needs of a model, without its tables."""

    langs: list[str]
    sharpness: float
    bounds: np.ndarray
