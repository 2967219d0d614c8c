"""Lempel-Ziv phrase fingerprints: texts are alike as far as they would share a compressor's dictionary.

A text is parsed into phrases, each the longest one that is in the dictionary so far and one character more, which then is a phrase of the
dictionary (the last one may be a phrase again). The set of phrases is hashed to 32 bits, and the ``SIZE`` least hashes, in order, are the
fingerprint: a minimum-hash signature of the set. Of two fingerprints the least ``SIZE`` hashes of both together are a sample
of all phrases of either text, and the share of it that is in both is their likeness; for texts with fewer phrases it is exact.

Phrases are found in one pass over the text, down a tree of their characters. Hashes are made of all phrases at once from sums of the
text's prefixes.

Texts next to each other (``with_next``) meet by one shuffle: blocks of consecutive ids are dealt to tasks and read in order, with the
first row of the following block after them. Blocks are ranges of an order by id and text hash, found from ids and hashes alone.

Cases: null text is empty text, which has no phrases and an empty fingerprint; two empty fingerprints have likeness 1, one has 0 with any
other; ids descend with null ids last, rows of one id are in the order of their texts' hashes; the text after the last is the first, so a
single text follows itself; an empty table gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import slices, staged

#: Hashes of a fingerprint.
SIZE = 128
#: Rows of a block of neighbours, and the most blocks.
BLOCK, MOST_BLOCKS = 1000, 10_000
_U = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def parse(text: str, start: int, stop: int, words: dict, ends: list[int], parents: list[dict] | None = None) -> int:
    """Adds the phrases of ``text[start:stop]`` to the dictionary, a tree of characters, and their ends to ``ends``; ``parents``: where each one hangs.
    Returns where the phrase begins that ``stop`` cuts short."""
    node = words
    for i, c in enumerate(text[start:stop], start + 1):
        below = node.get(c)
        if below is None:
            node[c] = {}
            ends.append(i)
            if parents is not None:
                parents.append(node)
            node = words
        else:
            node = below
    return max(start, ends[-1]) if ends else start


class Powers:
    """Powers of the multiplier and of its inverse, as many as the longest text so far needs."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, _U), np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * _U(pow(_MULTIPLIER, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * _U(pow(_INVERSE, k, 1 << 64))])
        return self.up[:n], self.down[:n]


_powers = Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def hashes(text: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """32-bit hashes of the pieces ``text[start:end]``; equal pieces have equal ones wherever they stand."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    up, down = _powers.upto(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, _U)
    np.cumsum(mixed(codes.astype(_U) + _U(1)) * up[:-1], out=sums[1:])
    return (mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U)) >> _U(32)).astype(np.uint32)


def least(values: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The ``size`` least different values, in order."""
    for most in (4 * size, len(values)):
        few = np.sort(np.partition(values, most)[:most] if most < len(values) else values)
        few = few[np.append(True, few[1:] != few[:-1])] if len(few) else few
        if len(few) >= size or most >= len(values):
            break
    return few[:size]


class Parsed:
    """A text's dictionary as it was up to ``cut``, where an edit may begin, and its fingerprint."""

    def __init__(self, text: str, kept: int, size: int = SIZE):
        self.text, self.kept, self.size = text, kept, size
        self.words: dict = {}
        self.ends: list[int] = []
        self.cut = parse(text, 0, kept, self.words, self.ends)
        more: list[int] = []
        parents: list[dict] = []
        rest = parse(text, self.cut, len(text), self.words, more, parents)
        for end, parent in zip(more, parents, strict=True):
            del parent[text[end - 1]]
        self.print = self._least(text, self.ends + more, rest)

    def _least(self, text: str, ends: list[int], rest: int) -> np.ndarray:
        stops = np.array(ends + ([len(text)] if rest < len(text) else []), np.int64)
        if not len(stops):
            return np.zeros(0, np.uint32)
        return least(hashes(text, np.append(0, stops[:-1]), stops), self.size)

    def edited(self, tail: str) -> tuple[str, np.ndarray]:
        """The text with ``tail`` after what is kept, and its fingerprint; the phrases before the cut are parsed already. Uses the dictionary up."""
        text = self.text[: self.kept] + tail
        rest = parse(text, self.cut, len(text), self.words, self.ends)
        return text, self._least(text, self.ends, rest)


def fingerprint(text: str | None, size: int = SIZE) -> np.ndarray:
    return Parsed(text or "", 0, size).print


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """The share of the least hashes of both together that is in both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    different = np.append(True, ~twice)
    n = min(size, int(different.sum()))
    last = both[different][n - 1]
    return float((twice & (both[1:] <= last)).sum() / n)


def shown(values: np.ndarray) -> str:
    """Base64 of the hashes, four bytes each, the lower first."""
    return base64.b64encode(values.astype("<u4").tobytes()).decode()


def read(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u4")


def fingerprints(docs: DataFrame, *keep: Column, text_col: str = "text", size: int = SIZE) -> DataFrame:
    """The kept columns and ``fingerprint``; one pass without a shuffle."""
    own = docs.select(*keep, F.col(text_col).alias("__text"))
    names = own.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            made = [shown(fingerprint(t, size)) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(made, pa.string())], names=[*names, "fingerprint"])

    return own.mapInArrow(run, own.drop("__text").withColumn("fingerprint", F.lit("")).schema)


#: An order of rows: id descending, null ids last, then text hash.
ORDER = "struct<none: boolean, down: bigint, hash: bigint>"


def neighbours(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, most: int = MOST_BLOCKS) -> DataFrame:
    """``block, extra, order, id, text``, in tasks that hold whole blocks, by block and order; after each block's rows comes, as ``extra``, the first of
    the next block (after the last: of the first)."""
    i, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    order = F.struct(i.isNull().alias("none"), F.coalesce(F.bitwise_not(i), F.lit(0).cast("long")).alias("down"), F.xxhash64(text).alias("hash"))
    orders = staged(docs.select(order.alias("order")), "orders")
    blocks = max(1, min(most, -(-orders.count() // block)))
    dealt = orders.repartitionByRange(blocks, "order").groupBy(F.spark_partition_id()).agg(F.min("order").alias("order"))
    firsts = [r.order.asDict() for r in dealt.sort("order").collect()]  # ``most`` of three numbers
    heads, n = F.from_json(F.lit(json.dumps(firsts)), f"array<{ORDER}>"), len(firsts)

    def halved(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["low"] + s["high"], 1)
        upper, lower = F.struct(mid.alias("low"), s["high"].alias("high")), F.struct(s["low"].alias("low"), mid.alias("high"))
        return F.when(s["high"] - s["low"] <= 1, s).when(heads[mid] <= F.col("order"), upper).otherwise(lower)

    begin = F.struct(F.lit(0).alias("low"), F.lit(n).alias("high"))
    at = F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length() + 1)), begin, halved)["low"]
    rows = docs.select(order.alias("order"), i.alias("id"), text.alias("text")).withColumn("at", at)
    own = F.struct(F.col("at").alias("block"), F.lit(False).alias("extra"))
    before = F.struct(F.pmod(F.col("at") - 1, F.lit(max(n, 1))).alias("block"), F.lit(True).alias("extra"))
    each = F.explode(F.when(heads[F.col("at")] == F.col("order"), F.array(own, before)).otherwise(F.array(own))).alias("to")
    return rows.select(each, "order", "id", "text").select("to.block", "to.extra", "order", "id", "text").repartition("block").sortWithinPartitions("block", "extra", "order")


NEXT = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, **how: int) -> DataFrame:
    """Per row: id, n_chars (code points), the fingerprint, that of the edited text, in which the last third gives way to the beginning of the next
    row's text, the edited text's SHA-256, and how like the row is to its edited text and to the next row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: Parsed | None = None
        last_id = last_block = None
        for whole in batches:
            for batch in slices([whole], "text"):
                out = []
                for block, extra, i, text in zip(*(batch.column(c).to_pylist() for c in ("block", "extra", "id", "text")), strict=True):
                    if extra and (last is None or block != last_block):
                        continue  # another first row of the next block that is the same
                    now = Parsed(text, len(text) - len(text) // 3, size)
                    if last is not None:
                        if block != last_block:
                            raise ValueError(f"block {last_block} ends without the row after it")
                        edited, other = last.edited(text[: len(last.text) - last.kept])
                        name = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                        out.append((last_id, len(last.text), name, shown(last.print), shown(other), likeness(last.print, other, size), likeness(last.print, now.print, size)))
                    last, last_id, last_block = (None, None, None) if extra else (now, i, block)
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)
        if last is not None:
            raise ValueError(f"block {last_block} ends without the row after it")

    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    return neighbours(docs, id_col=id_col, text_col=text_col, **how).select("block", "extra", "id", "text").mapInArrow(run, f"doc_id bigint, {NEXT}").withColumnRenamed("doc_id", id_col)
