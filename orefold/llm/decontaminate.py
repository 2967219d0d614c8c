"""Benchmark decontamination with suffix arrays over the training text.

Every shard of the corpus (an Arrow slice of documents inside a task) gets a suffix array over its words.
Each suffix of each benchmark item is binary-searched in it; a suffix that finds a range of at least one
window (13 words, or the whole of a shorter item) gives the places where the window occurs verbatim.
Neighbouring windows on one diagonal join into maximal verbatim matches.

The array is sparse: it holds the suffixes whose first two words stand side by side in some item, because
no other suffix can match, and for the same reason only test suffixes that begin with two words of the shard are searched.
Words that no item has are one and the same foreign word.

Documents are never shuffled. The benchmark goes to the executors in blocks of a checked size: as long as its index
is under ``block_bytes`` there is one block and one pass; beyond it each block gets a pass of its own over the stored, numbered
rows and the passes' matches are joined by row.

Cases: null or wordless text has no words and no hits; empty benchmark or items without words hit nothing;
repeated items each count; repeated documents, and different ones of one id, are judged each by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .base import as_bytes, slices, staged

WINDOW = 13
#: Bytes of a block's index, which every Python worker holds, and what a word of the benchmark adds to it (ids, places, counts, pairs; its own text, if new).
BLOCK_BYTES, WORD_BYTES = 64 << 20, 48
#: Windows searched, and pairs of places joined, at a time.
SEARCHED, PAIRS = 1 << 16, 1 << 20

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

SCHEMA = (
    "n_words long, spans array<struct<start:long,stop:long>>, "
    "matches array<struct<item_id:string,start:long,item_start:long,length:long>>, items array<string>"
)


def words_of(data: bytes | None) -> list[bytes]:
    """ASCII lower case, then runs of digits, letters a-z and anything beyond ASCII."""
    return data.translate(_WORD_BYTES).split() if data else []


class TestSuffixes:
    """One block of the benchmark as flat arrays: word ids, and the places of its windows in the order of their words.

    Equal windows are one, with as many places as it has. Only the words themselves are kept as a dictionary, made where the index is used.
    """

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.window = window
        self.items = [item for item, _ in items]
        vocab: dict[bytes, int] = {}
        parts = [np.array([vocab.setdefault(w, len(vocab) + 1) for w in words_of(data)], np.uint32) for _, data in items]
        self.words = b" ".join(vocab)
        self.span = len(vocab) + 1
        lengths = np.array([len(p) for p in parts], np.int64)
        self.item_starts = np.cumsum(lengths + 1) - lengths - 1
        flat = np.zeros(int((lengths + 1).sum()) + window, np.uint32)
        for start, own in zip(self.item_starts.tolist(), parts, strict=True):
            flat[start : start + len(own)] = own
        self.flat = flat
        #: words of a window of each item
        self.sizes_of_items = np.minimum(lengths, window)
        per_item = np.where(lengths > 0, lengths - self.sizes_of_items + 1, 0)
        item_of = np.repeat(np.arange(len(parts)), per_item)
        starts = np.arange(int(per_item.sum())) - np.repeat(np.cumsum(per_item) - per_item, per_item) + self.item_starts[item_of]
        rows = self.rows(starts, self.sizes_of_items[item_of], 0)
        order = np.argsort(_keys(rows), kind="stable")
        opens = np.flatnonzero(np.append(True, (rows[order[1:]] != rows[order[:-1]]).any(1))) if len(order) else np.zeros(0, np.int64)
        self.places = starts[order]
        # the places of window k are those from first[k] on, count[k] of them
        self.first = opens
        self.count = np.diff(np.append(opens, len(order)))
        self.sizes = self.sizes_of_items[item_of[order[opens]]]
        head = self.places[opens]
        second = np.where(self.sizes > 1, flat[head + 1] if len(head) else 0, 0).astype(np.int64)
        #: the first two words of each window, in the order of the windows; the second is 0 where a window is one word
        self.pairs = flat[head].astype(np.int64) * self.span + second

    def rows(self, starts: np.ndarray, sizes: np.ndarray, rest: int) -> np.ndarray:
        """The words of windows as big-endian numbers, ``rest`` where a window has no word."""
        out = self.flat[starts[:, None] + np.arange(self.window)].astype(">u4")
        out[np.arange(self.window) >= sizes[:, None]] = rest
        return out

    @cached_property
    def vocab(self) -> dict[bytes, int]:
        return {w: k for k, w in enumerate(self.words.split(b" ") if self.words else [], 1)}

    def nbytes(self) -> int:
        return sum(v.nbytes for v in vars(self).values() if isinstance(v, np.ndarray)) + len(self.words)

    def suffix_array(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys and positions of the suffixes that can match, and the windows that can; ids ends with ``window`` zeros."""
        known = np.flatnonzero(ids[: -self.window])
        pair = ids[known].astype(np.int64) * self.span
        asked = np.unique(np.concatenate([pair, pair + ids[known + 1]]))
        lo, hi = np.searchsorted(self.pairs, asked, "left"), np.searchsorted(self.pairs, asked, "right")
        there = asked[hi > lo]
        at = known[_among(pair + ids[known + 1], there) | _among(pair, there)]
        n = (hi - lo)[hi > lo]
        windows = np.arange(int(n.sum())) + np.repeat(lo[hi > lo] - np.cumsum(n) + n, n)
        keys = _keys(ids[at[:, None] + np.arange(self.window)].astype(">u4"))
        order = np.argsort(keys, kind="stable")
        return keys[order], at[order], windows

    def search(self, docs: list[bytes | None]) -> list[tuple[int, list, list, list]]:
        get = self.vocab.get
        parts, starts, n = [], [], 0
        counts = []
        for data in docs:
            words = words_of(data)
            starts.append(n)
            counts.append(len(words))
            parts.append(np.fromiter((get(w, 0) for w in words), np.uint32, len(words)))
            parts.append(np.zeros(1, np.uint32))
            n += len(words) + 1
        out = [(c, [], [], []) for c in counts]
        if not len(self.first) or not docs:
            return out
        ids = np.concatenate([*parts, np.zeros(self.window, np.uint32)])
        keys, at, windows = self.suffix_array(ids)
        ranges = []
        for some in range(0, len(windows), SEARCHED):
            k = windows[some : some + SEARCHED]
            starts_of = self.places[self.first[k]]
            lo = np.searchsorted(keys, _keys(self.rows(starts_of, self.sizes[k], 0)), "left")
            hi = np.searchsorted(keys, _keys(self.rows(starts_of, self.sizes[k], 0xFFFFFFFF)), "right")
            hit = hi > lo
            ranges.append((k[hit], lo[hit], hi[hit]))
        if not sum(len(k) for k, _, _ in ranges):
            return out
        found, lo, hi = (np.concatenate(c) for c in zip(*ranges, strict=True))
        n_found = hi - lo
        window_of = np.repeat(found, n_found)
        pos = at[np.arange(int(n_found.sum())) + np.repeat(lo - np.cumsum(n_found) + n_found, n_found)]
        order = np.argsort(pos, kind="stable")
        pos, window_of = pos[order], window_of[order]
        starts = np.array(starts)
        reach = np.maximum.accumulate(pos + self.sizes[window_of])
        opens = np.flatnonzero(np.append(True, pos[1:] > reach[:-1]))
        begin, stop = pos[opens], reach[np.append(opens[1:], len(pos)) - 1]
        for d, p, e in zip((np.searchsorted(starts, begin, "right") - 1).tolist(), begin.tolist(), stop.tolist(), strict=True):
            out[d][1].append([p - int(starts[d]), e - int(starts[d])])
        item, diagonal, p, size = self.matches(pos, window_of)
        doc = np.searchsorted(starts, p, "right") - 1
        by = np.lexsort((p - diagonal, item, p))
        for d, i, a, j, n in zip(*(c[by].tolist() for c in (doc, item, p - starts[doc], p - diagonal, size)), strict=True):
            out[d][2].append([self.items[i], a, j, n])
        for d in set(doc.tolist()):
            out[d][3].extend(sorted({m[0] for m in out[d][2]}))
        return out

    def matches(self, pos: np.ndarray, window_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Maximal verbatim matches (item, diagonal, place, words) of windows found at sorted places; at most ``PAIRS`` or one place's pairs of
        a found place and an item's place are looked at together, so texts that repeat themselves take time, not memory."""
        pairs = np.cumsum(self.count[window_of])
        parts, start = [], 0
        while start < len(pos):
            before = int(pairs[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(pairs, before + PAIRS, "right")))
            k = window_of[start:stop]
            n = self.count[k]
            which = np.arange(int(n.sum())) + np.repeat(self.first[k] - np.cumsum(n) + n, n)
            p = np.repeat(pos[start:stop], n)
            place = self.places[which]
            item = np.searchsorted(self.item_starts, place, "right") - 1
            parts.append(_joined(item, p - (place - self.item_starts[item]), p, np.repeat(self.sizes[k], n), self.sizes_of_items))
            start = stop
        return _joined(*(np.concatenate(c) for c in zip(*parts, strict=True)), self.sizes_of_items)


def _joined(item: np.ndarray, diagonal: np.ndarray, p: np.ndarray, size: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Matches of one item and diagonal whose windows follow each other, made one."""
    by = np.lexsort((p, diagonal, item))
    item, diagonal, p, size = item[by], diagonal[by], p[by], size[by]
    end = p + size
    opens = np.flatnonzero(np.append(True, (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (p[1:] > end[:-1] - window[item[1:]] + 1)))
    last = np.append(opens[1:], len(p)) - 1
    return item[opens], diagonal[opens], p[opens], end[last] - p[opens]


def _keys(rows: np.ndarray) -> np.ndarray:
    rows = np.ascontiguousarray(rows)
    return rows.view(f"V{rows.shape[1] * 4}").reshape(-1)


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark in blocks whose indexes take about ``block_bytes``, decided by its counted words; an item is in one block."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))
    words = F.regexp_count(F.col(text_col).cast("string"), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    size = benchmark.agg(F.coalesce(F.sum(F.coalesce(words, F.lit(0)) * WORD_BYTES + 64), F.lit(0))).first()[0]
    n = 1 + size // block_bytes
    return [rows] if n == 1 else [rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def _one_block(docs: DataFrame, text_col: str, block: DataFrame, window: int) -> DataFrame:
    """The index is made once, here, and broadcast; a Python worker reads it once for all its tasks."""
    items = [(r.item if r.item is not None else "", bytes(r.text) if r.text is not None else None) for r in block.toLocalIterator()]
    shared = docs.sparkSession.sparkContext.broadcast(TestSuffixes(items, window))
    result = [*docs.columns, *StructType.fromDDL(SCHEMA).names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in slices(batches, text_col):
            found = index.search(as_bytes(batch.column(text_col)))
            cols = [
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([[{"start": a, "stop": b} for a, b in f[1]] for f in found], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                pa.array(
                    [[{"item_id": m[0], "start": m[1], "item_start": m[2], "length": m[3]} for m in f[2]] for f in found],
                    pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())])),
                ),
                pa.array([f[3] for f in found], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=result)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *StructType.fromDDL(SCHEMA).fields]))


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: ``doc_id``, its number of words, hit word spans, maximal verbatim matches, item ids.

    Only ``doc_col`` and ``text_col`` are read, so other columns of any name do no harm.
    """
    own = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))
    blocks = blocks_of(benchmark, item_col, item_text_col, block_bytes)
    if len(blocks) == 1:
        return _one_block(own, "text", blocks[0], window).drop("text")
    numbered = _numbered(own, "decontaminate-rows")
    return numbered.select("row", "doc_id").join(_all_blocks(numbered.select("row", "text"), blocks, window), "row").drop("row")


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """Stored with a number for each row, so that passes agree on it."""
    return staged(docs.withColumn("row", F.monotonically_increasing_id()), name)


def _all_blocks(rows: DataFrame, blocks: list[DataFrame], window: int) -> DataFrame:
    """What the passes over ``row, text`` find, by row."""
    parts = [_one_block(rows, "text", b, window).drop("text") for b in blocks]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    spans = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.expr("cast(array() as array<struct<start:bigint,stop:bigint>>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= x["start"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["stop"], x["stop"]).alias("stop"))),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    return union.groupBy("row").agg(
        F.max("n_words").alias("n_words"), spans.alias("spans"), F.flatten(F.collect_list("matches")).alias("matches"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )


def with_verdict(found: DataFrame, share: int = 20) -> DataFrame:
    """Digest columns; contaminated: some word is hit, and at least one word in ``share`` is."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    return (
        found.withColumn("n_hit", hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join(F.array_sort("items"), ","), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
        .withColumn("longest_match", F.coalesce(F.array_max(F.transform("matches", lambda m: m["length"])), F.lit(0).cast("long")))
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", window: int = WINDOW, share: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that are not contaminated, with the columns they came with; each row is judged by itself.

    With one block no row leaves its task; beyond it the verdicts are joined by the row's number.
    """
    blocks = blocks_of(benchmark, "item_id", "text", block_bytes)
    body = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("body")
    own = docs.select(body, F.col(text_col).alias("text"))
    if len(blocks) == 1:
        return with_verdict(_one_block(own, "text", blocks[0], window), share).where(~F.col("contaminated")).select("body.*")
    numbered = _numbered(own, "decontaminate-rows")
    bad = with_verdict(_all_blocks(numbered.select("row", "text"), blocks, window), share).where("contaminated").select("row")
    return numbered.join(bad, "row", "left_anti").select("body.*")
