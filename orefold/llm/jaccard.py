"""Exact Jaccard self-join of word n-gram sets, by T-occurrence search.

A document's set holds 64-bit hashes of its distinct n-grams; equal sets are one class from the start, so exact copies
cost nothing more. Two classes link if 100 * intersection >= share * union, which asks for an overlap of at least
T(m, n) = ceil(share (m + n) / (100 + share)). The search has these steps, all as Spark jobs:

1. A pass over the texts gives each document's class, and the n-grams that several documents of a task share. The
   most frequent of these over the corpus (at most ``HOT``) are broadcast. They only decide the order of
   n-grams within a set, rare before frequent; any order gives the same links.
2. A pass gives each class's prefix, its n - T + 1 first n-grams for the least possible T. Two linked classes share
   k >= T(m, n) - ceil(share max(m, n) / 100) + 1 n-grams of their prefixes, one at least. The prefixes are the inverted lists;
   lists with one class fall out.
3. T-occurrence over these lists, as DivideSkip divides them: pairs are only made in short lists (at most ``SHORT``
   classes) and counted; a pair stays if its count and the number of its long lists (the lesser of both) reach k. What hangs
   together by such pairs is a search group. A pair that meets in long lists alone is found in the groups of these: the
   classes of long lists that could reach k there, grouped by the list's pivot, its class of least hash. Large
   groups are cut in chunks, and every pair of chunks is a task of its own, so a task's rows are bounded.
4. In each group the sets are indexed and every class is a query: DivideSkip merges the short lists of its n-grams in
   sorted order, keeps those seen T - L times, and binary-searches them for the n-grams of the L longest lists. Classes already
   connected aren't compared again; a group gives a spanning forest of its links.
5. Connected components over these links.

Nothing is capped: every pair that can link meets in a group. Fixed-size bitmaps only spare work (a bit set by
chance lets a row through that a later step drops).

Cases: null or wordless text has an empty set, which links with nothing and is its own component; a null id is the
component of its row if it is alone; repeated rows are one class; an empty table gives an empty result; ``cluster`` reads the two named
columns only. Class keys and
n-grams are 64-bit hashes: two different ones fall together once in 2^64.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .base import as_bytes, slices, staged
from .graph import components

HOT = 1 << 18
SHORT = 64
LEAST_CHUNK, MOST_CHUNK = 128, 4096
_U = np.uint64


def grams(data: bytes | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of words; fewer words than ``size`` are one n-gram."""
    words = data.lower().split() if data else []  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, _U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
    n = min(size, len(words))
    out = h[: len(h) - n + 1] + _U(n)
    for k in range(1, n):
        out = (out ^ (out >> _U(29))) * _U(0xBF58476D1CE4E5B9) + h[k : len(h) - n + 1 + k]
    out = (out ^ (out >> _U(32))) * _U(0x9E3779B97F4A7C15)
    return np.unique(out ^ (out >> _U(31)))


def class_of(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63) if len(own) else 0


def overlap_needed(m: int | np.ndarray, n: int | np.ndarray, share: int) -> int | np.ndarray:
    return -(-share * (m + n) // (100 + share))


def ordered(own: np.ndarray, hot: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Rare before frequent, then by hash."""
    if not len(hot):
        return own
    at = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
    return own[np.lexsort((own, np.where(hot[at] == own, times[at], 0)))]


def prefix_size(n: int, share: int) -> int:
    return n - -(-share * n // 100) + 1


def classes(docs: DataFrame, doc_col: str, text_col: str, size: int, *more: Column) -> DataFrame:
    """Rows of two kinds, stored: kind 0: doc_id, class, n, and more columns;  kind 1: an n-gram (as class) that n sets of a task have."""
    own = docs.select(F.col(doc_col).alias("doc_id"), *more, F.col(text_col).alias("text"))
    extra = own.schema.fields[1:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []
        met: set[int] = set()
        held = 0

        def repeated(given: list[pa.DataType]) -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(seen), return_counts=True)
            h, n = h[n > 1], n[n > 1]
            cols = [pa.array(np.ones(len(h), np.int32)), pa.array(h.view(np.int64)), pa.array(n.astype(np.int64)), *(pa.nulls(len(h), t) for t in given)]
            return pa.RecordBatch.from_arrays(cols, names=names)

        names = ["kind", "class", "n", "doc_id", *(f.name for f in extra)]
        for batch in slices(batches, "text"):
            keys, sizes = [], []
            for data in as_bytes(batch.column("text")):
                g = grams(data, size)
                keys.append(class_of(g))
                sizes.append(len(g))
                if len(g) and keys[-1] not in met:
                    met.add(keys[-1])
                    seen.append(g)
                    held += len(g)
            given = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(keys), np.int32)), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), *given], names=names)
            if held > 2_000_000:
                yield repeated([c.type for c in given])
                seen, held = [], 0
                met.clear()
        if seen:
            yield repeated([c.type for c in given])

    fields = [StructField("kind", IntegerType()), StructField("class", LongType()), StructField("n", LongType()), StructField("doc_id", own.schema[0].dataType), *(StructField(f.name, f.dataType) for f in extra)]
    return staged(own.mapInArrow(run, StructType(fields)), "classes")


def bit(column: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(column), 64 - bits)


def bitmap(keys: DataFrame, column: str, bits: int = 25) -> np.ndarray:
    """A bitmap of 2^bits bits of the hashed keys, made by Spark in parts of 4 KB, at most 4 MB in all."""
    out = np.zeros(1 << (bits - 3), np.uint8)
    place = bit(F.col(column), bits)
    parts = keys.groupBy(F.bitmap_bucket_number(place + 1).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)).alias("bits"))
    for r in parts.toLocalIterator():
        own = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["part"] - 1) * 4096 :][: len(own)] = own[: len(out)]
    return out


def has_bit(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def entries(docs: DataFrame, text_col: str, size: int, share: int, hot: object, keep: object | None, bits: int = 25) -> DataFrame:
    """Prefix entries: gram, class, n, place. ``keep``: a bitmap of the grams worth giving."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        often, times = hot.value
        for batch in slices(batches, "text"):
            parts, of, sizes = [], [], []
            for data in as_bytes(batch.column("text")):
                g = grams(data, size)
                key = class_of(g)
                if not len(g) or key in done:
                    continue
                done.add(key)
                parts.append(ordered(g, often, times)[: prefix_size(len(g), share)])
                of.append(key)
                sizes.append(len(g))
            if len(done) > 1_000_000:
                done.clear()
            if not parts:
                continue
            k = [len(p) for p in parts]
            gram = np.concatenate(parts)
            place = np.arange(len(gram)) - np.repeat(np.cumsum(k) - k, k)
            cols = [gram.view(np.int64), np.repeat(np.array(of, np.int64), k), np.repeat(np.array(sizes, np.int32), k), place.astype(np.int32)]
            if keep is not None:
                inside = has_bit(keep.value, (_mix(gram) >> _U(64 - bits)).astype(np.int64))
                cols = [c[inside] for c in cols]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["gram", "class", "n", "place"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "gram bigint, class bigint, n int, place int")


def _mix(gram: np.ndarray) -> np.ndarray:
    h = gram * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def sets_of(docs: DataFrame, doc_col: str, text_col: str, size: int, wanted: object, bits: int = 25) -> DataFrame:
    """class, grams of the documents whose id has its bit set."""
    own = docs.select(bit(F.col(doc_col), bits).alias("place"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = has_bit(wanted.value, batch.column("place").to_numpy())
            for part in slices([batch.filter(pa.array(inside))], "text"):
                got = [grams(d, size) for d in as_bytes(part.column("text"))]
                yield pa.RecordBatch.from_arrays([pa.array([class_of(g) for g in got], pa.int64()), pa.array([g.tobytes() for g in got], pa.binary())], names=["class", "grams"])

    return own.mapInArrow(run, "class bigint, grams binary")


def search(keys: list[int], sets: list[np.ndarray], share: int, side: list[int] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets (pairs of keys), by DivideSkip.

    ``side``: the chunk of each set; with two chunks, links within one are left to the task that has it alone.
    """
    order = sorted(range(len(keys)), key=lambda i: (len(sets[i]), keys[i]))
    keys, sets = [keys[i] for i in order], [sets[i] for i in order]
    side = [side[i] for i in order] if side else [0] * len(keys)
    cross = len(set(side)) > 1
    n = np.array([len(s) for s in sets])
    whole = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    by = np.lexsort((owner, whole))
    gram, first, back, df = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
    posting = owner[by]  # sorted by gram, then owner: the inverted lists one after the other
    start = np.concatenate([[0], np.cumsum(df)])
    local = np.split(back, np.cumsum(n)[:-1])
    root = list(range(len(keys)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for q in range(len(keys)):
        lists = local[q]
        lists = lists[np.argsort(df[lists], kind="stable")]
        least = int(np.searchsorted(n, -(-share * int(n[q]) // 100)))  # smaller sets can't link; larger ones are queries themselves
        t = int(overlap_needed(int(n[q]), max(int(n[least]), 1), share))
        # L longest lists are probed: more of them when the lists are long, T - 1 at most
        longest = int(df[lists[-1]])
        count_long = min(t - 1, int(t / (0.01 * math.log(max(longest, 2)) + 1)))
        short, long = lists[: len(lists) - count_long], lists[len(lists) - count_long :]
        merged = np.sort(np.concatenate([posting[start[g] : start[g + 1]] for g in short[df[short] > 1]] or [np.zeros(0, np.int64)]), kind="stable")
        merged = merged[(merged < q) & (merged >= least)]
        found, times = np.unique(merged, return_counts=True)
        for c, k in zip(found.tolist(), times.tolist(), strict=True):
            need = int(overlap_needed(int(n[q]), int(n[c]), share))
            if k + count_long < need or (cross and side[c] == side[q]):
                continue
            a, b = find(q), find(c)
            if a == b:
                continue
            at = np.searchsorted(sets[c], gram[long])
            k += int((sets[c][np.minimum(at, len(sets[c]) - 1)] == gram[long]).sum())
            if k >= need:
                root[max(a, b)] = min(a, b)
                links.append((keys[q], keys[c]))
    return links


def groups_search(rows: DataFrame, share: int) -> DataFrame:
    """``kind, pivot, one, two, class, side, grams``, dealt by the first four and sorted: links a, b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                links = search([h[0] for h in held], [h[1] for h in held], share, [h[2] for h in held])
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("kind", "pivot", "one", "two", "class", "side", "grams")]
            for *group, key, side, data in zip(*cols, strict=True):
                if group != now:
                    yield from close()
                    now, held = group, []
                held.append((key, np.frombuffer(data, _U), side))
        yield from close()

    dealt = rows.repartition("kind", "pivot", "one", "two").sortWithinPartitions("kind", "pivot", "one", "two", "class")
    return dealt.select("kind", "pivot", "one", "two", "class", "side", "grams").mapInArrow(run, "a bigint, b bigint")


def links(docs: DataFrame, table: DataFrame, *, doc_col: str, text_col: str, size: int, share: int) -> DataFrame:
    """Links between classes (a, b), enough of them to connect all that is connected."""
    context = docs.sparkSession.sparkContext
    hot = table.where("kind = 1").groupBy("class").agg(F.sum("n").alias("n")).where("n > 4").orderBy(F.desc("n"), "class").limit(HOT).toPandas()
    often = hot["class"].to_numpy(np.int64).view(_U)
    by = np.argsort(often)
    shared_hot = context.broadcast((often[by], hot["n"].to_numpy(np.int64)[by]))

    every = entries(docs, text_col, size, share, shared_hot, None).select("gram", "class")
    lists = every.groupBy("gram").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    few = staged(_filtered(docs, text_col, size, share, shared_hot, lists).select("gram", "class", "n").distinct(), "entries")
    per = few.groupBy("gram").agg(F.count("*").alias("classes"), F.min("n").alias("least"), F.max("n").alias("most"), F.min(F.struct(F.xxhash64("class").alias("by"), F.col("class").alias("pivot"))).alias("p"))
    known = staged(few.join(per.where("classes > 1").select("gram", "classes", "least", "most", "p.pivot"), "gram"), "lists")
    many = known.where(F.col("classes") > SHORT).groupBy("class").agg(F.count("*").alias("long"))
    known = known.join(many, "class", "left").withColumn("long", F.coalesce("long", F.lit(0)))
    members = staged(_near(known, share).unionByName(_among_long(known, share)), "members")
    counts = members.groupBy("kind", "pivot").agg(F.count("*").alias("size")).where("size > 1")
    members = staged(members.join(counts, ["kind", "pivot"]), "members")

    rep = table.where("kind = 0 and n > 0").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    ids = rep.join(members.select("class").distinct(), "class", "left_semi")
    wanted = context.broadcast(bitmap(ids, "doc_id"))
    sets = sets_of(docs, doc_col, text_col, size, wanted).dropDuplicates(["class"])
    chunk = F.least(F.greatest(F.ceil(F.col("size") / 8), F.lit(LEAST_CHUNK)), F.lit(MOST_CHUNK))
    cut = (
        members.withColumn("chunks", F.ceil(F.col("size") / chunk).cast("int"))
        .withColumn("side", F.pmod(F.xxhash64("class", F.lit(5)), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("kind", "pivot", "class", "side", F.least("side", "other").alias("one"), F.greatest("side", "other").alias("two"))
    )
    return groups_search(cut.join(sets, "class"), share)


def _needed(m: Column, n: Column, share: int) -> Column:
    """How many n-grams of their prefixes two linked classes share at least."""
    overlap = F.ceil((m + n) * share / F.lit(100.0 + share) - 1e-9)
    return overlap - F.ceil(F.greatest(m, n) * share / F.lit(100.0) - 1e-9) + 1


def _near(known: DataFrame, share: int) -> DataFrame:
    """kind 0, pivot, class: what hangs together by pairs that short lists let pass."""
    short = known.where(F.col("classes") <= SHORT).select("gram", "class", "n", "long")
    a, b = short.alias("a"), short.alias("b")
    sized = (F.col("a.n") * 100 >= F.col("b.n") * share) & (F.col("b.n") * 100 >= F.col("a.n") * share)
    met = a.join(b, (F.col("a.gram") == F.col("b.gram")) & (F.col("a.class") < F.col("b.class")) & sized)
    pairs = met.groupBy(F.col("a.class").alias("a"), F.col("b.class").alias("b")).agg(
        F.count("*").alias("k"), F.min("a.n").alias("m"), F.min("b.n").alias("n"), F.min(F.least("a.long", "b.long")).alias("long")
    )
    pairs = pairs.where(F.col("k") + F.col("long") >= _needed(F.col("m"), F.col("n"), share))
    return components(pairs.select("a", "b")).select(F.lit(0).alias("kind"), F.col("component").alias("pivot"), F.col("node").alias("class"))


def _among_long(known: DataFrame, share: int) -> DataFrame:
    """kind 1, pivot, class: the classes of long lists that have enough of these for some size of partner in the list."""
    n, long = F.col("n"), F.col("long")
    smaller = F.greatest(F.col("least"), F.ceil(n * share / F.lit(100.0) - 1e-9))
    larger = F.least(F.col("most"), F.floor(n * 100 / F.lit(float(share)) + 1e-9))
    # Up to n what is needed grows with the partner. Above n it isn't monotone, for both parts of it are rounded up: it is more than
    # their difference without rounding, which is least at the largest partner.
    above = F.floor((n + larger) * share / F.lit(100.0 + share) - larger * share / F.lit(100.0) - 1e-9) + 1
    able = (_needed(n, smaller, share) <= long) | (above <= long)
    return known.where((F.col("classes") > SHORT) & able).select(F.lit(1).alias("kind"), "pivot", "class").distinct()


def _filtered(docs: DataFrame, text_col: str, size: int, share: int, hot: object, lists: DataFrame, bits: int = 25) -> DataFrame:
    """The entries of the lists that have several classes, and a few more by chance."""
    keep = docs.sparkSession.sparkContext.broadcast(_gram_bitmap(lists, bits))
    return entries(docs, text_col, size, share, hot, keep, bits)


def _gram_bitmap(lists: DataFrame, bits: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch.column("gram").to_numpy().view(_U)
            yield pa.RecordBatch.from_arrays([pa.array((_mix(gram) >> _U(64 - bits)).astype(np.int64))], names=["place"])

    places = lists.select("gram").mapInArrow(run, "place bigint")
    out = np.zeros(1 << (bits - 3), np.uint8)
    parts = places.groupBy(F.bitmap_bucket_number(F.col("place") + 1).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits"))
    for r in parts.toLocalIterator():
        out[(r["part"] - 1) * 4096 :][:4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _components(docs: DataFrame, table: DataFrame, doc_col: str, text_col: str, size: int, share: int) -> DataFrame:
    """Per class: key, rep (its least doc_id), component_id (the least doc_id that links reach), first (the class that has it; the least of several)."""
    pairs = staged(links(docs, table, doc_col=doc_col, text_col=text_col, size=size, share=share), "links")
    rep = table.where("kind = 0 and n > 0").groupBy("class").agg(F.min("doc_id").alias("rep"))
    of = components(pairs)
    joined = rep.join(of, rep["class"] == of.node, "left").select("class", "rep", F.coalesce("component", "class").alias("component"))
    least = joined.where("rep is not null").groupBy("component").agg(F.min(F.struct("rep", "class")).alias("least"))
    return joined.join(least, "component", "left").select(F.col("class").alias("key"), "rep", F.col("least.rep").alias("component_id"), F.col("least.class").alias("first"))


def cluster(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", size: int = 4, share: int = 85) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id that links reach)."""
    table = classes(docs, doc_col, text_col, size)
    rows = table.where("kind = 0").select("doc_id", "class", F.col("n").alias("n_shingles"))
    final = _components(docs, table, doc_col, text_col, size, share).select("key", "component_id")
    filled, empty = rows.where("n_shingles > 0"), rows.where("n_shingles = 0")
    return (
        filled.join(final, filled["class"] == final.key, "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .unionByName(empty.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    )


def keep_one(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", size: int = 5, share: int = 80) -> DataFrame:
    """Of each component of texts one row: that of the least id (of several texts with this id in one component, that of the least class;
    of equal rows or rows that differ elsewhere, that of the least hash). Rows without an id or without words all stay, but for repeated ones of an id.

    Two different texts under one id are two documents: each is judged by its own links.
    """
    own = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash")
    table = classes(docs, doc_col, text_col, size, own)
    final = _components(docs, table, doc_col, text_col, size, share).where("key = first").select("key", "component_id")
    rows = table.where("kind = 0 and doc_id is not null")
    stay = rows.join(final, (rows["class"] == final.key) & (rows.doc_id == final.component_id), "left_semi").unionByName(rows.where("n = 0"))
    stay = stay.select(F.col("doc_id").alias("__kept"), F.col("text_hash").alias("__same")).distinct()
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if not {"map", "variant"} & set(re.findall(r"\w+", f.dataType.simpleString()))]
    body = docs.select(every.alias("body"), F.col(doc_col).alias("__id"), own.alias("__text"), F.xxhash64(*hashed).alias("__all"))
    known = body.where("__id is not null").join(stay, (F.col("__id") == F.col("__kept")) & (F.col("__text") == F.col("__same")), "left_semi")
    one = known.withColumn("__row", F.row_number().over(Window.partitionBy("__id", "__text").orderBy("__all"))).where("__row = 1")
    return one.select("body.*").unionByName(body.where("__id is null").select("body.*"))
