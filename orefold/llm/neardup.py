"""Near-duplicate embeddings by a robust-pruned flat graph.

1. Vectors that can link (label and vector not null, finite, not zero) with equal label and bits are one class with a
   weight, numbered by a 64-bit hash; so exact copies cost nothing more.
2. A bounded sample (``SAMPLE`` vectors) gives each label centroids by spherical k-means, about one for ``CELL`` vectors and at most
   ``CENTROIDS`` in all. A class goes to its nearest centroid c and to each other centroid b that it might share with a
   neighbour: with r the chord of the threshold, v.(c - b) <= r/2 |c - b|. Of two vectors within r at least one fulfils
   this for the other's cell, so every such pair meets in a shard. Shards are large, so few vectors lie in many. Shards above ``BLOCK`` vectors are cut in chunks and each pair
   of chunks is a shard of its own.
3. Each shard builds a flat graph: candidates are a vertex's nearest and some random ones in the shard, robust pruning keeps
   the nearest p and drops what p is closer to by the factor ``ALPHA``, and so on up to ``DEGREE``; edges go both ways. Parts of the graph
   that can't be reached from the medoid get an edge from it to their own medoid.
4. The adjacency lists of a vector are united over its shards and go back to the shards.
5. In its home shard, that of its nearest centroid, every vector is a query: greedy beam search from the medoid, then range expansion: whatever lies
   in range has its neighbours looked at, until nothing new is in range. Hits are verified by cosine in double
   precision. A pair counts in one shard, the lesser of the two homes that have both, so no pairs need to be written: a
   shard gives the numbers of links of its vectors and a spanning forest of them.
6. Recall is audited against all vectors by brute force: about ``AUDIT`` queries of all vectors and as many of those that have
   others in range in their shard. Under ``RECALL`` the search runs again with a wider beam, and after the widest
   the shards are compared whole; if even that misses links, it is an error. Then connected components.

Cases: a vector that can't link, or has no id, has no links and is its own component; repeated rows are linked to each other; different
vectors of one id are vertices of their own, each with its own links; vectors of different length never meet; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import staged
from .graph import components

SAMPLE = 20_000
CELL, BLOCK, CENTROIDS = 2048, 3072, 4096
#: Rows of a shard that are searched at a time.
QUERIES = 128
DEGREE, ALPHA, BEAM = 16, 1.2, 24
AUDIT, RECALL = 128, 0.95


def unit(v: np.ndarray) -> np.ndarray:
    big = np.abs(v).max(axis=-1, keepdims=True)
    v = v / big
    return v / np.sqrt((v * v).sum(-1, keepdims=True))


def usable(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, label (text), key (text; null if it can't link), dim, vec (doubles as bytes)."""
    own = df.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, dims, vecs = [], [], []
            for number, label, v in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "v")), strict=True):
                a = None if number is None or label is None or not v or None in v else np.array(v, np.float64) + 0.0
                if a is None or not np.isfinite(a).all() or not a.any():
                    keys.append(None)
                    dims.append(0)
                    vecs.append(None)
                else:
                    keys.append(xxhash.xxh3_128_hexdigest(a.tobytes()))
                    dims.append(len(a))
                    vecs.append(a.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(keys, pa.string()), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())], names=["vec_id", "label", "key", "dim", "vec"])

    return own.mapInArrow(run, "vec_id bigint, label string, key string, dim int, vec binary")


def centroids(classes: DataFrame, sample: int) -> dict[tuple[str, int], tuple[int, np.ndarray]]:
    """Per (label, dim): number of its first cell, and the centroids of its cells; one cell where there is no need for more."""
    sizes = {(r["label"], r["dim"]): r["n"] for r in classes.groupBy("label", "dim").agg(F.count("*").alias("n")).where(F.col("n") > CELL).orderBy(F.desc("n"), "label", "dim").limit(CENTROIDS).collect()}
    total = sum(sizes.values())
    if not total:
        return {}
    few = classes.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < math.ceil(1e6 * min(1.0, sample / total))).select("label", "dim", "vec")
    held: dict[tuple[str, int], list[np.ndarray]] = {k: [] for k in sizes}
    for r in few.toLocalIterator():
        if (r["label"], r["dim"]) in held:
            held[r["label"], r["dim"]].append(np.frombuffer(bytes(r["vec"])))
    out, first = {}, 0
    share = min(1.0, (CENTROIDS - len(sizes)) * CELL / total)
    for key in sorted(sizes):
        if not held[key]:
            continue
        x = unit(np.sort(np.array(held[key]).view([("", np.float64)] * key[1]).ravel()).view(np.float64).reshape(-1, key[1]))
        k = max(1, min(len(x), math.ceil(sizes[key] * share / CELL)))
        c = x[np.random.default_rng(0).choice(len(x), k, replace=False)]
        for _ in range(10):
            own = (x @ c.T).argmax(1)
            sums = np.zeros_like(c)
            np.add.at(sums, own, x)
            norm = np.sqrt((sums**2).sum(1, keepdims=True))
            c = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), c)
        out[key] = (first, c)
        first += k
    return out


def assign(classes: DataFrame, cells: dict, threshold: float) -> DataFrame:
    """label, dim, rep, vec, cells (sorted cell numbers)."""
    shared = classes.sparkSession.sparkContext.broadcast(cells)
    margin = math.sqrt(max(0.0, 2 - 2 * threshold)) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = {k: np.sqrt(np.maximum(0, 2 - 2 * c @ c.T)) * margin + 1e-9 for k, (_, c) in shared.value.items()}
        for batch in batches:
            got, homes = [], []
            for label, dim, vec in zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "vec")), strict=True):
                first, c = shared.value.get((label, dim), (0, None))
                if c is None:
                    got.append([-1])
                    homes.append(-1)
                    continue
                dots = c @ unit(np.frombuffer(vec))
                home = int(dots.argmax())
                homes.append(first + home)
                got.append((first + np.flatnonzero(dots[home] - dots <= gaps[label, dim][home])).tolist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "dim", "rep", "weight", "vec")), pa.array(homes, pa.int32()), pa.array(got, pa.list_(pa.int32()))], names=["label", "dim", "rep", "weight", "vec", "home", "cells"])

    return classes.select("label", "dim", "rep", "weight", "vec").mapInArrow(run, "label string, dim int, rep bigint, weight bigint, vec binary, home int, cells array<int>")


def shards(assigned: DataFrame) -> DataFrame:
    """A row for each class and shard: label, dim, cell, one, two (chunks), side (its chunk), and what assigned has."""
    each = assigned.withColumn("cell", F.explode("cells"))
    sizes = each.groupBy("label", "dim", "cell").agg(F.count("*").alias("size"))
    sizes = sizes.select("label", "dim", "cell", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int").alias("chunks"))
    cut = each.join(sizes, ["label", "dim", "cell"])
    return (
        cut.withColumn("side", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("one", F.least("side", "other"))
        .withColumn("two", F.greatest("side", "other"))
        .drop("chunks", "other")
    )


KEY = ("label", "dim", "cell", "one", "two")


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one shard at a time, of batches sorted by KEY."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in KEY), strict=True))
        start = 0
        for i, k in enumerate(keys):
            if k != now:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                now, held, start = k, [], i
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def build(x: np.ndarray, threshold: float = 2.0, seed: int = 0) -> tuple[list[np.ndarray], np.ndarray]:
    """Neighbours of each row of unit vectors (robust pruning, both directions, all in reach of the medoid), and who has some in range."""
    n = len(x)
    if n == 1:
        return [np.zeros(0, np.int64)], np.zeros(1, bool)
    start = medoid(x)
    x = x.astype(np.float32)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    linked = sims.max(1) >= threshold - 1e-5
    near = min(n - 1, 3 * DEGREE)
    pool = np.argpartition(-sims, near - 1, axis=1)[:, :near] if near < n - 1 else np.argsort(-sims, axis=1)[:, : n - 1]
    if n > near + 1:
        pool = np.concatenate([pool, np.random.default_rng(seed).integers(0, n, (n, DEGREE // 2))], axis=1)
    rows = np.arange(n)[:, None]
    dist = np.sqrt(np.maximum(0, 2 - 2 * sims[rows, pool]))
    order = np.argsort(dist, axis=1, kind="stable")
    pool, dist = np.take_along_axis(pool, order, 1), np.take_along_axis(dist, order, 1)
    alive = pool != rows
    edges: list[set[int]] = [set() for _ in range(n)]
    for _ in range(DEGREE):
        some = alive.any(1)
        if not some.any():
            break
        who = np.flatnonzero(some)
        first = alive[who].argmax(1)
        p = pool[who, first]
        for i, j in zip(who.tolist(), p.tolist(), strict=True):
            edges[i].add(j)
            edges[j].add(i)
        apart = np.sqrt(np.maximum(0, 2 - 2 * np.maximum(sims[p[:, None], pool[who]], -1)))
        apart[pool[who] == p[:, None]] = 0
        alive[who] &= ALPHA * apart > dist[who]
    reached = np.zeros(n, bool)
    for first in [start, *range(n)]:
        if reached[first]:
            continue
        part, reached[first] = [first], True
        for i in part:
            new = [j for j in edges[i] if not reached[j]]
            reached[new] = True
            part += new
        if first != start:
            own = part[medoid(x[part])]
            edges[start].add(own)
            edges[own].add(start)
    return [np.array(sorted(e), np.int64) for e in edges], linked


def medoid(x: np.ndarray) -> int:
    return int((x @ x.sum(0)).argmax())


def exact(x: np.ndarray, threshold: float, who: np.ndarray) -> np.ndarray:
    """In-range pairs (query, found) of the rows ``who`` by comparison with every row."""
    out = [np.zeros((0, 2), np.int64)]
    for a in range(0, len(who), QUERIES):
        q, v = np.nonzero(x[who[a : a + QUERIES]] @ x.T >= threshold - 1e-6)
        out.append(np.stack([who[a + q], v], 1))
    found = np.concatenate(out)
    return found[found[:, 0] != found[:, 1]]


def greedy(x: np.ndarray, edges: list[np.ndarray], threshold: float, beam: int, who: np.ndarray) -> np.ndarray:
    """In-range pairs (query, found) of the rows ``who``: beam search from the medoid, then range expansion."""
    n = len(x)
    table = np.full((n, max(1, max((len(e) for e in edges), default=0))), -1, np.int64)
    for i, e in enumerate(edges):
        table[i, : len(e)] = e
    start = medoid(x)
    found = [_search_some(x, who[a : a + QUERIES], table, start, threshold - 1e-6, min(beam, n)) for a in range(0, len(who), QUERIES)]
    out = np.concatenate([np.zeros((0, 2), np.int64), *found])
    return out[out[:, 0] != out[:, 1]]


def _search_some(x: np.ndarray, own: np.ndarray, table: np.ndarray, start: int, within: float, beam: int) -> np.ndarray:
    """``within`` is a little looser than the threshold; an exact test follows the search."""
    m, n = len(own), len(x)
    seen = np.zeros((m, n), bool)
    seen[:, start] = True
    at, sim, done = np.full((m, beam), -1, np.int64), np.full((m, beam), -np.inf), np.ones((m, beam), bool)
    at[:, 0], sim[:, 0], done[:, 0] = start, x[own] @ x[start], False
    first = np.flatnonzero(sim[:, 0] >= within)
    hits = [np.stack([first, np.full(len(first), start)], 1)]
    active = np.arange(m)
    while len(active):
        best = np.where(done[active], -np.inf, sim[active]).argmax(1)
        node = at[active, best]
        done[active, best] = True
        near = table[node]
        fresh = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
        s = np.where(fresh, np.einsum("qd,qkd->qk", x[own[active]], x[np.where(fresh, near, 0)]), -np.inf)
        q, k = np.nonzero(fresh)
        seen[active[q], near[q, k]] = True
        inside = s[q, k] >= within
        hits.append(np.stack([active[q[inside]], near[q[inside], k[inside]]], 1))
        all_at, all_sim = np.concatenate([at[active], np.where(fresh, near, -1)], 1), np.concatenate([sim[active], s], 1)
        all_done = np.concatenate([done[active], ~fresh], 1)
        top = np.argsort(-all_sim, axis=1, kind="stable")[:, :beam]
        at[active], sim[active], done[active] = (np.take_along_axis(a, top, 1) for a in (all_at, all_sim, all_done))
        active = active[~done[active].all(1)]
    found = np.concatenate(hits)
    front = found
    while len(front):  # whatever is in range is expanded, however many there are
        fresh = []
        for a in range(0, len(front), 8192):
            part = front[a : a + 8192]
            q, v = np.repeat(part[:, 0], table.shape[1]), table[part[:, 1]].reshape(-1)
            keep = v >= 0
            q, v = q[keep], v[keep]
            keep = ~seen[q, v]
            pair = np.unique(q[keep] * n + v[keep])
            q, v = pair // n, pair % n
            seen[q, v] = True
            inside = np.einsum("id,id->i", x[own[q]], x[v]) >= within
            fresh.append(np.stack([q[inside], v[inside]], 1))
        front = np.concatenate(fresh)
        found = np.concatenate([found, front])
    return np.stack([own[found[:, 0]], found[:, 1]], 1)


def vectors(part: pa.Table) -> np.ndarray:
    return np.array([np.frombuffer(b) for b in part.column("vec").to_pylist()])


def dealt(rows: DataFrame, *more: str) -> DataFrame:
    return rows.repartition(*KEY).sortWithinPartitions(*KEY, "rep").select(*KEY, "rep", *more)


def graph(rows: DataFrame, threshold: float) -> DataFrame:
    """rep, near, linked: the adjacency lists united over all shards of a class, and whether it has others in range in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_shard(batches):
            rep = np.array(part.column("rep").to_pylist(), np.int64)
            edges, linked = build(unit(vectors(part)), threshold)
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array([rep[e].tolist() for e in edges], pa.list_(pa.int64())), pa.array(linked)], names=["rep", "near", "linked"])

    lists = dealt(rows, "vec").mapInArrow(run, "rep bigint, near array<bigint>, linked boolean")
    return lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"), F.max("linked").alias("linked"))


def search(rows: DataFrame, threshold: float, beam: int | None) -> DataFrame:
    """By the graph, or without a beam by comparing whole shards. kind 0: (rep, n): links of rep in a shard, weights counted; kind 1: (rep, n): an edge of a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_shard(batches):
            rep = np.array(part.column("rep").to_pylist(), np.int64)
            if len(rep) == 1:
                continue
            number = {r: i for i, r in enumerate(rep.tolist())}
            raw = vectors(part)
            edges = [np.array(sorted({number[r] for r in e if r in number} - {i}), np.int64) for i, e in enumerate(part.column("near").to_pylist())]
            cell, one, two = (part.column(c)[0].as_py() for c in ("cell", "one", "two"))
            cells, side = part.column("cells").to_pylist(), part.column("side").to_pylist()
            home = part.column("home").to_numpy()
            who = np.flatnonzero(home == cell)
            pairs = exact(unit(raw), threshold, who) if beam is None else greedy(unit(raw), edges, threshold, beam, who)
            pairs = np.unique(np.sort(pairs, 1), axis=0)
            big = np.abs(raw).max(1, keepdims=True)
            raw = raw / big
            norm = np.sqrt((raw * raw).sum(1))
            a, b = pairs[:, 0], pairs[:, 1]
            cosine = (raw[a] * raw[b]).sum(1) / (norm[a] * norm[b])
            pairs = pairs[cosine >= threshold]
            weight = np.array(part.column("weight").to_pylist(), np.int64)
            n = np.zeros(len(rep), np.int64)
            root = list(range(len(rep)))

            def find(i: int, root: list[int] = root) -> int:
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            homes, number_of = np.unique(home, return_inverse=True)
            inside = np.array([[c in own for c in homes.tolist()] for own in map(set, cells)], bool).reshape(len(cells), len(homes))
            a, b = pairs[:, 0], pairs[:, 1]
            none = np.iinfo(np.int64).max
            here = np.minimum(np.where(inside[b, number_of[a]], home[a], none), np.where(inside[a, number_of[b]], home[b], none)) == cell
            if one != two:
                where = np.array(side)
                here &= where[a] != where[b]
            np.add.at(n, a[here], weight[b[here]])
            np.add.at(n, b[here], weight[a[here]])
            forest = []
            for i, j in pairs.tolist():
                p, q = find(i), find(j)
                if p != q:
                    root[max(p, q)] = min(p, q)
                    forest.append((rep[i], rep[j]))
            some = np.flatnonzero(n)
            kind = np.concatenate([np.zeros(len(some), np.int32), np.ones(len(forest), np.int32)])
            left = np.concatenate([rep[some], np.array([f[0] for f in forest], np.int64)])
            right = np.concatenate([n[some], np.array([f[1] for f in forest], np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(left), pa.array(right)], names=["kind", "rep", "n"])

    return dealt(rows, "vec", "weight", "home", "cells", "side", "near").mapInArrow(run, "kind int, rep bigint, n bigint")


def truth(classes: DataFrame, queries: list[tuple[int, str, int, bytes]], threshold: float) -> dict[int, int]:
    """Links of the queries (rep, label, dim, vec) against all classes, by brute force; queries are few and bounded."""
    shared = classes.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[tuple[str, int], list] = {}
        for rep, label, dim, vec in shared.value:
            own.setdefault((label, dim), []).append((rep, np.frombuffer(vec)))
        for batch in batches:
            held: dict[tuple[str, int], list] = {}
            for label, dim, rep, weight, vec in zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "rep", "weight", "vec")), strict=True):
                if (label, dim) in own:
                    held.setdefault((label, dim), []).append((rep, weight, np.frombuffer(vec)))
            for key, rows in held.items():
                q = unit(np.array([v for _, v in own[key]]))
                x = unit(np.array([v for _, _, v in rows]))
                near = q @ x.T >= threshold
                w = np.array([r[1] for r in rows])
                ids = np.array([r[0] for r in rows])
                n = [int((w * (near[i] & (ids != own[key][i][0]))).sum()) for i in range(len(q))]
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in own[key]], pa.int64()), pa.array(n, pa.int64())], names=["rep", "n"])

    got = classes.select("label", "dim", "rep", "weight", "vec").mapInArrow(run, "rep bigint, n bigint").groupBy("rep").agg(F.sum("n").alias("n"))
    return {r["rep"]: r["n"] for r in got.collect()}


def audited(classes: DataFrame, parts: DataFrame, audit: int) -> list[tuple[int, str, int, bytes]]:
    """Queries (rep, label, dim, vec): about ``audit`` of all classes and as many of those that have others in range."""
    linked = parts.where("linked").select("rep").distinct()
    picked = [some.where(F.pmod(F.xxhash64("rep", F.lit(11)), F.lit(1_000_000)) < math.ceil(1e6 * min(1.0, audit / max(some.count(), 1)))).select("rep") for some in (classes, linked)]
    few = classes.join(F.broadcast(picked[0].unionByName(picked[1]).distinct()), "rep", "left_semi")
    return [(r["rep"], r["label"], r["dim"], bytes(r["vec"])) for r in few.select("rep", "label", "dim", "vec").collect()]


def near_duplicates(df: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = 0.98, sample: int = SAMPLE, beam: int = BEAM, audit: int = AUDIT, found: dict | None = None) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept. ``found``: gets the audited recall."""
    rows = staged(usable(df, id_col, vec_col, label_col), "vectors")
    able = rows.where("key is not null")
    classes = able.groupBy("label", "dim", "key").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first("vec").alias("vec"))
    classes = staged(classes.withColumn("rep", F.xxhash64("label", "dim", "key")), "vector-classes")
    cells = centroids(classes, sample)
    parts = staged(shards(assign(classes, cells, threshold)), "shards")
    near = graph(parts, threshold)
    parts = staged(parts.join(near, "rep"), "graph")
    few = audited(classes, parts, audit) if audit else []
    known = truth(classes, few, threshold) if few else {}
    while True:
        result = staged(search(parts, threshold, beam), "links")
        counts = result.where("kind = 0").groupBy("rep").agg(F.sum("n").alias("n"))
        got = {r["rep"]: r["n"] for r in counts.where(F.col("rep").isin([k for k in known])).collect()} if known else {}
        all_true = sum(known.values())
        recall = sum(min(got.get(k, 0), v) for k, v in known.items()) / all_true if all_true else 1.0
        if found is not None:
            found.update(recall=recall, links=all_true, queries=len(known), beam=beam)
        if recall >= RECALL:
            break
        if beam is None:
            raise RuntimeError(f"{recall:.3f} of the audited links found by comparing whole shards")
        beam = beam * 2 if beam < 8 * BEAM else None
    of = components(result.where("kind = 1").select(F.col("rep").alias("a"), F.col("n").alias("b")))
    joined = (
        classes.select("label", "dim", "key", "rep", "least", "weight")
        .join(counts, "rep", "left")
        .join(of, F.col("rep") == F.col("node"), "left")
        .select("label", "dim", "key", "least", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    )
    first = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    final = joined.join(first, "component").select("label", "dim", "key", "n_links", "component_id")
    component = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id", "label", "dim", "key").join(final, ["label", "dim", "key"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")
    )
