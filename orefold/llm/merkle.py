"""Merkle manifest of a dataset: a content-addressed DAG of digests, and proofs that single rows belong to it.

Each row is a leaf, the SHA-256 (lowercase hex) of its fields; of each group (such as a language) the leaves, in order, are hashed two by two,
level by level, into one subroot, and the subroots, in order of their groups, into the root.

What is stored are records of a digest and its children. Records of ``SPAN`` levels below one digest lie together as a page, found by that
digest; equal subtrees are one page. ``build`` makes pages from the bottom, each from 2 ** ``SPAN`` nodes, so the tree needs one shuffle for
``SPAN`` levels. ``prove`` goes the other way: requests descend from the root by the digits of their rank, one digit a page; at each page a
request follows the children that its digit's bits select and collects the ones they don't, and the segment that this gives is
reversed, because a proof begins at the leaf. Requests that share the upper digits go there as one, so a page is asked for by at most
2 ** ``SPAN`` requests and no key is hot.

Ranks of rows in their group come from a range partitioning that is written once: the rows before a row are those of its task and the counts
of the tasks before, so no group passes through one task.

Cases: a null field is ``-`` and an empty one ``0:``; rows of a null group are a group of their own, the first; null ids stand first and rows
of one id are in the order of their leaves, so repeated rows are as many equal leaves; a group of one row has its leaf as subroot and an
only group's subroot is the root; an empty table has no leaves and no root; columns that aren't named as fields don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import staged

#: Levels of a page.
SPAN = 8
PAGE = "group string, n bigint, block bigint, head string, records map<string, array<string>>"
STEP = "struct<left: string, right: string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, their place in their group counted from 0, and ``n``, the group's rows."""
    salt = rows.withColumn("__salt", F.monotonically_increasing_id())  # tells equal rows apart, so that they can be dealt to many tasks
    dealt = salt.repartitionByRange(group, *order, "__salt").sortWithinPartitions(group, *order, "__salt").drop("__salt")
    placed = staged(dealt.withColumns({"__task": F.spark_partition_id(), "__row": F.monotonically_increasing_id()}), "dealt")
    counts = placed.groupBy(group, "__task").agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
    own = Window.partitionBy(group)
    upto = F.sum("__n").over(own.orderBy("__task").rowsBetween(Window.unboundedPreceding, 0))
    before = staged(counts.select(F.col(group).alias("__group"), F.col("__task").alias("__of"), (upto - F.col("__n") - F.col("__first")).alias("__shift"), F.sum("__n").over(own).alias("n")), "counts")
    joined = placed.join(before, (F.col(group) == F.col("__group")) & (F.col("__task") == F.col("__of")))
    return joined.withColumn("at", F.col("__row") + F.col("__shift")).drop("__task", "__row", "__group", "__of", "__shift")


def height(n: int) -> int:
    return (n - 1).bit_length()


def page(tier: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one block, in order, to the digest above them all and the records between."""
    kind = pa.map_(pa.string(), pa.list_(pa.string()))
    for batch in batches:
        heads, pages = [], []
        for n, level in zip(batch.column("n").to_pylist(), batch.column("digests").to_pylist(), strict=True):
            records = {}
            for _ in range(min(SPAN, height(n) - SPAN * tier)):
                children = [level[i : i + 2] for i in range(0, len(level), 2)]
                level = [digest("".join(c)) for c in children]
                records.update(zip(level, children, strict=True))
            heads.append(level[0])
            pages.append(list(records.items()))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("group", "n", "block")), pa.array(heads, pa.string()), pa.array(pages, kind)], names=["group", "n", "block", "head", "records"])


def of_tier(tier: int) -> Column:
    """Whether a tree of ``n`` leaves ends in this tier."""
    above = F.col("n") <= F.lit(1 << SPAN * (tier + 1))
    return above if tier == 0 else above & (F.col("n") > F.lit(1 << SPAN * tier))


def forest(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Pages of each tier, from the leaves up, over ``group, n, at, digest``; the largest group has ``most`` leaves."""
    tiers: list[DataFrame] = []
    while not tiers or most > 1 << SPAN * len(tiers):
        if tiers:
            nodes = tiers[-1].where(F.col("n") > F.lit(1 << SPAN * len(tiers))).select("group", "n", F.col("block").alias("at"), F.col("head").alias("digest"))
        blocks = nodes.groupBy("group", "n", F.shiftright("at", SPAN).alias("block")).agg(F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("nodes"))
        tiers.append(staged(blocks.select("group", "n", "block", F.col("nodes.digest").alias("digests")).mapInArrow(partial(page, len(tiers)), PAGE), "pages"))
    return tiers


def roots(tiers: list[DataFrame]) -> DataFrame:
    """``group, n, head`` of each tree."""
    return reduce(DataFrame.unionByName, [p.where(of_tier(t)).select("group", "n", "head") for t, p in enumerate(tiers)])


def walk(tier: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a page's head down to each asked digit; the new segment goes before the path of the page's head."""
    step = pa.struct([("left", pa.string()), ("right", pa.string())])
    for whole in batches:
        for k in range(whole.num_rows):  # a page at a time: its requests' paths take many times its own room
            batch = whole.slice(k, 1)
            n, block, now, records, above, digits = (batch.column(c)[0].as_py() for c in ("n", "block", "head", "records", "path", "digits"))
            head, children, levels = now, dict(records), min(SPAN, height(n) - SPAN * tier)
            reached, paths = [], []
            for digit in digits:
                segment, now = [], head
                for bit in range(levels - 1, -1, -1):
                    below = children[now]
                    right = digit >> bit & 1
                    segment.append((below[0], "") if right else ("", below[1] if len(below) > 1 else ""))
                    now = below[right]
                reached.append(now)
                paths.append([{"left": a, "right": b} for a, b in reversed(segment)] + above)
            own = batch.take(pa.array([0] * len(digits), pa.int64()))
            places = pa.array([(block << SPAN) + digit for digit in digits], pa.int64())
            arrays = [own.column("group"), own.column("n"), own.column("origin"), places, pa.array(reached, pa.string()), pa.array(paths, pa.list_(step))]
            names = ["group", "n", "origin", "at", "digest", "path"]
            if "rows" in batch.schema.names:  # the digits' own rows, one for each
                arrays.append(batch.column("rows").flatten())
                names.append("row")
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def descend(tiers: list[DataFrame], starts: DataFrame, requests: DataFrame) -> DataFrame:
    """``group, n, origin, at, digest, path, row`` of each request (``group, at, row``, the row a struct): the root that the descent began at, the leaf that it
    reached, and the path from it upwards. ``starts`` has each group's root: ``group, n, head, path`` (what lies above it)."""
    walked = None
    kind = requests.schema["row"].dataType.simpleString()
    for tier in range(len(tiers) - 1, -1, -1):
        asked = starts.where(of_tier(tier)).select("group", "n", F.col("head").alias("origin"), F.lit(0).cast("long").alias("block"), "head", "path")
        if walked is not None:
            asked = asked.unionByName(walked.select("group", "n", "origin", F.col("at").alias("block"), F.col("digest").alias("head"), "path"))
        place = F.shiftright("at", SPAN * tier)
        digit = place.bitwiseAND(F.lit((1 << SPAN) - 1)).cast("int").alias("digit")
        by = [F.col("group"), F.shiftright(place, SPAN).alias("block")]
        if tier:
            digits = requests.select(*by, digit).distinct().groupBy("group", "block").agg(F.sort_array(F.collect_list("digit")).alias("digits"))
        else:
            each = requests.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(digit, "row"))).alias("each"))
            digits = each.select("group", "block", F.col("each.digit").alias("digits"), F.col("each.row").alias("rows"))
        store = tiers[tier].groupBy(F.col("head").alias("address")).agg(F.any_value("records").alias("records"))
        found = asked.join(digits, ["group", "block"]).join(store, F.col("head") == F.col("address")).drop("address")
        walked = found.mapInArrow(partial(walk, tier), f"group string, n bigint, origin string, at bigint, digest string, path array<{STEP}>" + ("" if tier else f", row {kind}"))
    return walked


@dataclass(frozen=True)
class Manifest:
    """leaves: ``group, at, n, leaf`` and the columns kept; tiers: pages below the subroots; top: pages above them; groups: ``group, n, head, at, groups``."""

    leaves: DataFrame
    tiers: list[DataFrame]
    top: list[DataFrame]
    groups: DataFrame
    root: str | None

    def records(self) -> DataFrame:
        """``digest, children`` of the whole DAG, each digest once."""
        each = reduce(DataFrame.unionByName, [p.select("records") for p in [*self.tiers, *self.top]])
        return each.select(F.explode("records").alias("digest", "children")).groupBy("digest").agg(F.any_value("children").alias("children"))


def build(rows: DataFrame, fields: list[Column], group: Column, order: Column, **keep: Column) -> Manifest:
    """The manifest of ``rows``: leaves over ``fields``, in groups, by ``order`` and then leaf; ``keep``: more columns of the leaves."""
    key = F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))
    leaves = staged(rows.select(key.alias("group"), order.alias("__order"), leaf(*fields).alias("leaf"), *[c.alias(k) for k, c in keep.items()]), "leaves")
    leaves = staged(numbered(leaves, "group", ["__order", "leaf"]).drop("__order"), "leaves")
    most = leaves.agg(F.max("n")).first()[0]
    if most is None:
        return Manifest(leaves, [], [], leaves.select("group", "n", F.col("leaf").alias("head"), "at", F.col("n").alias("groups")), None)
    tiers = forest(leaves.select("group", "n", "at", F.col("leaf").alias("digest")), most)
    each = roots(tiers).select(F.lit("").alias("all"), "group", F.col("n").alias("rows"), "head")
    each = staged(numbered(each, "all", ["group"]).withColumnRenamed("n", "groups").withColumnRenamed("rows", "n"), "subroots")
    groups = each.agg(F.max("groups")).first()[0]
    top = forest(each.select(F.col("all").alias("group"), F.col("groups").alias("n"), "at", F.col("head").alias("digest")), groups)
    return Manifest(leaves, tiers, top, each.drop("all"), roots(top).first().head)


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Of each requested leaf (``group, at`` and more columns; None: all leaves with what they keep): its columns, ``reached`` (the digest
    that its rank leads to), subroot, root and ``path``, from the leaf to the root what stands left and right of the digest so far on each level."""
    asked = manifest.leaves if requests is None else requests
    if manifest.root is None:
        return asked.select("*", F.lit(None).cast("string").alias("reached"), F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"), F.lit(None).cast(f"array<{STEP}>").alias("path"))
    start = manifest.groups.limit(1).select(F.lit("").alias("group"), F.col("groups").alias("n"), F.lit(manifest.root).alias("head"), F.array().cast(f"array<{STEP}>").alias("path"))
    over = descend(manifest.top, start, manifest.groups.select(F.lit("").alias("group"), "at", F.struct("group", "n").alias("row")))
    starts = staged(over.select("row.group", "row.n", F.col("digest").alias("head"), "path"), "starts")
    found = descend(manifest.tiers, starts, asked.select("group", "at", F.struct(*[c for c in asked.columns if c not in ("group", "at", "n")]).alias("row")))
    return found.select("group", "at", "n", "row.*", F.col("digest").alias("reached"), F.col("origin").alias("subroot"), F.lit(manifest.root).alias("root"), "path")


def proof(path: Column) -> Column:
    """SHA-256 of all that a path has beside the leaf."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, start, lambda now, s: F.sha2(F.concat(s["left"], now, s["right"]), 256))
