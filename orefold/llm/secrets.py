"""Secret scans with corpus-wide ownership frequency.

1. Every whole text is scanned for candidates: the base kinds (``assign``, ``access``, ``hex``, see FIXED) and
   ``opaque`` ones, long mixed-case tokens with digits and high entropy that no base span covers.
2. Each candidate's value is hashed; per hash the distinct repositories and owners over the whole corpus are counted,
   by grouping first by (hash, owner, repository), so that a value that a third of all rows hold is summed
   where it is read and reaches a task as few rows.
3. A value with more owners or repositories than the bounds is ``copied`` (a documentation example, a fixture, a
   licence text's checksum); else it is ``live`` if it looks random enough, else ``plain``.

Base spans always stay. An opaque candidate becomes a span only if it is live, that is owner-specific.

Cases: null text is empty; a document without candidates has zero counts, an empty span list and the hash of the
empty string; null owner or repository counts as one unnamed owner or repository; repeated rows count once
as owners and repositories and each have their own result row; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .base import staged

# FIXED: patterns and least lengths of the base kinds, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "opaque")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_STEMS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
OPAQUE = re.compile(r"[A-Za-z0-9_-]{24,}")
PLACEHOLDER = re.compile(r"example|sample|changeme|placeholder|your|dummy|test|xxxx|1234567|abcdef", re.I)

MAX_OWNERS = 2
MAX_REPOS = 3
#: Least entropy, in bits a character, of values that look random; in assignments the name before the value says much already.
MIN_BITS = 3.0
MIN_ASSIGNED_BITS = 2.5

_CANDIDATE = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("value", pa.string()), ("random", pa.bool_())])


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_random(kind: int, value: str) -> bool:
    return entropy(value) >= (MIN_BITS if kind else MIN_ASSIGNED_BITS) and not PLACEHOLDER.search(value)


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(kind number, start, stop, value) in code points, by start, then kind."""
    found = []
    lower = text.lower()
    if any(s in lower for s in ASSIGN_STEMS):
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    base = [(s, e) for _, s, e, _ in found]
    for m in OPAQUE.finditer(text):
        v = m[0]
        mixed = any(c.isdigit() for c in v) and v.lower() != v and v.upper() != v
        if mixed and not any(s < m.end() and m.start() < e for s, e in base) and entropy(v) >= MIN_BITS + 0.5:
            found.append((3, m.start(), m.end(), v))
    return sorted(found)


def scan(docs: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """The kept columns, and ``row`` (a number of the row) and ``found`` (its candidates, values hashed)."""
    own = docs.select(*keep, F.monotonically_increasing_id().alias("row"), text.alias("text"))
    names = [c for c in own.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [
                    {"kind": k, "start": s, "stop": e, "value": hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()[:32], "random": looks_random(k, v)}
                    for k, s, e, v in candidates(t)
                ]
                if t
                else []
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found, pa.list_(_CANDIDATE))], names=[*names, "found"])

    extra = StructType.fromDDL("found array<struct<kind:int,start:bigint,stop:bigint,value:string,random:boolean>>")
    return own.mapInArrow(run, StructType([*own.drop("text").schema.fields, *extra.fields]))


def ownership(scanned: DataFrame) -> DataFrame:
    """Per value: distinct owners and repositories, and the verdict. ``scanned`` has owner, repo and found."""
    one = F.coalesce(F.col("owner"), F.lit("")).alias("owner"), F.coalesce(F.col("repo"), F.lit("")).alias("repo")
    uses = scanned.where(F.size("found") > 0).select(*one, F.explode("found").alias("c")).select("owner", "repo", F.col("c.value").alias("value"), F.col("c.random").alias("random"))
    by_repo = uses.groupBy("value", "owner", "repo").agg(F.max("random").alias("random"), F.count("*").alias("uses"))
    by_owner = by_repo.groupBy("value", "owner").agg(F.max("random").alias("random"), F.sum("uses").alias("uses"), F.count("*").alias("repos"))
    total = by_owner.groupBy("value").agg(F.max("random").alias("random"), F.sum("uses").alias("uses"), F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))
    copied = (F.col("n_owners") > MAX_OWNERS) | (F.col("n_repos") > MAX_REPOS)
    return total.withColumn("status", F.when(copied, "copied").when(F.col("random"), "live").otherwise("plain"))


def judged(scanned: DataFrame) -> DataFrame:
    """One row per candidate with its value's counts and status; ``scanned`` must be a stored table."""
    each = scanned.where(F.size("found") > 0).select("row", F.explode("found").alias("c")).select("row", "c.*")
    return each.join(ownership(scanned).drop("random"), "value")


def _text_of(spans: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kind, s["kind"] + 1), s["start"], s["stop"])), ",")


def find_secrets(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", owner: Column | str = "source", repo: Column | str = "source") -> DataFrame:
    """Per row: doc_id, ``base`` and ``extra`` spans (kind number, start, stop), and how many values are copied or live."""
    owner, repo = (F.col(c) if isinstance(c, str) else c for c in (owner, repo))
    scanned = staged(scan(docs, F.col(text_col), F.col(doc_col).alias("doc_id"), owner.cast("string").alias("owner"), repo.cast("string").alias("repo")), "secrets")
    verdict = (
        judged(scanned)
        .groupBy("row")
        .agg(
            F.count_if(F.col("status") == "copied").alias("n_copied"),
            F.count_if(F.col("status") == "live").alias("n_live"),
            F.array_sort(F.collect_list(F.when((F.col("kind") == 3) & (F.col("status") == "live"), F.struct("start", "kind", "stop")))).alias("extra"),
        )
    )
    spans = F.transform("found", lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["stop"].alias("stop")))
    base = F.array_sort(F.filter(spans, lambda s: s["kind"] < 3))
    return scanned.select("doc_id", "row", base.alias("base")).join(verdict, "row", "left").select(
        "doc_id", "base", F.coalesce("extra", F.filter("base", lambda s: F.lit(False))).alias("extra"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_copied", "n_live"))
    )


def digests(found: DataFrame) -> DataFrame:
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select(
        "doc_id", n(0), n(1), n(2), F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"), _text_of(F.array_sort(F.concat("base", "extra"))).alias("spans"), "n_copied", "n_live"
    )


def redact(docs: DataFrame, *, text_col: str = "text", owner: Column | str = "source", repo: Column | str = "source") -> DataFrame:
    """``docs`` with each live secret replaced by ``[secret]``; values copied widely or not random stay as they are.

    Overlapping spans become one. ``n_chars``, if there, is the new length. Only the spans are joined back, by the
    text's own hash, so documents of one text share them.
    """
    owner, repo = (F.col(c) if isinstance(c, str) else c for c in (owner, repo))
    key = F.xxhash64(F.col(text_col)).alias("key"), F.length(text_col).alias("size")
    scanned = staged(scan(docs, F.col(text_col), *key, owner.cast("string").alias("owner"), repo.cast("string").alias("repo")), "secrets")
    cut = judged(scanned).where("status = 'live'").select("row", "start", "stop")
    cut = scanned.where(F.size("found") > 0).select("row", "key", "size").join(cut, "row").groupBy("key", "size").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("cut"))
    names = docs.columns
    joined = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("body"), F.col(text_col).alias("text"), *key).join(cut, ["key", "size"], "left")
    done = F.expr(
        """aggregate(cut, named_struct('text', '', 'at', 0L),
             (acc, s) -> if(s.start >= acc.at,
               named_struct('text', concat(acc.text, substring(text, cast(acc.at + 1 as int), cast(s.start - acc.at as int)), '[secret]'), 'at', s.stop),
               named_struct('text', acc.text, 'at', greatest(acc.at, s.stop))),
             acc -> concat(acc.text, substring(text, cast(acc.at + 1 as int))))"""
    )
    new = F.when(F.col("cut").isNull(), F.col("text")).otherwise(done)
    out = joined.withColumn("new", new)
    return out.select(*[F.col("new").alias(c) if c == text_col else F.length("new").cast("long").alias(c) if c == "n_chars" else F.col(f"body.`{c}`").alias(c) for c in names])
