"""Audits of tables: column and identifier profiles, orphans, coverage of pairs, schema contracts, pass or fail."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def column_profile(df: DataFrame, columns: list[str], when: str | None = None) -> DataFrame:
    """column_name, n_rows, n_blank, blank_rate, and with ``when`` the table's min_time and max_time; one pass for all columns."""
    times = [F.min(when).alias("min_time"), F.max(when).alias("max_time")] if when else []
    kept = ["n_rows", *(["min_time", "max_time"] if when else [])]
    blank = [F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")).alias(c) for c in columns]
    one = df.agg(F.count("*").alias("n_rows"), *times, *blank)
    return one.unpivot(kept, columns, "column_name", "n_blank").select("column_name", *kept, "n_blank", (F.col("n_blank") / F.nullif(F.col("n_rows"), F.lit(0))).alias("blank_rate"))


def id_shapes(df: DataFrame, column: str) -> DataFrame:
    """Distinct identifiers by shape."""
    ids = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("id")).distinct()
    return ids.groupBy(S.id_shape(F.col("id")).alias("id_shape")).agg(F.count("*").alias("n_ids"), F.min("id").alias("first_id"))


def id_profile(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """One row: column_name, n_ids, n_uuid, n_numeric, n_text, and the first ``k`` identifiers; blank ones don't count."""
    text = F.col(column).cast("string")
    ids = df.where(text.isNotNull() & (F.trim(text) != "")).select(text.alias("id")).distinct()
    shape = S.id_shape(F.col("id"))
    counts = ids.agg(F.count("*").alias("n_ids"), *[F.count_if(shape == s).alias(f"n_{s}") for s in ("uuid", "numeric", "text")]).withColumn("column_name", F.lit(column))
    first = ids.orderBy("id").limit(k).agg(F.array_sort(F.collect_list("id")).alias("samples")).withColumn("column_name", F.lit(column))
    return counts.join(first, "column_name")


@dataclass(frozen=True)
class Relation:
    name: str
    child: DataFrame
    parent: DataFrame
    keys: dict[str, str]


def orphans(relations: list[Relation]) -> DataFrame:
    """relation, n_rows, n_orphans: child rows whose key is given and has no parent."""
    out = []
    for r in relations:
        given = r.child.where(reduce(and_, [F.col(c).isNotNull() for c in r.keys]))
        parent = r.parent.select(*[F.col(p).alias(f"__{p}") for p in r.keys.values()]).distinct()
        lost = given.join(parent, reduce(and_, [given[c] == parent[f"__{p}"] for c, p in r.keys.items()]), "left_anti")
        out.append(given.agg(F.count("*").alias("n_rows")).crossJoin(lost.agg(F.count("*").alias("n_orphans"))).select(F.lit(r.name).alias("relation"), "n_rows", "n_orphans"))
    return reduce(DataFrame.unionByName, out)


def pair_coverage(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs on one side only, with which side they miss."""
    seen = [df.select(*keys, F.lit(mine).alias("__mine")) for df, mine in ((expected, True), (actual, False))]
    pairs = seen[0].unionByName(seen[1]).groupBy(*keys).agg(F.bool_or("__mine").alias("__e"), F.bool_and("__mine").alias("__only"))
    status = F.when(F.col("__only"), "missing").when(~F.col("__e"), "extra")
    return pairs.select(*keys, status.alias("status")).where("status is not null")


def samples(pairs: DataFrame, keys: list[str], k: int = 10) -> DataFrame:
    """The first k pairs of each status, for a report."""
    parts = [pairs.where(F.col("status") == s).orderBy(*keys).limit(k) for s in ("missing", "extra")]
    return parts[0].unionByName(parts[1])


def check_columns(df: DataFrame, required: list[str], forbidden: list[str] = ()) -> None:
    missing, unwanted = [c for c in required if c not in df.columns], [c for c in forbidden if c in df.columns]
    if missing or unwanted:
        raise ValueError(f"missing columns: {missing}; columns that must not be there: {unwanted}")


def drop_empty(df: DataFrame, columns: list[str]) -> DataFrame:
    """Without the given columns; an error if one of them holds anything."""
    have = [c for c in columns if c in df.columns]
    if have:
        counts = df.agg(*[F.count(c).alias(c) for c in have]).first().asDict()
        if any(counts.values()):
            raise ValueError(f"columns that hold data: { {c: n for c, n in counts.items() if n} }")
    return df.drop(*have)


def review(profile: DataFrame, relation_counts: DataFrame, required: list[str]) -> DataFrame:
    """check, subject, passed: required columns have no blanks, relations no orphans, the table has rows."""
    blanks = profile.where(F.col("column_name").isin(required)).select(F.lit("required column").alias("check"), F.col("column_name").alias("subject"), (F.col("n_blank") == 0).alias("passed"))
    lost = relation_counts.select(F.lit("orphans").alias("check"), F.col("relation").alias("subject"), (F.col("n_orphans") == 0).alias("passed"))
    rows = profile.agg(F.max("n_rows").alias("n")).select(F.lit("rows").alias("check"), F.lit("table").alias("subject"), (F.col("n") > 0).alias("passed"))
    return blanks.unionByName(lost).unionByName(rows)
