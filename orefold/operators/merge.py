"""Latest-wins merges, snapshots and change detection on keyed tables. NULL keys are equal to each other throughout."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(and_, [a[k].eqNullSafe(b[k]) for k in keys])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], *, keep: list[str] = ()) -> DataFrame:
    """New rows replace old ones of their key; columns in ``keep`` (such as created_at) stay as they were.

    Both sides have one row per key. One full outer join on the keys, so each side is shuffled once.
    """
    o, n = old.alias("o"), new.alias("n")
    on = reduce(and_, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    o, n = o.withColumn("__o", F.lit(True)), n.withColumn("__n", F.lit(True))
    both = o.alias("o").join(n.alias("n"), on, "full")
    cols = []
    for c in old.columns:
        new_first = F.when(F.col("n.__n"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        old_first = F.when(F.col("o.__o"), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
        cols.append((old_first if c in keep else new_first).alias(c))
    return both.select(*cols)


def reconcile(live: DataFrame, snapshot: DataFrame, keys: list[str], *, mode: str = "merge", group: list[str] = ()) -> DataFrame:
    """``merge``: the snapshot's rows are the live ones. ``replace_group``: all live rows of each group that the
    snapshot has go, its rows come; other groups stay."""
    if mode == "merge":
        return snapshot.select(*live.columns)
    groups = snapshot.select(*group).distinct()
    stay = live.join(groups, same_keys(live, groups, list(group)), "left_anti")
    return stay.unionByName(snapshot.select(*live.columns))


def changes(live: DataFrame, snapshot: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys with what a reconcile would do: delete, insert, update or keep."""
    o, n = live.withColumn("__o", F.lit(True)).alias("o"), snapshot.withColumn("__n", F.lit(True)).alias("n")
    on = reduce(and_, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    same = reduce(and_, [F.col(f"o.{v}").eqNullSafe(F.col(f"n.{v}")) for v in values])
    action = F.when(F.col("n.__n").isNull(), "delete").when(F.col("o.__o").isNull(), "insert").when(same, "keep").otherwise("update")
    return o.join(n, on, "full").select(*[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys], action.alias("action"))


def changed_only(stored: DataFrame, incoming: DataFrame, request: list[str], payload: str, order: str) -> DataFrame:
    """Incoming rows whose payload differs from the latest stored one of the same request (not from any earlier one)."""
    last = latest(stored, request, [F.desc(order)]).select(*request, S.json_hash(F.col(payload)).alias("__h"), F.lit(True).alias("__known"))
    last = last.select(*[F.col(k).alias(f"__{k}") for k in request], "__h", "__known")
    joined = incoming.join(last, reduce(and_, [incoming[k].eqNullSafe(last[f"__{k}"]) for k in request]), "left")
    return joined.where(F.col("__known").isNull() | ~F.col("__h").eqNullSafe(S.json_hash(F.col(payload)))).select(*incoming.columns)


def duplicates_of_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
