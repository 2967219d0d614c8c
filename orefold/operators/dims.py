"""Who is in scope: membership of target groups, profiles, soft deletes, overlap flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .quality import persist_flags


def membership(assigned: DataFrame, targets: DataFrame) -> DataFrame:
    """profile_id, group_id of assignments that the ordered ``targets`` (group_id, category_id, priority) name, with
    is_ambiguous (a profile in several groups) and include_in_gold (its first by priority, names and raw_id).

    Targets are configuration, a few rows; Spark broadcasts them by their size.
    """
    rows = assigned.join(targets, ["group_id", "category_id"])
    order = ["priority", *[c for c in ("group_name", "category_name") if c in rows.columns], "raw_id", "group_id"]
    first = F.row_number().over(Window.partitionBy("profile_id").orderBy(*[F.col(c).asc_nulls_last() for c in order]))
    groups = rows.groupBy("profile_id").agg(F.countDistinct("group_id").alias("n_groups"))
    return rows.withColumn("include_in_gold", first == 1).join(groups, "profile_id").withColumn("is_ambiguous", F.col("n_groups") > 1)


def membership_summary(members: DataFrame) -> DataFrame:
    return members.agg(
        F.count("*").alias("n_rows"), F.countDistinct("profile_id").alias("n_profiles"), F.count_if("include_in_gold").alias("n_included"),
        F.countDistinct(F.when(F.col("is_ambiguous"), F.col("profile_id"))).alias("n_ambiguous"),
    )


def unmatched_targets(members: DataFrame, targets: DataFrame) -> DataFrame:
    """Target groups in which nobody is."""
    return targets.select("group_id").distinct().join(members.select("group_id"), "group_id", "left_anti")


def scoped_profiles(profiles: DataFrame, members: DataFrame) -> DataFrame:
    """Profiles (profile_id, tenant_id, given_name, family_name and more) with their included membership's columns and full_name; they meet by profile and tenant, so
    a membership of the same id with another tenant doesn't count."""
    m = members.where("include_in_gold").select(F.col("profile_id").alias("__p"), F.col("tenant_id").alias("__t"), *[F.col(c) for c in members.columns if c not in (*profiles.columns, "include_in_gold")])
    joined = profiles.join(m, (F.col("profile_id") == F.col("__p")) & F.col("tenant_id").eqNullSafe(F.col("__t"))).drop("__p", "__t")
    return joined.withColumn("full_name", S.full_name(F.col("given_name"), F.col("family_name")))


def upsert_profiles(old: DataFrame, new: DataFrame, key: str = "profile_id") -> DataFrame:
    """Scoped profiles come in or are updated: first_seen_at stays the earliest, and an inactive one is active again."""
    o, n = old.alias("o"), new.withColumn("__n", F.lit(True)).alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    cols = []
    for c in old.columns:
        if c == "first_seen_at":
            col = F.least(F.col("o.first_seen_at"), F.col("n.first_seen_at"))
        elif c == "is_active":
            col = F.when(F.col("n.__n"), True).otherwise(F.col("o.is_active"))
        elif c == "deactivated_at":
            col = F.when(F.col("n.__n").isNull(), F.col("o.deactivated_at"))
        else:
            col = F.when(F.col("n.__n"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        cols.append(col.alias(c))
    return both.select(*cols)


def soft_delete(profiles: DataFrame, members: DataFrame, now, key: str = "profile_id") -> DataFrame:
    """Active profiles without an included membership become inactive; the first time of it stays."""
    inside = members.where("include_in_gold").select(F.col(key).alias("__in")).distinct()
    rows = profiles.join(inside, profiles[key] == F.col("__in"), "left")
    gone = F.col("__in").isNull() & F.col("is_active")
    return rows.withColumn("deactivated_at", F.when(gone, F.coalesce("deactivated_at", now)).otherwise(F.col("deactivated_at"))).withColumn("is_active", F.col("is_active") & ~gone).drop("__in")


def overlap_states(old: DataFrame, new: DataFrame) -> DataFrame:
    return persist_flags(old, new, ["profile_id"])
