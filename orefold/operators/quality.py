"""Robust outlier audit: baselines at four grains, a cascade among them, rules, flags and their states."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.stored import stored
from .marts import LARGE_COHORT, exact_percentiles

MIN_SAMPLES = 10
Z_WARNING, Z_CRITICAL = 2.5, 3.5
FENCE = 2.0
ASYMMETRY_WARNING, ASYMMETRY_CRITICAL = 15.0, 25.0

# FIXED values: audited metrics of each family as (metric, least, most); all must not be negative.
RULES = {
    "plates": [
        ("concentric_mean_power", None, None), ("peak_power", None, None), ("jump_height_imp_mom", 0, 100), ("jump_height_flight_time", 0, 100),
        ("time_to_peak_force", None, None), ("contraction_time", None, None), ("eccentric_duration", None, None), ("rfd_at_100ms", None, None),
        ("concentric_impulse", None, None), ("eccentric_impulse", None, None),
    ],
    "frame": [("max_force", None, None), ("avg_force", None, None), ("impulse", None, None), ("repetitions", 0, 100)],
    "hamstring": [("max_force", None, None), ("avg_force", None, None), ("impulse", None, None), ("torque", None, None), ("repetitions", 0, 100)],
    "gates": [("split_time", 0, 120), ("total_time", 0, 120), ("velocity", 0, 15), ("max_velocity", 0, 15)],
    "dynamometer": [
        ("max_force", None, None), ("avg_force", None, None), ("max_impulse", None, None), ("avg_impulse", None, None),
        ("max_rfd", None, None), ("avg_rfd", None, None), ("max_rom", 0, 360), ("avg_rom", 0, 360),
    ],
}


def rule_table(spark: SparkSession, rules: dict[str, list] = RULES) -> DataFrame:
    rows = [(f, m, True, None if a is None else float(a), None if b is None else float(b), FENCE, Z_WARNING, Z_CRITICAL) for f, each in rules.items() for m, a, b in each]
    return spark.createDataFrame(
        rows, "assessment_family string, metric_name string, non_negative boolean, abs_min double, abs_max double, fence double, z_warning double, z_critical double"
    )


def grains(rows: DataFrame, keys: list[str], kind: str, team: str, rest: list[str]) -> DataFrame:
    """A row for each grain that a value belongs to: 0 all, 1 kind, 2 team, 3 both; a row without the grain's own dimension has no part in it."""
    each = rows.select(*keys, team, kind, *rest, F.explode(F.array(*[F.lit(g) for g in range(4)])).alias("grain"))
    each = each.where(((F.col("grain") < 2) | F.col(team).isNotNull()) & ((F.col("grain") % 2 == 0) | F.col(kind).isNotNull()))
    return _at_grain(each, kind, team)


def _at_grain(each: DataFrame, kind: str, team: str) -> DataFrame:
    return each.withColumn(team, F.when(F.col("grain") >= 2, F.col(team))).withColumn(kind, F.when(F.col("grain") % 2 == 1, F.col(kind)))


#: Buckets for each factor of e between values, so those of one bucket are less than half a percent apart.
BUCKETS = 256


def bucket(v: Column) -> Column:
    """A whole number that never falls as ``v`` grows; zero has its own, and NaN's is above all."""
    size = F.floor(F.least(F.log(F.abs(v)) * BUCKETS, F.lit(1e6))) + 200_000
    return F.when(F.isnan(v), F.lit(1 << 40)).when(v == 0, F.lit(0).cast("long")).when(v < 0, -size).otherwise(size)


def _same(a: DataFrame, b: DataFrame, columns: list[str], prefix: str) -> Column:
    return reduce(and_, [a[c].eqNullSafe(b[f"{prefix}{c}"]) for c in columns])


def _named(df: DataFrame, columns: list[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in columns})


def baselines(fact: DataFrame, keys: list[str], *, kind: str = "test_type", team: str = "team_group_id", large: bool | None = None, at_rest: bool = False) -> DataFrame:
    """Per keys and grain (global, kind, team, team and kind) from ``MIN_SAMPLES`` values on: count, mean, sd, quartiles, ends, mad.

    Values are counted by team, kind and bucket in one pass, and counts are added up to the coarser grains. They tell in which few buckets quartiles are, and then
    between which distances the median distance must lie; single values are read of these buckets alone, the others' stand in for them as their least value with
    its count, which keeps every rank. So nothing but the counts and those values is shuffled, and the figures are exact.

    ``at_rest``: the fact is a table that is cheap to read three times; else what is read of it is stored first.
    ``large``: None looks at how many different values are left in a group; above ``LARGE_COHORT`` the same numbers come from ranges of values.
    """
    by, v = [*keys, team, kind, "grain"], F.col("metric_value")
    cell = [*keys, team, kind, "bucket"]
    rows = fact.where("metric_value is not null").select(*keys, team, kind, "metric_value")
    rows = (rows if at_rest else stored(rows, "values")).withColumn("bucket", bucket(v))
    figures = [F.count("*").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count("*")).alias("squares")]
    cells = stored(rows.groupBy(*cell).agg(*figures), "cells").withColumns({"cell_team": F.col(team), "cell_kind": F.col(kind)})
    each = grains(cells, keys, kind, team, ["cell_team", "cell_kind", "bucket", "n", "lo", "hi", "mean", "squares"])
    n = F.col("n")
    sums = each.groupBy(*by).agg(F.sum("n").alias("sample_count"), (F.sum(F.col("mean") * n) / F.sum("n")).alias("mean_value"), F.min("lo").alias("min_value"), F.max("hi").alias("max_value"))
    sums = stored(sums.where(F.col("sample_count") >= MIN_SAMPLES), "sums")
    of = _named(sums.select(*by, "sample_count", "mean_value"), by, "s_").withColumnRenamed("sample_count", "size")
    each = each.join(of, _same(each, of, by, "s_")).drop(*[f"s_{c}" for c in by])
    sd = each.groupBy(*by).agg(F.sqrt(F.sum(F.col("squares") + F.pow(F.col("mean") - F.col("mean_value"), 2) * n) / F.sum("n")).alias("sd_value"))
    buckets = stored(each.groupBy(*by, "bucket").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("size").alias("size")), "buckets")

    def upto(c: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*by).orderBy(c))

    def at(share: float) -> Column:
        return F.lit(share) * (F.col("size") - 1)

    def percentiles(wanted: DataFrame, value, shares: list[float], more: DataFrame | None = None) -> DataFrame:
        """By group, as b_: p0, p1, ... of ``value`` (of a value's column); ``wanted``: the buckets that are looked into, ``more``: what ``value`` needs of a group."""
        w = _named(wanted.select(*by, "bucket"), [*by, "bucket"], "w_").withColumn("wanted", F.lit(True))
        marked = each.join(w, _same(each, w, [*by, "bucket"], "w_"), "left").withColumn("open", F.col("wanted").isNotNull() & (F.col("lo") < F.col("hi")))
        marked = stored(marked.select(*by, "cell_team", "cell_kind", "bucket", "lo", "n", "open"), "marked")
        asked = marked.where("open").groupBy(*keys, "cell_team", "cell_kind", "bucket").agg(F.collect_list("grain").alias("asked"))
        asked = asked.select(*[F.col(k).alias(f"a_{k}") for k in keys], F.col("cell_team").alias(f"a_{team}"), F.col("cell_kind").alias(f"a_{kind}"), F.col("bucket").alias("a_bucket"), "asked")
        asked = stored(asked, "asked")  # its size is known then, so rows need no shuffle to meet a small one
        found = rows.join(asked, _same(rows, asked, cell, "a_")).select(*keys, team, kind, v.alias("v"), F.explode("asked").alias("grain"))
        found = _at_grain(found, kind, team).groupBy(*by, "v").agg(F.count("*").alias("n"))
        values = marked.where("not open").select(*by, F.col("lo").alias("v"), "n").unionByName(found.select(*by, "v", "n"))
        if more is not None:
            values = values.join(more, _same(values, more, by, "b_"))
        counted = stored(values.select(*by, value(F.col("v")).alias("v"), "n").groupBy(*by, "v").agg(F.sum("n").alias("n")), "counted")
        many = large if large is not None else (counted.groupBy(*by).count().agg(F.max("count")).first()[0] or 0) > LARGE_COHORT
        if many:
            got = exact_percentiles(counted, by, "v", shares, weight="n")
        else:
            got = counted.groupBy(*by).agg(F.percentile("v", shares, F.col("n")).alias("p")).select(*by, *[F.col("p")[i].alias(f"p{i}") for i in range(len(shares))])
        return _named(stored(got, "percentiles"), by, "b_")

    end = upto("bucket")
    holds = lambda s: (F.floor(at(s)) < F.col("end")) & (F.ceil(at(s)) >= F.col("end") - n)
    quarters = percentiles(buckets.withColumn("end", end).where(reduce(or_, [holds(s) for s in (0.25, 0.5, 0.75)])), lambda x: x, [0.25, 0.5, 0.75])
    median = quarters.select(*[f"b_{c}" for c in by], F.col("p1").alias("median"))
    left, right = F.abs(F.col("lo") - F.col("median")), F.abs(F.col("hi") - F.col("median"))
    inside = (F.col("lo") <= F.col("median")) & (F.col("median") <= F.col("hi"))
    away = buckets.join(median, _same(buckets, median, by, "b_")).withColumns({"near": F.when(inside, F.lit(0.0)).otherwise(F.least(left, right)), "far": F.greatest(left, right)})
    away = away.withColumns({"near_end": upto("near"), "far_end": upto("far")})
    whole = Window.partitionBy(*by)
    away = away.withColumns({"least": F.min(F.when(F.col("near_end") > F.floor(at(0.5)), F.col("near"))).over(whole), "most": F.min(F.when(F.col("far_end") > F.ceil(at(0.5)), F.col("far"))).over(whole)})
    mad = percentiles(away.where("far >= least and near <= most"), lambda x: F.abs(x - F.col("median")), [0.5], median).withColumnRenamed("p0", "mad_value")
    out = sums
    for part, names in ((quarters, {"p0": "p25_value", "p1": "median_value", "p2": "p75_value"}), (_named(sd, by, "b_"), {}), (mad, {})):
        part = part.withColumnsRenamed(names)
        out = out.join(part, _same(out, part, by, "b_")).drop(*[f"b_{c}" for c in by])
    return out.select(*by, "sample_count", "mean_value", "sd_value", "p25_value", "median_value", "p75_value", "min_value", "max_value", "mad_value")


def with_baseline(fact: DataFrame, base: DataFrame, keys: list[str], *, kind: str = "test_type", team: str = "team_group_id") -> DataFrame:
    """Each row with the finest baseline there is: team and kind, team, kind, global. Which one that is, is found once for each pair of team and
    kind that a metric has, so the baselines are read once."""
    by = [*keys, team, kind, "grain"]
    values = [c for c in base.columns if c not in (*keys, team, kind)]
    pairs = fact.select(*keys, F.col(team).alias("__team"), F.col(kind).alias("__kind")).distinct()
    named = pairs.select(*keys, "__team", "__kind", F.col("__team").alias(team), F.col("__kind").alias(kind))
    asked = grains(named.withColumn("__pair", F.struct("__team", "__kind")), [*keys, "__pair"], kind, team, [])
    b = base.select(*[F.col(c).alias(f"b_{c}") for c in by], F.struct(*values).alias("b"))
    found = asked.join(b, reduce(and_, [asked[c].eqNullSafe(b[f"b_{c}"]) for c in by])).groupBy(*keys, "__pair").agg(F.max_by("b", "grain").alias("b"))
    found = found.select(*[F.col(k).alias(f"f_{k}") for k in keys], F.col("__pair.__team").alias("f_team"), F.col("__pair.__kind").alias("f_kind"), "b")
    found = stored(found, "found")  # its size is known then, so rows need no shuffle to meet a small one
    on = reduce(and_, [*[fact[k].eqNullSafe(found[f"f_{k}"]) for k in keys], fact[team].eqNullSafe(found["f_team"]), fact[kind].eqNullSafe(found["f_kind"])])
    return fact.join(found, on, "left").drop(*[f"f_{k}" for k in keys], "f_team", "f_kind")


@dataclass(frozen=True)
class Pair:
    """A left and a right metric of one row, compared where both are at least ``least``; flags carry ``label`` and the percentage."""

    label: str
    left: str
    right: str
    least: float = 0.0
    warning: float = ASYMMETRY_WARNING
    critical: float = ASYMMETRY_CRITICAL

    def entry(self) -> Column:
        a, b = F.col(self.left).cast("double"), F.col(self.right).cast("double")
        pct = F.when((F.abs(a) >= self.least) & (F.abs(b) >= self.least), S.asymmetry(a, b))
        limits = {"left_value": a, "right_value": b, "asymmetry_pct": pct, "warning_pct": F.lit(float(self.warning)), "critical_pct": F.lit(float(self.critical))}
        return F.struct(F.lit(self.label).alias("metric_name"), F.round(pct, 2).alias("metric_value"), F.struct(*[c.alias(n) for n, c in limits.items()]).alias("asymmetry"))


def wide_rows(rows: DataFrame, ids: list[str], metrics: list[str], pairs: list[Pair] = ()) -> DataFrame:
    """A row for each metric column and for each pair of them, from one pass over the table: ids, metric_name, metric_value, and for pairs ``asymmetry``."""
    kind = "struct<metric_name: string, metric_value: double, asymmetry: struct<left_value: double, right_value: double, asymmetry_pct: double, warning_pct: double, critical_pct: double>>"
    own = [F.struct(F.lit(m).alias("metric_name"), F.col(m).cast("double").alias("metric_value"), F.lit(None).alias("asymmetry")).cast(kind) for m in metrics]
    each = F.explode(F.array(*own, *[p.entry().cast(kind) for p in pairs])).alias("__each")
    return rows.select(*ids, *[c for c in ("updated_at",) if c in rows.columns and c not in ids], each).select("*", "__each.*").drop("__each")


def flags(rows: DataFrame) -> DataFrame:
    """A row per fact row and rule broken. ``rows`` has metric_value, the rule's columns, ``b``, a baseline or NULL, and maybe ``asymmetry``, a pair's values."""
    v, z, low, high = (F.col(c) for c in ("metric_value", "__z", "__low", "__high"))
    raw = S.fence(F.col("b.p25_value"), F.col("b.p75_value"), F.col("fence"))
    ends = (F.round(x, 9) for x in raw)  # not apart by a last bit
    rows = rows.where("metric_value is not null").withColumn("__z", F.abs(S.modified_z(v, F.col("b.median_value"), F.col("b.mad_value"))))
    # rounding is slow and moves an end by less than 1e-6, so it is left to rows that may break a rule
    maybe = [F.col("non_negative") & (v < 0), v < F.col("abs_min"), v > F.col("abs_max"), z >= F.least("z_warning", "z_critical"), v < raw[0] + 1e-6, v > raw[1] - 1e-6]
    maybe += [F.col("asymmetry").isNotNull()] if "asymmetry" in rows.columns else []
    rows = rows.where(reduce(or_, [F.coalesce(m, F.lit(False)) for m in maybe]))
    # what the rules share has columns of its own, so it is found once a row
    rows = rows.withColumns(dict(zip(("__low", "__high"), ends, strict=True)))
    width = high - low
    outside = (v < low) | (v > high)
    far = (v < F.round(low - width, 9)) | (v > F.round(high + width, 9))
    samples = F.col("b.sample_count")
    listed = {
        "negative_value": (F.when(F.col("non_negative") & (v < 0), "critical"), {"value": v}),
        "range_violation": (F.when((v < F.col("abs_min")) | (v > F.col("abs_max")), "critical"), {"value": v, "least": F.col("abs_min"), "most": F.col("abs_max")}),
        "outlier_modified_zscore": (F.when(z >= F.col("z_critical"), "critical").when(z >= F.col("z_warning"), "warning"), {"value": v, "modified_z": z, "median": F.col("b.median_value"), "mad": F.col("b.mad_value"), "samples": samples}),
        "outlier_iqr": (F.when(outside, F.when(far, "critical").otherwise("warning")), {"value": v, "low": low, "high": high, "p25": F.col("b.p25_value"), "p75": F.col("b.p75_value"), "samples": samples}),
    }
    if "asymmetry" in rows.columns:
        pair = F.col("asymmetry")
        severity = F.when(pair["asymmetry_pct"] >= pair["critical_pct"], "critical").when(pair["asymmetry_pct"] >= pair["warning_pct"], "warning")
        listed["asymmetry_extreme"] = severity, {c: pair[c] for c in ("left_value", "right_value", "asymmetry_pct")}
    broken = F.array_compact(F.array(*[F.when(s.isNotNull(), F.struct(F.lit(k).alias("flag_type"), s.alias("severity"))) for k, (s, _) in listed.items()]))
    flagged = rows.withColumn("flag", F.explode(broken)).select("*", "flag.flag_type", "flag.severity").drop("flag")
    # JSON of what led to a flag, of flagged rows only
    details = F.coalesce(*[F.when(F.col("flag_type") == k, F.to_json(F.struct(*[c.cast("double").alias(n) for n, c in of.items()]))) for k, (_, of) in listed.items()])
    return flagged.withColumn("details", details).drop("__z", "__low", "__high")


def asymmetry_flags(fact: DataFrame, keys: list[str], *, least: float = 0.0, warning: float = ASYMMETRY_WARNING, critical: float = ASYMMETRY_CRITICAL) -> DataFrame:
    """Left against right of the same test, metric and repetition (the greatest value of each side)."""
    sides = fact.where(F.col("side").isin("left", "right")).groupBy(*keys).agg(
        F.max(F.when(F.col("side") == "left", F.col("metric_value"))).alias("left_value"), F.max(F.when(F.col("side") == "right", F.col("metric_value"))).alias("right_value")
    )
    both = sides.where("left_value is not null and right_value is not null").where((F.abs("left_value") >= least) & (F.abs("right_value") >= least))
    pct = both.withColumn("asymmetry_pct", S.asymmetry(F.col("left_value"), F.col("right_value")))
    return pct.withColumn("severity", F.when(F.col("asymmetry_pct") >= critical, "critical").when(F.col("asymmetry_pct") >= warning, "warning")).where("severity is not null")


def persist_flags(old: DataFrame, new: DataFrame, keys: list[str], *, within: DataFrame | None = None) -> DataFrame:
    """keys, what else ``new`` has, status after an audit: an open flag takes the new values, a reviewed one stays, new ones open, a
    superseded one that comes back opens again. An open one that did not come back is superseded, if its row was looked at (``within``: rows
    looked at, by some of the keys; None: all), and else stays open."""
    o, n = old.withColumn("__o", F.lit(True)).alias("o"), new.withColumn("__n", F.lit(True)).alias("n")
    both = o.join(n, reduce(and_, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]), "full")
    reviewed = F.coalesce(~F.col("o.status").isin("open", "superseded"), F.lit(False))
    gone = F.col("n.__n").isNull()
    values = [c for c in new.columns if c not in keys]
    old_value = lambda c: F.col(f"o.{c}") if c in old.columns else F.lit(None)
    out = both.select(
        *[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys],
        *[F.when(reviewed | gone, old_value(c)).otherwise(F.col(f"n.{c}")).alias(c) for c in values],
        F.when(reviewed, F.col("o.status")).when(~gone, "open").otherwise("superseded").alias("status"), (gone & (F.col("o.status") == "open")).alias("__gone"),
    )
    if within is None:
        return out.drop("__gone")
    # of all rows looked at only those of flags that are gone matter; how many there are is known then, so rows need no shuffle to meet few
    out = stored(out, "merged")
    gone_keys = _named(stored(out.where("__gone").select(*within.columns).distinct(), "gone"), within.columns, "w_")
    w = within.join(gone_keys, _same(within, gone_keys, within.columns, "w_")).select(*gone_keys.columns, F.lit(True).alias("__seen")).distinct()
    out = out.join(w, reduce(and_, [out[c].eqNullSafe(w[f"w_{c}"]) for c in within.columns]), "left")
    status = F.when(F.col("__gone") & F.col("__seen").isNull(), "open").otherwise(F.col("status"))
    return out.withColumn("status", status).drop("__gone", "__seen", *[f"w_{c}" for c in within.columns])
