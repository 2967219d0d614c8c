"""Cohort thresholds, labels and the choice of what goes into a mart.

A cohort is (family, team, test type, metric, side); its upper limit is ``factor`` times the 99th percentile and its lower one
the 25th. Limits come from the full history also where only a scope of tests is published.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stored import stored

COHORT = ["assessment_family", "team_group_id", "test_type", "metric_name", "side"]
FACTOR = 1.2
#: Above so many different values in one group, percentiles are found in sorted ranges of values instead of in one group's memory.
LARGE_COHORT = 1_000_000


def _same(a: DataFrame, b: DataFrame, keys: list[str], prefix: str) -> Column:
    return reduce(and_, [a[k].eqNullSafe(b[f"{prefix}{k}"]) for k in keys])


def exact_percentiles(df: DataFrame, keys: list[str], value: str, shares: list[float], parts: int | None = None, *, weight: str | None = None) -> DataFrame:
    """Interpolated percentiles ``p0, p1, ...`` per key, of groups of any size. ``weight``: a column that says how often a row's value is there;
    ``parts``: how many ranges (None: as many as the session's shuffles have).

    Equal values of a key are counted, and the counts stored in order, dealt by ranges of key and value; sums per range tell which range has each rank, and
    only there values are added up. ``df`` is read once, and no task holds a whole group.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("w"))
    counted = stored(rows.groupBy(*keys, "v").agg(F.sum("w").alias("n")), "counts")  # each key and value once, so ranges are even
    ranges = stored(counted.repartitionByRange(*[parts] * bool(parts), *keys, "v").withColumn("part", F.spark_partition_id()), "ranges")
    w = Window.partitionBy(*keys).orderBy("part")
    sizes = ranges.groupBy(*keys, "part").agg(F.sum("n").alias("size"))  # a row for each range and the keys in it
    before = sizes.withColumn("before", F.sum("size").over(w) - F.col("size")).withColumn("total", F.sum("size").over(Window.partitionBy(*keys)))
    ranks = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(s) * (F.col("total") - 1)).alias("rank")) for i, s in enumerate(shares)])).alias("q")
    wanted = before.select("*", ranks).select("*", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.floor("q.rank").alias("r")), F.struct(F.lit(1).alias("side"), F.ceil("q.rank").alias("r")))).alias("t"))
    wanted = wanted.where((F.col("t.r") >= F.col("before")) & (F.col("t.r") < F.col("before") + F.col("size")))
    asked = wanted.groupBy(*[F.col(k).alias(f"w_{k}") for k in keys], F.col("part").alias("w_part")).agg(F.collect_list(F.struct("before", "q", "t")).alias("asked"))
    few = ranges.join(asked, _same(ranges, asked, [*keys, "part"], "w_"))
    few = few.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys, "part").orderBy("v")))
    hit = few.select(*keys, "v", "n", "upto", F.explode("asked").alias("a")).where((F.col("a.t.r") - F.col("a.before") < F.col("upto")) & (F.col("a.t.r") - F.col("a.before") >= F.col("upto") - F.col("n")))
    ends = hit.groupBy(*keys, F.col("a.q.i").alias("i")).agg(
        F.max("a.q.rank").alias("rank"), F.max(F.when(F.col("a.t.side") == 0, F.col("v"))).alias("low"), F.max(F.when(F.col("a.t.side") == 1, F.col("v"))).alias("high")
    )
    at = ends.withColumn("p", F.col("low") + (F.col("high") - F.col("low")) * (F.col("rank") - F.floor("rank")))
    return at.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, F.col("p"))).alias(f"p{i}") for i in range(len(shares))])


def thresholds(fact: DataFrame, *, factor: float = FACTOR, cohort: list[str] = COHORT, large: bool | None = None) -> DataFrame:
    """Per cohort: n_rows, p99, p25, upper_limit, lower_limit. Equal values of a cohort are counted first, in the one pass over the fact; ``large``: None looks
    at how many different values the cohorts have."""
    counted = stored(fact.groupBy(*cohort, "metric_value").agg(F.count("metric_value").alias("n")), "counts")
    if large is None:
        large = (counted.groupBy(*cohort).count().agg(F.max("count")).first()[0] or 0) > LARGE_COHORT
    if large:
        n = counted.groupBy(*cohort).agg(F.sum("n").alias("n_rows"))
        p = exact_percentiles(counted, cohort, "metric_value", [0.99, 0.25], weight="n")
        p = p.select(*[F.col(k).alias(f"p_{k}") for k in cohort], F.col("p0").alias("p99"), F.col("p1").alias("p25"))
        out = n.join(p, _same(n, p, cohort, "p_"), "left").select(*cohort, "n_rows", "p99", "p25")
    else:
        p = F.percentile("metric_value", [0.99, 0.25], F.col("n"))
        out = counted.groupBy(*cohort).agg(F.sum("n").alias("n_rows"), p.alias("p")).select(*cohort, "n_rows", F.col("p")[0].alias("p99"), F.col("p")[1].alias("p25"))
    return out.withColumn("upper_limit", F.col("p99") * factor).withColumn("lower_limit", F.col("p25"))


def label(fact: DataFrame, limits: DataFrame, *, cohort: list[str] = COHORT) -> DataFrame:
    """is_above and is_below, both strict; a missing value or limit is neither."""
    named = limits.select(*[F.col(k).alias(f"t_{k}") for k in cohort], "upper_limit", "lower_limit")
    on = reduce(and_, [fact[k].eqNullSafe(named[f"t_{k}"]) if k in ("test_type", "side") else fact[k] == named[f"t_{k}"] for k in cohort])
    joined = fact.join(named, on, "left").drop(*[f"t_{k}" for k in cohort])
    above, below = F.col("metric_value") > F.col("upper_limit"), F.col("metric_value") < F.col("lower_limit")
    return joined.withColumn("is_above", F.coalesce(above, F.lit(False))).withColumn("is_below", F.coalesce(below, F.lit(False)))


def stats(labelled: DataFrame, by: list[str]) -> DataFrame:
    return labelled.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.count_if("is_above").alias("n_above"), F.count_if("is_below").alias("n_below"), F.count_if(F.col("is_above") | F.col("is_below")).alias("n_outside")
    )


#: What names a test in a catalog of reference metrics.
NAMED = ("source_module", "assessment_family", "test_name")


def in_range(labelled: DataFrame) -> DataFrame:
    return labelled.where(~F.col("is_above") & ~F.col("is_below"))


def candidates(labelled: DataFrame, catalog: DataFrame, named: tuple[str, ...] = NAMED) -> DataFrame:
    """Rows in range that hold their test name's reference metric; ``catalog``: the names and reference_metric (NULL: not covered)."""
    c = catalog.where("reference_metric is not null").select(*[F.col(k).alias(f"c_{k}") for k in named], F.col("reference_metric").alias("c_metric")).distinct()
    rows = in_range(labelled)
    return rows.join(c, reduce(and_, [rows[k].eqNullSafe(c[f"c_{k}"]) for k in named], rows["metric_name"] == c["c_metric"]), "left_semi")


def back_to_rows(rows: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of what was chosen by ``keys``, NULL being a value."""
    picked = chosen.select(*[F.col(k).alias(f"w_{k}") for k in keys]).distinct()
    return rows.join(picked, reduce(and_, [rows[k].eqNullSafe(picked[f"w_{k}"]) for k in keys]), "left_semi")


def mart_simple(labelled: DataFrame, catalog: DataFrame, *, named: tuple[str, ...] = NAMED) -> DataFrame:
    """All rows in range of tests with a candidate."""
    return back_to_rows(in_range(labelled), candidates(labelled, catalog, named), ["test_id"])


def mart_by_side(labelled: DataFrame, catalog: DataFrame, *, named: tuple[str, ...] = NAMED) -> DataFrame:
    """All rows in range of tests and sides with a candidate."""
    return back_to_rows(in_range(labelled), candidates(labelled, catalog, named), ["test_id", "side"])


def _first(rows: DataFrame, keys: list[str], value: Column, tie: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(value, F.col("rep_number").asc(), *[F.col(t).asc_nulls_last() for t in tie])
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1")


def mart_least_rep(labelled: DataFrame, catalog: DataFrame, *, named: tuple[str, ...] = NAMED, tie: tuple[str, ...] = ("metric_row_key",)) -> DataFrame:
    """All rows in range, of any side, of the repetition with a test's least candidate; candidates have a repetition number."""
    rows = candidates(labelled, catalog, named).where("rep_number is not null")
    return back_to_rows(in_range(labelled), _first(rows, ["test_id"], F.col("metric_value").asc_nulls_last(), list(tie)), ["test_id", "rep_number"])


def mart_greatest_rep_by_side(labelled: DataFrame, catalog: DataFrame, *, named: tuple[str, ...] = NAMED, tie: tuple[str, ...] = ("metric_row_key",)) -> DataFrame:
    """All rows in range of the repetition with the greatest candidate of each test and side; where a test has candidates of left or right, only
    these compete."""
    rows = candidates(labelled, catalog, named).where("rep_number is not null")
    lateral = F.coalesce(F.col("side").isin("left", "right"), F.lit(False))
    rows = rows.withColumn("__sided", F.bool_or(lateral).over(Window.partitionBy("test_id"))).where(~F.col("__sided") | lateral)
    return back_to_rows(in_range(labelled), _first(rows, ["test_id", "side"], F.col("metric_value").desc_nulls_last(), list(tie)), ["test_id", "side", "rep_number"])


def publish(existing: DataFrame, chosen: DataFrame, scope: DataFrame | None) -> DataFrame:
    """The mart after a run: rows of the scope's tests are replaced, so what no longer qualifies goes; no scope: all."""
    return chosen if scope is None else existing.join(scope, "test_id", "left_anti").unionByName(chosen.join(scope, "test_id", "left_semi"))
