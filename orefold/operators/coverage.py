"""Which tests have a reference metric: catalog of sources against catalog of metrics."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

def source_catalog(sources: dict[str, DataFrame], *, name: str = "test_name", test: str = "test_id", when: str = "test_date") -> DataFrame:
    """source_module, test_name, n_tests, last_date over all sources."""
    each = [df.groupBy(name).agg(F.countDistinct(test).alias("n_tests"), F.max(when).alias("last_date")).withColumn("source_module", F.lit(k)) for k, df in sources.items()]
    return reduce(DataFrame.unionByName, each)


def catalog_of(rows: DataFrame, keys: list[str], *, test: str = "test_id", when: str = "test_date") -> DataFrame:
    """The same of one table that has the module as a column."""
    return rows.groupBy(*keys).agg(F.countDistinct(test).alias("n_tests"), F.max(when).alias("last_date"))


def metric_candidates(fact: DataFrame, keys: list[str]) -> DataFrame:
    return fact.groupBy(*keys, "metric_name").agg(F.max("metric_value").alias("max_metric_value"))


def reference_metrics(
    candidates: DataFrame, keys: list[str], *, module: str = "source_module", priority: dict[str, list[str]] | None = None, splits: tuple[str, ...] = (), fixed: dict[str, str] | None = None
) -> DataFrame:
    """One metric per keys, by what the caller says of a module: the first of a list of metrics (``priority``), the highest cumulative split
    (``splits``) or one metric (``fixed``); then the greatest value, then the name."""
    rank = F.lit(None).cast("int")
    for name, metrics in (priority or {}).items():
        position = F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col("metric_name")).cast("int")
        rank = F.coalesce(rank, F.when((F.col(module) == name) & (position > 0), position))
    if splits:
        rank = F.coalesce(rank, F.when(F.col(module).isin(*splits), -S.split_number(F.col("metric_name"))))
    for name, metric in (fixed or {}).items():
        rank = F.coalesce(rank, F.when((F.col(module) == name) & (F.col("metric_name") == metric), 0))
    w = Window.partitionBy(*keys).orderBy("rank", F.col("max_metric_value").desc_nulls_last(), "metric_name")
    return candidates.withColumn("rank", rank).where("rank is not null").withColumn("__n", F.row_number().over(w)).where("__n = 1").select(*keys, F.col("metric_name").alias("reference_metric"))


def coverage(catalog: DataFrame, reference: DataFrame, keys: list[str]) -> DataFrame:
    r = reference.select(*[F.col(k).alias(f"r_{k}") for k in keys], "reference_metric")
    joined = catalog.join(r, reduce(and_, [catalog[k].eqNullSafe(r[f"r_{k}"]) for k in keys]), "left").drop(*[f"r_{k}" for k in keys])
    return joined.withColumn("coverage_status", F.when(F.col("reference_metric").isNotNull(), "covered").otherwise("unmapped"))
