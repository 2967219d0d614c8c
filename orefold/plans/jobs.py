"""Whole refreshes: the long fact of all families, the marts, the audit; in full, for a window of days or for a scope of tests.

A scope is a DataFrame of test_id; rows of its tests are replaced and all others stay. Limits and baselines always come from the
full history. The fact is written once, in folders by family, and the limits of its cohorts once; labels, marts, statistics and audits read these.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import coverage, marts, quality, scope
from ..operators.merge import latest
from ..sources.stored import stored


@dataclass(frozen=True)
class Mart:
    """How a family's mart is made; ``select`` gets the labelled rows and the catalog of reference metrics."""

    family: str
    select: Callable[..., DataFrame]
    keys: tuple[str, ...]


MARTS = [
    Mart("hamstring", marts.mart_simple, ("test_id", "metric_name", "side")),
    Mart("frame", marts.mart_simple, ("test_id", "metric_name", "side")),
    Mart("dynamometer", marts.mart_by_side, ("test_id", "metric_name", "side", "rep_number")),
    Mart("gates", marts.mart_least_rep, ("test_id", "metric_name", "rep_number")),
    Mart("plates", marts.mart_greatest_rep_by_side, ("test_id", "metric_name", "side", "rep_number")),
]


#: Makes a family's part of the fact, for a scope of tests or for all (None).
Family = Callable[[DataFrame | None], DataFrame]


def refresh_fact(existing: DataFrame | None, families: dict[str, Family], *, tests: DataFrame | None = None, window: tuple[str, str] | None = None) -> DataFrame:
    """The fact after a run: all families anew, only the scope's tests, or only rows dated in [start, stop). Rows that are to be replaced and don't come
    again go; rows without a date are never in a window."""
    new = reduce(DataFrame.unionByName, [make(tests).withColumn("assessment_family", F.lit(family)) for family, make in families.items()])
    if tests is not None:
        return new.join(tests.select("test_id").distinct(), "test_id", "left_semi") if existing is None else scope.refreshed(existing, new, tests)
    if window is not None:
        within = F.coalesce(scope.in_window(F.col("test_date"), *[F.lit(w).cast("timestamp") for w in window]), F.lit(False))
        new = new.where(within)
        return new if existing is None else existing.where(~within).unionByName(new.select(*existing.columns))
    return new


def store_fact(fact: DataFrame) -> DataFrame:
    """The fact as a table with a folder for each family."""
    return stored(fact, "fact", "assessment_family")


def label_all(fact: DataFrame, *, factor: float = marts.FACTOR) -> DataFrame:
    """Every row of a stored fact with its labels. The limits of all cohorts are found once and stored; rows meet them as they are read, which costs less than
    writing and reading all rows again, as there are only as many limits as cohorts (Spark broadcasts them by their size)."""
    return marts.label(fact, stored(marts.thresholds(fact, factor=factor), "limits"))


def refresh_mart(
    fact: DataFrame, mart: Mart, catalog: DataFrame, existing: DataFrame | None = None, tests: DataFrame | None = None, *, factor: float = marts.FACTOR, named: tuple[str, ...] = marts.NAMED
) -> tuple[DataFrame, DataFrame]:
    """A family's mart, one row per natural key, and the counts of its labels. ``fact`` may be what ``label_all`` made; of it only the family's folder is read."""
    own = fact.where(F.col("assessment_family") == mart.family)
    labelled = own if "is_above" in own.columns else marts.label(own, marts.thresholds(own, factor=factor))
    columns = [c for c in fact.columns if c not in ("is_above", "is_below", "upper_limit", "lower_limit")]
    order = [F.desc("metric_row_key")] if "metric_row_key" in columns else []
    chosen = latest(mart.select(labelled, catalog, named=named).select(*columns), list(mart.keys), [*order, F.desc("metric_value")])
    full = chosen if existing is None else marts.publish(existing, chosen, tests)
    return full, marts.stats(labelled, ["assessment_family"])


def refresh_all(
    fact: DataFrame, catalog: DataFrame, existing: dict[str, DataFrame] | None = None, tests: DataFrame | None = None, *, every: list[Mart] | None = None, factor: float = marts.FACTOR,
    named: tuple[str, ...] = marts.NAMED,
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Mart and label counts of each family; with a scope, rows of the tests in it are replaced. Rows are labelled once for all families."""
    rows = label_all(fact, factor=factor)
    return {m.family: refresh_mart(rows, m, catalog, (existing or {}).get(m.family), tests, named=named) for m in every or MARTS}


@dataclass(frozen=True)
class Replay:
    """What a replay did: the scope that it touched (family, test_id), and the fact after it; ``ran`` is false where nothing was touched."""

    tests: DataFrame
    fact: DataFrame
    ran: bool


def replay(selection: scope.Selection, raw: DataFrame, typed: dict[str, list[DataFrame]], families: dict[str, Family], existing: DataFrame) -> Replay:
    """From selected raw rows by way of the typed rows that came from them to the tests whose part of the fact is made anew. A selection that touches no
    test stops the run: the fact stays what it was."""
    tests = stored(selection.tests(raw, typed), "scope")
    if tests.isEmpty():
        return Replay(tests, existing, False)
    touched = {r.family for r in tests.select("family").distinct().collect()}
    return Replay(tests, refresh_fact(existing, {k: v for k, v in families.items() if k in touched}, tests=tests.select("test_id").distinct()), True)


FLAG_KEYS = ["test_id", "metric_name", "side", "rep_number", "flag_type"]


def audit(fact: DataFrame, rules: DataFrame, existing: DataFrame | None = None, *, since: str | None = None, most: int | None = None, at_rest: bool = False) -> DataFrame:
    """Flags of the fact's rows (those updated after ``since``; of these ``most`` rows at most, if the caller limits a run) by the rules of their metric, with
    severity and details, merged into those there are. Only flags of rows that were looked at can be superseded. Baselines are found for metrics that have a rule.

    ``at_rest``: the fact is a table that is cheap to read three times, see ``quality.baselines``."""
    keys = ["assessment_family", "metric_name"]
    paired = "asymmetry" in fact.columns
    rules = stored(rules, "rules")  # its size is known then, so rows need no shuffle to meet it
    base = quality.baselines((fact.where("asymmetry is null") if paired else fact).join(rules.select(*keys), keys, "left_semi"), keys, at_rest=at_rest)
    rows = fact if since is None else fact.where(F.col("updated_at") > F.lit(since).cast("timestamp"))
    rows = rows if most is None else rows.orderBy("test_id", "metric_name", "side", "rep_number").limit(most)
    ruled = rows.join(rules, keys, "left" if paired else "inner")
    ruled = quality.with_baseline(ruled.where("asymmetry is not null or fence is not null") if paired else ruled, base, keys)
    worst = F.struct(F.col("severity") == "critical", F.abs("metric_value"))
    found = quality.flags(ruled).groupBy(*FLAG_KEYS).agg(*[F.max_by(c, worst).alias(n) for c, n in (("metric_value", "value"), ("severity", "severity"), ("details", "details"))])
    if existing is None:
        return found.withColumn("status", F.lit("open"))
    return quality.persist_flags(existing, found, FLAG_KEYS, within=rows.select(*FLAG_KEYS[:-1]))


def audit_wide(rows: DataFrame, ids: list[str], metrics: list[str], rules: DataFrame, existing: DataFrame | None = None, *, pairs: list[quality.Pair] = (), **how) -> DataFrame:
    """The same for a table with a column for each metric, and left against right for ``pairs`` of them; ``ids`` must hold the columns of a fact but metric_name
    and metric_value."""
    return audit(quality.wide_rows(rows, ids, metrics, pairs), rules, existing, **how)


def covered_only(sources: DataFrame, catalog: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of tests that have a reference metric."""
    named = catalog.where("coverage_status = 'covered'").select(*keys, "reference_metric")
    return marts.back_to_rows(sources, named, keys)


def coverage_of(fact: DataFrame, sources: DataFrame, **choice) -> DataFrame:
    """Source tests (source_module, assessment_family, test_name, test_id, test_date) with their reference metric, chosen as ``choice`` says."""
    keys = list(marts.NAMED)
    return coverage.coverage(coverage.catalog_of(sources, keys), coverage.reference_metrics(coverage.metric_candidates(fact, keys), keys, **choice), keys)


def last_audit(log: DataFrame) -> DataFrame:
    """Per family the start of its last good audit; the start, so that what came in during a run is looked at next time."""
    return log.where("status = 'completed'").groupBy("assessment_family").agg(F.max("started_at").alias("since"))
