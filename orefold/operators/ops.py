"""Operations: watermarks, batches, cursors, freshness, stage timings, reconciling positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .quality import persist_flags


def watermarks(log: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The greatest readable timestamp per key, and its original text."""
    at = S.timestamp(F.col(value))
    return log.where(at.isNotNull()).groupBy(*keys).agg(F.max_by(value, at).alias("watermark_text"), F.max(at).alias("watermark"))


def updated_watermarks(old: DataFrame, log: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The watermarks after a run: the later of the stored and the run's own per key; a null key is a key, a mark never goes back."""
    both = old.select(*keys, F.col("watermark_text").alias(value)).unionByName(log.select(*keys, value))
    return watermarks(both, keys, value)


def replay_cursor(raw: DataFrame) -> DataFrame:
    return raw.groupBy("source_account").agg(F.max("raw_id").alias("last_raw_id"))


def after_cursor(raw: DataFrame, cursor: DataFrame) -> DataFrame:
    c = cursor.select(F.col("source_account").alias("__a"), "last_raw_id")
    joined = raw.join(c, raw.source_account.eqNullSafe(F.col("__a")), "left")
    return joined.where(F.col("raw_id") > F.coalesce("last_raw_id", F.lit(-1))).drop("__a", "last_raw_id")


def page_after(raw: DataFrame, last_raw_id: int, size: int) -> DataFrame:
    """The next ``size`` raw rows by raw_id, for a replay in bounded steps; the last one's raw_id is the next call's start.

    Spark keeps at most ``size`` rows per task on the way. An id that repeats would be split over pages, so it is an error.
    """
    page = raw.where(F.col("raw_id") > last_raw_id).orderBy("raw_id").limit(size)
    twice = F.count("*").over(Window.partitionBy("raw_id")) > 1
    return page.withColumn("raw_id", F.when(twice, F.raise_error(F.lit("raw_id repeats")).cast("bigint")).otherwise(F.col("raw_id")))


def last_batches(log: DataFrame, keys: list[str]) -> DataFrame:
    """The latest completed batch per key, by start and id."""
    done = log.where("status = 'completed'")
    return done.groupBy(*keys).agg(F.max_by("batch_id", F.struct("started_at", "batch_id")).alias("batch_id"), F.max("started_at").alias("started_at"))


def batch_states(log: DataFrame) -> DataFrame:
    return log.groupBy("batch_id").agg(F.max_by("status", "logged_at").alias("status"))


def freshness(tables: dict[str, tuple[DataFrame, str]], now: Column) -> DataFrame:
    """table_name, last_update, lag_hours, limit_hours, severity; empty tables are left out."""
    each = [df.agg(F.max(c).alias("last_update")).select(F.lit(name).alias("table_name"), "last_update") for name, (df, c) in tables.items()]
    rows = reduce(DataFrame.unionByName, each).where("last_update is not null")
    lag = (now.cast("timestamp").cast("double") - F.col("last_update").cast("timestamp").cast("double")) / 3600
    out = rows.withColumn("lag_hours", lag).withColumn("limit_hours", S.lag_limit(F.col("table_name")))
    return out.withColumn("severity", S.severity(F.col("lag_hours"), F.col("limit_hours")))


def heartbeat(runs: DataFrame, providers: DataFrame, now: Column, silence_hours: int = 25) -> DataFrame:
    """provider, silent_hours, severity; one that never ran is critical."""
    last = runs.groupBy("provider").agg(F.max("started_at").alias("last_start"))
    joined = providers.join(last, "provider", "left").withColumn("silent_hours", (now.cast("double") - F.col("last_start").cast("double")) / 3600)
    return joined.withColumn("severity", F.when(F.col("last_start").isNull(), "critical").otherwise(S.severity(F.col("silent_hours"), F.lit(silence_hours))))


def freshness_flags(old: DataFrame, lag: DataFrame) -> DataFrame:
    """A resolved flag whose value changed opens again."""
    late = lag.where("severity is not null").select("table_name", F.col("lag_hours").alias("value"))
    known = old.join(late.select("table_name", F.col("value").alias("now")), "table_name", "left")
    again = known.withColumn("status", F.when((F.col("status") == "resolved") & F.col("now").isNotNull() & ~F.col("now").eqNullSafe(F.col("value")), "superseded").otherwise(F.col("status"))).drop("now")
    return persist_flags(again, late, ["table_name"])


def stage_percentiles(timings: DataFrame, stage: str, elapsed: str) -> DataFrame:
    """Discrete percentiles of elapsed times."""
    disc = lambda q: F.expr(f"percentile_disc({q}) within group (order by {elapsed})")
    return timings.groupBy(stage).agg(F.count("*").alias("n_runs"), disc(0.5).alias("p50"), disc(0.95).alias("p95"), F.max(elapsed).alias("max_elapsed"))


def run_breakdown(timings: DataFrame, run: str, stage: str, elapsed: str) -> DataFrame:
    """Stages of each run with their place by elapsed time, the slowest first, and their share of the run."""
    own = Window.partitionBy(run)
    place = F.row_number().over(own.orderBy(F.desc_nulls_last(elapsed), stage))
    return timings.withColumn("place", place).withColumn("share", F.col(elapsed) / F.nullif(F.sum(elapsed).over(own), F.lit(0)))


def recent_runs(timings: DataFrame, run: str, started: str, k: int) -> DataFrame:
    """Timings of the k runs that started last."""
    last = timings.groupBy(run).agg(F.max(started).alias("__s")).orderBy(F.desc("__s"), run).limit(k)
    return timings.join(last.select(run), run, "left_semi")


def reconcile_positions(wanted: DataFrame, positions: DataFrame, athletes: DataFrame) -> DataFrame:
    """Per row of the mapping: unchanged, to_update, missing_position or unknown_athlete.

    wanted: source_account, athlete_id, position_name, position_slug; positions: source_account, position_id, name,
    slug; athletes: source_account, athlete_id, position_id.
    """
    p = positions.select("source_account", F.col("name").alias("position_name"), F.col("slug").alias("position_slug"), F.col("position_id").alias("wanted_position"))
    a = athletes.select("source_account", "athlete_id", F.col("position_id").alias("current_position"), F.lit(True).alias("__known"))
    joined = wanted.join(p, ["source_account", "position_name", "position_slug"], "left").join(a, ["source_account", "athlete_id"], "left")
    status = (
        F.when(F.col("wanted_position").isNull(), "missing_position")
        .when(F.col("__known").isNull(), "unknown_athlete")
        .when(F.col("wanted_position").eqNullSafe(F.col("current_position")), "unchanged")
        .otherwise("to_update")
    )
    return joined.withColumn("status", status).drop("__known")


def position_statuses(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("source_account", "status").agg(F.count("*").alias("n_rows"))


def missing_positions(reconciled: DataFrame) -> DataFrame:
    """Wanted positions that an account lacks, and how many rows want each."""
    return reconciled.where("status = 'missing_position'").groupBy("source_account", "position_name", "position_slug").agg(F.count("*").alias("affected_rows"))
