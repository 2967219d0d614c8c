"""Filters on time and on what was touched; the scope of an incremental run."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

CUTOFF = "2024-06-30T23:00:00Z"
GATE = "2026-04-05T23:00:00Z"


def after_cutoff(df: DataFrame, fields: list[str], cutoff: str = CUTOFF) -> DataFrame:
    """The first field that can be read decides; a later one never saves an early first one."""
    first = F.coalesce(*[S.timestamp(F.col(f)) for f in fields])
    return df.where(first >= F.lit(cutoff).cast("timestamp"))


def activity_after(df: DataFrame, start: str, cutoff: str = CUTOFF) -> DataFrame:
    """A missing start is kept."""
    return df.where(F.col(start).isNull() | (F.col(start) >= F.lit(cutoff).cast("timestamp")))


def in_window(when: Column, start: Column, stop: Column) -> Column:
    return (when >= start) & (when < stop)


def local_day(when: Column, day: str, zone: str) -> Column:
    """Within one calendar day of a zone; days when clocks change have 23 or 25 hours."""
    d = F.lit(day).cast("date")
    return in_window(when, S.local_day_start(d, zone), S.local_day_start(F.date_add(d, 1), zone))


def min_tests(tests: DataFrame, profile: str, test: str, when: str, *, since: str, least: int = 2) -> DataFrame:
    """Tests before ``since``, and later ones of profiles with at least ``least`` distinct tests since then."""
    gate = F.lit(since).cast("timestamp")
    enough = tests.where(F.col(when) >= gate).groupBy(F.col(profile).alias("__p")).agg(F.countDistinct(test).alias("__n")).where(F.col("__n") >= least)
    joined = tests.join(enough, tests[profile] == F.col("__p"), "left")
    return joined.where((F.col(when) < gate) | F.col("__n").isNotNull()).drop("__p", "__n")


def touched(tables: dict[str, list[DataFrame]], test: str = "test_id") -> DataFrame:
    """family, test_id: distinct tests that any of a family's changed rows names."""
    each = [df.select(F.lit(family).alias("family"), F.col(test).alias("test_id")) for family, dfs in tables.items() for df in dfs]
    return reduce(DataFrame.unionByName, each).where("test_id is not null").distinct()


def of_raw_rows(typed: DataFrame, raw: DataFrame, key: str = "raw_id") -> DataFrame:
    return typed.join(raw.select(key).hint("shuffle_hash"), key, "left_semi")


def refreshed(existing: DataFrame, rebuilt: DataFrame, scope: DataFrame, test: str = "test_id") -> DataFrame:
    """Rows of the scope's tests come from ``rebuilt``, all others stay; an empty scope changes nothing. Tasks hold their part of the scope's ids; the
    many rows pass by them unsorted."""
    ids = scope.select(test).distinct().hint("shuffle_hash")
    return existing.join(ids, test, "left_anti").unionByName(rebuilt.join(ids, test, "left_semi"))


@dataclass(frozen=True)
class Selection:
    """Raw rows of a replay; what is given holds together: those after a cursor, of some batches, of one local day of ingestion, of a window of it.

    cursor: source_account, last_raw_id; batches: batch_id; day: (date, zone), of 23 or 25 hours where clocks change; window: [start, stop) as
    timestamp text. Without any of them it is every raw row, so a full replay ignores the cursor.
    """

    cursor: DataFrame | None = None
    batches: DataFrame | None = None
    day: tuple[str, str] | None = None
    window: tuple[str, str] | None = None

    def raw(self, raw: DataFrame) -> DataFrame:
        rows = raw
        if self.day:
            rows = rows.where(local_day(F.col("ingested_at"), *self.day))
        if self.window:
            rows = rows.where(in_window(F.col("ingested_at"), *[F.lit(w).cast("timestamp") for w in self.window]))
        if self.batches is not None:
            rows = rows.join(self.batches.select("batch_id"), "batch_id", "left_semi")
        if self.cursor is not None:
            c = self.cursor.select(F.col("source_account").alias("__a"), "last_raw_id")
            rows = rows.join(c, rows["source_account"].eqNullSafe(F.col("__a")), "left").where(F.col("raw_id") > F.coalesce("last_raw_id", F.lit(-1))).select(*raw.columns)
        return rows

    def tests(self, raw: DataFrame, typed: dict[str, list[DataFrame]]) -> DataFrame:
        """family, test_id of the typed rows (raw_id, test_id) that come from selected raw rows."""
        named = [rows.select("raw_id", "test_id", F.lit(family).alias("family")) for family, each in typed.items() for rows in each]
        hit = of_raw_rows(reduce(DataFrame.unionByName, named), self.raw(raw))
        return hit.where("test_id is not null").select("family", "test_id").distinct()
