"""The long fact: one row per test, metric, side and repetition."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.stored import stored
from .scope import CUTOFF, GATE

#: A hint tells apart rows of one value, such as the trial's id; the date isn't part of the key, so a corrected date makes no second row.
KEY_PARTS = ["profile_id", "team_group_id", "test_id", "assessment_family", "source_module", "metric_name", "side", "rep_number", "metric_value", "row_hint"]


def rep_numbers(df: DataFrame, *, test: str = "test_id", side: str = "side", when: str = "test_date", trial: str = "trial_id", repeat: str = "repeat") -> DataFrame:
    """Rank of the trial within test and side; without a trial the repeat counts from one."""
    w = Window.partitionBy(test, F.coalesce(F.col(side), F.lit("__unsided__"))).orderBy(F.col(when).asc_nulls_last(), F.col(trial).asc_nulls_last())
    rank = F.dense_rank().over(w)
    return df.withColumn("rep_number", F.when(F.col(trial).isNull(), F.col(repeat) + 1).otherwise(rank))


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Drops repeats of a key, keeping the first by a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def with_row_key(df: DataFrame, parts: list[str] | None = None) -> DataFrame:
    """md5 of the parts; what ``df`` has no column for is empty."""
    cols = [F.lit(None) if c not in df.columns else S.key_number(F.col(c)) if c == "metric_value" else F.trim(F.col(c).cast("string")) for c in parts or KEY_PARTS]
    return df.withColumn("metric_row_key", S.row_key(*cols))


def normalised(df: DataFrame, *, cutoff: str | None = None) -> DataFrame:
    """Metric rows with a number, on or after the cutoff, with name, side and unit normalised.

    Expects metric_name, metric_value, side, test_date; a side in the metric's name counts if there is none of its own.
    """
    name = S.metric_name(F.col("metric_name"))
    number = S.finite_double if dict(df.dtypes)["metric_value"] == "double" else S.finite
    out = (
        df.withColumn("metric_value", number(F.col("metric_value")))
        .withColumn("side", F.coalesce(S.side_label(F.col("side")), S.side_of_name(name)))
        .withColumn("metric_name", S.name_without_side(name))
        .withColumn("metric_unit", S.unit(F.col("metric_name")))
        .where("metric_value is not null")
    )
    return out if cutoff is None else out.where(F.col("test_date") >= F.lit(cutoff).cast("timestamp"))


@dataclass(frozen=True)
class Entry:
    """Which tests may enter a fact: those on or after ``cutoff``, and from ``gate`` on only tests of profiles that have ``least`` different tests since then."""

    cutoff: str | None = CUTOFF
    gate: str | None = GATE
    least: int = 2

    def profiles(self, tests: DataFrame, when: Column) -> DataFrame:
        """profile_id of those with enough tests since the gate."""
        late = tests.where(when >= F.lit(self.gate).cast("timestamp"))
        return late.groupBy("profile_id").agg(F.countDistinct("test_id").alias("__n")).where(F.col("__n") >= self.least).select("profile_id")

    def admitted(self, rows: DataFrame, tests: DataFrame | None = None, when: Column | None = None) -> DataFrame:
        """``rows`` with test_date that may enter; ``tests`` and their ``when``: what profiles are counted from (None: the rows themselves)."""
        if self.cutoff:
            rows = rows.where(F.col("test_date") >= F.lit(self.cutoff).cast("timestamp"))
        if not self.gate:
            return rows
        enough = self.profiles(rows if tests is None else tests, F.col("test_date") if when is None else when)
        joined = rows.join(enough.select(F.col("profile_id").alias("__enough")), F.col("profile_id") == F.col("__enough"), "left")
        return joined.where((F.col("test_date") < F.lit(self.gate).cast("timestamp")) | F.col("__enough").isNotNull()).drop("__enough")


#: All tests that have a date.
ANY = Entry(None, None)


def _active(profiles: DataFrame) -> DataFrame:
    return profiles.where("is_active").drop("is_active")


def _with_row(rows: DataFrame) -> DataFrame:
    """``__row``: a hash of the whole source row, which tells rows of one test apart."""
    return rows.withColumn("__row", F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))))


def first_in_row(rows: DataFrame) -> DataFrame:
    """Of several values of a metric, side and repetition within one source row (``__row``) the first one: columns before payloads (``__rank``), each in
    their order (``place``); without NULLs. Rows of different sources don't meet."""
    keys = ["test_id", "__row", "metric_name", "side", "rep_number"]
    return first_of(rows.where("metric_value is not null"), keys, [F.asc("__rank"), F.asc("place")]).drop("__rank", "__row", "place")


def with_metrics(tests: DataFrame, metrics: DataFrame, *, when: tuple[str, ...] = ("test_date", "modified_at")) -> DataFrame:
    """Tests with the metrics of theirs, if any (test_id, metrics as JSON, as ``payload``); test_date is the first of the dates that is given."""
    m = metrics.select(F.col("test_id").alias("__test"), F.col("metrics").alias("payload"))
    dated = tests.withColumn("test_date", F.coalesce(*[F.col(c) for c in when if c in tests.columns]))
    return dated.join(m, F.col("test_id") == F.col("__test"), "left").drop("__test")


def family_fact(base: DataFrame, profiles: DataFrame, ids: list[str], metrics: list[str], *, payload: str | None = None, depth: int | None = None, entry: Entry = ANY) -> DataFrame:
    """Wide columns and JSON leaves of a test to metric rows of active, scoped profiles; a column beats a leaf of its name, and of leaves the first does.

    ``base`` has test_id, profile_id, test_date, side, rep_number and the metric columns; ``profiles`` profile_id,
    is_active and the scope's columns. Tests without a date are left out.
    """
    from ..functions import jsonwalk

    who = _active(profiles)
    dated = base.where("test_date is not null")
    rows = _with_row(entry.admitted(dated.join(who, "profile_id"), dated))
    rows = stored(rows, "tests") if payload else rows  # read for columns, depth and leaves
    keep = [*ids, "__row", *[c for c in who.columns if c != "profile_id"]]
    wide = jsonwalk.wide_leaves(rows, keep, metrics).withColumn("__rank", F.lit(0))
    if payload:
        open_ = jsonwalk.all_leaves(rows, payload, *keep, depth=depth)
        wide = wide.unionByName(open_.withColumn("__rank", F.lit(1)))
    return first_in_row(normalised(wide))


#: Dates of a test of trials that stand in for the trial's own, in this order.
TEST_DATES = ("test_date", "analysed_at", "modified_at")


def trial_fact(results: DataFrame, tests: DataFrame, trials: DataFrame, definitions: DataFrame, profiles: DataFrame, *, entry: Entry = ANY) -> DataFrame:
    """Results of trials as metric rows: the six-way join, slugged metric names, ranks of trials as repetitions, no repeats.

    A result's date is its trial's or the first of the test's ``TEST_DATES`` (as far as ``tests`` has them); without any it is left out. Profiles are
    counted from the tests' own dates. Catalyst picks broadcast for definitions and profiles where their size allows; results and trials
    meet on their keys.
    """
    own = F.coalesce(*[F.col(c) for c in TEST_DATES if c in tests.columns])
    dated = tests.select("test_id", "profile_id", "test_type", own.alias("tested_at"))
    rows = (
        results.alias("r")
        .join(dated, ["test_id", "profile_id"])
        .join(trials.select("trial_id", F.col("trial_date"), F.col("limb").alias("trial_limb")), "trial_id", "left")
        .join(definitions.select("result_id", "result_group", "result_name", "result_unit"), "result_id", "left")
        .join(_active(profiles), "profile_id")
        .withColumn("test_date", F.coalesce("trial_date", "tested_at"))
        .where("test_date is not null")
    )
    rows = entry.admitted(rows, dated, F.col("tested_at"))
    named = (
        rows.withColumn("metric_name", S.slug(F.col("result_group"), F.col("result_name"), F.col("result_id")))
        .withColumn("side", S.limb_side(F.coalesce("limb", "trial_limb")))
        .withColumn("metric_value", S.finite(F.col("value")))
        .withColumn("metric_unit", F.nullif("result_unit", F.lit("")))
        .where("metric_value is not null")
    )
    ranked = rep_numbers(named).withColumn("__number", S.key_number(F.col("metric_value")))
    keys = ["profile_id", *[c for c in ("team_group_id",) if c in ranked.columns], "test_id", "metric_name", "side", "rep_number", "__number", "trial_id"]
    order = [F.col(c).asc_nulls_last() for c in ("test_date", "metric_unit", "test_type", "result_id")]
    return first_of(ranked, keys, order).drop("__number", "tested_at", "trial_date", "trial_limb", "result_group", "result_name", "result_unit", "limb", "value")


def gate_fact(summaries: DataFrame, details: DataFrame, profiles: DataFrame, *, entry: Entry = ANY) -> DataFrame:
    """Timing gates: test_id, test_name, test_type, test_date, the profile's columns, metric_name, metric_value, metric_unit, side, rep_number.

    Summaries (test_id, profile_id, test_name, test_type, test_date) with the details of their test, if any (test_id, profile_id, test_date, results,
    reps as JSON); the detail's profile and date go first. Numbers of results have no repetition, those of repetitions, jumps and splits have.
    Profiles are counted from the summaries.
    """
    from ..functions import jsonwalk

    d = details.select("test_id", F.col("profile_id").alias("__profile"), F.col("test_date").alias("__date"), "results", "reps")
    base = summaries.join(d, "test_id", "left").withColumn("profile_id", F.coalesce("__profile", "profile_id")).withColumn("test_date", F.coalesce("__date", "test_date"))
    base = base.drop("__profile", "__date").join(_active(profiles), "profile_id").where("test_date is not null")
    base = stored(_with_row(entry.admitted(base, summaries)), "tests")  # read for depth, leaves and four kinds of repetitions
    keep = [c for c in base.columns if c not in ("results", "reps")]
    own = [*keep, "metric_name", "metric_value", "place"]
    whole = jsonwalk.all_leaves(base, "results", *keep).select(*own, F.lit(None).cast("int").alias("rep_number"), S.gate_unit(F.col("metric_name")).alias("metric_unit"), F.lit(0).alias("__rank"))
    each = jsonwalk.repetition_leaves(base, "reps", *keep).withColumn("__rank", F.lit(1))
    rows = whole.unionByName(each)
    name = S.metric_name(F.col("metric_name"))
    return first_in_row(rows.withColumn("side", S.side_of_name(name)).withColumn("metric_name", S.name_without_side(name)))


#: Numbers of a repetition's payload that stand in the trace and aren't metrics of their own.
EXCLUDED = ("force", "force_newtons")


def dynamometer_fact(
    tests: DataFrame, summaries: DataFrame, repetitions: DataFrame, profiles: DataFrame, *, of_summary: list[str], of_repetition: list[str], excluded: tuple[str, ...] = EXCLUDED, entry: Entry = ANY
) -> DataFrame:
    """Dynamometer: summary rows and repetition rows of tests of active profiles, columns first, then the numbers of their payload (JSON).

    tests: test_id, profile_id, test_name, test_type, test_date; summaries: test_id, side, payload, metrics, and what else tells them apart, such as the
    movement; repetitions: also repetition_number. Every source row keeps its own values, so a test with two movements of a side has both.
    """
    from ..functions import jsonwalk

    base = tests.where("test_date is not null")
    base = entry.admitted(base.join(_active(profiles), "profile_id"), base)
    parts = []
    for rows, metrics, numbered in ((summaries, of_summary, False), (repetitions, of_repetition, True)):
        number = F.col("repetition_number").cast("int") if numbered else F.lit(None).cast("int")
        own = stored(base.join(_with_row(rows).withColumn("rep_number", number).drop("repetition_number"), "test_id"), "tests")
        keep = [*base.columns, "side", "rep_number", "__row"]
        wide = jsonwalk.wide_leaves(own, keep, metrics).withColumn("__rank", F.lit(0))
        open_ = jsonwalk.all_leaves(own, "payload", *keep).withColumn("__rank", F.lit(1))
        parts += [wide, open_.where(~F.col("metric_name").isin(*excluded)) if numbered else open_]
    return first_in_row(normalised(reduce(DataFrame.unionByName, parts)))


def all_families(families: dict[str, DataFrame]) -> DataFrame:
    """One fact of the families' facts, with assessment_family and the row key; columns that a family lacks are NULL."""
    named = [df.withColumn("assessment_family", F.lit(k)) for k, df in families.items()]
    return with_row_key(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named))


def fill_ticks(df: DataFrame, group: str, position: str, tick: str) -> DataFrame:
    """A missing tick is the one before plus one; before any tick it is the position."""
    w = Window.partitionBy(group).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    known = F.when(F.col(tick).isNotNull(), F.col(position))
    last, at = F.last(tick, ignorenulls=True).over(w), F.last(known, ignorenulls=True).over(w)
    return df.withColumn("filled_tick", F.coalesce(last + F.col(position) - at, F.col(position)))
