"""Cases on hand-made rows; the queries' equality with SQL is in test_queries.py."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from orefold.operators import audit, coverage, dims, fact, marts, ops, quality, scope

FACT = "test_id long, profile_id long, assessment_family string, team_group_id int, test_type string, metric_name string, side string, rep_number int, metric_value double"


def rows(spark, values, side=None):
    return spark.createDataFrame([(i, i, "f", 1, "t", "m", side, 1, float(v)) for i, v in enumerate(values)], FACT)


@pytest.mark.parametrize("large", [False, True])
def test_outlier_of_a_hundred_is_outside(spark, large):
    f = rows(spark, [*range(1, 101), 1000])
    labelled = marts.label(f, marts.thresholds(f, large=large))
    assert [r.metric_value for r in labelled.where("is_above").collect()] == [1000.0]
    catalog = spark.createDataFrame([("t", "m")], "test_type string, reference_metric string")
    assert {r.metric_value for r in marts.mart_simple(labelled, catalog, named=("test_type",)).collect()} == set(map(float, range(26, 101)))


def test_limits_are_strict_and_null_is_neither(spark):
    f = spark.createDataFrame([(1, 1, "f", 1, None, "m", None, 1, 12.0), (2, 2, "f", 1, None, "m", None, 1, None)], FACT)
    limits = spark.createDataFrame([("f", 1, None, "m", None, 12.0, 12.0)], "assessment_family string, team_group_id int, test_type string, metric_name string, side string, upper_limit double, lower_limit double")
    assert [(r.is_above, r.is_below) for r in marts.label(f, limits).collect()] == [(False, False)] * 2


def test_exact_percentiles_with_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", float(v % 7)) for v in range(1000)] + [("b", 5.0), (None, 1.0), (None, 2.0), ("a", None)], "k string, v double")
    got = {r.k: (r.p0, r.p1) for r in marts.exact_percentiles(df, ["k"], "v", [0.99, 0.25], parts=8).collect()}
    want = {r.k: tuple(r.p) for r in df.groupBy("k").agg(F.percentile("v", [0.99, 0.25]).alias("p")).collect()}
    assert {k: tuple(round(x, 9) for x in v) for k, v in got.items()} == {k: tuple(round(x, 9) for x in v) for k, v in want.items()}


def test_best_repetitions(spark):
    data = [(1, 1, "f", 1, "t", "m", s, r, v) for s, r, v in [("left", 1, 5.0), ("left", 2, 7.0), (None, 3, 9.0), ("right", 1, 4.0)]]
    f = spark.createDataFrame(data, FACT)
    lab = f.withColumn("is_above", F.lit(False)).withColumn("is_below", F.lit(False))
    how = {"catalog": spark.createDataFrame([("t", "m")], "test_type string, reference_metric string"), "named": ("test_type",), "tie": ("side",)}
    assert sorted(r.metric_value for r in marts.mart_greatest_rep_by_side(lab, **how).collect()) == [4.0, 7.0]
    assert sorted(r.metric_value for r in marts.mart_least_rep(lab, **how).collect()) == [4.0, 5.0]


def test_publish_drops_what_no_longer_qualifies(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "test_id int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "test_id int, v string")
    scope_ = spark.createDataFrame([(1,), (2,)], "test_id int")
    assert {tuple(r) for r in marts.publish(old, new, scope_).collect()} == {(2, "c")}


def test_baselines_need_ten_and_cascade(spark):
    f = rows(spark, range(9)).unionByName(rows(spark, range(9)).withColumn("team_group_id", F.lit(2)))
    b = quality.baselines(f, ["metric_name"])
    assert sorted(r.grain for r in b.collect()) == [0, 1]
    got = quality.with_baseline(f, b, ["metric_name"]).select("b.sample_count").distinct().collect()
    assert [r.sample_count for r in got] == [18]


RULE = {"non_negative": True, "abs_min": 0.0, "abs_max": 100.0, "fence": 2.0, "z_warning": 2.5, "z_critical": 3.5}


@pytest.mark.parametrize(
    "value,mad,expected",
    [(50.0, 10.0, set()), (-1.0, 10.0, {("negative_value", "critical"), ("range_violation", "critical"), ("outlier_modified_zscore", "critical")}), (101.0, 100.0, {("range_violation", "critical")}), (81.0, 0.5, {("outlier_iqr", "warning")}), (89.0, 10.0, {("outlier_modified_zscore", "warning"), ("outlier_iqr", "warning")})],
)
def test_flags(spark, value, mad, expected):
    base = F.struct(F.lit(45.0).alias("p25_value"), F.lit(50.0).alias("median_value"), F.lit(55.0).alias("p75_value"), F.lit(mad).alias("mad_value"), F.lit(10).alias("sample_count"))
    if value in (-1.0, 101.0):
        base = F.struct(F.lit(0.0).alias("p25_value"), F.lit(60.0).alias("median_value"), F.lit(60.0).alias("p75_value"), F.lit(mad).alias("mad_value"), F.lit(10).alias("sample_count"))
    df = spark.createDataFrame([Row(metric_value=value)]).withColumns({k: F.lit(v) for k, v in RULE.items()}).withColumn("b", base)
    assert {(r.flag_type, r.severity) for r in quality.flags(df).collect()} == expected


def test_asymmetry_levels(spark):
    f = spark.createDataFrame([(t, 1, "f", 1, "t", "m", s, 1, v) for t, l, r in [(1, 100.0, 75.0), (2, 100.0, 85.0), (3, 100.0, 86.0), (4, 0.0, 0.0)] for s, v in (("left", l), ("right", r))], FACT)
    assert {(r.test_id, r.severity) for r in quality.asymmetry_flags(f, ["test_id", "metric_name"]).collect()} == {(1, "critical"), (2, "warning")}


def test_rule_table(spark):
    t = quality.rule_table(spark)
    assert t.count() == sum(map(len, quality.RULES.values())) and t.where("abs_max = 15").count() == 2


def test_flag_states(spark):
    old = spark.createDataFrame([(1, 1.0, "open"), (2, 1.0, "superseded"), (3, 1.0, "dismissed"), (4, 1.0, "open")], "profile_id int, value double, status string")
    new = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, 2.0), (5, 2.0)], "profile_id int, value double")
    once = dims.overlap_states(old, new)
    want = {(1, 2.0, "open"), (2, 2.0, "open"), (3, 1.0, "dismissed"), (4, 1.0, "superseded"), (5, 2.0, "open")}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in dims.overlap_states(once, new).collect()}


def test_ambiguous_membership(spark):
    assigned = spark.createDataFrame([(1, "g1", "c1", 5), (1, "g2", "c2", 4), (2, "g2", "c2", 3), (3, "gx", "c1", 2)], "profile_id int, group_id string, category_id string, raw_id int")
    targets = spark.createDataFrame([("g1", "c1", 1), ("g2", "c2", 2)], "group_id string, category_id string, priority int")
    got = {(r.profile_id, r.group_id, r.is_ambiguous, r.include_in_gold) for r in dims.membership(assigned, targets).collect()}
    assert got == {(1, "g1", True, True), (1, "g2", True, False), (2, "g2", False, True)}


def test_soft_delete_and_return(spark):
    cols = "profile_id int, is_active boolean, deactivated_at date, first_seen_at date"
    d = dt.date
    p = spark.createDataFrame([(1, True, None, d(2026, 1, 1)), (2, True, None, d(2026, 1, 2)), (3, False, d(2025, 5, 5), d(2025, 1, 1))], cols)
    m = spark.createDataFrame([(1, True), (2, False)], "profile_id int, include_in_gold boolean")
    gone = dims.soft_delete(p, m, F.lit(d(2026, 2, 2)))
    assert {(r.profile_id, r.is_active, r.deactivated_at) for r in gone.collect()} == {(1, True, None), (2, False, d(2026, 2, 2)), (3, False, d(2025, 5, 5))}
    back = dims.upsert_profiles(gone, spark.createDataFrame([(3, True, None, d(2026, 3, 3))], cols))
    assert {(r.profile_id, r.is_active, r.first_seen_at) for r in back.where("profile_id = 3").collect()} == {(3, True, d(2025, 1, 1))}


def test_profiles_meet_members_of_their_own_tenant(spark):
    p = spark.createDataFrame([(1, "t", "A", "B"), (1, "u", "A", "C"), (2, None, "D", None), (3, "t", "E", "F")], "profile_id int, tenant_id string, given_name string, family_name string")
    m = spark.createDataFrame([(1, "t", "g", True), (2, None, "h", True), (3, "t", "g", False), (3, "u", "g", True)], "profile_id int, tenant_id string, group_id string, include_in_gold boolean")
    assert {(r.profile_id, r.tenant_id, r.full_name, r.group_id) for r in dims.scoped_profiles(p, m).collect()} == {(1, "t", "A B", "g"), (2, None, "D", "h")}


def test_reference_metrics(spark):
    c = spark.createDataFrame(
        [("gates", "a", "split_1_cumulative_time", 1.0), ("gates", "a", "split_3_cumulative_time", 3.0), ("gates", "a", "split_2_cumulative_time", 2.0), ("plates", "b", "peak_force", 900.0), ("plates", "b", "jump_height", 3.0), ("plates", "d", "peak_force", 9.0), ("frame", "c", "avg_force", 1.0), ("frame", None, "max_force", 1.0)],
        "source_module string, test_name string, metric_name string, max_metric_value double",
    )
    keys = ["source_module", "test_name"]
    choice = {"priority": {"plates": ["jump_height", "peak_force"]}, "splits": ("gates",), "fixed": {"frame": "max_force"}}
    ref = coverage.reference_metrics(c, keys, **choice)
    assert {(r.test_name, r.reference_metric) for r in ref.collect()} == {("a", "split_3_cumulative_time"), ("b", "jump_height"), ("d", "peak_force"), (None, "max_force")}
    assert coverage.reference_metrics(c, keys).count() == 0
    cat = spark.createDataFrame([("frame", None), ("frame", "c")], "source_module string, test_name string")
    assert {(r.test_name, r.coverage_status) for r in coverage.coverage(cat, ref, keys).collect()} == {(None, "covered"), ("c", "unmapped")}


def test_marts_publish_only_rows_in_range(spark):
    rows = [  # test, side, rep, metric, value, above
        (1, None, 1, "ref", 5.0, False), (1, "left", 1, "other", 1.0, False), (1, "left", 1, "wild", 9.0, True), (1, None, 2, "ref", 4.0, False), (1, "right", 2, "other", 2.0, False), (1, None, None, "ref", 1.0, False),
        (2, None, 1, "ref", 5.0, True), (2, None, 1, "other", 5.0, False), (3, "left", 1, "ref", 7.0, False), (3, "left", 2, "ref", 8.0, False), (3, None, 9, "ref", 99.0, False), (3, "left", 2, "other", 0.5, False),
    ]
    df = spark.createDataFrame([(*r[:5], r[5], False, "n") for r in rows], "test_id int, side string, rep_number int, metric_name string, metric_value double, is_above boolean, is_below boolean, test_name string")
    catalog = spark.createDataFrame([("n", "ref"), ("x", "other"), (None, None)], "test_name string, reference_metric string")
    of = lambda m, **how: sorted((r.test_id, r.side or "", r.rep_number or 0, r.metric_name) for r in m(df, catalog, named=("test_name",), **how).collect())
    assert of(marts.mart_simple) == sorted((r[0], r[1] or "", r[2] or 0, r[3]) for r in rows if r[0] != 2 and not r[5])
    assert of(marts.mart_by_side) == [(1, "", 0, "ref"), (1, "", 1, "ref"), (1, "", 2, "ref"), (3, "", 9, "ref"), (3, "left", 1, "ref"), (3, "left", 2, "other"), (3, "left", 2, "ref")]
    assert of(marts.mart_least_rep, tie=["side"]) == [(1, "", 2, "ref"), (1, "right", 2, "other"), (3, "left", 1, "ref")]
    assert of(marts.mart_greatest_rep_by_side, tie=["side"]) == [(1, "", 1, "ref"), (3, "left", 2, "other"), (3, "left", 2, "ref")]


def test_row_keys(spark):
    one = {"profile_id": "p", "team_group_id": 3, "test_id": "t", "assessment_family": "f", "source_module": "m", "metric_name": "x", "side": None, "rep_number": 1, "metric_value": 1.50, "row_hint": None, "test_date": "2026-01-01"}
    df = spark.createDataFrame([one], "profile_id string, team_group_id int, test_id string, assessment_family string, source_module string, metric_name string, side string, rep_number int, metric_value double, row_hint string, test_date string")
    key = lambda d: fact.with_row_key(d).first().metric_row_key
    assert key(df) == hashlib.md5(b"p|3|t|f|m|x||1|1.5|").hexdigest() == key(df.withColumn("test_date", F.lit("later"))) == key(df.drop("row_hint"))
    assert key(df.withColumn("row_hint", F.lit("trial 2"))) == hashlib.md5(b"p|3|t|f|m|x||1|1.5|trial 2").hexdigest()


def test_leaves_at_any_depth(spark):
    from orefold.functions import jsonwalk

    deep = '{"a": ' * 9 + "7" + "}" * 9
    df = spark.createDataFrame([(1, deep), (2, '{"b": [1, {"c": 2}]}'), (3, None), (4, "broken")], "n int, p string")
    got = {(r.n, r.metric_name, r.metric_value) for r in jsonwalk.all_leaves(df, "p", "n").collect()}
    assert got == {(1, "_".join("a" * 9), 7.0), (2, "b_1", 1.0), (2, "b_2_c", 2.0)}


def test_ranks_put_missing_last(spark):
    df = spark.createDataFrame([(1, None, "b", dt.datetime(2026, 1, 2), 0), (1, None, "a", None, 0), (1, None, None, None, 4), (1, "left", "c", dt.datetime(2026, 1, 1), 0)], "test_id int, side string, trial_id string, test_date timestamp, repeat int")
    assert {(r.trial_id, r.rep_number) for r in fact.rep_numbers(df).collect()} == {("b", 1), ("a", 2), (None, 5), ("c", 1)}


def test_trial_fact(spark):
    results = spark.createDataFrame([("r1", "x1", "t1", "p1", "Left", 0, "100"), ("r1", "x2", "t1", "p1", "Left", 0, "10"), ("r2", "x2", "t1", "p1", None, 1, "bad")], "result_id string, trial_id string, test_id string, profile_id string, limb string, repeat int, value string")
    tests = spark.createDataFrame([("t1", "p1", "CMJ", dt.datetime(2026, 1, 1))], "test_id string, profile_id string, test_type string, test_date timestamp")
    trials = spark.createDataFrame([("x1", dt.datetime(2026, 1, 1, 1), "Both"), ("x2", dt.datetime(2026, 1, 1, 2), "Both")], "trial_id string, trial_date timestamp, limb string")
    defs = spark.createDataFrame([("r1", "Take-off", "Jump Height", "cm")], "result_id string, result_group string, result_name string, result_unit string")
    who = spark.createDataFrame([("p1", True, 7)], "profile_id string, is_active boolean, team_group_id int")
    got = fact.trial_fact(results, tests, trials, defs, who).orderBy("rep_number").collect()
    assert [(r.metric_name, r.side, r.rep_number, r.metric_value, r.team_group_id) for r in got] == [("take_off_jump_height", "left", 1, 100.0, 7), ("take_off_jump_height", "left", 2, 10.0, 7)]


def test_family_fact_prefers_columns(spark):
    base = spark.createDataFrame([("t", "p", dt.datetime(2026, 1, 1), None, 1, 5.0, 0.0, '{"leftMaxForce": 99, "extra": {"v": 3}, "testId": 4}')], "test_id string, profile_id string, test_date timestamp, side string, rep_number int, left_max_force double, right_max_force double, payload string")
    who = spark.createDataFrame([("p", True, 7)], "profile_id string, is_active boolean, team_group_id int")
    got = fact.family_fact(base, who, ["test_id", "profile_id", "test_date", "side", "rep_number"], ["left_max_force", "right_max_force"], payload="payload")
    assert {(r.metric_name, r.side, r.metric_value, r.metric_unit) for r in got.collect()} == {("max_force", "left", 5.0, "N"), ("max_force", "right", 0.0, "N"), ("extra_v", None, 3.0, None)}


IDS = ["test_id", "profile_id", "test_date", "side", "rep_number"]


def test_the_first_of_a_payload_counts_and_sources_stay_apart(spark):
    from orefold.functions import jsonwalk

    base = spark.createDataFrame([("t", "p", dt.datetime(2026, 1, 1), None, 1, 5.0, p) for p in ('{"peak_force": 9, "peakForce": 2, "z": {"b": 1, "a": [2, {"c": 3}]}}', '{"peakForce": 2, "peak_force": 9}')], "test_id string, profile_id string, test_date timestamp, side string, rep_number int, power double, payload string")
    order = [r.metric_name for r in jsonwalk.all_leaves(base.limit(1), "payload").orderBy("place").collect()]
    assert order == ["peak_force", "peak_force", "z_b", "z_a_1", "z_a_2_c"]
    who = spark.createDataFrame([("p", True)], "profile_id string, is_active boolean")
    got = fact.family_fact(base, who, IDS, ["power"], payload="payload").where("metric_name = 'peak_force'").collect()
    assert sorted(r.metric_value for r in got) == [2.0, 9.0]
    nested = spark.createDataFrame([('{"a": "[1, {", "b": [[1]]}',), (r'{"a": "\\\"[{"}',), (None,), ("7",)], "p string")
    assert [r.d for r in nested.select(jsonwalk.depth_of(F.col("p")).alias("d")).collect()] == [3, 1, 0, 0]


def test_two_movements_of_a_side_are_two(spark):
    tests = spark.createDataFrame([("t", "p", "n", "k", dt.datetime(2026, 1, 1))], "test_id string, profile_id string, test_name string, test_type string, test_date timestamp")
    sums = spark.createDataFrame([("t", m, "left", v, f'{{"extra": {v}, "maxForce": 1}}') for m, v in (("push", 3.0), ("pull", 4.0))], "test_id string, movement_type string, side string, max_force double, payload string")
    reps = spark.createDataFrame([("t", 1, "left", 5.0, '{"force": 9}')], "test_id string, repetition_number int, side string, impulse double, payload string")
    who = spark.createDataFrame([("p", True)], "profile_id string, is_active boolean")
    got = fact.dynamometer_fact(tests, sums, reps, who, of_summary=["max_force"], of_repetition=["impulse"])
    assert sorted((r.metric_name, r.metric_value, r.rep_number) for r in got.collect()) == [("extra", 3.0, None), ("extra", 4.0, None), ("impulse", 5.0, 1), ("max_force", 3.0, None), ("max_force", 4.0, None)]


def test_entry_into_a_fact(spark):
    day = lambda m: dt.datetime(2026, m, 9)
    base = spark.createDataFrame([(t, p, d, None, 1, 5.0) for t, p, d in [("old", "p", dt.datetime(2023, 1, 1)), ("early", "p", day(1)), ("a", "p", day(5)), ("b", "q", day(5)), ("c", "q", day(6)), ("none", "q", None)]], "test_id string, profile_id string, test_date timestamp, side string, rep_number int, force double")
    who = spark.createDataFrame([("p", True), ("q", True)], "profile_id string, is_active boolean")
    ids = lambda e: {r.test_id for r in fact.family_fact(base, who, IDS, ["force"], entry=e).collect()}
    assert ids(fact.Entry()) == {"early", "b", "c"} and ids(fact.ANY) == {"old", "early", "a", "b", "c"} and ids(fact.Entry(least=3)) == {"early"}


def test_trials_have_four_dates(spark):
    results = spark.createDataFrame([("r", f"x{t}", f"t{t}", "p", None, 0, "1") for t in range(5)], "result_id string, trial_id string, test_id string, profile_id string, limb string, repeat int, value string")
    d = [dt.datetime(2026, 1, i + 1) for i in range(5)]
    tests = spark.createDataFrame([(f"t{i}", "p", "k", d[1] if i < 2 else None, d[2] if i < 3 else None, d[3] if i < 4 else None) for i in range(5)], "test_id string, profile_id string, test_type string, test_date timestamp, analysed_at timestamp, modified_at timestamp")
    trials = spark.createDataFrame([("x0", d[0], None)], "trial_id string, trial_date timestamp, limb string")
    defs = spark.createDataFrame([], "result_id string, result_group string, result_name string, result_unit string")
    who = spark.createDataFrame([("p", True)], "profile_id string, is_active boolean")
    run = lambda **how: {r.test_id: r.test_date for r in fact.trial_fact(results, tests, trials, defs, who, **how).collect()}
    assert run() == {f"t{i}": d[i] for i in range(4)}
    assert set(run(entry=fact.Entry("2026-01-02", "2026-01-03", 2))) == {"t1", "t2", "t3"} and set(run(entry=fact.Entry(None, "2026-01-03", 3))) == {"t0", "t1"}


def test_cutoff_and_gate(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "2025-01-01"), (2, "bad", "2025-01-01"), (3, "2024-06-30T23:00:00Z", None)], "id int, a string, b string")
    assert sorted(r.id for r in scope.after_cutoff(df, ["a", "b"]).collect()) == [2, 3]
    t = spark.createDataFrame([(1, 1, "2026-05-01"), (1, 2, "2026-05-02"), (2, 3, "2026-05-01"), (2, 4, "2026-01-01")], "p int, t int, d string").withColumn("d", F.col("d").cast("timestamp"))
    assert sorted(r.t for r in scope.min_tests(t, "p", "t", "d", since=scope.GATE).collect()) == [1, 2, 4]


def test_freshness_levels(spark):
    now = F.lit("2026-01-02 00:00:00")
    hours = lambda h: spark.sql(f"select timestamp'2026-01-02' - make_dt_interval(0, 0, {int(h * 60)}) u")
    tables = {"a": (hours(1), "u"), "b": (hours(7), "u"), "c": (hours(12.5), "u"), "sensor_data": (hours(7), "u"), "empty": (hours(1).limit(0), "u")}
    assert {(r.table_name, r.severity) for r in ops.freshness(tables, now).collect()} == {("a", None), ("b", "warning"), ("c", "critical"), ("sensor_data", None)}
    runs = spark.sql("select 'x' provider, timestamp'2026-01-01 12:00:00' started_at")
    got = ops.heartbeat(runs, spark.createDataFrame([("x",), ("y",)], "provider string"), now.cast("timestamp"))
    assert {(r.provider, r.severity) for r in got.collect()} == {("x", None), ("y", "critical")}


def test_positions(spark):
    w = spark.createDataFrame([("a", 1, "N", "n"), ("a", 2, "N", "n"), ("a", 3, "X", "x"), ("a", 9, "N", "n")], "source_account string, athlete_id int, position_name string, position_slug string")
    p = spark.createDataFrame([("a", 5, "N", "n")], "source_account string, position_id int, name string, slug string")
    a = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 3, 5)], "source_account string, athlete_id int, position_id int")
    assert {(r.athlete_id, r.status) for r in ops.reconcile_positions(w, p, a).collect()} == {(1, "unchanged"), (2, "to_update"), (3, "missing_position"), (9, "unknown_athlete")}


def test_cursor_and_batches(spark):
    raw = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "source_account string, raw_id long")
    assert sorted(r.raw_id for r in ops.after_cursor(raw, ops.replay_cursor(raw.where("raw_id in (1, 3)"))).collect()) == [2, 4]
    log = spark.createDataFrame([("b1", "completed", 1, "x"), ("b2", "failed", 9, "x"), ("b3", "completed", 5, "x")], "batch_id string, status string, started_at int, api string")
    assert ops.last_batches(log, ["api"]).first().batch_id == "b3"


def test_pages_follow_each_other(spark):
    raw = spark.createDataFrame([(i, f"p{i}") for i in (5, 1, 9, 3)], "raw_id long, payload string")
    assert [[r.raw_id for r in ops.page_after(raw, at, 2).orderBy("raw_id").collect()] for at in (0, 3, 9)] == [[1, 3], [5, 9], []]
    with pytest.raises(Exception, match="raw_id repeats"):
        ops.page_after(raw.union(raw), 0, 4).collect()


def test_watermarks_never_go_back(spark):
    row = "source_account string, seen string"
    old = ops.watermarks(spark.createDataFrame([("a", "2026-03-01T00:00:00Z"), ("b", "2026-01-01T00:00:00Z")], row), ["source_account"], "seen")
    run = spark.createDataFrame([("a", "2026-02-01T00:00:00Z"), ("b", "2026-02-01T00:00:00Z"), ("b", "x"), (None, "2026-02-01T00:00:00Z")], row)
    got = {r.source_account: r.watermark_text[:7] for r in ops.updated_watermarks(old, run, ["source_account"], "seen").collect()}
    assert got == {"a": "2026-03", "b": "2026-02", None: "2026-02"}


def test_breakdown_and_profile_of_nothing(spark):
    timings = spark.createDataFrame([("r", "a", 1.0), ("r", "b", 3.0), ("r", "c", None), ("s", "a", 0.0)], "run string, stage string, elapsed double")
    got = {(r.run, r.stage): (r.place, r.share) for r in ops.run_breakdown(timings, "run", "stage", "elapsed").collect()}
    assert got == {("r", "b"): (1, 0.75), ("r", "a"): (2, 0.25), ("r", "c"): (3, None), ("s", "a"): (1, None)}
    none = audit.id_profile(spark.createDataFrame([(None,), (" ",)], "id string"), "id").first()
    assert (none.n_ids, none.n_uuid, none.samples) == (0, 0, [])


def test_columns_that_hold_data_are_not_dropped(spark):
    df = spark.createDataFrame([(1, None, 2)], "a int, b int, c int")
    assert audit.drop_empty(df, ["b", "zz"]).columns == ["a", "c"]
    with pytest.raises(ValueError):
        audit.drop_empty(df, ["c"])
    with pytest.raises(ValueError):
        audit.check_columns(df, ["a", "d"])
