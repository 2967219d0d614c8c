import json

import pandas
from pyspark.sql import functions as F

from orefold.functions.jsonwalk import repetition_leaves
from orefold.operators import quality, scope
from orefold.operators.fact import all_families
from orefold.plans import jobs

FACT = "test_id long, profile_id long, assessment_family string, team_group_id int, test_type string, metric_name string, side string, rep_number int, metric_value double"


def test_repetitions_jumps_and_splits(spark):
    body = [{"repIndex": 3, "reactionTime": 0.2, "jumpResults": [{"flightTime": 400}, {"jumpIndex": 7, "flightTime": 410}], "splitResults": [{"splitIndex": 1, "splitTime": 1.1, "gateIndex": 9, "additionalSplitData": {"peakVelocity": 8}}]}, {"totalWeightKg": "70"}]
    got = {(r.rep_number, r.metric_name, r.metric_value, r.metric_unit) for r in repetition_leaves(spark.createDataFrame([(1, json.dumps(body))], "test_id int, p string"), "p", "test_id").collect()}
    assert got == {(3, "reaction_time", 0.2, "s"), (3, "jump_1_flight_time", 400.0, "ms"), (3, "jump_7_flight_time", 410.0, "ms"), (3, "split_1_split_time", 1.1, "s"), (3, "split_1_peak_velocity", 8.0, None), (2, "total_weight_kg", 70.0, "kg")}


def fact(spark, values):
    rows = [(i, i, "frame", 1, "t", "max_force", None, 1, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, FACT)


def test_only_the_scope_changes(spark):
    old, new = fact(spark, range(1, 101)), fact(spark, [v + 0.25 for v in range(1, 101)])
    tests = spark.createDataFrame([(50,)], "test_id long")
    merged = jobs.refresh_fact(old, {"frame": lambda _: new}, tests=tests)
    assert merged.where("metric_value % 1 <> 0").count() == 1 and merged.count() == 100
    mart = next(m for m in jobs.MARTS if m.family == "frame")
    catalog = old.select("assessment_family", "test_type", F.lit("max_force").alias("reference_metric")).distinct()
    named = ("assessment_family", "test_type")
    full, stats = jobs.refresh_mart(old, mart, catalog, named=named)
    again, _ = jobs.refresh_mart(merged, mart, catalog, full, tests, named=named)
    assert full.count() == again.count() == 75 and stats.first().n_below == 25
    assert {r.test_id for r in again.exceptAll(full).collect()} == {50}


def test_audit_twice_is_audit_once(spark):
    f = fact(spark, [*range(100, 200), 5000, -1])
    rules = quality.rule_table(spark)
    once = jobs.audit(f, rules)
    twice = jobs.audit(f, rules, once)
    assert set(map(tuple, once.select("test_id", "flag_type", "status").collect())) == set(map(tuple, twice.select("test_id", "flag_type", "status").collect()))
    assert {(r.test_id, r.flag_type) for r in once.collect()} >= {(100, "outlier_iqr"), (101, "negative_value")}


def test_an_incremental_audit_leaves_other_rows_flags(spark):
    f = fact(spark, [*range(100, 200), 5000, 6000]).withColumn("updated_at", F.when(F.col("test_id") == 100, F.lit("2026-02-01")).otherwise("2026-01-01").cast("timestamp"))
    rules = quality.rule_table(spark)
    once = jobs.audit(f, rules)
    assert {r.severity for r in once.where("test_id in (100, 101)").collect()} == {"critical"} and all(json.loads(r.details)["value"] == r.value for r in once.collect())
    mended = f.withColumn("metric_value", F.when(F.col("test_id") == 100, 150.0).otherwise(F.col("metric_value")))
    again = jobs.audit(mended, rules, once, since="2026-01-15")
    assert {(r.test_id, r.status) for r in again.collect()} == {(100, "superseded"), (101, "open")}


def test_a_wide_table_is_audited(spark):
    ids = ["test_id", "assessment_family", "team_group_id", "test_type", "side", "rep_number"]
    wide = fact(spark, [*range(100, 200), -4]).select(*ids, F.col("metric_value").alias("max_force"), F.lit(1.0).alias("other"))
    got = jobs.audit_wide(wide, ids, ["max_force", "other"], quality.rule_table(spark))
    assert {(r.test_id, r.metric_name) for r in got.where("flag_type = 'negative_value'").collect()} == {(100, "max_force")}


def test_all_families_at_once(spark):
    f = fact(spark, range(50)).withColumn("source_module", F.lit("m")).withColumn("test_name", F.lit(None).cast("string"))
    f = all_families({m.family: f for m in jobs.MARTS})
    catalog = jobs.coverage_of(f, f.withColumn("test_date", F.lit("2026-01-01")), fixed={"m": "max_force"})
    assert {r.coverage_status for r in catalog.collect()} == {"covered"}
    got = jobs.refresh_all(f, catalog)
    assert {k: m.count() for k, (m, _) in got.items()} == dict.fromkeys((m.family for m in jobs.MARTS), 37)
    assert jobs.refresh_mart(f, jobs.MARTS[0], catalog.withColumn("reference_metric", F.lit(None).cast("string")))[0].count() == 0


def test_baselines_of_large_groups_are_the_same(spark):
    rows = [(i, i, "frame", i % 3 or None, "ab"[i % 2], "max_force", None, 1, float(i * 37 % 101)) for i in range(120)]
    f = spark.createDataFrame(rows, FACT)
    plain, ranged = (quality.baselines(f, ["assessment_family", "metric_name"], large=large).toPandas().sort_values(["grain", "team_group_id", "test_type"]).reset_index(drop=True) for large in (False, True))
    pandas.testing.assert_frame_equal(plain, ranged[plain.columns])
    assert len(plain) == 1 + 2 + 2 + 4


def dated(spark, n=60):
    f = fact(spark, range(n)).withColumn("test_date", F.expr("timestamp'2026-01-01' + make_interval(0, 0, 0, cast(test_id % 30 as int))"))
    return f.withColumn("assessment_family", F.element_at(F.array(*[F.lit(m.family) for m in jobs.MARTS]), (F.col("test_id") % 5 + 1).cast("int")))


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0


def test_full_window_and_scope_runs_agree(spark):
    rows = dated(spark)
    families = {m.family: (lambda tests, own=rows.where(F.col("assessment_family") == m.family): own if tests is None else own.join(tests, "test_id", "left_semi")) for m in jobs.MARTS}
    full = jobs.store_fact(jobs.refresh_fact(None, families))
    assert same(full, rows)
    window = ("2026-01-05", "2026-01-08")
    old = full.withColumn("metric_value", F.when(F.col("test_date").between("2026-01-05", "2026-01-07 23:59:59"), -1.0).otherwise(F.col("metric_value")))
    old = old.unionByName(old.where("test_id = 4").withColumn("test_id", F.lit(1000).cast("long")))  # a row of that window that doesn't come again
    again = jobs.refresh_fact(old, families, window=window)
    assert same(again, rows) and not same(old, rows)
    tests = old.where("metric_value = -1").select("test_id")
    assert same(jobs.refresh_fact(old.where("test_id < 1000"), families, tests=tests), rows)


def test_a_replay_makes_what_it_touches(spark):
    rows = dated(spark)
    families = {m.family: (lambda tests, own=rows.where(F.col("assessment_family") == m.family): own.join(tests, "test_id", "left_semi")) for m in jobs.MARTS}
    raw = rows.select(F.col("test_id").alias("raw_id"), F.concat(F.lit("b"), F.col("test_id") % 3).alias("batch_id"), F.lit(None).cast("string").alias("source_account"), F.col("test_date").alias("ingested_at"))
    typed = {m.family: [rows.where(F.col("assessment_family") == m.family).select(F.col("test_id").alias("raw_id"), "test_id")] for m in jobs.MARTS}
    old = rows.withColumn("metric_value", F.lit(-1.0))
    batches = spark.createDataFrame([("b1",), ("zz",)], "batch_id string")
    done = jobs.replay(scope.Selection(batches=batches), raw, typed, families, old)
    assert done.ran and {r.test_id for r in done.tests.collect()} == set(range(1, 60, 3)) == {r.test_id for r in done.fact.where("metric_value >= 0").collect()}
    cursor = spark.createDataFrame([(None, 50)], "source_account string, last_raw_id long")
    assert {r.raw_id for r in scope.Selection(cursor=cursor, window=("2026-01-21", "2026-01-25")).raw(raw).collect()} == {51, 52, 53}
    assert scope.Selection().raw(raw).count() == 60
    none = jobs.replay(scope.Selection(batches=batches.where("batch_id = 'zz'")), raw, typed, families, old)
    assert not none.ran and same(none.fact, old)


def test_a_family_reads_its_own_folder(spark):
    rows = dated(spark)
    labelled = jobs.label_all(jobs.store_fact(rows))
    own = labelled.where("assessment_family = 'gates'")
    assert "PartitionFilters: [isnotnull(assessment_family" in own._jdf.queryExecution().executedPlan().toString()
    assert own.count() == 12 and labelled.count() == 60
    assert next(m.keys for m in jobs.MARTS if m.family == "gates") == ("test_id", "metric_name", "rep_number")


def test_left_against_right_of_a_wide_table(spark):
    ids = ["test_id", "assessment_family", "team_group_id", "test_type", "side", "rep_number"]
    wide = fact(spark, range(100, 130)).select(*ids, F.col("metric_value").alias("left_max"), F.when(F.col("test_id") == 0, 80.0).when(F.col("test_id") == 1, 3.0).when(F.col("test_id") > 2, F.col("metric_value")).alias("right_max"))
    rules = quality.rule_table(spark, {"frame": [("left_max", None, None), ("right_max", None, 120)]})
    got = jobs.audit_wide(wide, ids, ["left_max", "right_max"], rules, pairs=[quality.Pair("max", "left_max", "right_max", least=5)])
    pairs = {(r.test_id, r.metric_name, r.value, r.severity) for r in got.where("flag_type = 'asymmetry_extreme'").collect()}
    assert pairs == {(0, "max", 20.0, "warning")}
    assert json.loads(got.where("flag_type = 'asymmetry_extreme'").first().details) == {"left_value": 100.0, "right_value": 80.0, "asymmetry_pct": 20.0}
    assert {r.test_id for r in got.where("flag_type = 'range_violation'").collect()} == set(range(21, 30))
