"""What keeps a query's work in step with its input: reads, shuffles and expressions of its plan."""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from orefold.functions import jsonwalk
from orefold.functions import scalars as S
from orefold.operators import audit, fact, marts, quality, scope
from orefold.plans import driver as D
from orefold.plans import flows, jobs, queries, shapes  # noqa: F401  # register their queries
from orefold.sources import payloads


def plan(df, part="executedPlan"):
    return getattr(df._jdf.queryExecution(), part)().toString()


def test_a_cohort_without_values_stays_in_large_thresholds(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, metric_value double")
    for large in (True, False):
        got = {r.k: (r.n_rows, r.p25) for r in marts.thresholds(rows, cohort=["k"], large=large).collect()}
        assert got == {"a": (2, 1.5), "b": (0, None)}


def test_percentiles_read_their_input_once(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    seen = spark.sparkContext.accumulator(0)
    once = df.rdd.map(lambda r: (seen.add(1), tuple(r))[1]).toDF("k long, v double")
    got = marts.exact_percentiles(once, ["k"], "v", [0.5]).collect()
    assert {r.k: r.p0 for r in got} == {0: 499.5, 1: 499.0, 2: 500.0} and seen.value == 1000


def test_json_of_a_flag_is_left_out_where_nobody_reads_it(spark):
    b = "named_struct('p25_value', 1d, 'median_value', 2d, 'p75_value', 3d, 'mad_value', 1d, 'sample_count', 20L)"
    rows = spark.sql(f"select 99d as metric_value, true as non_negative, 0d as abs_min, 50d as abs_max, 2d as fence, 2.5d as z_warning, 3.5d as z_critical, {b} as b from range(2)")
    flags = quality.flags(rows)
    assert {r.flag_type for r in flags.collect()} == {"range_violation", "outlier_modified_zscore", "outlier_iqr"}
    assert "to_json" not in plan(flags.select("flag_type"), "optimizedPlan").lower().replace("structstojson", "to_json")


def test_lines_are_shuffled_once_by_order(spark, data):
    assert plan(D.lines(spark, data).groupBy("l_orderkey").count()).count("Exchange hashpartitioning") == 1


def test_pairs_are_read_once_a_side(spark):
    e, a = spark.range(4).withColumnRenamed("id", "k"), spark.range(2, 6).withColumnRenamed("id", "k")
    got = audit.pair_coverage(e, a, ["k"])
    assert {(r.k, r.status) for r in got.collect()} == {(0, "missing"), (1, "missing"), (4, "extra"), (5, "extra")}
    assert plan(audit.pair_coverage(e, a, ["k"]), "optimizedPlan").count("Range (") == 2


def test_a_scope_meets_raw_rows_unsorted(spark):
    rows = spark.range(6).select(F.col("id").alias("raw_id"), (F.col("id") * 10).alias("test_id"))
    got = scope.Selection().tests(rows.where("raw_id < 4"), {"a": [rows, rows], "b": [rows.where("raw_id > 2")]})
    assert {(r.family, r.test_id) for r in got.collect()} == {("a", 0), ("a", 10), ("a", 20), ("a", 30), ("b", 30)}
    assert "ShuffledHashJoin" in plan(got) and "SortMergeJoin" not in plan(got)


def test_a_payloads_fields_are_taken_out_once(spark):
    raw = spark.sql("""select 1L as raw_id, '{}' as request_params, '[{"id": "7", "attributes": [{"attributeTypeId": "x", "attributeValueId": 5}]}]' as response_payload from range(1)""")
    got = payloads.flatten(raw, "profile_categories").select("profile_id", "category_id", "group_id")
    assert [tuple(r) for r in got.collect()] == [("7", "x", "5")]
    assert plan(got, "optimizedPlan").lower().count("variant_get") <= 20


def test_texts_of_an_item_are_taken_out_in_one_pass(spark):
    """Two dozen names with or without a value, some of them alike but for their case."""
    raw = spark.sql("""select 1L as raw_id, '{"tenantId": "t"}' as request_params, '{"items": [{"testId": 7, "hubAthleteId": "p", "testDateUTC": "2024-01-02T00:00:00Z", "innerLeftMaxForce": 2.5}, 4, {"id": "8"}]}' as response_payload from range(1)""")
    got = payloads.flatten(raw, "frame_tests")
    assert {(r.test_id, r.profile_id, r.tenant_id, str(r.test_date), r.inner_left_max_force) for r in got.collect()} == {("7", "p", "t", "2024-01-02 00:00:00", 2.5), ("8", None, "t", "None", None)}
    assert plan(got, "optimizedPlan").lower().count("variant_get") <= 8


def test_raw_rows_stay_dealt_among_tasks(spark):
    assert queries.dealt(spark.range(2000)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_rows_of_two_accounts_are_read_once(spark, data):
    assert plan(queries.QUERIES["payload_tracking"](spark, data)).count("FileScan parquet") == 9


def test_baselines_shuffle_counts_and_few_values(spark):
    """40,000 different values: what is left to look at is a small part of them, and the figures are those of all values."""
    f = spark.range(40_000).select(F.lit("m").alias("metric_name"), (F.col("id") % 2).cast("int").alias("team_group_id"), F.lit("t").alias("test_type"), (F.pow(F.col("id") - 9000, 2) / 7e3 - 50).alias("metric_value"))
    seen = []
    whole, quality.stored = quality.stored, lambda df, name, *by: seen.append((name, whole(df, name, *by))) or seen[-1][1]
    try:
        got = {(r.grain, r.team_group_id): r for r in quality.baselines(f, ["metric_name"]).collect()}
    finally:
        quality.stored = whole
    assert max(df.count() for name, df in seen if name == "counted") < 20_000
    for (grain, team), r in got.items():
        values = sorted(x.metric_value for x in (f if grain < 2 else f.where(F.col("team_group_id") == team)).collect())
        want = f if grain < 2 else f.where(F.col("team_group_id") == team)
        q = want.agg(F.percentile("metric_value", [0.25, 0.5, 0.75]).alias("q"), F.stddev_pop("metric_value").alias("sd")).first()
        mad = want.agg(F.percentile(F.abs(F.col("metric_value") - q.q[1]), 0.5).alias("d")).first().d
        assert (r.sample_count, r.min_value, r.max_value) == (len(values), values[0], values[-1])
        assert [r.p25_value, r.median_value, r.p75_value] == q.q and r.mad_value == mad and abs(r.sd_value - q.sd) < 1e-9 * q.sd
    assert len(got) == 6


def test_buckets_keep_the_order_of_values(spark):
    values = [float("-inf"), -1e300, -7.0, -1e-300, 0.0, 5e-324, 0.01, 0.0101, 7.0, 1e300, float("inf"), float("nan")]
    got = [r.b for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(quality.bucket(F.col("v")).alias("b")).collect()]
    assert got == sorted(got) and got[4] == 0 and len(set(got)) == len(got)


def test_a_fact_reads_doubles_without_text(spark):
    rows = spark.sql("select 'maxForce' as metric_name, 'Left Side' as side, timestamp '2024-01-01' as test_date, explode(array(1.5d, double('NaN'), double('-Infinity'), 0.1d, null)) as metric_value")
    got = fact.normalised(rows)
    assert [(r.metric_name, r.side, r.metric_value) for r in got.collect()] == [("max_force", "left", 1.5), ("max_force", "left", 0.1)]
    assert "cast(metric_value" not in plan(got, "optimizedPlan").lower()


def test_plain_names_are_not_rewritten(spark):
    names = ["max_force", "a", "a1_b2", "_a", "a_", "a__b", "maxForce", "RFDAt100", "left_max", "inner_left_x", "x_left_y", "left_", "cleft_a", "bright_x", "", "_", "a b", "a-b", "a\n", "left_a\nb", "right_\n"]
    rows = spark.createDataFrame([(n,) for n in [*names, None]], "n string")
    n = F.col("n")
    full = F.regexp_replace(F.regexp_replace(S.camel_to_snake(n), "_+", "_"), "^_|_$", "")
    side = F.nullif(F.regexp_extract(n, S.SIDE_PREFIX, 1), F.lit(""))
    bare = F.when(n.rlike(S.SIDE_PREFIX), F.regexp_extract(n, S.SIDE_PREFIX, 2)).otherwise(n)
    pairs = [(S.metric_name(n), full), (S.side_of_name(n), side), (S.name_without_side(n), bare)]
    assert rows.where(~reduce(and_, [a.eqNullSafe(b) for a, b in pairs])).collect() == []
    assert "rlike" in plan(rows.select(S.metric_name(n)), "optimizedPlan").lower()


def largest_method(spark, df):
    """Bytes of the largest method of a plan's generated code; beyond 8,000 the JVM leaves it uncompiled."""
    debug = getattr(getattr(spark._jvm, "org.apache.spark.sql.execution.debug.package$"), "MODULE$")
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        seq = debug.codegenStringSeq(df.select("*")._jdf.queryExecution().executedPlan())
        return max(seq.apply(i)._3().maxMethodCodeSize() for i in range(seq.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


RAW = "'acc' as source_account, '{\"k\": 1}' as request_params"


def test_readings_are_shuffled_with_hashes_as_bytes(spark, data):
    raw = spark.sql(f"""select explode(array(1L, 2L)) as raw_id, {RAW}, '[{{"entity_id": 7, "entity_type": "x", "tag": {{"id": 9}}}}]' as response_payload""")
    got = payloads.entity_tags(raw)
    want = spark.range(1).select(S.record_hash(F.lit("acc"), F.lit("x"), F.lit("7"), F.lit("9")).alias("h")).first().h
    assert [(r.raw_id, r.record_hash) for r in got.collect()] == [(2, want)]
    assert "unhex(sha2" in plan(got, "optimizedPlan").lower()
    assert "hex(record_hash" not in plan(got.select("entity_id"), "optimizedPlan").lower().replace("unhex", "")
    assert plan(queries.QUERIES["payload_readings"](spark, data)).count("FileScan parquet") == 7  # 18 when raw rows that come twice and kinds of efforts were read apart


def test_methods_of_payloads_are_compiled(spark, data):
    for name in ("payload_readings", "payload_stats", "payload_tests"):
        assert largest_method(spark, queries.QUERIES[name](spark, data)) < 8000, name


def test_rejected_statistics_are_not_read_where_nobody_asks(spark):
    raw = spark.sql(f"""select 1L as raw_id, {RAW}, '[{{"activity_id": "5", "athlete_id_id": "6", "n": "1"}}, {{"activity_id": "0", "athlete_id": "6"}}, {{"activity_id": "5", "athlete_id": "true"}}, {{}}]' as response_payload""")
    none = spark.createDataFrame([], "source_account string, activity_id string, period_id string, start_time timestamp, end_time timestamp")
    got = payloads.stats(raw, none, none)
    assert sorted((r.reject_reason or "", r.activity_id or "", r.athlete_id or "") for r in got.collect()) == [("", "5", "6"), ("missing activity_id", "", ""), ("missing activity_id", "", "6"), ("missing athlete_id", "5", "")]
    assert plan(got, "optimizedPlan").count("Generate posexplode") == 2
    assert plan(got.where("reject_reason is null"), "optimizedPlan").count("Generate posexplode") == 1


def test_a_field_of_the_request_is_found_with_one_column_read(spark):
    """Columns that an explode takes from outside, of which a reader wants one."""
    raw = spark.sql("""select 1L as raw_id, 'acc' as source_account, '{"athlete_id": 3, "activity_id": 4}' as request_params, '[{"data": [{"ts": 100, "lat": 1.5}, {"ts": 101}]}]' as response_payload from range(1)""")
    rows = payloads.rows_of(raw, "sensor")
    assert [r.activity_id for r in rows.select("activity_id").collect()] == ["4", "4"]
    assert [r.pos for r in rows.select("pos", "latitude").orderBy("pos").collect()] == [0, 1]
    assert rows.count() == 2


def test_leaves_are_made_once_and_their_methods_are_compiled(spark, data):
    assert largest_method(spark, queries.QUERIES["dynamometer_fact"](spark, data)) < 8000
    texts = ['{"a": 1, "b": {"c": "2.5", "dId": 3, "e": [4, null, "x", [5]]}, "f": true, "g": null, "h": "[7]", "i": "8"}', "[1, {\"j\": 2}]", "7", '"{"', "", None, '{"k": 1e400, "l": 12345678901234567890123, "m": 0.10}']
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, p string")
    got = jsonwalk.all_leaves(rows, "p", "id")
    want = [(0, "a", 1.0, [0]), (0, "b_c", 2.5, [1, 0]), (0, "b_e_1", 4.0, [1, 2, 0]), (0, "b_e_4_1", 5.0, [1, 2, 3, 0]), (0, "i", 8.0, [5]), (1, "1", 1.0, [0]), (1, "2_j", 2.0, [1, 0])]
    assert sorted(tuple(r) for r in got.collect()) == [*want, (6, "l", 12345678901234567890123.0, [1]), (6, "m", 0.1, [2])]
    assert {r.d for r in rows.where("id < 2").select(jsonwalk.depth_of(F.col("p")).alias("d")).collect()} == {4, 2}
    filtered = plan(got.where("metric_value > 1 and metric_name <> 'a'"), "optimizedPlan")
    assert filtered.count("try_variant_get(__v") <= 1 and filtered.count("array_position") <= 4


def test_an_audit_shuffles_no_rows_to_meet_rules_or_flags_that_are_gone(spark):
    rules = spark.createDataFrame([("a", "m", True, None, 50.0, 2.0, 2.5, 3.5)], "assessment_family string, metric_name string, non_negative boolean, abs_min double, abs_max double, fence double, z_warning double, z_critical double")
    f = spark.range(40).select(F.lit("a").alias("assessment_family"), F.when(F.col("id") < 30, "m").otherwise("free").alias("metric_name"), F.lit(1).alias("team_group_id"), F.lit("t").alias("test_type"), F.col("id").alias("test_id"), F.lit(None).cast("string").alias("side"), F.lit(1).alias("rep_number"), F.when(F.col("id") < 3, 99.0).otherwise(F.col("id") % 7).cast("double").alias("metric_value"))
    made = []
    whole, quality.stored = quality.stored, lambda df, name, *by: made.append((name, whole(df, name, *by))) or made[-1][1]
    try:
        first = jobs.audit(f, rules, at_rest=True)
        old = whole(first, "flags").where("flag_type = 'range_violation'")
        mended = f.where("test_id <> 1").withColumn("metric_value", F.when(F.col("test_id") == 0, 1.0).otherwise(F.col("metric_value")))  # one row is gone, one is mended
        again = jobs.audit(mended, rules, old, at_rest=True).where("flag_type = 'range_violation'")
    finally:
        quality.stored = whole
    assert {(r.test_id, r.status) for r in again.collect()} == {(0, "superseded"), (1, "open"), (2, "open")}
    assert "values" not in [name for name, _ in made] and {r.metric_name for name, df in made if name == "cells" for r in df.collect()} == {"m"}
    assert [df.count() for name, df in made if name == "gone"] == [2]
    assert "Exchange hashpartitioning(assessment_family" not in plan(first) and "SortMergeJoin" not in plan(first)
