"""Queries over the driver's tables, each with an equal SQL text where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonwalk
from ..functions import scalars as S
from ..operators import audit, coverage, dims, fact, marts, merge, ops, quality, scope
from ..sources import landing, payloads
from ..sources.stored import fresh, stored
from . import driver as D
from . import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return D.table(spark, sf, name)


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` dealt by their first column: reading JSON takes long for its bytes, so a table of few files would leave it to few tasks. Their number is given,
    as for the rows' few bytes they would be put together again."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, rows.columns[0])


def r6(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


# thresholds, labels and marts

COHORT_OUT = "assessment_family, team_group_id, test_type, metric_name, side"


@query(f"WITH {D.limits_sql(1.2)} SELECT {COHORT_OUT}, n_rows, round(p99, 6) AS p99, round(p25, 6) AS p25, round(upper_limit, 6) AS upper_limit FROM limits")
def cohort_thresholds(spark, sf):
    return marts.thresholds(stored(D.fact(spark, sf), "fact")).select(*marts.COHORT, "n_rows", *r6("p99", "p25", "upper_limit"))


@query(f"WITH {D.limits_sql(1.2)} SELECT {COHORT_OUT}, n_rows, round(p99, 6) AS p99, round(p25, 6) AS p25 FROM limits")
def cohort_thresholds_by_ranges(spark, sf):
    """The same limits by the method for cohorts of any size."""
    return marts.thresholds(D.fact(spark, sf), large=True).select(*marts.COHORT, "n_rows", *r6("p99", "p25"))


def _labelled(spark, sf, factor):
    f = stored(D.fact(spark, sf), "fact")
    return f, jobs.label_all(f, factor=factor)


@query(f"WITH {D.limits_sql(1.0)} SELECT test_id, side, rep_number, metric_name, is_above, is_below FROM labelled WHERE is_above OR is_below")
def threshold_labels(spark, sf):
    return _labelled(spark, sf, 1.0)[1].where("is_above or is_below").select("test_id", "side", "rep_number", "metric_name", "is_above", "is_below")


@query(f"""WITH {D.limits_sql(1.2)} SELECT assessment_family, metric_name, count(*) AS n_rows, count(*) FILTER (is_above) AS n_above,
count(*) FILTER (is_below) AS n_below, count(*) FILTER (is_above OR is_below) AS n_outside FROM labelled GROUP BY ALL""")
def threshold_stats(spark, sf):
    return marts.stats(_labelled(spark, sf, 1.2)[1], ["assessment_family", "metric_name"])


MART = "test_id, side, rep_number, metric_name, metric_value"
TEST_NAMED = ("assessment_family", "test_type")
#: Reference metrics by test name, here the order's priority; one has none. Line 7 stands for a row without a repetition.
_METRICS = {"1-URGENT": "quantity", "2-HIGH": "extendedprice", "3-MEDIUM": "extendedprice", "4-NOT SPECIFIED": "tax"}
_MARTS_SQL = D.limits_sql(1.0) + f""",
source AS (SELECT * REPLACE (nullif(rep_number, 7) AS rep_number) FROM labelled),
catalog AS (SELECT DISTINCT assessment_family, test_type, CASE test_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _METRICS.items())} END AS reference FROM fact),
kept AS MATERIALIZED (SELECT * FROM source WHERE NOT is_above AND NOT is_below),
cand AS MATERIALIZED (SELECT s.* FROM kept s JOIN catalog c ON c.assessment_family = s.assessment_family AND c.test_type IS NOT DISTINCT FROM s.test_type AND c.reference = s.metric_name)"""


def _mart(select, spark, sf, **how):
    f, labelled = _labelled(spark, sf, 1.0)
    keys = list(TEST_NAMED)
    catalog = coverage.reference_metrics(coverage.metric_candidates(f, keys), keys, module="test_type", fixed=_METRICS)
    return select(labelled.withColumn("rep_number", F.nullif("rep_number", F.lit(7))), catalog, named=TEST_NAMED, **how).select(*MART.split(", "))


@query(f"WITH {_MARTS_SQL} SELECT {MART} FROM kept WHERE test_id IN (SELECT test_id FROM cand)")
def mart_simple(spark, sf):
    return _mart(marts.mart_simple, spark, sf)


@query(f"WITH {_MARTS_SQL} SELECT {MART} FROM kept f WHERE EXISTS (SELECT 1 FROM cand i WHERE i.test_id = f.test_id AND i.side IS NOT DISTINCT FROM f.side)")
def mart_side(spark, sf):
    return _mart(marts.mart_by_side, spark, sf)


@query(f"""WITH {_MARTS_SQL}, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY metric_value NULLS LAST, rep_number, side NULLS LAST) AS n FROM cand WHERE rep_number IS NOT NULL) WHERE n = 1)
SELECT {MART} FROM kept f WHERE EXISTS (SELECT 1 FROM best b WHERE b.test_id = f.test_id AND b.rep_number = f.rep_number)""")
def mart_min_rep(spark, sf):
    return _mart(marts.mart_least_rep, spark, sf, tie=["side"])


@query(f"""WITH {_MARTS_SQL}, mode AS (SELECT test_id, bool_or(coalesce(side IN ('left', 'right'), false)) AS has FROM cand WHERE rep_number IS NOT NULL GROUP BY 1),
best AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.test_id, c.side ORDER BY metric_value DESC NULLS LAST, rep_number) AS n FROM cand c JOIN mode m ON c.test_id = m.test_id
  WHERE rep_number IS NOT NULL AND (NOT has OR coalesce(side IN ('left', 'right'), false))) WHERE n = 1)
SELECT {MART} FROM kept f WHERE EXISTS (SELECT 1 FROM best b WHERE b.test_id = f.test_id AND b.side IS NOT DISTINCT FROM f.side AND b.rep_number = f.rep_number)""")
def mart_max_rep_side(spark, sf):
    return _mart(marts.mart_greatest_rep_by_side, spark, sf, tie=[])


# the fact


@query(f"WITH {D.FACT_SQL} SELECT test_id, rep_number, metric_name, metric_value FROM fact")
def metric_unpivot(spark, sf):
    return D.fact(spark, sf).select("test_id", "rep_number", "metric_name", "metric_value")


@query("""SELECT l_orderkey AS test_id, l_partkey AS trial_id, l_returnflag AS side, CAST(CASE WHEN l_partkey IS NULL THEN l_linenumber + 1
 ELSE dense_rank() OVER (PARTITION BY l_orderkey, coalesce(l_returnflag, '__unsided__') ORDER BY l_shipdate NULLS LAST, l_partkey NULLS LAST) END AS BIGINT) AS rep_number FROM lineitem""")
def rep_dense_rank(spark, sf):
    rows = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("test_id"), F.col("l_partkey").alias("trial_id"), F.col("l_returnflag").alias("side"), F.col("l_shipdate").alias("test_date"), F.col("l_linenumber").alias("repeat"))
    return fact.rep_numbers(rows).select("test_id", "trial_id", "side", F.col("rep_number").cast("long").alias("rep_number"))


@query(f"""WITH {D.WIDE_SQL} SELECT test_id, rep_number, md5(concat_ws('|', CAST(profile_id AS VARCHAR), CAST(team_group_id AS VARCHAR), CAST(test_id AS VARCHAR), assessment_family, 'erp', 'extendedprice',
coalesce(side, ''), CAST(rep_number AS VARCHAR), regexp_replace(regexp_replace(CAST(CAST(extendedprice AS DECIMAL(18, 4)) AS VARCHAR), '0+$', ''), '\\.$', ''), 'line ' || CAST(rep_number AS VARCHAR))) AS metric_row_key FROM wide""")
def fact_dedup(spark, sf):
    rows = D.wide(spark, sf).withColumns({"source_module": F.lit("erp"), "metric_name": F.lit("extendedprice"), "metric_value": F.col("extendedprice").cast("decimal(18,4)"), "row_hint": F.concat(F.lit("line "), F.col("rep_number").cast("string"))})
    return fact.with_row_key(rows).select("test_id", "rep_number", "metric_row_key")


@query("""WITH e AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, CASE WHEN event_id % 3 = 0 THEN event_id % 50 END AS tick FROM events),
g AS (SELECT *, last_value(tick IGNORE NULLS) OVER w AS t, last_value(CASE WHEN tick IS NOT NULL THEN pos END IGNORE NULLS) OVER w AS p FROM e WINDOW w AS (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING))
SELECT event_id, CAST(coalesce(t + pos - p, pos) AS BIGINT) AS filled_tick FROM g""")
def tick_gap_fill(spark, sf):
    from pyspark.sql import Window

    e = t(spark, sf, "events")
    pos = (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).alias("pos")
    rows = e.select("event_id", "user_id", pos, F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 50).alias("tick"))
    return fact.fill_ticks(rows, "user_id", "pos", "tick").select("event_id", F.col("filled_tick").cast("long").alias("filled_tick"))


# quality

_STATS = "count(*) AS sample_count, round(avg(metric_value), 6) AS mean_value, round(stddev_pop(metric_value), 4) AS sd_value, round(quantile_cont(metric_value, 0.25), 6) AS p25_value, round(median(metric_value), 6) AS median_value, round(quantile_cont(metric_value, 0.75), 6) AS p75_value, min(metric_value) AS min_value, max(metric_value) AS max_value"


@query(f"WITH {D.FACT_SQL} SELECT assessment_family, metric_name, {_STATS} FROM fact GROUP BY 1, 2 HAVING count(*) >= 10")
def baseline_stats(spark, sf):
    b = quality.baselines(D.fact(spark, sf), ["assessment_family", "metric_name"]).where("grain = 0")
    return b.select("assessment_family", "metric_name", "sample_count", *r6("mean_value"), F.round("sd_value", 4).alias("sd_value"), *r6("p25_value", "median_value", "p75_value"), "min_value", "max_value")


GRAINS_SQL = f"""{D.FACT_SQL}, grains AS MATERIALIZED (
  SELECT assessment_family, metric_name, team_group_id, test_type, CAST(2 * (1 - grouping(team_group_id)) + (1 - grouping(test_type)) AS INTEGER) AS grain, count(*) AS sample_count,
    quantile_cont(metric_value, 0.25) AS p25_value, median(metric_value) AS median_value, quantile_cont(metric_value, 0.75) AS p75_value FROM fact
  GROUP BY GROUPING SETS ((assessment_family, metric_name), (assessment_family, metric_name, test_type), (assessment_family, metric_name, team_group_id), (assessment_family, metric_name, team_group_id, test_type))
  HAVING count(*) >= 10),
mads AS MATERIALIZED (SELECT g.assessment_family, g.metric_name, g.team_group_id, g.test_type, g.grain, median(abs(f.metric_value - g.median_value)) AS mad_value FROM grains g JOIN fact f
  ON f.assessment_family = g.assessment_family AND f.metric_name = g.metric_name AND (g.grain < 2 OR f.team_group_id = g.team_group_id) AND (g.grain % 2 = 0 OR f.test_type = g.test_type) GROUP BY ALL)"""
KEYS = ["assessment_family", "metric_name"]


@query(f"WITH {GRAINS_SQL} SELECT assessment_family, metric_name, CAST(team_group_id AS VARCHAR) AS team_group_id, test_type, grain, sample_count, round(p25_value, 6) AS p25_value, round(median_value, 6) AS median_value, round(p75_value, 6) AS p75_value FROM grains")
def baseline_grains(spark, sf):
    b = quality.baselines(D.fact(spark, sf), KEYS)
    return b.select(*KEYS, F.col("team_group_id").cast("string").alias("team_group_id"), "test_type", F.col("grain").cast("int").alias("grain"), "sample_count", *r6("p25_value", "median_value", "p75_value"))


@query(f"WITH {GRAINS_SQL} SELECT assessment_family, metric_name, CAST(team_group_id AS VARCHAR) AS team_group_id, test_type, grain, round(mad_value, 6) AS mad_value FROM mads")
def baseline_mad(spark, sf):
    b = quality.baselines(D.fact(spark, sf), KEYS)
    return b.select(*KEYS, F.col("team_group_id").cast("string").alias("team_group_id"), "test_type", F.col("grain").cast("int").alias("grain"), *r6("mad_value"))


def _flags(spark, sf):
    f = stored(D.fact(spark, sf), "fact")
    b = quality.with_baseline(f, stored(quality.baselines(f, KEYS, at_rest=True), "baselines"), KEYS)
    ruled = b.select("*", F.lit(True).alias("non_negative"), F.lit(0.0).alias("abs_min"), F.when(F.col("metric_name") == "quantity", 49.0).alias("abs_max"), F.lit(0.5).alias("fence"), F.lit(1.2).alias("z_warning"), F.lit(1.4).alias("z_critical"))
    return quality.flags(ruled)


FLAGS_SQL = f"""{GRAINS_SQL}, base AS (SELECT g.*, m.mad_value FROM grains g JOIN mads m ON g.assessment_family = m.assessment_family AND g.metric_name = m.metric_name AND g.grain = m.grain
  AND g.team_group_id IS NOT DISTINCT FROM m.team_group_id AND g.test_type IS NOT DISTINCT FROM m.test_type),
picked AS MATERIALIZED (SELECT f.*, b.median_value, b.mad_value, round(b.p25_value - (b.p75_value - b.p25_value) * 0.5, 9) AS low, round(b.p75_value + (b.p75_value - b.p25_value) * 0.5, 9) AS high FROM fact f JOIN base b
  ON f.assessment_family = b.assessment_family AND f.metric_name = b.metric_name AND (b.grain < 2 OR f.team_group_id = b.team_group_id) AND (b.grain % 2 = 0 OR f.test_type = b.test_type)
  QUALIFY row_number() OVER (PARTITION BY f.test_id, f.rep_number, f.metric_name ORDER BY b.grain DESC) = 1),
flagged AS (
  SELECT *, 'range_violation' AS flag_type, 'critical' AS severity FROM picked WHERE metric_value < 0 OR (metric_name = 'quantity' AND metric_value > 49)
  UNION ALL SELECT *, 'outlier_modified_zscore', CASE WHEN abs(0.6745 * (metric_value - median_value) / mad_value) >= 1.4 THEN 'critical' ELSE 'warning' END FROM picked
    WHERE mad_value >= 1.0 AND abs(0.6745 * (metric_value - median_value) / mad_value) >= 1.2
  UNION ALL SELECT *, 'outlier_iqr', CASE WHEN metric_value < round(low - (high - low), 9) OR metric_value > round(high + (high - low), 9) THEN 'critical' ELSE 'warning' END FROM picked WHERE metric_value < low OR metric_value > high)"""


@query(f"WITH {FLAGS_SQL} SELECT test_id, rep_number, metric_name, flag_type, severity FROM flagged")
def outlier_flags(spark, sf):
    return _flags(spark, sf).select("test_id", "rep_number", "metric_name", "flag_type", "severity")


@query(f"WITH {FLAGS_SQL} SELECT severity, flag_type, count(*) AS n_flags FROM flagged GROUP BY ALL")
def outlier_summary(spark, sf):
    return _flags(spark, sf).groupBy("severity", "flag_type").agg(F.count("*").alias("n_flags"))


@query(f"""WITH {D.FACT_SQL}, s AS (SELECT test_id, metric_name, max(CASE WHEN side = 'left' THEN metric_value END) AS l, max(CASE WHEN side = 'right' THEN metric_value END) AS r FROM fact GROUP BY ALL),
a AS (SELECT *, CASE WHEN greatest(abs(l), abs(r)) = 0 THEN 0 ELSE abs(l - r) / greatest(abs(l), abs(r)) * 100 END AS pct FROM s WHERE l IS NOT NULL AND r IS NOT NULL AND abs(l) >= 0.01 AND abs(r) >= 0.01)
SELECT test_id, metric_name, round(pct, 6) AS asymmetry_pct, CASE WHEN pct >= 25 THEN 'critical' ELSE 'warning' END AS severity FROM a WHERE pct >= 15""")
def asymmetry_flags(spark, sf):
    rows = quality.asymmetry_flags(D.fact(spark, sf), ["test_id", "metric_name"], least=0.01)
    return rows.select("test_id", "metric_name", *r6("asymmetry_pct"), "severity")


# scope and dimensions


@query("""SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' OR o_custkey IN
(SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1 HAVING count(DISTINCT o_orderkey) >= 5)""")
def min_tests_gate(spark, sf):
    return scope.min_tests(t(spark, sf, "orders"), "o_custkey", "o_orderkey", "o_orderdate", since="1996-01-01", least=5).select("o_orderkey")


def _members(spark, sf):
    e = t(spark, sf, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("raw_id"))
    assigned = e.select(F.col("user_id").alias("profile_id"), F.col("event_type").alias("group_id"), (F.col("user_id") % 3).alias("category_id"), "raw_id")
    kinds = t(spark, sf, "events").select(F.col("event_type").alias("group_id")).distinct()
    targets = kinds.withColumn("category_id", F.explode(F.expr("array(0L, 1L)"))).withColumn("priority", F.ascii("group_id") % 7)
    return dims.membership(assigned, targets)


MEMBERS_SQL = """a AS (SELECT user_id AS profile_id, event_type AS group_id, user_id % 3 AS category_id, min(event_id) AS raw_id FROM events GROUP BY ALL),
m AS (SELECT *, ascii(group_id) % 7 AS priority, count(*) OVER (PARTITION BY profile_id) > 1 AS is_ambiguous,
  row_number() OVER (PARTITION BY profile_id ORDER BY ascii(group_id) % 7, raw_id, group_id) = 1 AS include_in_gold FROM a WHERE category_id IN (0, 1))"""


@query(f"WITH {MEMBERS_SQL} SELECT profile_id, group_id FROM m WHERE include_in_gold")
def membership_primary(spark, sf):
    return _members(spark, sf).where("include_in_gold").select("profile_id", "group_id")


@query(f"WITH {MEMBERS_SQL} SELECT count(*) AS n_rows, count(DISTINCT profile_id) AS n_profiles, count(*) FILTER (include_in_gold) AS n_included, count(DISTINCT profile_id) FILTER (is_ambiguous) AS n_ambiguous FROM m")
def membership_ambiguity(spark, sf):
    return dims.membership_summary(_members(spark, sf))


@query("SELECT CAST(n_nationkey AS BIGINT) AS group_id FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000)")
def membership_unmatched(spark, sf):
    """Nations are target groups, customers with high balances their members."""
    n = t(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("group_id"), F.lit(0).alias("category_id"), F.col("n_nationkey").alias("priority"))
    c = t(spark, sf, "customer").where("c_acctbal > 9000")
    assigned = c.select(F.col("c_custkey").alias("profile_id"), F.col("c_nationkey").cast("bigint").alias("group_id"), F.lit(0).alias("category_id"), F.col("c_custkey").alias("raw_id"))
    return dims.unmatched_targets(dims.membership(assigned, n), n)


@query(f"WITH {MEMBERS_SQL} SELECT c_custkey AS profile_id, c_name AS full_name, group_id FROM customer JOIN m ON c_custkey = profile_id WHERE include_in_gold")
def profile_scope(spark, sf):
    m = _members(spark, sf).withColumn("tenant_id", F.lit("t"))
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("profile_id"), F.lit("t").alias("tenant_id"), F.col("c_name").alias("given_name"), F.lit(None).cast("string").alias("family_name"))
    return dims.scoped_profiles(c, m).select("profile_id", "full_name", "group_id")


@query(f"""WITH {MEMBERS_SQL} SELECT c_custkey AS profile_id, c_acctbal > 0 AND c_custkey IN (SELECT profile_id FROM m WHERE include_in_gold) AS is_active,
CASE WHEN c_acctbal > 0 AND c_custkey NOT IN (SELECT profile_id FROM m WHERE include_in_gold) THEN '2026-01-01' END AS deactivated_on FROM customer""")
def profile_soft_delete(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("profile_id"), (F.col("c_acctbal") > 0).alias("is_active"), F.lit(None).cast("string").alias("deactivated_at"))
    return dims.soft_delete(c, _members(spark, sf), F.lit("2026-01-01")).select("profile_id", "is_active", F.col("deactivated_at").alias("deactivated_on"))


OLD_NEW_SQL = """o AS (SELECT user_id AS profile_id, CASE WHEN min(event_id) % 4 = 0 THEN 'reviewed' ELSE 'open' END AS status, count(*) AS value FROM events WHERE event_id % 2 = 0 AND user_id % 3 <> 0 GROUP BY 1),
n AS (SELECT user_id AS profile_id, count(*) AS value FROM events WHERE event_id % 2 = 1 AND user_id % 5 <> 0 GROUP BY 1)"""


@query(f"""WITH {OLD_NEW_SQL} SELECT coalesce(n.profile_id, o.profile_id) AS profile_id, CASE WHEN o.status = 'reviewed' OR n.profile_id IS NULL THEN o.value ELSE n.value END AS value,
CASE WHEN o.status = 'reviewed' THEN 'reviewed' WHEN n.profile_id IS NOT NULL THEN 'open' ELSE 'superseded' END AS status FROM o FULL JOIN n ON o.profile_id = n.profile_id""")
def overlap_flag_states(spark, sf):
    e = t(spark, sf, "events").select(F.col("user_id").alias("profile_id"), "event_id")
    old = e.where("event_id % 2 = 0 and profile_id % 3 <> 0").groupBy("profile_id").agg(F.when(F.min("event_id") % 4 == 0, "reviewed").otherwise("open").alias("status"), F.count("*").alias("value"))
    new = e.where("event_id % 2 = 1 and profile_id % 5 <> 0").groupBy("profile_id").agg(F.count("*").alias("value"))
    return dims.overlap_states(old, new)


# merges


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def upsert_latest(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    half = e.where("event_id % 2 = 0")
    order = [F.desc("ts"), F.desc("event_id")]
    old, new = (merge.latest(x, ["user_id", "event_type"], order) for x in (half, e))
    return merge.upsert(old, new, ["user_id", "event_type"]).select("user_id", "event_type", "event_id", "value")


@query("""WITH o AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'), n AS (SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders WHERE o_orderstatus <> 'F')
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, CASE WHEN n.o_orderkey IS NULL THEN 'delete' WHEN o.o_orderkey IS NULL THEN 'insert' WHEN o.o_totalprice IS NOT DISTINCT FROM n.o_totalprice THEN 'keep' ELSE 'update' END AS action
FROM o FULL JOIN n ON o.o_orderkey = n.o_orderkey""")
def snapshot_reconcile(spark, sf):
    o = t(spark, sf, "orders")
    new = o.where("o_orderstatus <> 'F'").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return merge.changes(o.where("o_orderstatus <> 'P'"), new, ["o_orderkey"], ["o_totalprice"])


@query("""WITH e AS (SELECT user_id, event_type, event_id, ts, props FROM events), s AS (SELECT * FROM e WHERE event_id % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1),
i AS (SELECT * FROM e WHERE event_id % 3 = 0)
SELECT i.event_id FROM i LEFT JOIN s ON i.user_id = s.user_id AND i.event_type = s.event_type WHERE s.event_id IS NULL OR json_extract(i.props, '$.k') IS DISTINCT FROM json_extract(s.props, '$.k')""")
def change_only_append(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_type", "event_id", "props")
    return merge.changed_only(e.where("event_id % 3 <> 0"), e.where("event_id % 3 = 0"), ["user_id", "event_type"], "props", "event_id").select("event_id")


# coverage and audits


@query("""WITH c AS (SELECT c_mktsegment AS source_module, o_orderpriority AS test_name, count(DISTINCT o_orderkey) AS n_tests, max(o_orderdate) AS last_date FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
r AS (SELECT DISTINCT c_mktsegment AS source_module, o_orderpriority AS test_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE l_quantity >= 50 AND c_mktsegment <> 'BUILDING')
SELECT c.source_module, c.test_name, n_tests, last_date, CASE WHEN r.test_name IS NULL THEN 'unmapped' ELSE 'covered' END AS coverage_status, CASE WHEN r.test_name IS NOT NULL THEN 'quantity' END AS reference_metric
FROM c LEFT JOIN r ON c.source_module = r.source_module AND c.test_name = r.test_name""")
def coverage_catalog(spark, sf):
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    keys = ["source_module", "test_name"]
    sources = o.select(F.col("c_mktsegment").alias("source_module"), F.col("o_orderpriority").alias("test_name"), F.col("o_orderkey").alias("test_id"), F.col("o_orderdate").alias("test_date"))
    high = o.join(t(spark, sf, "lineitem").where("l_quantity >= 50"), F.col("l_orderkey") == F.col("o_orderkey"))
    fact_ = high.select(F.col("c_mktsegment").alias("source_module"), F.col("o_orderpriority").alias("test_name"), F.lit("quantity").alias("metric_name"), F.col("l_quantity").alias("metric_value"))
    fixed = dict.fromkeys(("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY"), "quantity")
    return coverage.coverage(coverage.catalog_of(sources, keys), coverage.reference_metrics(coverage.metric_candidates(fact_, keys), keys, fixed=fixed), keys)


_PAIRS = [("orders_customer", "orders", "customer", "o_custkey", "c_custkey"), ("lineitem_orders", "lineitem", "orders", "l_orderkey", "o_orderkey"), ("lineitem_part", "lineitem", "part", "l_partkey", "p_partkey"), ("lineitem_supplier", "lineitem", "supplier", "l_suppkey", "s_suppkey"), ("customer_nation", "customer", "nation", "c_nationkey", "n_nationkey"), ("supplier_customer", "supplier", "customer", "s_suppkey", "c_custkey"), ("events_customer", "events", "customer", "user_id", "c_custkey"), ("labels_documents", "labels", "documents", "doc_id", "doc_id")]


@query(" UNION ALL ".join(f"SELECT '{n}' AS relation, count(*) AS n_rows, count(*) FILTER (c.{k} NOT IN (SELECT {p} FROM {b} WHERE {p} IS NOT NULL)) AS n_orphans FROM {a} c WHERE c.{k} IS NOT NULL" for n, a, b, k, p in _PAIRS))
def orphan_audit(spark, sf):
    return audit.orphans([audit.Relation(n, t(spark, sf, a), t(spark, sf, b), {k: p}) for n, a, b, k, p in _PAIRS])


@query("""WITH e AS (SELECT DISTINCT o_custkey AS a, CAST(year(o_orderdate) AS INTEGER) AS b FROM orders WHERE o_orderstatus <> 'P'), x AS (SELECT DISTINCT o_custkey AS a, CAST(year(o_orderdate) AS INTEGER) AS b FROM orders WHERE o_totalprice > 100000)
SELECT a, b, 'missing' AS status FROM (SELECT * FROM e EXCEPT SELECT * FROM x) UNION ALL SELECT a, b, 'extra' FROM (SELECT * FROM x EXCEPT SELECT * FROM e)""")
def pair_coverage(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_custkey").alias("a"), F.year("o_orderdate").alias("b"), "o_orderstatus", "o_totalprice")
    return audit.pair_coverage(o.where("o_orderstatus <> 'P'"), o.where("o_totalprice > 100000"), ["a", "b"])


_PROFILED = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER ({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS n_blank, round(count(*) FILTER ({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') / count(*), 6) AS blank_rate FROM customer" for c in _PROFILED))
def column_profile(spark, sf):
    return audit.column_profile(t(spark, sf, "customer"), _PROFILED).withColumn("blank_rate", F.round("blank_rate", 6))


@query("""SELECT CASE WHEN regexp_full_match(lower(id), '[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}') THEN 'uuid' WHEN regexp_full_match(id, '[0-9]+') THEN 'numeric' ELSE 'text' END AS id_shape,
count(*) AS n_ids, min(id) AS first_id FROM (SELECT DISTINCT CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) WHEN c_custkey % 3 = 1 THEN c_name ELSE substr(md5(c_name), 1, 8) || '-0000-4000-8000-' || substr(md5(c_name), 1, 12) END AS id FROM customer) GROUP BY 1""")
def id_shape_profile(spark, sf):
    k, h = F.col("c_custkey"), F.md5("c_name")
    made = F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, F.col("c_name")).otherwise(F.concat(F.substring(h, 1, 8), F.lit("-0000-4000-8000-"), F.substring(h, 1, 12)))
    return audit.id_shapes(t(spark, sf, "customer").select(made.alias("id")), "id")


@query("""WITH ids AS (SELECT DISTINCT c_name AS id FROM customer UNION SELECT CAST(c_custkey AS VARCHAR) FROM customer)
SELECT 'id' AS column_name, count(*) AS n_ids, 0 AS n_uuid, count(*) FILTER (regexp_full_match(id, '[0-9]+')) AS n_numeric, count(*) FILTER (NOT regexp_full_match(id, '[0-9]+')) AS n_text,
(SELECT string_agg(id, ',' ORDER BY id) FROM (SELECT id FROM ids ORDER BY id LIMIT 5)) AS samples FROM ids""")
def id_profile(spark, sf):
    c = t(spark, sf, "customer")
    ids = c.select(F.col("c_name").alias("id")).unionByName(c.select(F.col("c_custkey").cast("string").alias("id")))
    return audit.id_profile(ids, "id").withColumn("samples", F.array_join("samples", ","))


_TIMED = ["o_orderkey", "o_custkey", "o_orderpriority"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_rows, min(o_orderdate) AS min_time, max(o_orderdate) AS max_time, count(*) FILTER ({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS n_blank FROM orders" for c in _TIMED))
def column_profile_times(spark, sf):
    return audit.column_profile(t(spark, sf, "orders"), _TIMED, "o_orderdate").drop("blank_rate")


# operations


@query("SELECT event_type AS stage, count(*) AS n_runs, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, max(value) AS max_elapsed FROM events GROUP BY 1")
def stage_percentiles(spark, sf):
    return ops.stage_percentiles(t(spark, sf, "events").withColumnRenamed("event_type", "stage"), "stage", "value")


_NOW = "2026-01-01 00:00:00"


@query(f"""WITH x AS (SELECT 'orders' AS table_name, max(o_orderdate) AS last_update FROM orders UNION ALL SELECT 'events', max(ts) FROM events UNION ALL SELECT 'sensor_data', max(l_shipdate) FROM lineitem),
y AS (SELECT *, (epoch(TIMESTAMP '{_NOW}') - epoch(last_update)) / 3600 AS lag, CASE table_name WHEN 'sensor_data' THEN 12 WHEN 'events' THEN 8 ELSE 6 END AS limit_hours FROM x)
SELECT table_name, round(lag, 6) AS lag_hours, limit_hours, CASE WHEN lag > 2 * limit_hours THEN 'critical' WHEN lag > limit_hours THEN 'warning' END AS severity FROM y""")
def freshness_lag(spark, sf):
    tables = {"orders": (t(spark, sf, "orders"), "o_orderdate"), "events": (t(spark, sf, "events"), "ts"), "sensor_data": (t(spark, sf, "lineitem"), "l_shipdate")}
    return ops.freshness(tables, F.lit(_NOW)).select("table_name", *r6("lag_hours"), "limit_hours", "severity")


@query("SELECT event_id FROM events WHERE ts >= (SELECT min(date_trunc('day', ts)) FROM events) + INTERVAL 1 DAY AND ts < (SELECT min(date_trunc('day', ts)) FROM events) + INTERVAL 2 DAY")
def day_window_scope(spark, sf):
    e = t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first = e.agg(F.date_add(F.min(F.to_date("ts")), 1).alias("d")).first().d
    return e.where(scope.local_day(F.col("ts"), str(first), "UTC")).select("event_id")


_SINCE = "1997-01-01"


@query(f"""SELECT DISTINCT c_mktsegment AS family, test_id FROM (SELECT o_orderkey AS test_id, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{_SINCE}'
UNION ALL SELECT o_orderkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= TIMESTAMP '{_SINCE}') JOIN customer ON o_custkey = c_custkey""")
def touched_scope(spark, sf):
    """Tests of which the order or a line is of a date since then."""
    o, c = t(spark, sf, "orders"), t(spark, sf, "customer")
    tests = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("family"), F.col("o_orderkey").alias("test_id"))
    lines = t(spark, sf, "lineitem").where(F.col("l_shipdate") >= F.lit(_SINCE).cast("timestamp_ntz")).select(F.col("l_orderkey").alias("test_id"))
    names = scope.touched({"any": [o.where(F.col("o_orderdate") >= F.lit(_SINCE).cast("timestamp_ntz")).select(F.col("o_orderkey").alias("test_id")), lines]})
    return names.drop("family").join(tests, "test_id").select("family", "test_id").distinct()


@query(f"WITH {_MARTS_SQL} SELECT {MART} FROM kept WHERE test_id IN (SELECT test_id FROM cand)")
def scoped_refresh(spark, sf):
    """A mart in which the rows of one order status are stale, refreshed: the same as the full one."""
    full = stored(mart_simple(spark, sf), "mart")
    ids = t(spark, sf, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("test_id"))
    marked = full.join(ids.withColumn("__stale", F.lit(True)), "test_id", "left")
    stale = marked.withColumn("metric_value", F.when(F.col("__stale"), -1.0).otherwise(F.col("metric_value"))).drop("__stale")
    return scope.refreshed(stale.select(*full.columns), full, ids)


@query("SELECT event_id, 'k' AS metric_name, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS metric_value FROM events WHERE props IS NOT NULL AND json_extract_string(props, '$.k') IS NOT NULL")
def json_leaf_walk(spark, sf):
    return jsonwalk.all_leaves(t(spark, sf, "events"), "props", "event_id").select("event_id", "metric_name", "metric_value")


_CAMEL = "concat('maxRFDValue', upper(substr(p_brand, 1, 1)), lower(substr(replace(p_brand, '#', ''), 2)), 'Test - ', replace(p_type, ' ', '--'))"


@query(f"""SELECT p_partkey, regexp_replace(regexp_replace(lower(translate(regexp_replace(regexp_replace({_CAMEL}, '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g'), '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), ' -', '__')), '_+', '_', 'g'), '^_|_$', '', 'g') AS metric_name FROM part""")
def name_normalise(spark, sf):
    b = F.col("p_brand")
    name = F.concat(F.lit("maxRFDValue"), F.upper(F.substring(b, 1, 1)), F.lower(F.expr("substring(replace(p_brand, '#', ''), 2)")), F.lit("Test - "), F.replace("p_type", F.lit(" "), F.lit("--")))
    return t(spark, sf, "part").select("p_partkey", S.metric_name(name).alias("metric_name"))


_SIDED = "CASE p_size % 4 WHEN 0 THEN 'inner_left_' WHEN 1 THEN 'right_' WHEN 2 THEN 'outer_right_' ELSE '' END || 'max_force'"


@query(f"SELECT p_partkey, nullif(regexp_extract({_SIDED}, '{S.SIDE_PREFIX}', 1), '') AS side, CASE WHEN regexp_matches({_SIDED}, '{S.SIDE_PREFIX}') THEN regexp_extract({_SIDED}, '{S.SIDE_PREFIX}', 2) ELSE {_SIDED} END AS metric_name FROM part")
def side_split(spark, sf):
    n = F.expr(_SIDED)
    return t(spark, sf, "part").select("p_partkey", S.side_of_name(n).alias("side"), S.name_without_side(n).alias("metric_name"))


_NAMED = "CASE p_size % 9 WHEN 0 THEN 'flight_time' WHEN 1 THEN 'weight_kg' WHEN 2 THEN 'max_rfd_nps' WHEN 3 THEN 'avg_impulse' WHEN 4 THEN 'time_to_peak_s' WHEN 5 THEN 'max_rom_degrees' WHEN 6 THEN 'peak_torque' WHEN 7 THEN 'rep_count' ELSE lower(p_brand) END"
_UNIT_CASE = "CASE " + " ".join(f"WHEN regexp_matches(n, '{p}') THEN '{u}'" for p, u in S.UNITS) + " END"


@query(f"SELECT p_partkey, {_UNIT_CASE} AS metric_unit FROM (SELECT p_partkey, {_NAMED} AS n FROM part)")
def unit_infer(spark, sf):
    return t(spark, sf, "part").select("p_partkey", S.unit(F.expr(_NAMED)).alias("metric_unit"))


# payloads, written from the tables as JSON and read again


def _raw(rows: DataFrame, payload, params=None) -> DataFrame:
    """Raw rows: raw_id, source_account, request_params, response_payload (JSON of a column)."""
    asked = F.to_json(params) if params is not None else F.lit("{}")
    return rows.select("raw_id", F.lit("acc").alias("source_account"), asked.alias("request_params"), F.to_json(payload).alias("response_payload"))


def _per_order(spark, sf, *fields, name: str = "items") -> DataFrame:
    """An order's lines as an array of structs in their order."""
    return D.lines(spark, sf).groupBy(F.col("l_orderkey").alias("raw_id")).agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), *fields))).alias(name))


_LINES_SQL = D.WIDE_SQL.split(",\nwide AS")[0]


@query(f"WITH {_LINES_SQL} SELECT CAST(l_orderkey AS VARCHAR) AS trial_id, CAST(l_partkey AS VARCHAR) AS result_id, coalesce(CASE l_returnflag WHEN 'R' THEN 'right' WHEN 'A' THEN 'left' END, 'both') AS limb, CAST(l_linenumber AS BIGINT) AS repeat, l_extendedprice AS value FROM lines WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL")
def payload_results(spark, sf):
    """Trials with results inside; a result without a limb has its trial's."""
    side = F.when(F.col("l_returnflag") == "R", "right").when(F.col("l_returnflag") == "A", "left")
    rows = _per_order(spark, sf, F.col("l_partkey").alias("resultId"), F.col("l_extendedprice").alias("value"), side.alias("limb"), F.col("l_linenumber").alias("repeat"), name="results").where("raw_id is not null")
    raw = _raw(rows, F.array(F.struct(F.col("raw_id").alias("id"), F.lit("both").alias("limb"), "results")))
    return payloads.flatten(raw, "plate_results").select("trial_id", "result_id", "limb", F.col("repeat").cast("long").alias("repeat"), "value")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS profile_id, kind AS category_id, CASE kind WHEN 'segment' THEN lower(c_mktsegment) ELSE CAST(c_nationkey AS VARCHAR) END AS group_id FROM customer, (VALUES ('segment'), ('nation')) AS k(kind) WHERE c_custkey IS NOT NULL""")
def payload_categories(spark, sf):
    """Attributes of profiles: a kind is a category, its value the group; a kind given twice counts once, as given first."""
    c = dealt(t(spark, sf, "customer").where("c_custkey is not null")).withColumn("raw_id", F.col("c_custkey"))
    one = lambda kind, value: F.struct(F.lit(kind).alias("attributeTypeId"), value.cast("string").alias("attributeValueId"))
    listed = F.array(one("segment", F.lower("c_mktsegment")), one("nation", F.col("c_nationkey")), one("segment", F.lit("late")))
    return payloads.flatten(_raw(c, F.array(F.struct(F.col("c_custkey").alias("id"), listed.alias("attributes")))), "profile_categories").select("profile_id", "category_id", "group_id")


@query(f"""WITH {_LINES_SQL}, e AS (SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS pos, CASE WHEN l_linenumber % 3 = 1 THEN 10 * l_linenumber END AS tick FROM lines WHERE l_orderkey IS NOT NULL),
g AS (SELECT *, last_value(tick IGNORE NULLS) OVER w AS known, last_value(CASE WHEN tick IS NOT NULL THEN pos END IGNORE NULLS) OVER w AS p FROM e WINDOW w AS (PARTITION BY l_orderkey ORDER BY pos ROWS UNBOUNDED PRECEDING)),
tr AS (SELECT l_orderkey, CAST(coalesce(known + pos - p, pos) AS BIGINT) AS tick, l_quantity FROM g QUALIFY row_number() OVER (PARTITION BY l_orderkey, coalesce(known + pos - p, pos) ORDER BY pos DESC) = 1)
SELECT CAST(l_orderkey AS VARCHAR) AS test_id, tick, l_quantity AS inner_left, CAST(o_custkey AS VARCHAR) AS profile_id, CASE WHEN o_custkey IS NULL THEN 'missing profile_id' END AS reject_reason
FROM tr LEFT JOIN (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""")
def payload_traces(spark, sf):
    """Traces with gaps in their ticks, and the profile of their test; of tests that aren't known they are rejected."""
    rows = _per_order(spark, sf, F.when(F.col("l_linenumber") % 3 == 1, 10 * F.col("l_linenumber")).alias("tick"), F.col("l_quantity").alias("innerLeftForce"), name="forces").where("raw_id is not null")
    flat = payloads.flatten(_raw(rows, F.struct("forces"), F.struct(F.col("raw_id").alias("testId"))), "frame_traces")
    tests = t(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").cast("string").alias("test_id"), F.col("o_custkey").cast("string").alias("profile_id"))
    return payloads.with_parent(flat, tests, "test_id", {"profile_id": "profile_id"}, required="profile_id").select("test_id", F.col("tick").cast("long").alias("tick"), "inner_left", "profile_id", "reject_reason")


@query(f"""WITH {_LINES_SQL}, s AS (SELECT l_orderkey, l_suppkey, l_partkey, max(l_linenumber) AS n FROM lines WHERE l_orderkey > 0 AND l_suppkey > 0 AND l_partkey > 0 GROUP BY ALL)
SELECT CAST(s.l_orderkey AS VARCHAR) AS activity_id, CAST(s.l_suppkey AS VARCHAR) AS athlete_id, CASE WHEN p_partkey IS NOT NULL THEN CAST(s.l_partkey AS VARCHAR) END AS period_id, CAST(s.l_partkey AS VARCHAR) AS period_key, CAST(n AS VARCHAR) AS n_text,
  o_orderdate AS start_time FROM s LEFT JOIN orders ON s.l_orderkey = o_orderkey LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 10) ON s.l_partkey = p_partkey""")
def payload_stats(spark, sf):
    """Statistics rows: suffixed ids, start from the activity, the period only where it is known, the latest of repeats."""
    both = lambda c, name: F.col(c).cast("string").alias(name)
    rows = _per_order(spark, sf, both("l_orderkey", "activity_id_id"), both("l_suppkey", "athlete_id"), both("l_partkey", "period_id_id"), both("l_linenumber", "n_text")).where("raw_id is not null")
    listed = F.filter("items", lambda x: (x["athlete_id"] > "0") & (x["period_id_id"] > "0"))
    activities = t(spark, sf, "orders").select(F.lit("acc").alias("source_account"), F.col("o_orderkey").cast("string").alias("activity_id"), F.col("o_orderdate").cast("timestamp").alias("start_time"), F.lit(None).cast("timestamp").alias("end_time"))
    periods = t(spark, sf, "part").where("p_size > 10").select(F.lit("acc").alias("source_account"), F.col("p_partkey").cast("string").alias("period_id"))
    got = payloads.stats(_raw(rows, listed), activities, periods).where("reject_reason is null")
    return got.select("activity_id", "athlete_id", "period_id", "period_key", F.col("all_parameters")["n_text"].alias("n_text"), F.col("start_time").cast("timestamp_ntz").alias("start_time"))


_GATE_SQL = f"""{_LINES_SQL}, o AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0 AND o_orderdate IS NOT NULL)"""


@query(f"""WITH {_GATE_SQL}, r AS (SELECT l_orderkey, l_linenumber AS rep, l_tax, l_quantity, l_discount FROM lines JOIN o ON l_orderkey = o_orderkey)
SELECT o_orderkey AS test_id, NULL AS rep_number, 'total_price' AS metric_name, o_totalprice AS metric_value FROM o WHERE o_totalprice IS NOT NULL
UNION ALL SELECT l_orderkey, rep, 'reaction_time', l_tax FROM r WHERE l_tax IS NOT NULL UNION ALL SELECT l_orderkey, rep, 'split_1_split_time', l_quantity FROM r WHERE l_quantity IS NOT NULL
UNION ALL SELECT l_orderkey, rep, 'split_1_peak_velocity', l_discount FROM r WHERE l_discount IS NOT NULL UNION ALL SELECT l_orderkey, rep, 'jump_4_flight_time', l_quantity + 1 FROM r WHERE l_quantity IS NOT NULL""")
def gate_fact(spark, sf):
    """Timing gates: details with repetitions, splits and jumps inside, of active profiles; the profile is the detail's."""
    split = F.array(F.struct(F.col("l_quantity").alias("splitTime"), F.lit(9).alias("gateIndex"), F.struct(F.col("l_discount").alias("peakVelocity")).alias("additionalSplitData")))
    jump = F.array(F.struct(F.lit(4).alias("jumpIndex"), (F.col("l_quantity") + 1).alias("flightTime")))
    reps = _per_order(spark, sf, F.struct(F.col("l_linenumber").alias("repIndex"), F.col("l_tax").alias("reactionTime"), split.alias("splitResults"), jump.alias("jumpResults")).alias("rep"))
    o = t(spark, sf, "orders").where("o_orderkey is not null")
    summaries = o.select(F.col("o_orderkey").alias("test_id"), F.lit(-1).cast("long").alias("profile_id"), F.col("o_orderpriority").alias("test_name"), F.lit("run").alias("test_type"), F.lit(None).cast("timestamp_ntz").alias("test_date"))
    blob = F.to_json(F.struct(F.col("o_totalprice").alias("totalPrice"), F.lit(5).alias("someId"), F.lit(True).alias("valid")))
    details = o.join(reps, F.col("o_orderkey") == F.col("raw_id"), "left").select(F.col("o_orderkey").alias("test_id"), F.col("o_custkey").alias("profile_id"), F.col("o_orderdate").alias("test_date"), blob.alias("results"), F.to_json(F.transform("items", lambda i: i["rep"])).alias("reps"))
    profiles = t(spark, sf, "customer").select(F.col("c_custkey").alias("profile_id"), (F.col("c_acctbal") > 0).alias("is_active"))
    return fact.gate_fact(summaries, details, profiles).select("test_id", "rep_number", "metric_name", "metric_value")


@query(f"""WITH {_GATE_SQL}, s AS (SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 'right' WHEN 'A' THEN 'left' END AS side, max(l_quantity) AS q, max(l_tax) AS x FROM lines JOIN o ON l_orderkey = o_orderkey GROUP BY ALL),
r AS (SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 'right' WHEN 'A' THEN 'left' END AS side, l_linenumber AS rep, l_extendedprice AS v, l_discount AS d FROM lines JOIN o ON l_orderkey = o_orderkey)
SELECT l_orderkey AS test_id, side, NULL AS rep_number, 'max_force_newtons' AS metric_name, q AS metric_value FROM s WHERE q IS NOT NULL UNION ALL SELECT l_orderkey, side, NULL, 'extra_tax', x FROM s WHERE x IS NOT NULL
UNION ALL SELECT l_orderkey, side, rep, 'impulse_ns', v FROM r WHERE v IS NOT NULL UNION ALL SELECT l_orderkey, side, rep, 'speed', d FROM r WHERE d IS NOT NULL""")
def dynamometer_fact(spark, sf):
    """Dynamometer: summaries and repetitions; a column goes before a number of its name in the payload, and some payload numbers are left out."""
    side = F.when(F.col("l_returnflag") == "R", "right").when(F.col("l_returnflag") == "A", "left").alias("side")
    rows = D.lines(spark, sf).where("l_orderkey is not null").withColumnRenamed("l_orderkey", "test_id")
    summaries = rows.groupBy("test_id", side).agg(F.max("l_quantity").alias("max_force_newtons"), F.to_json(F.struct(F.max("l_tax").alias("extraTax"))).alias("payload"))
    blob = F.to_json(F.struct(F.col("l_discount").alias("speed"), F.lit(3).alias("force"), F.when(F.col("l_extendedprice").isNotNull(), -1).alias("impulseNs")))
    repetitions = rows.select("test_id", side, F.col("l_linenumber").alias("repetition_number"), F.col("l_extendedprice").alias("impulse_ns"), blob.alias("payload"))
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("test_id"), F.col("o_custkey").alias("profile_id"), F.col("o_orderpriority").alias("test_name"), F.lit("hold").alias("test_type"), F.col("o_orderdate").alias("test_date"))
    profiles = t(spark, sf, "customer").select(F.col("c_custkey").alias("profile_id"), (F.col("c_acctbal") > 0).alias("is_active"))
    got = fact.dynamometer_fact(o, summaries, repetitions, profiles, of_summary=["max_force_newtons"], of_repetition=["impulse_ns"])
    return got.select("test_id", "side", "rep_number", "metric_name", "metric_value")


@query("""WITH w AS (SELECT CAST(s_nationkey % 5 AS VARCHAR) AS a, s_suppkey AS i, n_name AS p FROM supplier JOIN nation ON s_nationkey = n_nationkey),
pos AS (SELECT CAST(n_nationkey % 5 AS VARCHAR) AS a, n_nationkey AS id, n_name AS p FROM nation WHERE n_nationkey % 4 <> 0), ath AS (SELECT CAST(c_nationkey % 5 AS VARCHAR) AS a, c_custkey AS i, c_nationkey AS id FROM customer)
SELECT w.a AS source_account, w.i AS athlete_id, CASE WHEN pos.id IS NULL THEN 'missing_position' WHEN ath.i IS NULL THEN 'unknown_athlete' WHEN pos.id = ath.id THEN 'unchanged' ELSE 'to_update' END AS status
FROM w LEFT JOIN pos ON w.a = pos.a AND w.p = pos.p LEFT JOIN ath ON w.a = ath.a AND w.i = ath.i""")
def reconcile_status(spark, sf):
    return _reconciled(spark, sf).select("source_account", "athlete_id", "status")


def _reconciled(spark, sf):
    n, acc = t(spark, sf, "nation"), lambda c: (F.col(c) % 5).cast("string").alias("source_account")
    wanted = t(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(acc("s_nationkey"), F.col("s_suppkey").alias("athlete_id"), F.col("n_name").alias("position_name"), F.lower("n_name").alias("position_slug"))
    positions = n.where("n_nationkey % 4 <> 0").select(acc("n_nationkey"), F.col("n_nationkey").alias("position_id"), F.col("n_name").alias("name"), F.lower("n_name").alias("slug"))
    athletes = t(spark, sf, "customer").select(acc("c_nationkey"), F.col("c_custkey").alias("athlete_id"), F.col("c_nationkey").alias("position_id"))
    return ops.reconcile_positions(wanted, positions, athletes)


_POSITIONS_SQL = """WITH w AS (SELECT CAST(s_nationkey % 5 AS VARCHAR) AS a, n_name AS p FROM supplier JOIN nation ON s_nationkey = n_nationkey),
pos AS (SELECT CAST(n_nationkey % 5 AS VARCHAR) AS a, n_name AS p FROM nation WHERE n_nationkey % 4 <> 0)"""


@query(f"""{_POSITIONS_SQL} SELECT a AS source_account, p AS position_name, lower(p) AS position_slug, count(*) AS affected_rows FROM w
WHERE NOT EXISTS (SELECT 1 FROM pos WHERE pos.a = w.a AND pos.p = w.p) GROUP BY ALL""")
def missing_positions(spark, sf):
    return ops.missing_positions(_reconciled(spark, sf))


@query("""SELECT user_id, event_id, event_type AS stage, value AS elapsed, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) AS place,
round(value / nullif(sum(value) OVER (PARTITION BY user_id), 0), 6) AS share FROM events""")
def run_breakdown(spark, sf):
    """Each user is a run, each of the user's events a stage of it."""
    timings = t(spark, sf, "events").select("user_id", "event_id", F.col("event_type").alias("stage"), F.col("value").alias("elapsed"))
    return ops.run_breakdown(timings, "user_id", "event_id", "elapsed").withColumn("share", F.round("share", 6))


@query("""SELECT c_mktsegment AS source_account, strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%SZ') AS watermark_text FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def watermark_update(spark, sf):
    """Marks of finished orders are stored, those of the rest come with the run."""
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    log = o.select(F.col("c_mktsegment").alias("source_account"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("seen"), "o_orderstatus")
    stored = ops.watermarks(log.where("o_orderstatus = 'F'"), ["source_account"], "seen")
    return ops.updated_watermarks(stored, log.where("o_orderstatus <> 'F'"), ["source_account"], "seen").select("source_account", "watermark_text")


@query("SELECT user_id, max(event_id) AS last_raw_id, count(*) AS n_rows FROM events GROUP BY 1")
def replay_watermark(spark, sf):
    raw = t(spark, sf, "events").select(F.col("user_id").alias("source_account"), F.col("event_id").alias("raw_id"))
    n = raw.groupBy("source_account").agg(F.count("*").alias("n_rows"))
    return ops.replay_cursor(raw).join(n, "source_account").withColumnRenamed("source_account", "user_id")


@query("SELECT strftime(o_orderdate, '%Y_%m') AS month, count(*) AS n_rows, min(o_orderdate) AS first_date FROM orders GROUP BY 1")
def month_partitions(spark, sf):
    where, o = fresh(spark, "months"), t(spark, sf, "orders").select("o_orderdate")
    landing.write_monthly(o, where, "o_orderdate")
    return landing.read_months(spark, where, o.schema).groupBy("month").agg(F.count("*").alias("n_rows"), F.min("o_orderdate").alias("first_date"))


# scalar functions on texts made of the tables' own columns

_WRITTEN = """CASE o_orderkey % 9 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN ' ' || CAST(o_custkey AS STRING) || ' ' WHEN 2 THEN CAST(o_custkey AS STRING) || '.75'
  WHEN 3 THEN '-' || CAST(o_custkey AS STRING) || '.0' WHEN 4 THEN 'true' WHEN 5 THEN 'No' WHEN 6 THEN '   ' WHEN 7 THEN '0' ELSE 'n/a' END"""


@query(f"""WITH w AS (SELECT o_orderkey, trim({_WRITTEN}) AS v, TRY_CAST(trim({_WRITTEN}) AS DOUBLE) AS d FROM orders)
SELECT o_orderkey, d AS number, CAST(trunc(d) AS BIGINT) AS whole, CASE WHEN d = floor(d) THEN CAST(d AS BIGINT) END AS whole_only, CASE WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN CAST(v AS BIGINT) END AS whole_text,
  d AS exact, CASE WHEN lower(v) IN ('1', 'true') THEN true WHEN lower(v) IN ('0', 'no') THEN false END AS truth, CASE WHEN v NOT IN ('', 'true') THEN v END AS identifier,
  CASE WHEN v NOT IN ('', 'true', '0') THEN v ELSE CAST(o_orderkey AS VARCHAR) END AS dimension_id, substr(nullif(v, ''), 1, 3) AS short_text FROM w""")
def scalar_numbers(spark, sf):
    """Numbers, truth values and identifiers read from text with blanks, signs, words and nothing in it."""
    c = F.col("v")
    rows = t(spark, sf, "orders").select("o_orderkey", F.expr(_WRITTEN).alias("v"))
    return rows.select(
        "o_orderkey", S.finite(c).alias("number"), S.whole(c).alias("whole"), S.whole_only(c).alias("whole_only"), S.whole_text(c).alias("whole_text"), S.decimal(c).cast("double").alias("exact"),
        S.boolean(c).alias("truth"), S.identifier(c).alias("identifier"), S.dimension_id(c, F.col("o_orderkey").cast("string")).alias("dimension_id"), S.text(c, 3).alias("short_text"),
    )


@query("""WITH w AS (SELECT o_orderkey, o_orderdate AS d, CASE WHEN o_orderkey % 4 <> 3 THEN o_orderdate END AS known FROM orders WHERE o_orderkey IS NOT NULL)
SELECT o_orderkey, known AS moment, strftime(known, '%Y-%m-%d') AS day, d + to_milliseconds(250 * (o_orderkey % 4)) AS sensor_time, strftime(d, '%Y-%m-%dT%H:%M:%SZ') AS utc_text,
  greatest(d, TIMESTAMP '1996-01-01') AS clamped, CASE WHEN o_orderkey % 2 = 0 THEN 7.0 ELSE epoch(TIMESTAMP '2000-01-01') - epoch(d) END AS duration FROM w""")
def scalar_times(spark, sf):
    """Epoch seconds and milliseconds, ISO text, and a negative number, which is no time."""
    ts, seconds = F.col("o_orderdate").cast("timestamp"), F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    k, end = F.col("o_orderkey") % 4, F.lit("2000-01-01 00:00:00").cast("timestamp")
    made = F.when(k == 0, seconds.cast("string")).when(k == 1, (seconds * 1000).cast("string")).when(k == 2, S.utc_text(ts)).otherwise("-5")
    at = lambda c: c.cast("timestamp_ntz")
    return t(spark, sf, "orders").where("o_orderkey is not null").select(
        "o_orderkey", at(S.moment(made)).alias("moment"), S.day(made).cast("string").alias("day"), at(S.sensor_time(seconds, k * 25)).alias("sensor_time"), S.utc_text(ts).alias("utc_text"),
        at(S.clamp(ts, F.lit("1996-01-01 00:00:00").cast("timestamp"))).alias("clamped"), S.duration(F.when(F.col("o_orderkey") % 2 == 0, 7.0), ts, end).alias("duration"),
    )


def _by_size(n: int, *values: str | None) -> str:
    """SQL: of ``n`` values the one of the part's size; the last also of parts without a size."""
    shown = ["NULL" if v is None else v if "(" in v else f"'{v}'" for v in values]
    return f"CASE p_size % {n} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(shown[:-1])) + f" ELSE {shown[-1]} END"


@query(f"""SELECT p_partkey, {_by_size(6, 'left', 'bilateral', 'inner_left', 'right', None, 'lower(p_brand)')} AS side, {_by_size(6, 'left', 'bilateral', 'trial', 'upper_limb_2', None, 'right')} AS limb,
  {_by_size(6, 'ms', 'm', 's', 's', 'N', None)} AS gate_unit, p_size % 5 < 4 AND p_size IS NOT NULL AS is_id_key,
  CASE WHEN p_size % 2 = 0 THEN 'result_' || CAST(p_partkey AS VARCHAR) ELSE coalesce(replace(lower(p_brand), '#', '_') || '_', '') || 'peak_force_n' END AS slug,
  concat_ws(' ', nullif(trim(p_type), ''), CASE WHEN p_size % 2 = 0 THEN NULL ELSE 'knee' END) AS test_name, p_type || CASE WHEN p_size % 2 = 0 THEN '' ELSE ' - knee' END AS with_position,
  CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS INTEGER) END AS split_number, 'velocity' || coalesce('_band_' || CAST(p_size AS VARCHAR), '') AS effort_type,
  CASE WHEN p_size % 2 = 0 THEN substr(md5(p_type), 1, 8) || '-0000-4000-8000-' || substr(md5(p_type), 1, 12) END AS uuid,
  sha256('{{"p0":' || coalesce(CAST(p_partkey AS VARCHAR), 'null') || ',"p1":' || coalesce('"' || p_brand || '"', 'null') || '}}') AS record_hash FROM part""")
def scalar_names(spark, sf):
    """Sides, units, slugs, names and keys of texts as payloads have them."""
    p, e = F.col("p_partkey"), lambda *a: F.expr(_by_size(*a))
    even, h = F.col("p_size") % 2 == 0, F.upper(F.md5(F.col("p_type")))
    knee = F.when(even, " ").otherwise(" knee ")
    return t(spark, sf, "part").select(
        p, S.side_label(e(6, "Left Side", "both", "innerLeft", "RIGHT", "", "lower(p_brand)")).alias("side"), S.limb_side(e(6, "LeftSide", "Both", "trial", "Upper Limb-2", "", "right")).alias("limb"),
        S.gate_unit(e(6, "flight_time", "jump_height_m", "split_1_split_time", "total_run", "max_force", "peak_velocity")).alias("gate_unit"), S.is_id_key(e(5, "testId", "id", "gateIndex", "modifiedUtc", "identity")).alias("is_id_key"),
        S.slug(F.when(even, "").otherwise(F.col("p_brand")), F.when(even, "").otherwise("Peak Force [N]"), p).alias("slug"), S.test_name([F.col("p_type"), knee], "").alias("test_name"), S.with_position(F.col("p_type"), knee).alias("with_position"),
        S.split_number(F.when(even, F.concat(F.lit("split_"), F.col("p_size").cast("string"), F.lit("_cumulative_time"))).otherwise("split_time")).alias("split_number"), S.effort_type(F.lit("velocity"), F.col("p_size")).alias("effort_type"),
        S.uuid(F.when(even, F.concat(F.lit(" "), F.substring(h, 1, 8), F.lit("-0000-4000-8000-"), F.substring(h, 1, 12))).otherwise(h)).alias("uuid"), S.record_hash(p, F.col("p_brand")).alias("record_hash"),
    )
