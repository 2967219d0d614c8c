"""Queries of whole runs: replays, refreshes, loads, and what they leave in their tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import audit, coverage, dims, fact, marts, merge, ops, quality, scope
from ..sources import landing, payloads
from ..sources.runs import RunLog
from ..sources.stored import fresh, stored
from ..streaming.replay import merge_stream
from . import driver as D
from . import jobs
from .queries import _METRICS, FLAGS_SQL, MEMBERS_SQL, SQL, TEST_NAMED, _members, query, t

# a stream of raw rows into a keyed table

_EVENT = "struct<id: bigint, user: bigint, kind: string, at: timestamp, value: double>"


@query(SQL["upsert_latest"])
def replay_stream(spark, sf):
    """Events land as JSON in three batches; a stream flattens them and merges each batch into a keyed table."""
    e = t(spark, sf, "events")
    where = fresh(spark, "stream")
    for k in range(3):
        body = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("user"), F.col("event_type").alias("kind"), F.col("ts").cast("timestamp").alias("at"), "value"))
        made = e.where(F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(3)) == k).select(F.lit("events").alias("api_endpoint"), body.alias("response_payload"))
        landing.append(landing.with_lineage(made, batch_id=f"b{k}", ingested_at=F.lit("2026-01-01").cast("timestamp"), last_raw_id=k << 50), f"{where}/raw")

    def typed(raw: DataFrame) -> DataFrame:
        p = raw.select(F.from_json("response_payload", _EVENT).alias("p"))
        return p.select(F.col("p.user").alias("user_id"), F.col("p.kind").alias("event_type"), F.col("p.id").alias("event_id"), F.col("p.at").alias("ts"), F.col("p.value").alias("value"))

    schema = spark.read.parquet(f"{where}/raw").schema
    got = merge_stream(spark, f"{where}/raw", schema, where, "latest", ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")], checkpoint=f"{where}/progress", transform=typed, files_per_batch=8, buckets=16)
    return got.select("user_id", "event_type", "event_id", "value")


# five families: one fact, one labelling, five marts

FAMILIES = {"AUTOMOBILE": "hamstring", "BUILDING": "frame", "FURNITURE": "dynamometer", "HOUSEHOLD": "gates", "MACHINERY": "plates"}
_FAMILY_SQL = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FAMILIES.items()) + " END"


def families(spark, sf) -> dict[str, jobs.Family]:
    """A market segment's orders are a family's tests. The tests are stored in folders by segment, of which each family reads its own."""
    rows = stored(D.wide(spark, sf), "wide", "assessment_family")

    def of(segment: str) -> jobs.Family:
        own = D.long(rows.where(F.col("assessment_family") == segment))
        return lambda tests: own if tests is None else own.join(tests, "test_id", "left_semi")

    return {family: of(segment) for segment, family in FAMILIES.items()}


ROWS = "test_id, rep_number, metric_name, metric_value"
_FAMILY_FACT = D.FACT_SQL.replace("c_mktsegment AS assessment_family", f"{_FAMILY_SQL} AS assessment_family")
_FIVE = D.limits_sql(1.0).replace(D.FACT_SQL, _FAMILY_FACT) + f""",
cand AS MATERIALIZED (SELECT * FROM labelled WHERE NOT is_above AND NOT is_below AND metric_name = CASE test_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _METRICS.items())} END),
kept AS MATERIALIZED (SELECT * FROM labelled WHERE NOT is_above AND NOT is_below),
mode AS (SELECT test_id, bool_or(coalesce(side IN ('left', 'right'), false)) AS has FROM cand WHERE rep_number IS NOT NULL GROUP BY 1),
least AS (SELECT * FROM cand WHERE rep_number IS NOT NULL QUALIFY row_number() OVER (PARTITION BY test_id ORDER BY metric_value NULLS LAST, rep_number, side NULLS LAST) = 1),
best AS (SELECT c.* FROM cand c JOIN mode m ON c.test_id = m.test_id WHERE rep_number IS NOT NULL AND (NOT has OR coalesce(side IN ('left', 'right'), false))
  QUALIFY row_number() OVER (PARTITION BY c.test_id, c.side ORDER BY metric_value DESC NULLS LAST, rep_number) = 1),
chosen AS (SELECT * FROM kept WHERE assessment_family IN ('hamstring', 'frame') AND test_id IN (SELECT test_id FROM cand)
  UNION ALL SELECT * FROM kept k WHERE assessment_family = 'dynamometer' AND EXISTS (SELECT 1 FROM cand c WHERE c.test_id = k.test_id AND c.side IS NOT DISTINCT FROM k.side)
  UNION ALL SELECT * FROM kept k WHERE assessment_family = 'gates' AND EXISTS (SELECT 1 FROM least b WHERE b.test_id = k.test_id AND b.rep_number = k.rep_number)
  UNION ALL SELECT * FROM kept k WHERE assessment_family = 'plates' AND EXISTS (SELECT 1 FROM best b WHERE b.test_id = k.test_id AND b.side IS NOT DISTINCT FROM k.side AND b.rep_number = k.rep_number))"""
#: What tells rows of a family's mart apart, as text.
_KEY = "CASE WHEN assessment_family IN ('hamstring', 'frame') THEN coalesce(side, '') WHEN assessment_family = 'gates' THEN CAST(rep_number AS VARCHAR) ELSE coalesce(side, '') || '/' || CAST(rep_number AS VARCHAR) END"


def _catalog(rows: DataFrame) -> DataFrame:
    keys = list(TEST_NAMED)
    return coverage.reference_metrics(coverage.metric_candidates(rows, keys), keys, module="test_type", fixed=_METRICS)


def _refreshed(spark, sf, factor: float):
    rows = jobs.store_fact(jobs.refresh_fact(None, families(spark, sf)))
    by_side = lambda select: lambda *a, **how: select(*a, **how, tie=("side",))  # noqa: E731  # these rows have no key to break ties
    every = [jobs.Mart(m.family, by_side(m.select) if m.family in ("gates", "plates") else m.select, m.keys) for m in jobs.MARTS]
    return jobs.refresh_all(rows, _catalog(rows), every=every, factor=factor, named=TEST_NAMED)


@query(f"WITH {_FIVE} SELECT assessment_family, test_id, metric_name, {_KEY} AS key, max(metric_value) AS metric_value FROM chosen GROUP BY ALL")
def marts_of_all_families(spark, sf):
    each = [mart for mart, _ in _refreshed(spark, sf, 1.0).values()]
    key = F.expr(_KEY.replace("VARCHAR", "STRING"))
    return reduce(DataFrame.unionByName, each).select("assessment_family", "test_id", "metric_name", key.alias("key"), "metric_value")


@query(f"""WITH {D.limits_sql(1.2).replace(D.FACT_SQL, _FAMILY_FACT)} SELECT assessment_family, count(*) AS n_rows, count(*) FILTER (is_above) AS n_above, count(*) FILTER (is_below) AS n_below,
count(*) FILTER (is_above OR is_below) AS n_outside FROM labelled GROUP BY 1""")
def label_counts_of_all_families(spark, sf):
    return reduce(DataFrame.unionByName, [counts for _, counts in _refreshed(spark, sf, marts.FACTOR).values()])


def stale(rows: DataFrame, which) -> DataFrame:
    """``rows`` with other values and without some metrics where ``which`` says so."""
    wrong = F.coalesce(which, F.lit(False))
    return rows.where(~wrong | (F.col("metric_name") != "tax")).withColumn("metric_value", F.when(wrong, -1.0).otherwise(F.col("metric_value")))


_WINDOW = ("1996-01-01", "1997-01-01")


@query(f"WITH {_FAMILY_FACT} SELECT {ROWS} FROM fact")
def refresh_of_a_window(spark, sf):
    """The rows of a year are stale; a run over that year gives the whole fact again."""
    made = families(spark, sf)
    full = jobs.store_fact(jobs.refresh_fact(None, made))
    old = stale(full, scope.in_window(F.col("test_date"), *[F.lit(w).cast("timestamp") for w in _WINDOW]))
    return jobs.refresh_fact(old, made, window=_WINDOW).select(*ROWS.split(", "))


def _replay(spark, sf, selection: scope.Selection, which) -> jobs.Replay:
    """Orders are raw rows, ingested when ordered, in a batch for each priority; lines are what was typed from them."""
    made = families(spark, sf)
    o = t(spark, sf, "orders")
    raw = o.select(F.col("o_orderkey").alias("raw_id"), F.col("o_orderpriority").alias("batch_id"), F.lit("a").alias("source_account"), F.col("o_orderdate").cast("timestamp").alias("ingested_at"))
    tests = o.join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("test_id"), "c_mktsegment")
    lines = stored(t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("raw_id"), F.col("l_orderkey").alias("test_id")).join(tests, "test_id"), "typed", "c_mktsegment")
    typed = {family: [lines.where(F.col("c_mktsegment") == segment).select("raw_id", "test_id")] for segment, family in FAMILIES.items()}
    full = jobs.store_fact(jobs.refresh_fact(None, made))
    hit = o.where(which).select(F.col("o_orderkey").alias("test_id"), F.lit(True).alias("__hit")).distinct().hint("shuffle_hash")
    old = stale(full.join(hit, "test_id", "left"), F.col("__hit")).select(*full.columns)
    return jobs.replay(selection, raw, typed, made, old)


@query(f"WITH {_FAMILY_FACT} SELECT {ROWS} FROM fact")
def replay_of_batches(spark, sf):
    """The tests of two batches are stale; a replay of these batches gives the whole fact again."""
    batches = t(spark, sf, "orders").where("o_orderpriority in ('1-URGENT', '5-LOW')").select(F.col("o_orderpriority").alias("batch_id")).distinct()
    return _replay(spark, sf, scope.Selection(batches=batches), F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).fact.select(*ROWS.split(", "))


@query(f"WITH {_FAMILY_FACT} SELECT {ROWS} FROM fact")
def replay_after_a_cursor(spark, sf):
    """The raw rows after a cursor, within a window of ingestion."""
    cursor = spark.createDataFrame([("a", 1000)], "source_account string, last_raw_id long")
    chosen = scope.Selection(cursor=cursor, window=("1995-06-01", "1996-06-01"))
    ordered = F.col("o_orderdate").cast("timestamp")
    which = (F.col("o_orderkey") > 1000) & scope.in_window(ordered, *[F.lit(w).cast("timestamp") for w in chosen.window])
    return _replay(spark, sf, chosen, which).fact.select(*ROWS.split(", "))


#: A day on which clocks go forward in this zone, so that it has 23 hours: from 23:00 UTC the day before to 22:00 UTC.
DAY, ZONE = "1997-03-30", "Europe/Paris"


@query(f"""WITH x AS (SELECT o_orderkey AS test_id, {_FAMILY_SQL} AS family, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS seen FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
SELECT DISTINCT family, test_id FROM x WHERE seen >= TIMESTAMP '1997-03-29 23:00:00' AND seen < TIMESTAMP '1997-03-30 22:00:00' AND family IS NOT NULL""")
def replay_of_a_local_day(spark, sf):
    """The tests that a replay of one local day touches; orders are ingested at some hour of their day."""
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    hour = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    raw = o.select(F.col("o_orderkey").alias("raw_id"), (F.col("o_orderdate").cast("timestamp") + hour).alias("ingested_at"))
    known = o.select("o_orderkey", "c_mktsegment").hint("shuffle_hash")
    lines = t(spark, sf, "lineitem").select("l_orderkey").join(known, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderkey").alias("raw_id"), F.col("o_orderkey").alias("test_id"), "c_mktsegment")
    lines = stored(lines, "typed", "c_mktsegment")
    typed = {family: [lines.where(F.col("c_mktsegment") == segment).select("raw_id", "test_id")] for segment, family in FAMILIES.items()}
    return scope.Selection(day=(DAY, ZONE)).tests(raw, typed)


# payloads in their order, and what a load counts


@query("""SELECT event_id AS test_id, 'peak_force' AS metric_name, CASE WHEN event_id % 2 = 0 THEN value + 1 ELSE value END AS metric_value FROM events WHERE value IS NOT NULL
UNION ALL SELECT event_id, 'more_2_z', CAST(event_id AS DOUBLE) FROM events WHERE value IS NOT NULL AND event_id IS NOT NULL""")
def first_of_a_payload(spark, sf):
    """One metric is spelt in two ways in each payload; the one that is written first counts."""
    one, two = F.concat(F.lit('"peakForce": '), F.col("value")), F.concat(F.lit('"peak_force": '), F.col("value") + 1)
    more = F.concat(F.lit('"more": [{"someId": 3}, {"z": '), F.col("event_id"), F.lit("}]"))
    body = F.concat(F.lit("{"), F.when(F.col("event_id") % 2 == 0, F.concat_ws(", ", two, more, one)).otherwise(F.concat_ws(", ", one, two, more)), F.lit("}"))
    e = t(spark, sf, "events")
    base = e.select(F.col("event_id").alias("test_id"), F.lit(1).alias("profile_id"), F.col("ts").cast("timestamp").alias("test_date"), F.lit(None).cast("string").alias("side"), F.lit(1).alias("rep_number"), F.lit(None).cast("double").alias("unused"), body.alias("payload"))
    who = spark.range(1).select(F.lit(1).alias("profile_id"), F.lit(True).alias("is_active"))
    ids = ["test_id", "profile_id", "test_date", "side", "rep_number"]
    return fact.family_fact(base, who, ids, ["unused"], payload="payload").select("test_id", "metric_name", "metric_value")


@query("""SELECT 'attempted' AS what, count(*) AS n FROM orders UNION ALL SELECT 'loaded', count(*) FILTER (o_orderkey % 5 <> 0 AND o_orderstatus <> 'P') FROM orders
UNION ALL SELECT 'skipped', count(*) FILTER (o_orderkey % 5 = 0 OR o_orderstatus = 'P') FROM orders UNION ALL SELECT 'missing source_account', count(*) FILTER (o_orderstatus = 'P') FROM orders
UNION ALL SELECT 'missing team_id', count(*) FILTER (o_orderkey % 5 = 0 AND o_orderstatus <> 'P') FROM orders
UNION ALL SELECT 'written', count(DISTINCT CASE WHEN o_orderkey % 5 <> 0 AND o_orderstatus <> 'P' THEN o_orderstatus || '/' || (o_orderkey % 100) END) FROM orders""")
def load_counts(spark, sf):
    """Items of payloads, some without an id or an account; the run that writes the rows counts what it sees."""
    o = t(spark, sf, "orders")
    item = F.struct(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") % 100).alias("id"), F.col("o_orderpriority").alias("name"))
    account = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    raw = o.select(F.col("o_orderkey").alias("raw_id"), account.alias("source_account"), F.lit("{}").alias("request_params"), F.to_json(F.array(item)).alias("response_payload"))
    load = payloads.load(raw, "teams")
    written = stored(load.rows, "teams").count()
    counts = {**load.counts(), **dict.fromkeys(load.reasons, 0), **load.skipped(), "written": written}
    return spark.createDataFrame(list(counts.items()), "what string, n long")


# tables by month, in order, and in a database


@query("""SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1996-05-01' AND o_orderdate < TIMESTAMP '1996-06-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, strftime(o_orderdate, '%Y_%m') AS month FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-04-01' AND o_orderdate < TIMESTAMP '1996-08-01' AND NOT (o_orderdate >= TIMESTAMP '1996-05-01' AND o_orderdate < TIMESTAMP '1996-06-01' AND o_orderkey % 2 = 0)""")
def monthly_tables(spark, sf):
    """Orders by month; one month is written again, with other rows and prices; four months are read."""
    o, where = t(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"), fresh(spark, "months")
    landing.write_monthly(o, where, "o_orderdate")
    may = o.where("o_orderdate >= '1996-05-01' and o_orderdate < '1996-06-01' and o_orderkey % 2 <> 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    landing.write_monthly(may, where, "o_orderdate", mode="overwrite")
    return landing.read_months(spark, where, o.schema, dt.date(1996, 4, 1), dt.date(1996, 8, 1)).select("o_orderkey", "o_totalprice", "month")


@query("""WITH m AS (SELECT unnest(generate_series(DATE '1992-01-01', DATE '1998-03-01', INTERVAL 1 MONTH)) AS s) SELECT strftime(s, '%Y_%m') AS month, count(o_orderkey) AS n_rows
FROM m LEFT JOIN orders ON o_orderdate >= s AND o_orderdate < s + INTERVAL 1 MONTH GROUP BY 1 UNION ALL SELECT 'outside', count(*) FILTER (o_orderdate >= TIMESTAMP '1998-04-01' OR o_orderdate < TIMESTAMP '1992-01-01') FROM orders""")
def month_plan_rows(spark, sf):
    """The months that are planned, with the rows that fall in each, and how many fall in none."""
    plan = landing.month_plan(spark, dt.date(1996, 9, 15), first=dt.date(1992, 1, 1), ahead=18)
    o = t(spark, sf, "orders").where("o_orderdate is not null")
    placed = landing.planned(o, plan, "o_orderdate")
    n = placed.groupBy("month").agg(F.count("*").alias("n_rows"))
    each = plan.select("month").join(n, "month", "left").select("month", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    return each.unionByName(placed.agg(F.lit("outside").alias("month"), F.count_if(F.col("month").isNull()).alias("n_rows")))


@query("""SELECT o_custkey, o_orderdate, o_orderkey, row_number() OVER (ORDER BY o_custkey NULLS FIRST, o_orderdate NULLS FIRST, o_orderkey) AS place
FROM (SELECT CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS o_custkey, o_orderdate, o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def audit_in_order(spark, sf):
    """A table that is published in an order; a row's place is told from its file's name and its place in the file."""
    rows = t(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderdate", "o_orderkey")
    where = fresh(spark, "ordered")
    landing.publish(rows, where, "audit", order=["o_custkey", "o_orderdate", "o_orderkey"])
    return landing.in_order(landing.current(spark, where, "audit"), "place")


@query("""SELECT n_name, count(*) AS n_suppliers, round(sum(s_acctbal), 2) AS balance FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0 GROUP BY 1""")
def jdbc_round_trip(spark, sf):
    """Suppliers go to a database in batches, come back in four ranges of their key, meet their nation there, and the result goes the same way. The database here
    lives in the driver's process, so this query runs on one machine only; with a served database nothing else differs."""
    url, props = f"jdbc:derby:memory:{fresh(spark, 'db').rsplit('/', 1)[-1]};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    s = t(spark, sf, "supplier").where("s_suppkey is not null").select(*[F.col(c).alias(c.upper()) for c in ("s_suppkey", "s_nationkey", "s_acctbal")])
    landing.write_jdbc(s, url, "SUPPLIER", mode="overwrite", batch_size=1000, properties=props)
    bounds = landing.partition_bounds(s, "S_SUPPKEY").first()
    back = landing.read_jdbc(spark, url, "select S_SUPPKEY, S_NATIONKEY, S_ACCTBAL from SUPPLIER where S_ACCTBAL > 0", partition_column="S_SUPPKEY", bounds=(bounds.lower, bounds.upper + 1), partitions=4, properties=props)
    joined = back.join(t(spark, sf, "nation"), F.col("S_NATIONKEY") == F.col("n_nationkey"))
    report = joined.groupBy("n_name").agg(F.count("*").alias("n_suppliers"), F.round(F.sum("S_ACCTBAL"), 2).alias("balance"))
    landing.write_jdbc(report.select(F.col("n_name").alias("N_NAME"), F.col("n_suppliers").alias("N_SUPPLIERS"), F.col("balance").alias("BALANCE")), url, "REPORT", properties=props)
    got = landing.read_jdbc(spark, url, "select * from REPORT", properties=props)
    return got.select(F.col("N_NAME").alias("n_name"), F.col("N_SUPPLIERS").cast("long").alias("n_suppliers"), F.col("BALANCE").alias("balance"))


# audits


_WIDE_METRICS = {"left_force": "quantity", "right_force": "extendedprice / 1000", "lean": "discount * 1000 - 10"}
_WIDE_FACT = D.WIDE_SQL + ",\nfact AS (" + " UNION ALL ".join(f"SELECT {', '.join(D.IDS)}, '{m}' AS metric_name, {c} AS metric_value FROM wide" for m, c in _WIDE_METRICS.items()) + ")"
_WIDE_FLAGS = FLAGS_SQL.replace(D.FACT_SQL, _WIDE_FACT).replace(
    "SELECT *, 'range_violation' AS flag_type, 'critical' AS severity FROM picked WHERE metric_value < 0 OR (metric_name = 'quantity' AND metric_value > 49)",
    "SELECT *, 'range_violation' AS flag_type, 'critical' AS severity FROM picked WHERE metric_name = 'left_force' AND metric_value > 49 UNION ALL SELECT *, 'negative_value', 'critical' FROM picked WHERE metric_value < 0",
)


@query(f"""WITH {_WIDE_FLAGS}, pairs AS (SELECT test_id, rep_number, abs(quantity - extendedprice / 1000) / greatest(abs(quantity), abs(extendedprice / 1000)) * 100 AS pct FROM wide WHERE abs(quantity) >= 5 AND abs(extendedprice / 1000) >= 5)
SELECT test_id, rep_number, metric_name, flag_type, severity FROM flagged
UNION ALL SELECT test_id, rep_number, 'force', 'asymmetry_extreme', CASE WHEN pct >= 25 THEN 'critical' ELSE 'warning' END FROM pairs WHERE pct >= 15""")
def wide_audit(spark, sf):
    """A table with a column for each metric: negative values, ranges, modified z, fences, and left against right."""
    w = D.wide(spark, sf).select(*D.IDS, *[F.expr(c).alias(m) for m, c in _WIDE_METRICS.items()])
    rules = spark.createDataFrame(
        [(f, m, True, None, 49.0 if m == "left_force" else None, 0.5, 1.2, 1.4) for f in FAMILIES for m in _WIDE_METRICS],
        "assessment_family string, metric_name string, non_negative boolean, abs_min double, abs_max double, fence double, z_warning double, z_critical double",
    )
    pairs = [quality.Pair("force", "left_force", "right_force", least=5)]
    return jobs.audit_wide(stored(w, "wide"), D.IDS, list(_WIDE_METRICS), rules, pairs=pairs).select("test_id", "rep_number", "metric_name", "flag_type", "severity")


_STEPS = ["1994-01-01", "1996-01-01", "1997-01-01", "2100-01-01"]


@query("SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1")
def incremental_runs(spark, sf):
    """Four runs over orders, each from where the last good one began; the second breaks off and the third fails, so the fourth takes up their rows, and a
    run that is asked for again does nothing."""
    o, log = t(spark, sf, "orders").where("o_orderdate is not null"), RunLog(spark, fresh(spark, "runs"))

    def work(until: str, breaks: type | None = None):
        def go(since, current):
            rows = o.where(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))
            rows = rows if since is None else rows.where(F.col("o_orderdate") >= F.lit(str(since)).cast("timestamp_ntz"))
            new = rows.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max("o_orderdate").alias("last_order"))
            if breaks:
                raise breaks("on purpose")
            both = new if current is None else current.unionByName(new)
            return both.groupBy("o_custkey").agg(F.sum("n_orders").alias("n_orders"), F.max("last_order").alias("last_order"))

        return go

    for k, (until, breaks) in enumerate(zip(_STEPS, (None, KeyboardInterrupt, ValueError, None), strict=True)):
        for _ in range(2):
            try:
                log.run("orders", f"run {k}", work(until, breaks), started=dt.datetime.fromisoformat(until))
            except (ValueError, KeyboardInterrupt):
                continue
    return log.current("orders")


@query(f"WITH {MEMBERS_SQL} SELECT c_custkey AS profile_id, 'tenant ' || c_custkey % 4 AS tenant_id, c_name AS full_name, group_id FROM customer JOIN m ON c_custkey = profile_id WHERE include_in_gold AND c_custkey % 4 <> 3")
def profiles_by_tenant(spark, sf):
    """Profiles meet their membership by profile and tenant; a membership of another tenant is none."""
    tenant = lambda c: F.concat(F.lit("tenant "), (F.col(c) % 4).cast("string"))
    members = _members(spark, sf).withColumn("tenant_id", F.when(F.col("profile_id") % 4 != 3, tenant("profile_id")).otherwise("elsewhere"))
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("profile_id"), tenant("c_custkey").alias("tenant_id"), F.col("c_name").alias("given_name"), F.lit(" ").alias("family_name"))
    return dims.scoped_profiles(c, members).select("profile_id", "tenant_id", "full_name", "group_id")


@query(" UNION ALL ".join(f"SELECT '{m}' AS source_module, o_orderpriority AS test_name, count(DISTINCT o_orderkey) AS n_tests, max(o_orderdate) AS last_date FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = '{s}' GROUP BY 2" for s, m in FAMILIES.items()))
def source_catalogs(spark, sf):
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", F.col("o_orderpriority").alias("test_name"), F.col("o_orderkey").alias("test_id"), F.col("o_orderdate").alias("test_date"))
    return coverage.source_catalog({m: o.where(F.col("c_mktsegment") == s) for s, m in FAMILIES.items()})


# facts of the families whose tests have metrics beside them, with who may enter

_ENTRY = fact.Entry("1993-01-01", "1996-01-01", 5)
#: Tests that may enter: those from the cutoff on, and from the gate on those of profiles with five tests since then.
_ENTRY_SQL = """enough AS (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1 HAVING count(DISTINCT o_orderkey) >= 5),
o AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0 AND o_orderdate >= TIMESTAMP '1993-01-01' AND (o_orderdate < TIMESTAMP '1996-01-01' OR o_custkey IN (SELECT o_custkey FROM enough)))"""


def _profiles(spark, sf) -> DataFrame:
    return t(spark, sf, "customer").select(F.col("c_custkey").alias("profile_id"), (F.col("c_acctbal") > 0).alias("is_active"), F.col("c_nationkey").alias("team_group_id"))


def _tested(spark, sf, *more) -> DataFrame:
    return t(spark, sf, "orders").where("o_orderkey is not null").select(F.col("o_orderkey").alias("test_id"), F.col("o_custkey").alias("profile_id"), F.col("o_orderdate").cast("timestamp").alias("modified_at"), F.lit(None).cast("timestamp").alias("test_date"), F.lit(None).cast("string").alias("side"), F.lit(None).cast("int").alias("rep_number"), *more)


@query(f"""WITH {_ENTRY_SQL}, m AS (SELECT * FROM o WHERE o_orderstatus <> 'P' AND o_totalprice IS NOT NULL)
SELECT o_orderkey AS test_id, c_nationkey AS team_group_id, 'left' AS side, 'max_force' AS metric_name, 'N' AS metric_unit, o_totalprice AS metric_value FROM o WHERE o_totalprice IS NOT NULL
UNION ALL SELECT o_orderkey, c_nationkey, 'right', 'torque', 'Nm', o_totalprice + 1 FROM o WHERE o_totalprice IS NOT NULL UNION ALL SELECT o_orderkey, c_nationkey, NULL, 'deep_2_power_w', NULL, o_totalprice FROM m""")
def hamstring_fact(spark, sf):
    """Tests with their columns and, if there are any, their metrics; a column goes before a metric of its name."""
    tests = _tested(spark, sf, F.col("o_totalprice").alias("left_max_force"), (F.col("o_totalprice") + 1).alias("right_torque"))
    found = t(spark, sf, "orders").where("o_orderstatus <> 'P'")
    body = F.to_json(F.struct(F.lit(-5).alias("leftMaxForce"), F.array(F.struct(F.lit(None).cast("double").alias("powerW")), F.struct(F.col("o_totalprice").alias("powerW"))).alias("deep"), F.lit(4).alias("testId")))
    base = fact.with_metrics(tests, found.select(F.col("o_orderkey").alias("test_id"), body.alias("metrics")))
    rows = fact.family_fact(base, _profiles(spark, sf), ["test_id", "profile_id", "test_date", "side", "rep_number"], ["left_max_force", "right_torque"], payload="payload", entry=_ENTRY)
    return rows.select("test_id", "team_group_id", "side", "metric_name", "metric_unit", "metric_value")


@query(f"""WITH {_ENTRY_SQL} SELECT o_orderkey AS test_id, side, 'max_force' AS metric_name, o_totalprice AS metric_value FROM o, (VALUES ('inner_left'), ('inner_right'), ('outer_left'), ('outer_right')) AS s(side) WHERE o_totalprice IS NOT NULL""")
def frame_fact(spark, sf):
    """Four forces of a frame, their sides told from the columns' names."""
    names = [f"{a}_{b}_max_force" for a in ("inner", "outer") for b in ("left", "right")]
    tests = fact.with_metrics(_tested(spark, sf, *[F.col("o_totalprice").alias(n) for n in names]), spark.createDataFrame([], "test_id long, metrics string"))
    rows = fact.family_fact(tests, _profiles(spark, sf), ["test_id", "profile_id", "test_date", "side", "rep_number"], names, payload="payload", entry=_ENTRY)
    return rows.select("test_id", "side", "metric_name", "metric_value")


@query(f"""WITH {D.WIDE_SQL.split(",{chr(10)}wide AS")[0]}, enough AS (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1 HAVING count(DISTINCT o_orderkey) >= 5),
r AS (SELECT l_orderkey, o_custkey, l_linenumber, l_quantity, CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate ELSE o_orderdate END AS d, CASE l_returnflag WHEN 'R' THEN 'right' WHEN 'A' THEN 'left' ELSE 'bilateral' END AS side
  FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0 AND l_quantity IS NOT NULL),
k AS (SELECT * FROM r WHERE d >= TIMESTAMP '1993-01-01' AND (d < TIMESTAMP '1996-01-01' OR o_custkey IN (SELECT o_custkey FROM enough)))
SELECT l_orderkey AS test_id, 'jump_peak_force' AS metric_name, side, dense_rank() OVER (PARTITION BY l_orderkey, side ORDER BY d, l_linenumber) AS rep_number, l_quantity AS metric_value FROM k""")
def plates_fact(spark, sf):
    """Results of trials: a result's date is its trial's or one of its test's three; repetitions are the trials' ranks."""
    lines = D.lines(spark, sf).where("l_orderkey is not null")
    trial = F.format_string("%d/%02d", "l_orderkey", "l_linenumber")
    limb = F.when(F.col("l_returnflag") == "R", "RightSide").when(F.col("l_returnflag") == "A", "Left")
    results = lines.join(t(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.lit("r1").alias("result_id"), trial.alias("trial_id"), F.col("l_orderkey").alias("test_id"), F.col("o_custkey").alias("profile_id"), limb.alias("limb"), F.lit(0).alias("repeat"), F.col("l_quantity").cast("string").alias("value"))
    at, third = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey") % 3
    tests = t(spark, sf, "orders").select(F.col("o_orderkey").alias("test_id"), F.col("o_custkey").alias("profile_id"), F.lit("k").alias("test_type"), F.when(third == 0, at).alias("test_date"), F.when(third <= 1, at).alias("analysed_at"), at.alias("modified_at"))
    trials = lines.select(trial.alias("trial_id"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_shipdate").cast("timestamp")).alias("trial_date"), F.lit("Both").alias("limb"))
    defs = spark.createDataFrame([("r1", "Jump", "Peak Force", "N")], "result_id string, result_group string, result_name string, result_unit string")
    rows = fact.trial_fact(results, tests, trials, defs, _profiles(spark, sf), entry=_ENTRY)
    return rows.select("test_id", "metric_name", "side", F.col("rep_number").cast("long").alias("rep_number"), "metric_value")


@query("""SELECT o_orderkey, o_orderkey % 2 = 0 OR o_orderdate >= TIMESTAMP '1995-01-01' AS is_recent_activity FROM orders WHERE CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1996-06-30 23:00:00' ELSE o_orderdate END >= TIMESTAMP '1996-06-30 23:00:00'""")
def cutoff_scope(spark, sf):
    """The first date that can be read decides; an activity without a start is kept."""
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.when(F.col("o_orderkey") % 3 == 0, "1996-06-30T23:00:00Z").otherwise("no date").alias("first"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("second"))
    late = scope.after_cutoff(o, ["first", "second"], "1996-06-30T23:00:00Z")
    started = late.withColumn("start", F.when(F.col("o_orderkey") % 2 != 0, F.col("o_orderdate").cast("timestamp")))
    recent = scope.activity_after(started, "start", "1995-01-01").select(F.col("o_orderkey").alias("__k")).distinct()
    return late.join(recent, F.col("o_orderkey") == F.col("__k"), "left").select("o_orderkey", F.col("__k").isNotNull().alias("is_recent_activity"))


@query("""SELECT c_custkey AS profile_id, CASE WHEN c_custkey % 3 <> 0 THEN 'new ' || c_name ELSE c_name END AS full_name, c_custkey % 3 <> 0 OR c_acctbal > 0 AS is_active,
CASE WHEN c_custkey % 5 = 0 AND c_custkey % 3 <> 0 THEN TIMESTAMP '2025-01-01' WHEN c_custkey % 5 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01' END AS first_seen_at FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey % 3 <> 0""")
def profile_upsert(spark, sf):
    """Profiles that come again are updated and active, keep the time they were first seen, and new ones come in."""
    c = t(spark, sf, "customer")
    seen = lambda text: F.lit(text).cast("timestamp")
    old = c.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("profile_id"), F.col("c_name").alias("full_name"), (F.col("c_acctbal") > 0).alias("is_active"), F.lit(None).cast("timestamp").alias("deactivated_at"), seen("2024-01-01").alias("first_seen_at"))
    new = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("profile_id"), F.concat(F.lit("new "), "c_name").alias("full_name"), F.lit(True).alias("is_active"), F.lit(None).cast("timestamp").alias("deactivated_at"), seen("2025-01-01").alias("first_seen_at"))
    return dims.upsert_profiles(old, new).select("profile_id", "full_name", "is_active", F.col("first_seen_at").cast("timestamp_ntz").alias("first_seen_at"))


_RENAMED = {"quantity": "max_force", "extendedprice": "avg_force", "discount": "impulse", "tax": "repetitions"}
_RULED = _FAMILY_FACT
for _a, _b in _RENAMED.items():
    _RULED = _RULED.replace(f"'{_a}' AS metric_name, {_a} AS metric_value", f"'{_b}' AS metric_name, {f'{_a} * 2000 - 40' if _a == 'tax' else _a} AS metric_value")
_LONG_FLAGS = FLAGS_SQL.replace(D.FACT_SQL, _RULED).replace("* 0.5, 9)", "* 2.0, 9)").replace(">= 1.4 THEN", ">= 3.5 THEN").replace(">= 1.2", ">= 2.5").replace(
    "SELECT *, 'range_violation' AS flag_type, 'critical' AS severity FROM picked WHERE metric_value < 0 OR (metric_name = 'quantity' AND metric_value > 49)",
    "SELECT *, 'range_violation' AS flag_type, 'critical' AS severity FROM picked WHERE metric_name = 'repetitions' AND (metric_value < 0 OR metric_value > 100) UNION ALL SELECT *, 'negative_value', 'critical' FROM picked WHERE metric_value < 0",
)


@query(f"""WITH {_LONG_FLAGS} SELECT test_id, rep_number, metric_name, flag_type, severity, 'open' AS status FROM flagged
WHERE assessment_family IN ('hamstring', 'frame') AND metric_name IN ('max_force', 'avg_force', 'impulse', 'repetitions') OR assessment_family = 'dynamometer' AND metric_name IN ('max_force', 'avg_force')""")
def long_audit(spark, sf):
    """The fact of all families by the rules of each; only metrics that have a rule are looked at. A first run, and a second one that changes nothing."""
    rows = jobs.store_fact(jobs.refresh_fact(None, families(spark, sf)))
    name = F.coalesce(*[F.when(F.col("metric_name") == a, b) for a, b in _RENAMED.items()])
    value = F.when(F.col("metric_name") == "tax", F.col("metric_value") * 2000 - 40).otherwise(F.col("metric_value"))
    rows = rows.select(*[c for c in rows.columns if not c.startswith("metric_")], name.alias("metric_name"), value.alias("metric_value"))
    first = stored(jobs.audit(rows, quality.rule_table(spark), at_rest=True), "flags")
    return jobs.audit(rows, quality.rule_table(spark), first, at_rest=True).select("test_id", "rep_number", "metric_name", "flag_type", "severity", "status")


@query("""WITH d AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS n, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS many FROM orders)
SELECT o_custkey, o_orderpriority, o_orderkey, many AS n_rows FROM d WHERE n = 1 AND many > 1""")
def key_repair(spark, sf):
    """Rows that share a natural key, and which of them stays."""
    o, keys = t(spark, sf, "orders"), ["o_custkey", "o_orderpriority"]
    twice = merge.duplicates_of_key(o, keys)
    kept = merge.latest(o, keys, [F.desc("o_orderdate"), F.desc("o_orderkey")]).select(*[F.col(k).alias(f"k_{k}") for k in keys], "o_orderkey")
    return twice.join(kept, merge.reduce(merge.and_, [twice[k].eqNullSafe(kept[f"k_{k}"]) for k in keys])).select(*keys, "o_orderkey", "n_rows")


@query("""WITH e AS (SELECT CAST(event_id % 40 AS VARCHAR) AS batch_id, 'api ' || event_id % 4 AS api, user_id % 3 AS kind, event_id, ts FROM events),
s AS (SELECT batch_id, arg_max(CASE kind WHEN 0 THEN 'started' WHEN 1 THEN 'completed' ELSE 'failed' END, event_id) AS status FROM e GROUP BY 1),
l AS (SELECT api, batch_id FROM e WHERE kind = 1 QUALIFY row_number() OVER (PARTITION BY api ORDER BY ts DESC, batch_id DESC) = 1)
SELECT s.batch_id, status, l.api AS latest_of FROM s LEFT JOIN l ON s.batch_id = l.batch_id""")
def batch_log(spark, sf):
    """What became of each batch, and which completed batch is the latest of its interface."""
    status = F.when(F.col("user_id") % 3 == 0, "started").when(F.col("user_id") % 3 == 1, "completed").otherwise("failed")
    log = t(spark, sf, "events").select((F.col("event_id") % 40).cast("string").alias("batch_id"), F.concat(F.lit("api "), (F.col("event_id") % 4).cast("string")).alias("api"), status.alias("status"), F.col("event_id").alias("logged_at"), F.col("ts").alias("started_at"))
    last = ops.last_batches(log, ["api"]).select(F.col("batch_id").alias("__b"), F.col("api").alias("latest_of"))
    return ops.batch_states(log).join(last, F.col("batch_id") == F.col("__b"), "left").select("batch_id", "status", "latest_of")


@query("""WITH x AS (SELECT c_mktsegment AS table_name, max(o_orderdate) AS last FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
y AS (SELECT table_name, (epoch(TIMESTAMP '1998-08-05 00:00:00') - epoch(last)) / 3600 AS lag FROM x)
SELECT table_name, round(CASE WHEN lag > 6 THEN lag ELSE 1 END, 6) AS value, CASE WHEN lag > 6 AND table_name = 'BUILDING' THEN 'ignored' WHEN lag > 6 THEN 'open' WHEN table_name = 'BUILDING' THEN 'ignored' WHEN table_name = 'MACHINERY' THEN 'resolved' ELSE 'superseded' END AS status FROM y
WHERE lag > 6 OR table_name IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""")
def freshness_flags(spark, sf):
    """Flags of late tables over those there are: an open one that is in time again is superseded, a resolved one whose value changed opens again."""
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    tables = {s: (o.where(F.col("c_mktsegment") == s), "o_orderdate") for s in FAMILIES}
    lag = ops.freshness(tables, F.lit("1998-08-05 00:00:00"))
    old = spark.createDataFrame([("MACHINERY", 1.0, "resolved"), ("HOUSEHOLD", 1.0, "open"), ("BUILDING", 1.0, "ignored")], "table_name string, value double, status string")
    got = ops.freshness_flags(old, lag.select("table_name", "lag_hours", "severity"))
    # a flag that a person has set aside keeps its value
    late = lag.where("severity is not null").select(F.col("table_name").alias("__t"), "lag_hours")
    return got.join(late, F.col("table_name") == F.col("__t"), "left").select("table_name", F.round(F.coalesce("lag_hours", "value"), 6).alias("value"), "status")


@query("""WITH p AS (SELECT count(*) AS n, count(*) FILTER (c_custkey IS NULL) AS a, count(*) FILTER (c_name IS NULL OR trim(c_name) = '') AS b FROM customer),
r AS (SELECT count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)) AS lost FROM orders WHERE o_custkey IS NOT NULL)
SELECT 'required column' AS "check", 'c_custkey' AS subject, a = 0 AS passed FROM p UNION ALL SELECT 'required column', 'c_name', b = 0 FROM p UNION ALL SELECT 'orphans', 'orders', lost = 0 FROM r UNION ALL SELECT 'rows', 'table', n > 0 FROM p""")
def review(spark, sf):
    c = t(spark, sf, "customer")
    audit.check_columns(c, ["c_custkey", "c_name"], ["c_secret"])
    lost = audit.orphans([audit.Relation("orders", t(spark, sf, "orders"), c, {"o_custkey": "c_custkey"})])
    return audit.review(audit.column_profile(c, ["c_custkey", "c_name"]), lost, ["c_custkey", "c_name"])


@query("""WITH e AS (SELECT DISTINCT o_custkey AS a, CAST(year(o_orderdate) AS INTEGER) AS b FROM orders WHERE o_orderstatus <> 'P'), x AS (SELECT DISTINCT o_custkey AS a, CAST(year(o_orderdate) AS INTEGER) AS b FROM orders WHERE o_totalprice > 100000)
SELECT * FROM (SELECT a, b, 'missing' AS status FROM (SELECT * FROM e EXCEPT SELECT * FROM x) ORDER BY a NULLS FIRST, b LIMIT 10) UNION ALL SELECT * FROM (SELECT a, b, 'extra' FROM (SELECT * FROM x EXCEPT SELECT * FROM e) ORDER BY a NULLS FIRST, b LIMIT 10)""")
def pair_samples(spark, sf):
    """The first pairs of a report, ten of each kind."""
    o = t(spark, sf, "orders").select(F.col("o_custkey").alias("a"), F.year("o_orderdate").alias("b"), "o_orderstatus", "o_totalprice")
    return audit.samples(audit.pair_coverage(o.where("o_orderstatus <> 'P'"), o.where("o_totalprice > 100000"), ["a", "b"]), ["a", "b"], 10)


@query("SELECT event_id AS raw_id, user_id FROM events WHERE event_id > 100 ORDER BY event_id LIMIT 250")
def replay_page(spark, sf):
    """A page of raw rows after the last one seen."""
    return ops.page_after(t(spark, sf, "events").select(F.col("event_id").alias("raw_id"), "user_id"), 100, 250)


@query("""SELECT o_orderkey, strftime(o_orderdate + INTERVAL 1 HOUR, '%Y-%m-%d') AS local_day, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE o_custkey END AS first_number, round((o_totalprice - 1000) / 250, 9) AS z,
CASE o_orderkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END AS n_items FROM orders WHERE o_orderkey IS NOT NULL AND month(o_orderdate) IN (1, 2, 12)""")
def scalar_rest(spark, sf):
    """Local days of epochs in winter, first numbers of maps, standard z, items of payloads of any shape."""
    o = t(spark, sf, "orders").where("o_orderkey is not null and month(o_orderdate) in (1, 2, 12)")
    k = F.col("o_orderkey") % 4
    fields = F.create_map(F.lit("id"), F.lit("9"), F.lit("note"), F.lit("x"), F.lit("some"), F.col("o_custkey").cast("string"), F.lit("height"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice").cast("string")).otherwise("none"))
    payload = F.when(k == 0, "[1, 2, 3]").when(k == 1, '{"a": 1}').when(k == 2, '{"items": [1, 2]}').otherwise("7")
    epoch = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("string")
    z = S.standard_z(F.col("o_totalprice"), F.lit(1000.0), F.lit(250.0))
    return o.select("o_orderkey", S.local_date(epoch, "Europe/Paris").cast("string").alias("local_day"), S.first_number(fields, ["height"], ["id"]).alias("first_number"), F.round(z, 9).alias("z"), payloads.count_items(payload).cast("int").alias("n_items"))
