"""Queries of payload shapes: the tables' rows written as the JSON that a source would send, read as typed rows again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources import payloads
from ..sources.stored import stored
from . import driver as D
from .queries import _LINES_SQL, dealt, query, t

KNOWN = "o_orderkey IS NOT NULL"


def obj(**fields: Column | str) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(k) for k, c in fields.items()])


def raw(rows: DataFrame, payload: Column, params: Column | None = None, account: Column | None = None) -> DataFrame:
    """Raw rows of ``rows`` (with raw_id), the payload as JSON."""
    asked = F.lit("{}") if params is None else F.to_json(params)
    return rows.select("raw_id", (F.lit(None).cast("string") if account is None else account).alias("source_account"), asked.alias("request_params"), F.to_json(payload).alias("response_payload"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _orders(spark, sf) -> DataFrame:
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return dealt(t(spark, sf, "orders").where(KNOWN)).select(F.col("o_orderkey").alias("raw_id"), F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderpriority").alias("p"), at.alias("at"), F.col("o_totalprice").alias("v"))


_TEST = "CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS profile_id"


@query(
    "SELECT 'profiles' AS shape, CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey AS VARCHAR) AS profile_id, c_name AS kind, TIMESTAMP '1990-01-02' AS happened, CAST(NULL AS DOUBLE) AS number FROM customer WHERE c_custkey IS NOT NULL"
    + "".join(
        f" UNION ALL SELECT '{shape}', {_TEST}, {kind}, o_orderdate, {number} FROM orders WHERE {KNOWN}"
        for shape, kind, number in (
            ("plate_tests", "o_orderpriority", "o_totalprice"), ("frame_tests", "o_orderpriority", "o_totalprice"), ("hamstring_tests", "o_orderpriority", "o_totalprice"),
            ("gate_summaries", "o_orderpriority", "7"), ("dynamo_tests", "o_orderpriority", "NULL"),
        )
    )
)
def payload_tests(spark, sf):
    """Profiles and the tests of five families, each with its own names for the same things."""
    o = _orders(spark, sf)
    c = dealt(t(spark, sf, "customer").where("c_custkey is not null")).withColumn("raw_id", F.col("c_custkey"))
    none = F.lit(None)

    def of(shape: str, rows: DataFrame, payload: Column, id_: str, profile: str, kind: str, at: Column, number: Column) -> DataFrame:
        got = payloads.flatten(raw(rows, payload), shape)
        return got.select(F.lit(shape).alias("shape"), F.col(id_).alias("id"), F.col(profile).alias("profile_id"), F.col(kind).alias("kind"), at.cast("timestamp_ntz").alias("happened"), number.cast("double").alias("number"))

    return union([
        of("profiles", c, F.array(obj(profileId="c_custkey", teamId=F.lit("t"), givenName="c_name", familyName=F.lit(" "), dateOfBirth=F.lit("1990-01-02"))), "profile_id", "profile_id", "given_name", F.col("date_of_birth").cast("timestamp"), none),
        of("plate_tests", o, F.array(obj(id="k", athleteId="c", testType="p", weight="v", recordedDateUtc="at")), "test_id", "profile_id", "test_type", F.col("recorded_at"), F.col("weight")),
        of("frame_tests", o, obj(items=F.array(obj(testId="k", hubAthleteId="c", testTypeName="p", testDateUTC="at", innerLeftMaxForce="v"))), "test_id", "profile_id", "test_type", F.col("test_date"), F.col("inner_left_max_force")),
        of("hamstring_tests", o, obj(testId="k", profileId="c", testType="p", testDateUtc="at", leftMaxForce=F.col("v").cast("string")), "test_id", "profile_id", "test_type", F.col("test_date"), F.col("left_max_force")),
        of("gate_summaries", o, F.array(obj(id="k", profileId="c", testName="p", testDateUtc="at", repCount=F.lit("7"))), "test_id", "profile_id", "test_name", F.col("test_date"), F.col("rep_count")),
        of("dynamo_tests", o, F.array(obj(id="k", athleteId="c", bodyRegion="p", startTimeUTC="at")), "test_id", "profile_id", "body_region", F.col("start_at"), none),
    ])


_ORDERED = f"{_LINES_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS place FROM lines WHERE l_orderkey IS NOT NULL)"


@query(
    f"WITH {_ORDERED} SELECT 'plate_definitions' AS shape, CAST(p_partkey AS VARCHAR) AS id, p_brand AS part, CAST(NULL AS DOUBLE) AS number FROM part WHERE p_partkey IS NOT NULL"
    + "".join(f" UNION ALL SELECT '{s}', CAST(o_orderkey AS VARCHAR), {part}, {number} FROM orders WHERE {KNOWN}" for s, part, number in (
        ("plate_trials", "o_orderpriority", "NULL"), ("frame_metrics", "'t'", "o_totalprice"), ("hamstring_metrics", "'t'", "o_totalprice"), ("hamstring_exercises", "o_orderpriority", "NULL"),
        ("gate_details", "CAST(o_custkey AS VARCHAR)", "o_totalprice"), ("dynamo_traces", "'t'", "o_totalprice")))
    + "".join(f" UNION ALL SELECT '{s}', CAST(l_orderkey AS VARCHAR), {part}, {number} FROM n" for s, part, number in (
        ("hamstring_repetitions", "CAST(l_linenumber AS VARCHAR)", "l_quantity"), ("gate_reps", "CAST(place AS VARCHAR)", "l_tax"), ("dynamo_summaries", "'m' || l_linenumber", "l_quantity"), ("dynamo_repetitions", "CAST(place AS VARCHAR)", "l_tax")))
)
def payload_details(spark, sf):
    """What belongs to a test: definitions, trials, metrics as they came, exercises, repetitions with and without a number, summaries, traces."""
    o, asked = _orders(spark, sf), obj(testId="k", tenantId=F.lit("t"))
    p = dealt(t(spark, sf, "part").where("p_partkey is not null")).withColumn("raw_id", F.col("p_partkey"))
    fields = obj(n="l_linenumber", key=F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")), q="l_quantity", x="l_tax")
    each = D.lines(spark, sf).where("l_orderkey is not null").groupBy(F.col("l_orderkey").alias("raw_id")).agg(F.array_sort(F.collect_list(fields)).alias("items")).withColumn("k", F.col("raw_id"))
    each = stored(each, "each")  # four payloads are made of it
    inner = lambda f: F.transform("items", f)
    one = lambda **c: F.struct(*[v.alias(k) for k, v in c.items()])

    def of(shape: str, rows: DataFrame, payload: Column, id_: str, part: str, number: Column, params: Column | None = None) -> DataFrame:
        got = payloads.flatten(raw(rows, payload, params), shape)
        return got.select(F.lit(shape).alias("shape"), F.col(id_).alias("id"), F.col(part).cast("string").alias("part"), number.cast("double").alias("number"))

    inside = lambda column, path: F.get_json_object(F.col(column), path)
    none = F.lit(None)
    return union([
        of("plate_definitions", p, obj(resultDefinitions=F.array(obj(resultId="p_partkey", resultName="p_brand", resultUnit=F.lit("N")))), "result_id", "result_name", none),
        of("plate_trials", o, F.array(obj(id="k", testId="c", recordedUTC="at", limb="p")), "trial_id", "limb", none),
        of("frame_metrics", o, obj(x="v"), "test_id", "tenant_id", inside("metrics", "$.x"), asked),
        of("hamstring_metrics", o, obj(x="v"), "test_id", "tenant_id", inside("metrics", "$.x"), asked),
        of("hamstring_exercises", o, F.array(obj(exerciseId="k", exerciseName="p", startUtc="at")), "test_id", "name", none, asked),
        of("gate_details", o, obj(athleteId="c", additionalTestResult=obj(a="v")), "test_id", "profile_id", inside("results", "$.a"), asked),
        of("dynamo_traces", o, obj(points=F.array("v", "v")), "test_id", "tenant_id", inside("trace", "$.points[1]"), asked),
        of("hamstring_repetitions", each, inner(lambda i: one(repetitionId=i["key"], number=i["n"], leftForce=i["q"])), "exercise_id", "number", F.col("left_force"), obj(exerciseId="k")),
        of("gate_reps", each, obj(id="k", repResults=inner(lambda i: one(reactionTime=i["x"], z=F.lit(1)))), "test_id", "rep_number", F.col("reaction_time")),
        of("dynamo_summaries", each, F.array(obj(id="k", repetitionSummaries=inner(lambda i: one(movementType=F.concat(F.lit("m"), i["n"].cast("string")), side=F.lit("left"), maxForce=i["q"])))), "test_id", "movement_type", F.col("max_force_newtons")),
        of("dynamo_repetitions", each, obj(repetitions=inner(lambda i: one(laterality=F.lit("LeftSide"), impulse=i["x"]))), "test_id", "repetition_number", F.col("impulse_ns"), obj(testId="k")),
    ])


_NAMED = ("teams", "positions", "parameters", "venues", "tag_types")


@query(
    " UNION ALL ".join(f"SELECT '{s}' AS shape, a AS source_account, CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CAST(NULL AS DOUBLE) AS number FROM nation, (VALUES ('a'), ('b')) AS x(a)" for s in _NAMED)
    + """ UNION ALL SELECT 'tags', a, CAST(c_custkey AS VARCHAR), c_mktsegment, c_nationkey FROM customer, (VALUES ('a'), ('b')) AS x(a) WHERE c_custkey IS NOT NULL
UNION ALL SELECT 'athletes', a, CAST(c_custkey AS VARCHAR), c_name || ' Lee', c_nationkey FROM customer, (VALUES ('a'), ('b')) AS x(a) WHERE c_custkey IS NOT NULL"""
    + "".join(f" UNION ALL SELECT '{s}', a, CAST(o_orderkey AS VARCHAR), o_orderpriority, {n} FROM orders, (VALUES ('a'), ('b')) AS x(a) WHERE {KNOWN}" for s, n in (("activities", "epoch(TIMESTAMP '2000-01-01') - epoch(o_orderdate)"), ("periods", "o_custkey")))
)
def payload_tracking(spark, sf):
    """Dimensions, athletes, activities and periods of two accounts with the same ids; the account is the raw row's."""
    n = t(spark, sf, "nation").withColumn("raw_id", F.col("n_nationkey").cast("long"))
    c = dealt(t(spark, sf, "customer").where("c_custkey is not null")).withColumn("raw_id", F.col("c_custkey"))
    o = _orders(spark, sf)

    def of(shape: str, rows: DataFrame, payload: Column, id_: str, name: Column, number: Column, params: Column | None = None, then=lambda df: df) -> DataFrame:
        two = raw(rows, payload, params).withColumn("source_account", F.explode(F.array(F.lit("a"), F.lit("b"))))  # rows are read once for both
        got = payloads.athletes(two) if shape == "athletes" else payloads.flatten(two, shape)
        return then(got).select(F.lit(shape).alias("shape"), "source_account", F.col(id_).alias("id"), name.alias("name"), number.cast("double").alias("number"))

    named = F.array(obj(id="n_nationkey", name="n_name", slug=F.lower("n_name"), unit=F.lit("m")))
    return union([
        *[of(s, n, named, f"{s[:-1]}_id", F.col("name"), F.lit(None)) for s in _NAMED],
        of("tags", c, F.array(obj(id="c_custkey", name="c_mktsegment", tag_type=obj(id="c_nationkey"))), "tag_id", F.col("name"), F.col("tag_type_id")),
        of("athletes", c, obj(items=F.array(obj(id="c_custkey", first_name="c_name", last_name=F.lit(" Lee "), current_team=obj(id="c_nationkey"), is_synced=F.lit(1)))), "athlete_id", F.col("full_name"), F.col("team_id")),
        of("activities", o, F.array(obj(id="k", name="p", start_time="at", end_time=F.lit("2000-01-01T00:00:00Z"))), "activity_id", F.col("name"), F.col("duration"), None, payloads.with_duration),
        of("periods", o, F.array(obj(id="k", name="p", start_time="at")), "period_id", F.col("name"), F.col("activity_id"), obj(activity_id="c")),
    ])


@query(f"""SELECT 'sensor' AS shape, CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d') AS part, o_totalprice AS number FROM orders WHERE {KNOWN} UNION ALL SELECT 'sensor', CAST(o_orderkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), o_totalprice + 1 FROM orders WHERE {KNOWN}
UNION ALL SELECT 'efforts', CAST(o_orderkey AS VARCHAR), 'velocity_band_' || o_orderkey % 7, o_totalprice FROM orders WHERE {KNOWN} UNION ALL SELECT 'efforts', CAST(o_orderkey AS VARCHAR), 'acceleration_band_-1', 5 FROM orders WHERE {KNOWN} AND o_orderkey % 2 = 0
UNION ALL SELECT 'events', CAST(o_orderkey AS VARCHAR), 'jump', o_totalprice FROM orders WHERE {KNOWN} UNION ALL SELECT 'events', CAST(o_orderkey AS VARCHAR), 'new_kind', NULL FROM orders WHERE {KNOWN}
UNION ALL SELECT 'entity_tags', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), NULL FROM orders WHERE {KNOWN} AND o_custkey IS NOT NULL
UNION ALL SELECT 'annotations', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), NULL FROM orders WHERE {KNOWN}""")
def payload_readings(spark, sf):
    """Sensor rows, efforts of both payload shapes, events bare and under data, tags of entities, annotations; each raw row comes twice."""
    o = _orders(spark, sf).withColumn("odd", F.col("k") % 2 != 0)
    account = F.lit("acc")
    twice = lambda df: df.withColumn("raw_id", F.explode(F.array("raw_id", F.col("raw_id") + 1_000_000_000)))  # noqa: E731  # rows are read and written as JSON once for both
    seconds = F.unix_seconds(F.to_timestamp("at"))
    read = lambda more: obj(ts=seconds, cs=F.lit(0), lat=F.col("v") + more, long=F.lit(2.0), v=F.lit(3))
    sensor = payloads.sensor(twice(raw(o, F.array(obj(data=F.array(read(0), read(1)))), obj(athlete_id="c", activity_id="k"), account)))
    quick, slow = F.array(obj(start_time="at", band=F.col("k") % 7, distance="v")), F.array(obj(start_time="at", band=F.lit(-1), acceleration=F.lit(5)))
    flat = raw(o.where("not odd"), obj(velocity=quick, acceleration=slow), obj(k="k"), account)
    deep = raw(o.where("odd"), F.array(obj(data=obj(velocity_efforts=quick))), obj(k="k"), account)
    efforts = payloads.efforts(twice(flat.unionByName(deep)))
    kinds = obj(jump=F.array(obj(start_time="at", height="v")), new_kind=F.array(obj(start_time="at", note=F.lit("x"))))
    events = payloads.events(twice(raw(o.where("odd"), obj(data=kinds), obj(k="k"), account).unionByName(raw(o.where("not odd"), kinds, obj(k="k"), account))))
    tags = payloads.entity_tags(twice(raw(o, F.array(obj(entity_id="k", entity_type=F.lit("x"), tag=obj(id="c"))), None, account)))
    notes = payloads.annotations(twice(raw(o, F.array(obj(id="k", comment="p", athlete_id="c")), obj(activity_id="c"), account)), "activity")
    of_request = F.get_json_object("request_params", "$.k")
    parts = [
        ("sensor", sensor, F.col("activity_id"), F.date_format("recorded_at", "yyyy-MM-dd"), F.col("latitude")), ("efforts", efforts, of_request, F.col("effort_type"), F.col("value")),
        ("events", events, of_request, F.col("event_type"), S.first_number(F.col("fields"), ["height"], ["start_time"])), ("entity_tags", tags, F.col("entity_id"), F.col("tag_id"), F.lit(None)),
        ("annotations", notes, F.col("annotation_id"), F.col("activity_id"), F.lit(None)),
    ]
    return union([df.select(F.lit(s).alias("shape"), i.alias("id"), p.alias("part"), n.cast("double").alias("number")) for s, df, i, p, n in parts])
