import json

from pyspark.sql import functions as F

from orefold.sources import payloads as P

RAW = "raw_id long, source_account string, request_params string, response_payload string"


def raw(spark, *rows):
    return spark.createDataFrame([(i + 1, "acc", json.dumps(p), json.dumps(b) if not isinstance(b, str) else b) for i, (p, b) in enumerate(rows)], RAW)


def test_attributes_are_categories_and_the_first_of_a_payload_counts(spark):
    of = lambda kind, value, name=None: {"attributeTypeId": kind, "typeName": name, "attributeValueId": value, "valueName": value and value.upper()}
    body = [{"id": "P1", "tenantId": "T", "attributes": [of("k1", "g1", "K"), of("k2", "g2"), of("k1", "g3"), of(None, "g4")]}]
    got = P.flatten(raw(spark, ({}, body)), "profile_categories").orderBy("category_id").collect()
    assert [(r.profile_id, r.category_id, r.category_name, r.group_id, r.group_name) for r in got] == [("P1", "k1", "K", "g1", "G1"), ("P1", "k2", None, "g2", "G2")]
    later = raw(spark, ({}, body), ({}, [{"id": "P1", "attributes": [of("k1", "g9"), of("k1", "g1")]}]))
    assert {(r.category_id, r.group_id) for r in P.flatten(later, "profile_categories").collect()} == {("k1", "g9"), ("k2", "g2")}


def test_aliases_and_latest_wins(spark):
    rows = raw(spark, ({}, [{"id": "t1", "athleteId": "a", "weight": 0, "recordedDateUtc": "2026-01-01T00:00:00Z"}]), ({}, {"id": "t1", "hubAthleteId": "b", "weight": "71.5"}), ({}, "broken json"))
    got = P.flatten(rows, "plate_tests").collect()
    assert [(r.test_id, r.profile_id, r.weight) for r in got] == [("t1", "b", 71.5)]
    assert P.flatten(rows.where("raw_id = 1"), "plate_tests").first().weight == 0


def test_trial_results_need_an_id(spark):
    body = [{"id": "tr", "limb": "Left", "results": [{"resultId": "r1", "value": 3, "repeat": 0}, {"definition": {"id": 9}, "value": 4, "limb": "Right"}, {"value": 5}]}]
    rows = raw(spark, ({"testId": "t9"}, body))
    got = {(r.result_id, r.value, r.limb, r.test_id) for r in P.flatten(rows, "plate_results").collect()}
    assert got == {("r1", 3.0, "Left", "t9"), ("9", 4.0, "Right", "t9")}
    load = P.load(rows, "plate_results")
    assert load.rows.count() == 2 and load.skipped() == {"missing result_id": 1}


def test_definitions_in_three_shapes(spark):
    one = {"resultId": 5, "resultName": "Jump Height"}
    for body in ({"resultDefinitions": [one]}, {"items": [one]}, one):
        assert [r.result_id for r in P.flatten(raw(spark, ({}, body)), "plate_definitions").collect()] == ["5"]


def test_trace_ticks_are_filled(spark):
    body = {"forces": [{"tick": 10}, {"innerLeftForce": 2.5}, {"sampleIndex": "12"}]}
    got = P.flatten(raw(spark, ({"testId": "t"}, body)), "frame_traces").orderBy("tick").collect()
    assert [(r.test_id, r.tick, r.inner_left) for r in got] == [("t", 10, None), ("t", 11, 2.5), ("t", 12, None)]
    bare = P.flatten(raw(spark, ({"testId": "t"}, body["forces"])), "frame_traces")
    assert bare.count() == 3


def test_repetition_number_defaults_to_place(spark):
    body = {"repetitions": [{"laterality": "LeftSide", "impulseNs": 0}, {"repetitionNumber": 7, "laterality": "LeftSide", "impulse": 2}]}
    got = P.flatten(raw(spark, ({"testId": "t"}, body)), "dynamo_repetitions").orderBy("repetition_number").collect()
    assert [(r.repetition_number, r.impulse_ns) for r in got] == [(1, 0.0), (7, 2.0)]


def test_every_shape_takes_an_empty_and_a_broken_payload(spark):
    rows = raw(spark, ({}, []), ({}, "{"), ({}, {}))
    for name in P.SHAPES:
        assert P.flatten(rows, name).count() == 0 or name.endswith(("metrics", "traces")), name


def test_athlete(spark):
    body = [{"id": 7, "first_name": " Ann ", "last_name": "Lee", "nickname": " ", "is_synced": 0, "current_team": {"id": 3}, "created_at": "2026-01-02 03:04:05"}]
    r = P.athletes(raw(spark, ({"source_account": "acc"}, body))).first()
    assert (r.full_name, r.nickname, r.is_synced, r.team_id, r.source_account) == ("Ann Lee", None, False, "3", "acc")


def test_sensor_time(spark):
    body = [{"data": [{"ts": 100, "cs": 5}, {"ts": 100, "cs": 15}]}]
    got = P.sensor(raw(spark, ({"athlete_id": 1, "activity_id": 2}, body))).select(F.col("recorded_at").cast("double").alias("t")).orderBy("t").collect()
    assert [round(r.t, 2) for r in got] == [100.05, 100.15]


def test_stats(spark):
    body = [{"activity_id_id": "a1", "athlete_id": "p1", "period_id": "x", "total": "5"}, {"activity_id": "0", "athlete_id": "p2"}]
    activities = spark.sql("select 'acc' source_account, 'a1' activity_id, timestamp'2026-01-01' start_time, timestamp'2026-01-01 01:00:00' end_time")
    periods = spark.createDataFrame([("acc", "y")], "source_account string, period_id string")
    got = {r.athlete_id: r for r in P.stats(raw(spark, ({}, body)), activities, periods).collect()}
    assert got["p1"].activity_id == "a1" and got["p1"].period_id is None and got["p1"].period_key == "x" and got["p1"].all_parameters == {"total": "5"}
    assert got["p2"].reject_reason == "missing activity_id"


def test_efforts_of_both_shapes(spark):
    flat = {"velocity": [{"start_time": "10", "band": 6, "distance": 1.5}] * 2, "acceleration": [{"start_time": "11", "band": -1}]}
    deep = [{"data": {"velocity_efforts": [{"start_time": "12", "band": 6}], "acceleration_efforts": []}}]
    got = sorted(r.effort_type for r in P.efforts(raw(spark, ({"a": 1}, flat), ({"a": 2}, deep))).collect())
    assert got == ["acceleration_band_-1", "velocity_band_6", "velocity_band_6"]


def test_events_bare_and_under_data(spark):
    kinds = {"jump": [{"start_time": "1"}], "new_kind": [{"start_time": "2"}]}
    for body in (kinds, {"data": kinds}):
        assert sorted(r.event_type for r in P.events(raw(spark, ({}, body))).collect()) == ["jump", "new_kind"]


def test_placeholders(spark):
    tags = spark.createDataFrame([("acc", "t1", "k1"), ("acc", "t2", "k2")], "source_account string, tag_id string, tag_type_id string")
    types = spark.createDataFrame([("acc", "k1", "Known")], "source_account string, tag_type_id string, name string")
    got = {(r.tag_type_id, r.name) for r in P.with_placeholders(tags, types, "tag_type_id", "tag_type_id", ["source_account"]).collect()}
    assert got == {("k1", "Known"), ("k2", None)}


def test_stats_replayed_are_there_once(spark):
    body = [{"activity_id": "a1", "athlete_id": "p1", "total": "5"}]
    none = spark.createDataFrame([], "source_account string, activity_id string, period_id string, start_time timestamp, end_time timestamp")
    got = P.stats(raw(spark, ({}, body), ({}, [{**body[0], "total": "7"}])), none, none).collect()
    assert [(r.raw_id, r.all_parameters) for r in got] == [(2, {"total": "7"})]


def test_traces_take_profile_and_date_from_their_test(spark):
    traces = spark.createDataFrame([("t1", 1, None), ("t2", 1, None), ("t3", 1, "own")], "test_id string, tick int, profile_id string")
    tests = spark.sql("select 't1' test_id, 'p1' profile_id, date'2026-01-01' test_date union all select 't3', 'p3', null")
    got = {r.test_id: r for r in P.with_parent(traces, tests, "test_id", {"profile_id": "profile_id", "started": "test_date"}, required="profile_id").collect()}
    assert (got["t1"].profile_id, str(got["t1"].started), got["t1"].reject_reason) == ("p1", "2026-01-01", None)
    assert got["t2"].reject_reason == "missing profile_id" and got["t3"].profile_id == "own"


def test_counts_of_a_load(spark):
    rows = raw(spark, ({}, [{"id": "1"}, {"id": "1"}, {"name": "x"}]), ({}, "broken {"), ({}, {"items": [{"id": 3}]}), ({}, {"id": 4}))
    load = P.load(rows, P.Shape({"team_id": ("id", "id")}, ["team_id"], required=["team_id"]))
    assert sorted(r.team_id for r in load.rows.collect()) == ["1", "3", "4"]
    assert load.counts() == {"attempted": 5, "loaded": 4, "skipped": 1} and load.skipped() == {"missing team_id": 1}
    none = P.load(rows.limit(0), "teams")
    assert none.rows.count() == 0 and none.counts() == {"attempted": 0, "loaded": 0, "skipped": 0} and none.skipped() == {}
    assert [r.n for r in rows.orderBy("raw_id").select(P.count_items(F.col("response_payload")).alias("n")).collect()] == [3, 0, 1, 1]
    others = spark.createDataFrame([("7",), ("null",), ("{}",), ('{"items": {"id": 1}}',), ("[]",), (None,)], "payload string")
    assert [r.n for r in others.select(P.count_items(F.col("payload")).alias("n")).collect()] == [0, 0, 1, 1, 0, 0]


def accounts(spark, body, params=None):
    return spark.createDataFrame([(i, a, json.dumps(params or {}), json.dumps(body)) for i, a in enumerate(("a", "b"))], RAW)


def test_the_raw_rows_own_account_counts(spark):
    for name, key in (("teams", "team_id"), ("tags", "tag_id"), ("athletes", "athlete_id"), ("activities", "activity_id"), ("periods", "period_id")):
        got = {(r.source_account, r[key]) for r in P.flatten(accounts(spark, [{"id": 1}]), name).collect()}
        assert got == {("a", "1"), ("b", "1")}, name
    request = spark.createDataFrame([(1, None, '{"source_account": "c"}', '[{"id": 1}]'), (2, None, "{}", '[{"id": 1}]')], RAW)
    load = P.load(request, "teams")
    assert [r.source_account for r in load.rows.collect()] == ["c"] and load.skipped() == {"missing source_account": 1}
    assert P.annotations(accounts(spark, [{"id": 1, "activity_id": 5, "comment": "x"}]), "activity").count() == 2
    assert P.entity_tags(accounts(spark, [{"entity_id": 1, "tag_id": 5}])).count() == 2


def test_statistics_of_one_period_on_two_days_are_two(spark):
    body = [{"activity_id": "a1", "athlete_id": "p1", "period_id": "x", "start_time": f"2026-01-0{d}T00:00:00Z", "total": str(d)} for d in (1, 2, 2)]
    none = spark.createDataFrame([], "source_account string, activity_id string, period_id string, start_time timestamp, end_time timestamp")
    assert sorted(r.all_parameters["total"] for r in P.stats(raw(spark, ({}, body)), none, none).collect()) == ["1", "2"]


def test_two_readings_of_one_hundredth_are_two(spark):
    read = {"ts": 100, "cs": 5, "lat": 1.0, "long": 2.0, "v": 3}
    body = [{"data": [read, {**read, "lat": 1.5}, {**read, "hr": 90}, {"ts": 99, "cs": 105, "latitude": 1.0, "longitude": 2.0, "velocity": 3, "heart_rate": 91}]}]
    got = P.sensor(raw(spark, ({"athlete_id": 1, "activity_id": 2}, body))).collect()
    assert sorted((r.latitude, r.heart_rate) for r in got) == [(1.0, 91.0), (1.5, None)]


def test_a_payload_may_list_many_profiles_with_attributes(spark):
    body = [{"id": f"P{k}", "attributes": [{"attributeTypeId": "k", "attributeValueId": k}, {"attributeTypeId": "k", "attributeValueId": -1}]} for k in range(5)]
    got = P.rows_of(raw(spark, ({}, body)), "profile_categories").orderBy("pos").collect()
    assert [(r.pos, r.profile_id, r.group_id) for r in got] == [(k * 1_000_000_000 + i, f"P{k}", str(v)) for k in range(5) for i, v in enumerate((k, -1))]
