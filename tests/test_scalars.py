import datetime as dt

import pytest
from pyspark.sql import functions as F

from orefold.functions import jsonwalk
from orefold.functions import scalars as S

CASES = [
    (S.metric_name, "maxRFDValue2Test", "max_rfd_value2_test"),
    (S.metric_name, "_Peak  Force-N_", "peak_force_n"),
    (S.side_of_name, "inner_left_max_force", "inner_left"),
    (S.side_of_name, "max_force", None),
    (S.name_without_side, "left_max_force", "max_force"),
    (S.side_label, "Left Side", "left"),
    (S.side_label, "both", "bilateral"),
    (S.limb_side, "LeftSide", "left"),
    (S.limb_side, "Some Limb", "some_limb"),
    (S.unit, "left_contact_time", "ms"),
    (S.unit, "power_per_kg", "kg"),
    (S.unit, "max_rfd_value", "N/s"),
    (S.unit, "unknown", None),
    (S.gate_unit, "total_height", "s"),
    (S.finite, "12.5", 12.5),
    (S.finite, "NaN", None),
    (S.finite, "abc", None),
    (S.whole, "-3.9", -3),
    (S.whole_only, "3.5", None),
    (S.whole_text, " -12 ", -12),
    (S.whole_text, "3.0", None),
    (S.whole_text, "true", None),
    (S.boolean, " Yes ", True),
    (S.boolean, "maybe", None),
    (S.identifier, "  ", None),
    (S.identifier, "true", None),
    (S.identifier, " FaLsE", None),
    (S.identifier, " untrue ", "untrue"),
    (S.id_shape, "123456", "numeric"),
    (S.id_shape, "team-A", "text"),
    (S.id_shape, "AAAAAAAA-aaaa-aaaa-aaaa-aaaaaaaaaaaa", "uuid"),
    (S.clean_name, "  a \t b ", "a b"),
    (S.key_number, "001.2300", "1.23"),
    (S.key_number, "-0.0", "0"),
    (S.key_number, "100", "100"),
    (S.key_number, "10", "10"),
    (S.split_number, "split_12_cumulative_time", 12),
    (S.split_number, "split_cumulative_time", None),
    (S.uuid, "x", None),
]


def test_table_of_cases(spark):
    for k in range(0, len(CASES), 12):
        part = CASES[k : k + 12]
        row = spark.range(1).select(*[f(F.lit(x)).alias(f"c{i}") for i, (f, x, _) in enumerate(part)]).first()
        assert [row[f"c{i}"] for i in range(len(part))] == [e for _, _, e in part]


@pytest.mark.parametrize("value,expected", [("100.05", dt.datetime(1970, 1, 1, 0, 1, 40, 50000)), ("-1", None), ("2026-01-15T10:00:00.1234567Z", dt.datetime(2026, 1, 15, 10, 0, 0, 123456)), ("1700000000000", dt.datetime(2023, 11, 14, 22, 13, 20))])
def test_moment(spark, value, expected):
    text = F.date_format(S.moment(F.lit(value)), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    assert spark.range(1).select(text.alias("t")).first().t == (expected and expected.strftime("%Y-%m-%d %H:%M:%S.%f"))


def test_local_day_has_23_hours_when_clocks_change(spark):
    row = spark.sql("select date'2026-03-29' d, date'2026-03-30' e").select(((S.local_day_start(F.col("e"), "Europe/Lisbon").cast("long") - S.local_day_start(F.col("d"), "Europe/Lisbon").cast("long")) / 3600).alias("h")).first()
    assert row.h == 23


def test_asymmetry_and_z(spark):
    row = spark.range(1).select(S.asymmetry(F.lit(100.0), F.lit(80.0)).alias("a"), S.asymmetry(F.lit(0.0), F.lit(0.0)).alias("z"), S.modified_z(F.lit(10.0), F.lit(5.0), F.lit(0.5)).alias("m")).first()
    assert row.a == 20 and row.z == 0 and row.m is None


def test_json_leaves(spark):
    doc = '{"totalTime": 1.5, "testId": 7, "ok": true, "list": [{"v": 1}, {"v": "2"}], "deep": {"a": {"b": {"c": {"d": {"e": 1}}}}}, "id": {"x": 3}}'
    got = {(r.metric_name, r.metric_value, r.too_deep) for r in jsonwalk.numeric_leaves(spark.createDataFrame([(1, doc), (2, None), (3, "broken")], "id int, p string"), "p", "id").collect()}
    assert got == {("total_time", 1.5, False), ("list_1_v", 1.0, False), ("list_2_v", 2.0, False), ("deep_a_b_c_d", None, True)}


def test_json_hash_ignores_key_order(spark):
    row = spark.range(1).select((S.json_hash(F.lit('{"a": 1, "b": 2}')) == S.json_hash(F.lit('{"b":2,"a":1}'))).alias("same")).first()
    assert row.same
