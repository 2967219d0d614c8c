from pyspark.sql import functions as F

from orefold.llm import queries, warc
from tests import sqlcheck

SCHEMA = "record_id long, url string, captured_at long, kind string, headers map<string,string>, body string"


def records(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_canonical_urls(spark):
    cases = {
        "HTTPS://WWW.Example.com:443/A/?b=2&utm_source=x&a=1#f": "example.com/A?a=1&b=2",
        "http://m.example.com/": "example.com",
        "example.com?ref=1": "example.com",
        "http://example.com/x?q=ref": "example.com/x?q=ref",
    }
    got = spark.createDataFrame([(u,) for u in cases], "u string").select(warc.canonical_url(F.col("u")).alias("c")).collect()
    assert [r.c for r in got] == list(cases.values())


def test_outcomes_and_headers(spark):
    u = "http://a.example/x"
    rows = [
        (1, u, 10, "response", {"ETag": '"1"', "Content-Length": "9", "Date": "d1"}, "old"),
        (2, u + "#z", 20, "revisit", {"etag": 'W/"1"', "Content-Length": "0", "date": "d2"}, None),
        (3, u, 30, "response", {"ETag": '"2"', "Last-Modified": "m"}, "new"),
        (4, u, 40, "revisit", {"etag": '"1"'}, None),
        (5, u, 50, "revisit", {"last-modified": "m"}, None),
        (6, u, 60, "revisit", {}, None),
        (7, u, 5, "revisit", {"etag": '"1"'}, None),
        (8, None, 70, "revisit", {}, None),
        (9, u, 40, "response", None, None),
    ]
    got = {r.record_id: r for r in warc.resolve(records(spark, rows)).collect()}
    assert {k: (r.source_id, r.outcome, r.body) for k, r in got.items()} == {
        2: (1, "resolved", "old"), 4: (9, "unchecked", None), 5: (9, "unchecked", None), 6: (9, "unchecked", None), 7: (None, "missing", None), 8: (None, "missing", None),
    }
    assert got[2].headers == {"etag": 'W/"1"', "content-length": "9", "date": "d2"}


def test_a_hot_url_over_many_spans_equals_brute_force(spark):
    rows = [(i, "http://h.example/" if i % 3 else f"http://o.example/{i % 7}", (i * 7919) % 1000, "response" if i % 4 == 0 else "revisit", {"etag": str(i % 2)}, f"b{i}" if i % 4 == 0 else None) for i in range(400)]
    got = {r.record_id: (r.source_id, r.outcome) for r in warc.resolve(records(spark, rows)).collect()}
    for i, url, at, kind, head, _ in rows:
        if kind == "revisit":
            earlier = [(t, k, h) for k, u, t, kd, h, _ in rows if kd == "response" and u == url and (t, 0) < (at, 1)]
            last = max(earlier, key=lambda x: x[:2], default=None)
            want = (None, "missing") if last is None else (last[1], "resolved") if last[2] == head else (None, "changed")
            assert got[i] == want
    assert len(got) == 300 and warc.resolve(records(spark, rows).limit(0)).count() == 0


def test_odd_records(spark):
    u = "http://a.example/x"
    rows = [
        (1, u, 10, "response", {"ETag": "1", "etag": "2", "Vary": None}, "first"),
        (1, u, 12, "response", {"etag": "3"}, "later"),
        (2, u, 10, "revisit", {"ETAG": "1", "Etag": "2"}, None),
        (2, u, 10, "revisit", {"ETAG": "1", "Etag": "2"}, None),
        (3, u, None, "revisit", {"etag": "1"}, None),
        (4, u, None, "response", {"etag": "9"}, "timeless"),
        (5, u, 99, "revisit", {"etag": "3"}, None),
        (None, "http://b.example", 1, "response", {}, "no id"),
        (6, "http://b.example", 2, "revisit", None, None),
    ]
    wide = records(spark, rows).withColumns({"span": F.lit("x"), "from": F.lit(1), "full": F.lit(None).cast("int"), "good": F.lit(2)})
    got = sorted((r.record_id, r.source_id, r.outcome, r.body) for r in warc.resolve(wide).collect())
    assert got == [(2, 1, "resolved", "later"), (2, 1, "resolved", "later"), (3, None, "changed", None), (5, 1, "resolved", "later"), (6, None, "missing", None)]
    heads = {r.record_id: r.headers for r in warc.resolve(wide).collect()}
    assert heads[2] == {"etag": "1, 2"} and heads[5] == {"etag": "3"}


def test_many_records_of_one_time(spark):
    rows = [(i, "http://h.example/", 5, "response" if i % 2 else "revisit", {"etag": "e"}, f"b{i}" if i % 2 else None) for i in range(200)]
    got = warc.resolve(records(spark, rows)).collect()
    assert {(r.source_id, r.outcome, r.body) for r in got} == {(199, "resolved", "b199")} and len(got) == 100


def test_equals_sql(spark, data):
    sqlcheck.assert_equal(queries.op2_warc_revisits(spark, data), sqlcheck.connect(data), queries.OP2_SQL)
