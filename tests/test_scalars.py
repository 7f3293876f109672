from pyspark.sql import functions as F

from obsframe import functions as O
from obsframe.functions.scalars import json_value, micros, seconds, series_key


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_traceparent(spark):
    rows = spark.createDataFrame(
        [("00-4bf92f3577b34da6a3ce929d0e0e4736-00f067aa0ba902b7-01",), ("lonely",), ("a-b",), (None,)], "s string"
    ).select(O.traceparent_parse("s").alias("c")).collect()
    assert rows[0].c.trace_id == "4bf92f3577b34da6a3ce929d0e0e4736"
    assert (rows[0].c.version, rows[0].c.span_id, rows[0].c.flags) == ("00", "00f067aa0ba902b7", "01")
    assert rows[1].c is None and rows[3].c is None
    assert rows[2].c.trace_id == "b" and rows[2].c.span_id is None


def test_trace_id_validity(spark):
    good = "0af7651916cd43dd8448eb211c80319c"
    ids = [good, good.upper(), good[:31], good[:31] + "g", good + "\n", ""]
    got = spark.createDataFrame([(i,) for i in ids], "s string").select(O.is_valid_trace_id("s")).collect()
    assert [r[0] for r in got] == [True, True, False, False, False, False]


def test_span_context_validity(spark):
    rows = [("a" * 32, "b" * 16), ("0" * 32, "b" * 16), ("a" * 32, "0" * 16), (None, "b" * 16), ("a" * 32, "b")]
    got = spark.createDataFrame(rows, "t string, s string").select(O.is_valid_span_context("t", "s")).collect()
    assert [r[0] for r in got] == [True, False, False, False, False]


def test_header_get(spark):
    schema = "headers array<struct<key:string,value:binary>>"
    cases = [
        [("TraceParent", b"x")],
        [("traceparent", b"first"), ("TRACEPARENT", b"second")],
        [("traceparent", b"\xff\xfe"), ("traceparent", b"after")],
        [("traceparent", b"\xff\xfe")],
        [("other", b"x")],
        [],
        None,
    ]
    got = spark.createDataFrame([(c,) for c in cases], schema).select(O.header_get("headers", "traceparent")).collect()
    assert [r[0] for r in got] == ["x", "first", "after", None, None, None, None]


def test_nano_times(spark):
    r = one(
        spark,
        F.unix_micros(O.nano_to_ts(F.lit("1700000000123456789"))).alias("a"),
        O.duration_ns(F.lit("1700000000123456789"), F.lit("1700000000123456999")).alias("b"),
        O.nano_to_ts(F.lit("x")).alias("c"),
    )
    assert (r.a, r.b, r.c) == (1700000000123456, 210, None)


def test_reasons_levels_forms(spark):
    r = one(
        spark,
        O.http_reason(F.lit(418)).alias("a"), O.http_reason(F.lit(599)).alias("b"),
        O.level_rank(F.lit("warn")).alias("c"), O.level_rank(F.lit("x")).alias("d"),
        O.span_kind(F.lit("Consumer")).alias("e"), O.span_kind(F.lit("SPAN_KIND_SERVER")).alias("f"),
        O.status_code(F.lit("ERROR")).alias("g"), O.hex_pad(F.lit("AB"), 4).alias("h"),
        O.status_to_db(F.lit("Lost")).alias("i"), O.status_to_db(F.lit("lost")).alias("j"),
        O.status_to_json(F.lit("lost")).alias("k"), O.message_key(F.lit(7)).alias("l"),
    )
    assert tuple(r) == (
        "I'm a teapot", "Injected Error", 2, None, "SPAN_KIND_CONSUMER", "SPAN_KIND_SERVER",
        "STATUS_CODE_ERROR", "00ab", "lost", None, "Lost", "key-7",
    )


def test_json_value_is_exactly_one_value(spark):
    texts = ['{"a":1}', ' [1] ', "5", '{"a":1} x', '{"a":1}{"b":2}', "1],[2", '1},{"v":2', "1,2", '1,"x":2', "", "{", None]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select(json_value("s").isNotNull()).collect()
    assert [r[0] for r in got] == [True, True, True] + [False] * 9


def test_series_key_ignores_order(spark):
    df = spark.sql("select map('a','1','b','2') as x, map('b','2','a','1') as y, map('a','1') as z")
    r = df.select(series_key("x").alias("x"), series_key("y").alias("y"), series_key("z").alias("z")).first()
    assert r.x == r.y != r.z


def test_label_map_leaves_out_nulls(spark):
    r = one(spark, O.label_map({"a": F.lit("1"), "b": F.lit(None).cast("string")}).alias("m"))
    assert r.m == {"a": "1"}


def test_intervals():
    assert seconds("5 minutes") == 300 and seconds("90s") == 90 and seconds("1 hour") == 3600
    assert micros("10 seconds") == 10_000_000 and micros(0.5) == 500_000 and seconds("2 days") == 172800
