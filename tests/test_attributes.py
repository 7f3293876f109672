from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.functions import bags
from obsframe.operators import attributes as A
from obsframe.operators import routing as R

SCHEMA = "ts timestamp, severity_text string, attributes map<string,string>, resource map<string,string>"


def logs(spark, *rows):
    return spark.createDataFrame([(None, *r) for r in rows], SCHEMA)


CASES = [
    ("ERROR", {"name": "event src/a.rs:0012", "x": "1"}, {"host.name": "h1"}),
    ("INFO", {"name": "src/b.rs:7", "level": "old", "file_path": "old", "line_number": "old"}, {"container_id": "c", "host.name": "h"}),
    ("WARN", {"name": "no location", "line_number": "0042"}, {fixed.LOG_RESOURCE_KEY: "mine"}),
    (None, {"line_number": "x1", "level": "kept"}, {}),
    ("DEBUG", {}, {"host.name": None}),
    ("TRACE", {"name": "src/c.rs:99999999999999999999"}, {"other": "o"}),
    ("INFO", {"empty": None, "name-copied": "before"}, None),
]


def test_process_logs_equals_its_steps(spark):
    df = logs(spark, *CASES)
    assert A.process_logs(df).columns == df.columns
    fused = [(r.attributes, r.resource) for r in A.process_logs(df).collect()]
    steps = [(r.attributes, r.resource) for r in A.process_logs_stepwise(df).collect()]
    for (fa, fr), (sa, sr), case in zip(fused, steps, CASES):
        assert fa == sa, case
        assert fr == sr, case


def test_process_logs_values(spark):
    r = A.process_logs(logs(spark, CASES[0])).first()
    assert r.attributes == {
        "x": "1", "level": "ERROR", "file_path": "src/a.rs", "line_number": "12", "name-copied": "event src/a.rs:0012"}
    assert r.resource == {fixed.LOG_RESOURCE_KEY: fixed.LOG_RESOURCE_VALUE, "container_id": "h1"}


def test_edit_keeps_what_it_does_not_name(spark):
    df = spark.sql("select map('a','1','b',cast(null as string),'c','3') as m")
    r = df.select(bags.edit("m", {"a": F.lit("9"), "b": F.lit(None).cast("string"), "d": F.lit(None).cast("string")}, ["c"]).alias("m")).first()
    assert r.m == {"a": "9", "b": None}


def test_insert_upsert_delete_set(spark):
    df = logs(spark, ("INFO", {"a": "1"}, {"r": "2"}))
    got = lambda d: d.first().attributes
    assert got(A.attr_insert(df, "attributes", "a", "x")) == {"a": "1"}
    assert got(A.attr_insert(df, "attributes", "b", "x")) == {"a": "1", "b": "x"}
    assert got(A.attr_upsert_from(df, "attributes", "a", "missing")) == {"a": "1"}
    assert got(A.attr_upsert_from(df, "attributes", "c", "a")) == {"a": "1", "c": "1"}
    assert got(A.attr_delete(df, "attributes", "a")) == {}
    assert got(A.attr_set(df, "attributes", "a", F.lit(None).cast("string"))) == {"a": "1"}
    assert got(A.attr_set(df, "attributes", "a", bags.value_of("resource", "r"))) == {"a": "2"}


def test_extract_overwrites_only_on_match(spark):
    df = logs(spark, ("INFO", {"n": "a-1", "g": "old"}, {}), ("INFO", {"n": "zzz", "g": "old"}, {}), ("INFO", {}, {}))
    got = [r.attributes for r in A.attr_extract(df, "attributes", "n", r"^a-(\d)(x?)", ["g", "h"]).collect()]
    assert got == [{"n": "a-1", "g": "1", "h": ""}, {"n": "zzz", "g": "old"}, {}]


def test_convert_int(spark):
    df = logs(spark, ("I", {"k": "007"}, {}), ("I", {"k": "x"}, {}), ("I", {}, {}))
    rows = A.attr_convert_int(df, "attributes", "k", typed="n").collect()
    assert [(r.attributes, r.n) for r in rows] == [({"k": "7"}, 7), ({"k": "x"}, None), ({}, None)]


def test_promote_labels(spark):
    df = spark.sql("select map('a','1') as labels, map('container.name','c1') as resource")
    assert A.promote_labels(df, fixed.CONTAINER_LABELS).first().labels == {"a": "1", "container_name": "c1"}


def test_level_router(spark):
    df = spark.createDataFrame([("ERROR",), ("WARN",), ("INFO",), ("DEBUG",), ("TRACE",), (None,)], "severity_text string")
    assert [r.route for r in R.route_by_level(df).collect()] == ["event", "breadcrumb", "log"]


def test_longest_target_prefix_wins(spark):
    rules = {"h": "ERROR", "hyper": "TRACE", "hyper::client": "WARN"}
    rows = [("h2", "WARN"), ("hyper::server", "TRACE"), ("hyper::client::x", "INFO"), ("hyper::client", "WARN"), ("z", "INFO"), ("z", "DEBUG")]
    df = spark.createDataFrame(rows, "target string, severity_text string")
    kept = [tuple(r) for r in R.filter_by_target(df, rules).collect()]
    assert kept == [("hyper::server", "TRACE"), ("hyper::client", "WARN"), ("z", "INFO")]
    assert R.filter_by_target(df, {}, "error").count() == 0


def test_before_send(spark):
    schema = "url string, tags map<string,string>, server_name string"
    rows = [("http://a/health", {}, "s"), ("http://a/metrics?x", {}, "s"), (None, None, "s"), ("http://a/books", {"k": "v"}, "s")]
    got = [tuple(r) for r in R.before_send(spark.createDataFrame(rows, schema)).collect()]
    assert got == [(None, {"service": "bookapp"}, None), ("http://a/books", {"k": "v", "service": "bookapp"}, None)]


def test_sampling_keeps_whole_traces(spark):
    df = spark.range(20000).select(F.md5((F.col("id") % 2000).cast("string")).alias("trace_id"))
    kept = R.sample_traces(df).groupBy("trace_id").count().collect()
    assert all(r["count"] == 10 for r in kept) and 140 < len(kept) < 260
