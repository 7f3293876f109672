import json

import pytest
from pyspark.sql import functions as F

from obsframe.operators import correlate as C
from obsframe.operators import spanmetrics as M
from obsframe.plans.session import fresh_dir
from obsframe.sources import read_log_json, read_metric_json, read_trace_json

T1 = "0af7651916cd43dd8448eb211c80319c"


def kv(key, s=None, i=None):
    return {"key": key, "value": {k: v for k, v in (("stringValue", s), ("intValue", i)) if v is not None}}


def span(span_id, name, kind="SPAN_KIND_SERVER", parent=None, code=None, events=None, attrs=(), links=None):
    out = {"traceId": T1, "spanId": span_id, "name": name, "kind": kind, "startTimeUnixNano": "1700000000000001500",
           "endTimeUnixNano": "1700000000000003750", "attributes": list(attrs), "status": {"code": code} if code else {}}
    for key, value in (("parentSpanId", parent), ("events", events), ("links", links)):
        if value is not None:
            out[key] = value
    return out


DOC = {"batches": [
    {"resource": {"attributes": [kv("service.name", "bookapp"), kv("host.name", "h1")]},
     "scopeSpans": [
         {"scope": {"name": "bookapp"}, "spans": [
             span("a" * 16, "get_all_books", attrs=[kv("text", "t"), kv("number", i="5"), kv("both", "s", "9"), kv("text", "last"), kv("nothing")],
                  events=[{"name": "query", "timeUnixNano": "1700000000000002000", "attributes": [kv("code.namespace", "bookapp::db")]},
                          {"name": "query", "attributes": [kv("code.namespace", "bookapp::rest")]}])]},
         {"scope": {"name": "backend"}, "spans": [
             span("b" * 16, "query", "SPAN_KIND_CLIENT", "a" * 16, "STATUS_CODE_ERROR",
                  events=[{"name": "exception", "attributes": [kv("exception.type", "DbError"), kv("exception.message", "gone")]}],
                  links=[{"traceId": "c" * 32, "spanId": "d" * 16, "attributes": [kv("somekey", "somevalue")]}])]}]},
    {"resource": {"attributes": [kv("service.name", "backend")]},
     "scopeSpans": [{"spans": [span("e" * 16, "get_book", "SPAN_KIND_INTERNAL", "")]}]},
    {"resource": {"attributes": []}, "scopeSpans": [{"spans": []}]},
]}


def write(spark, label, *docs, indent=None):
    path = fresh_dir(spark, label)
    spark.createDataFrame([(json.dumps(d, indent=indent),) for d in docs], "value string").coalesce(1).write.option(
        "lineSep", "\n").text(path)
    return path


@pytest.fixture(scope="module")
def spans(spark):
    return read_trace_json(spark, write(spark, "doc", DOC, indent=1), multi_line=True)


def test_spans_are_flattened(spans):
    rows = {r.span_id[0]: r for r in spans.collect()}
    assert set(rows) == {"a", "b", "e"}
    a, b, e = rows["a"], rows["b"], rows["e"]
    assert (a.service_name, a.scope_name, a.parent_span_id, a.status_code) == ("bookapp", "bookapp", None, None)
    assert (b.scope_name, b.parent_span_id, b.status_code) == ("backend", "a" * 16, "STATUS_CODE_ERROR")
    assert (e.service_name, e.scope_name, e.parent_span_id) == ("backend", None, None)
    assert a.duration_ns == 2250 and a.start_ts.microsecond == 1
    assert a.attributes == {"text": "last", "number": "5", "both": "s", "nothing": None}
    assert a.resource == {"service.name": "bookapp", "host.name": "h1"}
    assert [x.name for x in a.events] == ["query", "query"] and a.links == [] and e.events == []
    assert b.links[0].attributes == {"somekey": "somevalue"} and b.links[0].span_id == "d" * 16


def test_one_document_per_line(spark):
    assert read_trace_json(spark, write(spark, "docs", DOC, DOC)).count() == 6


def test_expected_span_and_error_in_any_scope(spans):
    assert C.find_spans(spans, T1, "bookapp", "get_all_books").count() == 1
    assert C.find_spans(spans, T1, "backend", "get_all_books").count() == 0
    assert C.find_spans(spans, T1, "bookapp", "query").count() == 0
    assert [r.has_error for r in C.traces_with_error(spans, "bookapp").collect()] == [True]
    assert [r.has_error for r in C.traces_with_error(spans, "backend").collect()] == [False]


def test_event_and_exception_counts(spans):
    assert M.span_event_count(spans).first().events == 1
    r = M.exception_count(spans).collect()
    assert [(x.name, x.exception_type, x.exception_message, x.exceptions) for x in r] == [("query", "DbError", "gone", 1)]


def test_documents_without_spans(spark):
    assert read_trace_json(spark, write(spark, "none", {"batches": []})).count() == 0
    assert read_trace_json(spark, write(spark, "empty", {})).count() == 0


def test_log_results(spark):
    none = read_log_json(spark, write(spark, "l0", {"data": {"result": []}}))
    assert none.count() == 0
    doc = {"data": {"result": [{"stream": {"service_name": "bookapp"}, "values": [["1700000000000001500", "one"], ["x", "two"]]}]}}
    rows = read_log_json(spark, write(spark, "l1", doc)).orderBy("line").collect()
    assert [(r.line, r.ts_ns, r.labels) for r in rows] == [
        ("one", 1700000000000001500, {"service_name": "bookapp"}), ("two", None, {"service_name": "bookapp"})]
    assert rows[0].ts.microsecond == 1 and rows[1].ts is None


def test_metric_results(spark):
    result = [{"metric": {"__name__": "m", "i": str(i)}, "value": [1700000000.25, v]} for i, v in enumerate(["1", "0", "NaN", "x"])]
    rows = read_metric_json(spark, write(spark, "m", {"status": "success", "data": {"result": result}})).orderBy(
        F.col("labels")["i"]).collect()
    assert [r.value for r in rows][:2] == [1.0, 0.0] and rows[2].value != rows[2].value and rows[3].value is None
    assert {r.metric for r in rows} == {"m"} and rows[0].ts.microsecond == 250000
