import random

import pytest
from pyspark.sql import functions as F

from obsframe.operators import correlate as C
from obsframe.operators import ingest as I
from obsframe.operators import servicegraph as G
from obsframe.operators import spanmetrics as M
from obsframe.sources import parse_ingestion, split_ingestion, to_ingestion_records

T1, T2 = "a" * 32, "b" * 32
S1, S2, S3 = "1" * 16, "2" * 16, "3" * 16


def spans(spark, *rows):
    """(trace, span, parent, service, name, kind, status, start_us, duration_ns)"""
    return spark.createDataFrame(
        list(rows),
        "trace_id string, span_id string, parent_span_id string, service_name string, name string, "
        "kind string, status_code string, us bigint, duration_ns bigint",
    ).withColumn("start_ts", F.timestamp_micros("us"))


@pytest.mark.parametrize("seed", range(3))
def test_breadcrumbs_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "a", "a", None, "b"]), rng.choice(["ERROR", "WARN", "WARN", "INFO"]), f"m{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "event_id bigint, scope string, severity_text string, body string").withColumn(
        "ts", F.timestamp_micros("event_id"))
    got = {r.event_id: [c.seq for c in r.breadcrumbs] for r in C.attach_breadcrumbs(df, "scope", n=4, pieces=9).collect()}
    want = {i: [j for j, s, lv, _ in rows if s == scope and lv == "WARN" and j < i][-4:]
            for i, scope, level, _ in rows if level == "ERROR"}
    assert got == want


EVENTS = [("ERROR", T1, S2), ("WARN", T1, S2), ("INFO", T1, S2), ("ERROR", None, None), ("ERROR", "0" * 32, S2), ("ERROR", T2, S3)]


def events(spark):
    return spark.createDataFrame([(i, *e, {"k": "v"}) for i, e in enumerate(EVENTS)],
                                 "n int, severity_text string, trace_id string, span_id string, tags map<string,string>").withColumn(
        "ts", F.timestamp_micros(F.col("n").cast("bigint")))


def test_severe_events_get_their_own_span(spark):
    got = [r.tags.get("otel.span_id") for r in C.correlate_errors(events(spark)).orderBy("n").collect()]
    assert got == [S2, S2, None, None, None, S3]
    assert all(r.tags["k"] == "v" for r in C.correlate_errors(events(spark)).collect())
    only = C.correlate_errors(events(spark), levels=["INFO"]).orderBy("n").collect()
    assert [r.tags.get("otel.span_id") for r in only] == [None, None, S2, None, None, None]


def test_severe_events_get_the_parent_span(spark):
    known = spans(spark, (T1, S2, S1, "s", "n", "k", None, 0, 1), (T2, S3, None, "s", "n", "k", None, 0, 1))
    got = C.correlate_errors(events(spark), known, use="parent").orderBy("n").collect()
    assert [r.tags.get("otel.span_id") for r in got] == [S1, S1, None, None, None, None]
    with pytest.raises(ValueError):
        C.correlate_errors(events(spark), known, use="child")


def test_logs_without_a_span_stay(spark):
    known = spans(spark, (T1, S2, S1, "svc", "op", "k", None, 0, 1))
    got = C.logs_for_traces(events(spark), known).orderBy("n").collect()
    assert [r.span_name for r in got] == ["op", "op", "op", None, None, None]


def test_links(spark):
    link = "array<struct<trace_id:string,span_id:string,attributes:map<string,string>>>"
    consumers = spark.createDataFrame(
        [("c" * 32, "c1", [(T1, S1, {})]), ("d" * 32, "c2", []), ("e" * 32, "c3", [(T1, S1, {}), (T2, "9" * 16, {})])],
        f"trace_id string, span_id string, links {link}").withColumn("start_ts", F.timestamp_micros(F.lit(0).cast("bigint")))
    producers = spans(spark, (T1, S1, None, "app", "send", "SPAN_KIND_PRODUCER", None, 0, 1))
    got = sorted((r.consumer_span_id, r.linked_span_id, r.producer_name) for r in C.link_ingestion(consumers, producers).fillna("").collect())
    assert got == [("c1", S1, "send"), ("c2", "", ""), ("c3", S1, "send"), ("c3", "9" * 16, "")]


def test_edges(spark):
    df = spans(
        spark,
        (T1, S1, None, "app", "call", "SPAN_KIND_CLIENT", "STATUS_CODE_UNSET", 0, 900_000_000),
        (T1, S2, S1, "backend", "serve", "SPAN_KIND_SERVER", "STATUS_CODE_ERROR", 1, 100_000_000),
        (T1, S3, S2, "backend", "inner", "SPAN_KIND_INTERNAL", None, 2, 5),
        (T2, S2, S1, "backend", "other trace", "SPAN_KIND_SERVER", None, 3, 5),
        (T1, "4" * 16, S1, "backend", "wrong pair", "SPAN_KIND_CONSUMER", None, 3, 5),
        (T1, "5" * 16, None, "app", "send", "SPAN_KIND_PRODUCER", None, 3, 5),
        (T1, "6" * 16, "5" * 16, "backend", "take", "SPAN_KIND_CONSUMER", None, 3, 5),
    )
    got = sorted((r.server_span_id, r.connection_type, r.failed) for r in G.service_edges(df).collect())
    assert got == [(S2, "", True), ("6" * 16, "messaging_system", False)]
    rows = {r.le: r for r in G.service_graph(df, [0.1, 0.5]).filter("connection_type = ''").collect()}
    assert [(rows[le].server_count, rows[le].client_count) for le in (0.1, 0.5, float("inf"))] == [(1, 0), (1, 0), (1, 1)]
    assert rows[0.1].request_total == 1 and rows[0.1].failed_total == 1


def test_coverage(spark):
    now = "2024-01-01 00:10:00"
    known = spans(spark, (T1, S1, None, "app", "op", "SPAN_KIND_SERVER", None, 0, 1), (T2, S1, None, "app", "op", "SPAN_KIND_CLIENT", None, 0, 1))
    ids = spark.createDataFrame([(T1,), (T2,)], "trace_id string")
    logs = spark.sql("select timestamp'2024-01-01 00:00:00' as ts, map('service.name','app') as resource")
    point = spark.sql("select 'm' as metric, map('service','app') as labels, timestamp'2024-01-01 00:09:00' as ts, 1.0d as value")
    run = lambda p: {r.trace_id: (r.has_span, r.has_logs, r.has_metric, r.ok) for r in C.telemetry_coverage(
        ids, known, logs, p, "app", "op", "m", {"service": "app"}, now).collect()}
    assert run(point) == {T1: (True, False, True, True), T2: (False, False, True, False)}
    assert run(point.filter("value > 1")) == {T1: (True, False, False, False), T2: (False, False, False, False)}


RECORDS = "key string, value string, headers array<struct<key:string,value:binary>>, topic string, partition int, offset bigint, timestamp timestamp"


def test_message_round_trip_and_dead_letters(spark):
    rows = spark.createDataFrame([(7, T1, S1), (8, None, None)], "book_id int, trace_id string, span_id string")
    sent = to_ingestion_records(rows).collect()
    assert (sent[0].key, sent[0].value, sent[0].topic) == ("key-7", '{"book_id":7}', "book_ingestion")
    assert bytes(sent[0].headers[0].value).decode() == f"00-{T1}-{S1}-01" and sent[1].headers == []
    values = ['{"book_id":7}', '{"book_id":7,"x":1}', None, "", '{"book_id":"7"}', '{"book_id":7.0}', '{"book_id":3000000000}',
              "{}", "[7]", '{"book_id":7} x', '{"book_id":-1}']
    records = spark.createDataFrame([("k", v, None, "t", 0, i, None) for i, v in enumerate(values)], RECORDS)
    good, dead = split_ingestion(parse_ingestion(records))
    assert sorted((r.offset, r.book_id) for r in good.collect()) == [(0, 7), (1, 7), (10, -1)]
    assert dead.count() == 8


def test_topic_and_lag(spark):
    rows = [("k", "v", None, "t", p, o, None) for p, o in [(0, 5), (0, 6), (0, 7), (1, 0)]]
    records = spark.createDataFrame(rows, RECORDS)
    got = sorted((r.partition, r.oldest_offset, r.current_offset, r.messages) for r in I.topic_metrics(records).collect())
    assert got == [(0, 5, 8, 3), (1, 0, 1, 1)]
    assert I.topic_partitions(records).first().partitions == 2
    commits = spark.createDataFrame([("g", "t", 0, 6), ("g", "t", 0, 8), ("h", "t", 1, 0)], "group string, topic string, partition int, offset bigint")
    lag = sorted((r.group, r.partition, r.consumer_offset if r.consumer_offset is not None else -1, r.lag, r.lag_sum)
                 for r in I.consumer_lag(records, commits).collect())
    assert lag == [("g", 0, 8, 0, 1), ("g", 1, -1, 1, 1), ("h", 0, -1, 3, 4), ("h", 1, 0, 1, 4)]


def test_histogram_invariants(spark, sf_dir):
    from workload.views import view

    df = view(spark, sf_dir, "spans")
    rows = M.span_latency(df).collect()
    by_key = {}
    for r in rows:
        by_key.setdefault((r.service_name, r.name, r.kind, r.status_code), []).append((r.le, r.bucket_count, r["count"]))
    for buckets in by_key.values():
        counts = [n for _, n, _ in sorted(buckets)]
        assert counts == sorted(counts) and counts[-1] == buckets[0][2] and len(counts) == 13
    calls = M.span_calls(df).agg(F.sum("calls")).first()[0]
    assert calls == df.count() == sum(b[0][2] for b in by_key.values())


def test_bounds_are_inclusive_and_exemplars_hold_the_slowest(spark):
    rows = [(T1, f"{i:016d}", None, "s", "n", "k", "c", 0, d) for i, d in enumerate([2_000_000, 2_000_001, 9_000_000_000])]
    df = spans(spark, *rows)
    got = {r.le: r.bucket_count for r in M.span_latency(df, [0.002, 0.004]).collect()}
    assert got == {0.002: 1, 0.004: 2, float("inf"): 3}
    assert {r.le: r.duration_ns for r in M.exemplars(df, [0.002, 0.004]).collect()} == {
        0.002: 2_000_000, 0.004: 2_000_001, float("inf"): 9_000_000_000}


def test_active_requests(spark):
    rows = [(T1, str(i), None, "s", "n", "k", "c", a, d * 1000) for i, (a, d) in enumerate([(0, 10), (5, 10), (10, 5), (20, 0)])]
    got = M.active_requests(spans(spark, *rows), pieces=3).select(F.unix_micros("at").alias("at"), "active").collect()
    assert sorted(map(tuple, got)) == [(0, 1), (5, 2), (15, 0)]


def test_red_summary_approximate_and_exact(spark):
    rows = [(T1, str(i), None, "s", "n", "k", "STATUS_CODE_ERROR" if i < 25 else "x", 0, i + 1) for i in range(100)]
    exact = M.red_summary(spans(spark, *rows)).first()
    assert (exact.calls, exact.errors, exact.error_ratio, exact.avg_ns) == (100, 25, 0.25, 50.5)
    assert (exact.p50_ns, exact.p95_ns, exact.p99_ns) == (50, 95, 99)
    near = M.red_summary(spans(spark, *rows), accuracy=10000).first()
    assert (near.p50_ns, near.p95_ns, near.p99_ns) == (50, 95, 99)


def test_quantile_predicate_is_anchored(spark):
    df = spark.createDataFrame([("insert into x",), ("select insert",), (None,)], "s string")
    assert [r[0] for r in df.select(M.matches_fully("s", "insert.*")).collect()] == [True, False, False]


def test_repeated_and_hot_spans_do_not_multiply(spark):
    """A span that holds a third of all events, and spans that arrived twice."""
    ids = lambda n: (f"{n % 50:032x}", f"{n % 500 + 1:016x}")
    rows = [(*ids(n), f"{n % 500 + 7:016x}", f"svc{n % 3}", f"op{n % 500}", "SPAN_KIND_CLIENT") for n in range(500)]
    table = "trace_id string, span_id string, parent_span_id string, service_name string, name string, kind string"
    once = spark.createDataFrame(rows, table)
    again = once.unionByName(once.filter("span_id > '00000000000000c0'")).unionByName(
        spark.createDataFrame([(None, "x", None, "s", "n", "k"), ("x", None, None, "s", "n", "k")], table)).repartition(5)
    logs = spark.createDataFrame(
        [(n, *(ids(7) if n % 3 == 0 else ids(n) if n % 5 else (None, None)), "ERROR", {}) for n in range(3000)],
        "event_id int, trace_id string, span_id string, severity_text string, tags map<string,string>").withColumn(
        "ts", F.timestamp_seconds("event_id"))
    for join in (C.logs_for_traces, lambda e, s: C.correlate_errors(e, s, use="parent").withColumn("tags", F.to_json("tags"))):
        plain = join(logs.drop("tags") if join is C.logs_for_traces else logs, once)
        hot = join(logs.drop("tags") if join is C.logs_for_traces else logs, again)
        assert hot.count() == 3000 and hot.exceptAll(plain).count() == 0
    servers = spark.createDataFrame(
        [(*([rows[7][0]] if n % 3 == 0 else [rows[n % 500][0]]), f"{n + 9000:016x}", rows[7 if n % 3 == 0 else n % 500][1],
          "svc9", "op", "SPAN_KIND_SERVER") for n in range(900)], table)
    timed = lambda df: df.selectExpr(
        "*", "'STATUS_CODE_UNSET' as status_code", "timestamp_seconds(1) as start_ts", "5L as duration_ns")
    assert G.service_edges(timed(again.unionByName(servers))).count() == 900


def test_invalid_headers_link_nothing(spark):
    good = "00-" + "a" * 32 + "-" + "b" * 16 + "-01"
    headers = [good, "00-xyz-abc-01", "00-" + "0" * 32 + "-" + "b" * 16 + "-01", "00-" + "a" * 32 + "-" + "0" * 16 + "-01", "00", None]
    rows = [(f"key-{n}", '{"book_id":1}', [("traceparent", h.encode())] if h else [], "book_ingestion", 0, n) for n, h in enumerate(headers)]
    records = spark.createDataFrame(
        rows, "key string, value string, headers array<struct<key:string,value:binary>>, topic string, partition int, `offset` bigint"
    ).withColumn("timestamp", F.timestamp_seconds("offset"))
    spans = I.consumer_spans(parse_ingestion(records)).orderBy("start_ts").collect()
    assert [len(r.links) for r in spans] == [1, 0, 0, 0, 0, 0]
    assert spans[0].links[0].attributes == {"somekey": "somevalue"} and spans[0].links[0].span_id == "b" * 16
