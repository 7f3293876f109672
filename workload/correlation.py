"""Correlation of traces, logs, error events, metrics and messages."""

from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.functions.bags import value_of
from obsframe.operators import correlate as C
from obsframe.operators import ingest as I
from obsframe.plans.session import fresh_dir
from obsframe.sources import documents as D
from obsframe.sources import messages as MS
from obsframe.sources import tables as T
from workload.registry import query
from workload.views import as_logs, as_points, as_records, us, view, with_views

_V = with_views


def _spans(spark, sf):
    return view(spark, sf, "spans")


@query("p19_find_spans", _V(["spans"], """
  SELECT event_id, trace_id, span_id FROM spans
  WHERE service_name = 'bookapp' AND name = 'GET /books' AND kind IN ('SPAN_KIND_SERVER', 'SPAN_KIND_INTERNAL')"""))
def find_spans(spark, sf):
    return C.find_spans(_spans(spark, sf), service="bookapp", name="GET /books").select("event_id", "trace_id", "span_id")


@query("a16_traces_with_error", _V(["spans"], """
  SELECT trace_id, bool_or(service_name = 'backend' AND status_code = 'STATUS_CODE_ERROR') AS has_error FROM spans GROUP BY 1"""))
def traces_with_error(spark, sf):
    return C.traces_with_error(_spans(spark, sf), "backend")


_RANGE = "ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'"


@query("a15_count_logs", _V(["logs"], f"SELECT count(*) AS logs FROM logs WHERE {_RANGE} AND service_name = 'bookapp'"))
def count_logs(spark, sf):
    return C.count_logs(as_logs(view(spark, sf, "logs")), {"service.name": "bookapp"}, "2024-01-10", "2024-01-20")


@query("l3_log_range", _V(["logs"], f"SELECT epoch_us(ts) AS ts_us, body FROM logs WHERE {_RANGE} AND service_name = 'backend' ORDER BY ts"))
def log_range(spark, sf):
    out = C.log_range(as_logs(view(spark, sf, "logs")), {"service.name": "backend"}, "2024-01-10", "2024-01-20")
    return out.select(us("ts"), "body")


@query("j6_correlate_errors", _V(["logs"], """
  SELECT event_id, CASE WHEN severity_text IN ('ERROR', 'WARN') THEN trace_id END AS tag_trace,
    CASE WHEN severity_text IN ('ERROR', 'WARN') THEN span_id END AS tag_span FROM logs"""))
def correlate_errors(spark, sf):
    events = view(spark, sf, "logs").withColumn("tags", F.expr("cast(map() as map<string,string>)"))
    return C.correlate_errors(events).select(
        "event_id", value_of("tags", "otel.trace_id").alias("tag_trace"), value_of("tags", "otel.span_id").alias("tag_span"))


@query("j6_correlate_errors_parent", _V(["logs", "spans"], """
  SELECT l.event_id, CASE WHEN s.parent_span_id IS NOT NULL THEN l.trace_id END AS tag_trace, s.parent_span_id AS tag_span
  FROM logs l LEFT JOIN spans s ON s.trace_id = l.trace_id AND s.span_id = l.span_id AND l.severity_text IN ('ERROR', 'WARN')"""))
def correlate_errors_parent(spark, sf):
    events = view(spark, sf, "logs").withColumn("tags", F.expr("cast(map() as map<string,string>)"))
    return C.correlate_errors(events, _spans(spark, sf), use="parent").select(
        "event_id", value_of("tags", "otel.trace_id").alias("tag_trace"), value_of("tags", "otel.span_id").alias("tag_span"))


@query("j7_logs_for_traces", _V(["logs", "spans"], """
  SELECT l.event_id, l.trace_id, s.name AS span_name, s.service_name AS span_service
  FROM logs l LEFT JOIN spans s ON s.trace_id = l.trace_id AND s.span_id = l.span_id"""))
def logs_for_traces(spark, sf):
    return C.logs_for_traces(view(spark, sf, "logs"), _spans(spark, sf)).select("event_id", "trace_id", "span_name", "span_service")


@query("j8_telemetry_coverage", _V(["spans", "logs", "points"], """
  SELECT trace_id, has_span, has_logs, has_metric, has_span AND has_metric AS ok FROM (
    SELECT trace_id, bool_or(service_name = 'bookapp' AND name = 'GET /books'
        AND kind IN ('SPAN_KIND_SERVER', 'SPAN_KIND_INTERNAL')) AS has_span,
      (SELECT count(*) FROM logs WHERE service_name = 'bookapp' AND ts <= TIMESTAMP '2024-01-15 12:00:00'
        AND ts >= TIMESTAMP '2024-01-15 00:00:00') > 0 AS has_logs,
      coalesce((SELECT sum(v) FROM (SELECT span_kind, span_name, status_code, arg_max(value, ts) AS v FROM points
        WHERE service = 'bookapp' AND span_name = 'GET /books' AND ts <= TIMESTAMP '2024-01-15 12:00:00'
        AND ts > TIMESTAMP '2024-01-15 00:00:00' GROUP BY ALL)) >= 1, false) AS has_metric
    FROM spans GROUP BY trace_id)"""))
def telemetry_coverage(spark, sf):
    spans = _spans(spark, sf)
    return C.telemetry_coverage(
        spans.select("trace_id").distinct(), spans, as_logs(view(spark, sf, "logs")),
        as_points(view(spark, sf, "points")), "bookapp", "GET /books", fixed.CALLS_METRIC,
        {"service": "bookapp", "span_name": "GET /books"}, "2024-01-15 12:00:00", "12 hours")


@query("j4_link_ingestion", _V(["messages", "spans"], """
  SELECT md5('consume:book_ingestion:' || CAST(part AS VARCHAR) || ':' || CAST(off AS VARCHAR)) AS consumer_trace_id,
    CASE WHEN m.event_id % 19 <> 0 AND m.event_id % 23 <> 0 THEN split_part(traceparent, '-', 3) END AS linked_span_id,
    s.service_name AS producer_service, s.name AS producer_name
  FROM messages m LEFT JOIN spans s ON s.trace_id = split_part(m.traceparent, '-', 2)
    AND s.span_id = split_part(m.traceparent, '-', 3) AND s.kind = 'SPAN_KIND_PRODUCER'"""))
def link_ingestion(spark, sf):
    parsed = MS.parse_ingestion(as_records(view(spark, sf, "messages")))
    producers = _spans(spark, sf).filter("kind = 'SPAN_KIND_PRODUCER'")
    return C.link_ingestion(I.consumer_spans(parsed), producers).select(
        "consumer_trace_id", "linked_span_id", "producer_service", "producer_name")


@query("w8_attach_breadcrumbs", _V(["logs"], """
  SELECT event_id, host_name, coalesce(array_to_string(list_slice(w, greatest(len(w) - 9, 1), len(w)), ','), '') AS crumbs
  FROM (SELECT *, list(event_id) FILTER (WHERE severity_text = 'WARN') OVER (PARTITION BY host_name ORDER BY event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS w FROM logs) WHERE severity_text = 'ERROR'"""))
def attach_breadcrumbs(spark, sf):
    out = C.attach_breadcrumbs(view(spark, sf, "logs"), "host_name", n=10)
    return out.select("event_id", "host_name", F.array_join(
        F.transform("breadcrumbs", lambda c: c["seq"].cast("string")), ",").alias("crumbs"))


@query("w8_breadcrumbs_of_sparse_events", _V(["logs"], """
  SELECT seq, host_name, coalesce(array_to_string(list_slice(w, greatest(len(w) - 9, 1), len(w)), ','), '') AS crumbs
  FROM (SELECT *, list(seq) FILTER (WHERE severity_text = 'WARN') OVER (PARTITION BY host_name ORDER BY seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS w FROM s) WHERE severity_text = 'ERROR'""",
    s="SELECT *, CASE WHEN event_id % 3 = 0 THEN epoch_us(ts) * 100 + event_id % 97 ELSE event_id END AS seq FROM logs"))
def breadcrumbs_of_sparse_events(spark, sf):
    seq = F.expr("CASE WHEN event_id % 3 = 0 THEN unix_micros(ts) * 100 + event_id % 97 ELSE event_id END")
    out = C.attach_breadcrumbs(view(spark, sf, "logs").withColumn("seq", seq), "host_name", n=10, seq="seq")
    return out.select("seq", "host_name", F.array_join(
        F.transform("breadcrumbs", lambda c: c["seq"].cast("string")), ",").alias("crumbs"))


@query("w8_breadcrumb_count", _V(["logs"], """
  SELECT event_id, CAST(least(coalesce(count(*) FILTER (WHERE severity_text = 'WARN') OVER (PARTITION BY service_name
    ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 100) AS INT) AS crumbs
  FROM logs QUALIFY severity_text = 'ERROR'"""))
def breadcrumb_count(spark, sf):
    out = C.attach_breadcrumbs(view(spark, sf, "logs"), "service_name")
    return out.select("event_id", F.size("breadcrumbs").alias("crumbs"))


@query("p18_parse_ingestion", _V(["messages"], """
  SELECT event_id, CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL
      ELSE CAST(substr(key, 5) AS INT) END AS book_id,
    CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 'malformed payload' WHEN event_id % 17 = 0 THEN 'no valid book_id' END AS error,
    CASE WHEN event_id % 19 <> 0 AND event_id % 23 <> 0 THEN split_part(traceparent, '-', 2) END AS linked_trace_id FROM messages"""))
def parse_ingestion(spark, sf):
    parsed = MS.parse_ingestion(as_records(view(spark, sf, "messages")))
    event_id = (F.col("offset") * 3 + F.col("partition")).alias("event_id")
    return parsed.select(event_id, "book_id", "error", "linked_trace_id")


@query("a14_topic_metrics", _V(["messages"], """
  SELECT topic, part AS partition, min(off) AS oldest_offset, max(off) + 1 AS current_offset, count(*) AS messages
  FROM messages GROUP BY ALL"""))
def topic_metrics(spark, sf):
    return I.topic_metrics(as_records(view(spark, sf, "messages")))


@query("a14_consumer_lag", _V(["messages"], """
  SELECT "group", topic, partition, current_offset, consumer_offset, lag, CAST(sum(lag) OVER (PARTITION BY "group", topic) AS BIGINT) AS lag_sum
  FROM (SELECT g."group", h.topic, h.partition, current_offset, consumer_offset, greatest(current_offset - coalesce(consumer_offset, oldest), 0) AS lag
    FROM (SELECT DISTINCT "group" FROM c) g CROSS JOIN h LEFT JOIN c ON c."group" = g."group" AND c.partition = h.partition)""",
    h="SELECT topic, part AS partition, max(off) + 1 AS current_offset, min(off) AS oldest FROM messages GROUP BY ALL",
    c="""SELECT CASE WHEN event_id % 2 = 0 OR part = 0 THEN 'a' ELSE 'b' END AS "group", part AS partition, max(off) AS consumer_offset
      FROM messages GROUP BY ALL"""))
def consumer_lag(spark, sf):
    """Group b never commits on partition 0."""
    flat = view(spark, sf, "messages")
    commits = flat.select(
        F.when((F.col("event_id") % 2 == 0) | (F.col("part") == 0), "a").otherwise("b").alias("group"), "topic",
        F.col("part").alias("partition"), F.col("off").alias("offset"))
    return I.consumer_lag(as_records(flat), commits)


@query("s2_to_ingestion_records", _V(["spans"], """
  SELECT 'key-' || CAST(event_id AS VARCHAR) AS key, '{"book_id":' || CAST(event_id AS VARCHAR) || '}' AS value,
    'traceparent' AS header_key, '00-' || trace_id || '-' || span_id || '-01' AS header_value, 'book_ingestion' AS topic FROM spans"""))
def to_ingestion_records(spark, sf):
    out = MS.to_ingestion_records(_spans(spark, sf).withColumn("book_id", F.col("event_id")))
    return out.select("key", "value", F.col("headers")[0]["key"].alias("header_key"),
                      F.col("headers")[0]["value"].cast("string").alias("header_value"), "topic")


@query("s3_read_table", _V(["books"], "SELECT id, title, author, status FROM books"))
def read_table(spark, sf):
    path = fresh_dir(spark, "books")
    view(spark, sf, "books").write.parquet(path)
    return T.read_table(spark, "books", "parquet", path=path)


def _documents(spark, sf):
    """Trace documents of the spans: one per trace, which has eight spans, one batch per service."""
    text = lambda c: F.struct(F.col(c).cast("string").alias("stringValue"), F.lit(None).cast("string").alias("intValue"))
    start = F.unix_micros("start_ts") * 1000
    whole = F.struct(F.lit(None).cast("string").alias("stringValue"), F.col("event_id").cast("string").alias("intValue"))
    span = F.struct(
        F.col("trace_id").alias("traceId"), F.col("span_id").alias("spanId"), F.col("parent_span_id").alias("parentSpanId"),
        "name", "kind", start.cast("string").alias("startTimeUnixNano"),
        (start + F.col("duration_ns")).cast("string").alias("endTimeUnixNano"),
        F.array(F.struct(F.lit("event.target").alias("key"), text("event_target").alias("value")),
                F.struct(F.lit("event.id").alias("key"), whole.alias("value"))).alias("attributes"),
        F.struct(F.col("status_code").alias("code")).alias("status"))
    scoped = _spans(spark, sf).groupBy("trace_id", "service_name").agg(F.collect_list(span).alias("spans"))
    batch = F.struct(
        F.struct(F.array(F.struct(F.lit("service.name").alias("key"), text("service_name").alias("value"))).alias("attributes")).alias("resource"),
        F.array(F.struct(F.struct(F.col("service_name").alias("name")).alias("scope"), "spans")).alias("scopeSpans"))
    return scoped.groupBy("trace_id").agg(F.collect_list(batch).alias("batches"))


@query("s4_read_trace_json", _V(["spans"], """
  SELECT event_id, trace_id, span_id, parent_span_id, service_name, service_name AS scope_name, name, kind, status_code,
    epoch_us(start_ts) AS start_us, duration_ns, event_target FROM spans"""))
def read_trace_json(spark, sf):
    path = fresh_dir(spark, "traces")
    _documents(spark, sf).select("batches").write.json(path)
    return D.read_trace_json(spark, path, multi_line=False).select(
        value_of("attributes", "event.id").cast("bigint").alias("event_id"),
        "trace_id", "span_id", "parent_span_id", "service_name", "scope_name", "name", "kind", "status_code",
        us("start_ts", "start_us"), "duration_ns", value_of("attributes", "event.target").alias("event_target"))


@query("p1_flatten_spans", _V(["spans"], """
  SELECT service_name, kind, count(*) AS spans, CAST(sum(duration_ns) AS DOUBLE) AS total_ns FROM spans GROUP BY ALL"""))
def flatten_spans(spark, sf):
    flat = D.flatten_spans(_conform(_documents(spark, sf)))
    return flat.groupBy("service_name", "kind").agg(F.count(F.lit(1)).alias("spans"), F.sum(F.col("duration_ns").cast("double")).alias("total_ns"))


def _conform(docs):
    """Documents in the full wire schema, as a JSON round trip gives them."""
    from obsframe import schemas

    text = F.to_json(F.struct("batches"))
    return docs.select(F.from_json(text, schemas.TRACE_DOCUMENT).alias("d")).select("d.*")


@query("p2_kv_to_map", _V(["spans"], """
  SELECT event_id, event_target, CAST(event_id AS VARCHAR) AS id_text, 2 AS size FROM spans"""))
def kv_to_map(spark, sf):
    from obsframe.functions import kv_to_map as to_map

    value = lambda s, i: F.struct(s.alias("stringValue"), i.alias("intValue"))
    none = F.lit(None).cast("string")
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    kvs = F.array(
        pair("id", value(F.lit("overwritten"), none)),
        pair("target", value(F.col("event_target"), F.lit("0"))),
        pair("id", value(none, F.col("event_id").cast("string"))))
    out = _spans(spark, sf).select("event_id", to_map(kvs).alias("m"))
    return out.select("event_id", value_of("m", "target").alias("event_target"),
                      value_of("m", "id").alias("id_text"), F.size("m").alias("size"))


@query("s5_read_log_json", _V(["logs"], "SELECT service_name, epoch_us(ts) AS ts_us, body AS line FROM logs"))
def read_log_json(spark, sf):
    path = fresh_dir(spark, "logs")
    entry = F.array((F.unix_micros("ts") * 1000).cast("string"), F.col("body"))
    # A stream of a document holds the lines of at most 64 neighbouring events.
    part = F.floor(F.col("event_id") / 64).alias("part")
    streams = view(spark, sf, "logs").groupBy("service_name", part).agg(F.collect_list(entry).alias("values"))
    stream = F.struct(F.create_map(F.lit("service_name"), F.col("service_name")).alias("stream"), "values")
    streams.select(F.struct(F.array(stream).alias("result")).alias("data")).write.json(path)
    return D.read_log_json(spark, path, multi_line=False).select(
        value_of("labels", "service_name").alias("service_name"), us("ts"), "line")


@query("s6_read_metric_json", _V(["points"], """
  SELECT 'success' AS status, 'calls' AS metric, series, epoch_us(ts) AS ts_us,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value FROM points"""))
def read_metric_json(spark, sf):
    path = fresh_dir(spark, "metrics")
    seconds = (F.unix_micros("ts").cast("decimal(20,0)") / F.lit(1000000).cast("decimal(8,0)")).cast("decimal(20,6)").cast("string")
    value = F.when(F.col("event_id") % 5 == 0, "x").otherwise(F.col("value").cast("string"))
    text = F.format_string(
        '{"status":"success","data":{"result":[{"metric":{"__name__":"calls","series":"%s"},"value":[%s,"%s"]}]}}',
        "series", seconds, value)
    view(spark, sf, "points").select(text).write.text(path)
    return D.read_metric_json(spark, path, multi_line=False).select(
        "status", "metric", value_of("labels", "series").alias("series"), us("ts"), "value")


@query("s7_write_signal", _V(["spans"], """
  SELECT CAST(CAST(start_ts AS DATE) AS VARCHAR) AS date, count(*) AS spans FROM spans GROUP BY 1"""))
def write_signal(spark, sf):
    path = fresh_dir(spark, "store")
    T.write_signal(_spans(spark, sf), "traces", path)
    return spark.read.parquet(path).groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("spans"))


@query("u2_fan_out", _V(["logs"], """
  SELECT 'store' AS sink, event_id FROM logs UNION ALL SELECT 'errors', event_id FROM logs WHERE severity_text = 'ERROR'"""))
def fan_out(spark, sf):
    path = fresh_dir(spark, "sinks")
    T.route_out(view(spark, sf, "logs"), path, {"store": F.lit(True), "errors": F.col("severity_text") == "ERROR"})
    return spark.read.parquet(path).select("sink", "event_id")
