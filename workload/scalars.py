"""Scalar functions."""

from pyspark.sql import functions as F

from obsframe import functions as O
from obsframe.functions.scalars import is_valid_span_context
from obsframe.operators.routes import route_template
from workload.registry import query
from workload.views import table, view, with_views

_V = with_views


@query("f1_traceparent_parse", _V(["messages"], """
  SELECT event_id, split_part(traceparent, '-', 1) AS version, split_part(traceparent, '-', 2) AS trace_id,
         split_part(traceparent, '-', 3) AS span_id, split_part(traceparent, '-', 4) AS flags
  FROM messages"""))
def traceparent_parse(spark, sf):
    ctx = O.traceparent_parse("traceparent")
    return view(spark, sf, "messages").select(
        "event_id", *[ctx[f].alias(f) for f in ("version", "trace_id", "span_id", "flags")]
    )


@query("f2_traceparent_format", _V(["logs"], """
  SELECT event_id, '00-' || trace_id || '-' || span_id || '-01' AS traceparent FROM logs"""))
def traceparent_format(spark, sf):
    return view(spark, sf, "logs").select(
        "event_id", O.traceparent_format("trace_id", "span_id").alias("traceparent")
    )


@query("f3_is_valid_trace_id", """
  WITH ids AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN md5(props) WHEN 1 THEN substr(md5(props), 1, 31)
                 WHEN 2 THEN replace(md5(props), 'a', 'x') ELSE upper(md5(props)) END AS id FROM events)
  SELECT event_id, id, length(id) = 32 AND length(regexp_replace(id, '[0-9a-fA-F]', '', 'g')) = 0 AS valid FROM ids""")
def is_valid_trace_id(spark, sf):
    ids = table(spark, sf, "events").select("event_id", F.expr(
        "CASE event_id % 4 WHEN 0 THEN md5(props) WHEN 1 THEN substr(md5(props), 1, 31) "
        "WHEN 2 THEN replace(md5(props), 'a', 'x') ELSE upper(md5(props)) END AS id"))
    return ids.select("event_id", "id", O.is_valid_trace_id("id").alias("valid"))


@query("f4_header_get", _V(["messages"], """
  SELECT event_id, traceparent AS found FROM messages"""))
def header_get(spark, sf):
    df = view(spark, sf, "messages")
    header = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    bad = F.unhex(F.lit("FFFE"))
    headers = F.array(
        header("other", F.encode("key", "UTF-8")),
        header("TRACEPARENT", bad),
        header("TraceParent", F.encode("traceparent", "UTF-8")),
        header("traceparent", F.encode(F.lit("second"), "UTF-8")),
    )
    first = F.array(header("other", F.encode("key", "UTF-8")))
    return df.select("event_id", O.header_get(
        F.when(F.col("traceparent").isNotNull(), headers).otherwise(first), "traceparent").alias("found"))


@query("f5_nano_times", """
  SELECT event_id, epoch_us(ts) AS ts_us, CAST(round(value * 1000000) AS BIGINT) AS duration_ns FROM events""")
def nano_times(spark, sf):
    start = F.unix_micros("ts") * 1000 + 999
    nanos = table(spark, sf, "events").select(
        "event_id",
        start.cast("string").alias("a"),
        (start + F.round(F.col("value") * 1000000).cast("bigint")).cast("string").alias("b"),
    )
    return nanos.select(
        "event_id", F.unix_micros(O.nano_to_ts("a")).alias("ts_us"), O.duration_ns("a", "b").alias("duration_ns")
    )


@query("f6_http_reason", """
  WITH c AS (SELECT event_id, CAST(400 + event_id % 200 AS INT) AS code FROM events)
  SELECT event_id, code, CASE code
    WHEN 400 THEN 'Bad Request' WHEN 401 THEN 'Unauthorized' WHEN 402 THEN 'Payment Required' WHEN 403 THEN 'Forbidden'
    WHEN 404 THEN 'Not Found' WHEN 405 THEN 'Method Not Allowed' WHEN 406 THEN 'Not Acceptable'
    WHEN 407 THEN 'Proxy Authentication Required' WHEN 408 THEN 'Request Timeout' WHEN 409 THEN 'Conflict'
    WHEN 410 THEN 'Gone' WHEN 411 THEN 'Length Required' WHEN 412 THEN 'Precondition Failed'
    WHEN 413 THEN 'Payload Too Large' WHEN 414 THEN 'URI Too Long' WHEN 415 THEN 'Unsupported Media Type'
    WHEN 416 THEN 'Range Not Satisfiable' WHEN 417 THEN 'Expectation Failed' WHEN 418 THEN 'I''m a teapot'
    WHEN 421 THEN 'Misdirected Request' WHEN 422 THEN 'Unprocessable Entity' WHEN 423 THEN 'Locked'
    WHEN 424 THEN 'Failed Dependency' WHEN 426 THEN 'Upgrade Required' WHEN 428 THEN 'Precondition Required'
    WHEN 429 THEN 'Too Many Requests' WHEN 431 THEN 'Request Header Fields Too Large'
    WHEN 451 THEN 'Unavailable For Legal Reasons' WHEN 500 THEN 'Internal Server Error' WHEN 501 THEN 'Not Implemented'
    WHEN 502 THEN 'Bad Gateway' WHEN 503 THEN 'Service Unavailable' WHEN 504 THEN 'Gateway Timeout'
    WHEN 505 THEN 'HTTP Version Not Supported' WHEN 506 THEN 'Variant Also Negotiates' WHEN 507 THEN 'Insufficient Storage'
    WHEN 508 THEN 'Loop Detected' WHEN 510 THEN 'Not Extended' WHEN 511 THEN 'Network Authentication Required'
    ELSE 'Injected Error' END AS reason FROM c""")
def http_reason(spark, sf):
    codes = table(spark, sf, "events").select(
        "event_id", (F.lit(400) + F.col("event_id") % 200).cast("int").alias("code"))
    return codes.withColumn("reason", O.http_reason("code"))


@query("f7_route_template", _V(["requests"], """
  SELECT request_id, CASE WHEN path = '/books' THEN '/books' WHEN path = '/books/add' THEN '/books/add'
    WHEN regexp_full_match(path, '/books/[^/]+') THEN '/books/{id}' END AS route FROM requests"""))
def routes(spark, sf):
    return view(spark, sf, "requests").select(
        "request_id", route_template("path", ["/books/{id}", "/books", "/books/add"]).alias("route"))


@query("f8_status_forms", """
  WITH s AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Available' WHEN 1 THEN 'Borrowed' WHEN 2 THEN 'Lost'
               WHEN 3 THEN 'available' ELSE p_type END AS raw FROM part)
  SELECT p_partkey, CASE WHEN raw IN ('Available', 'Borrowed', 'Lost') THEN lower(raw) END AS db_status,
         CASE raw WHEN 'available' THEN 'Available' END AS json_status FROM s""")
def status_forms(spark, sf):
    raw = table(spark, sf, "part").select("p_partkey", F.expr(
        "CASE p_partkey % 5 WHEN 0 THEN 'Available' WHEN 1 THEN 'Borrowed' WHEN 2 THEN 'Lost' "
        "WHEN 3 THEN 'available' ELSE p_type END AS raw"))
    return raw.select("p_partkey", O.status_to_db("raw").alias("db_status"), O.status_to_json("raw").alias("json_status"))


@query("f9_hex_pad", """
  WITH h AS (SELECT event_id, upper(substr(md5(props), 1, CAST(5 + event_id % 12 AS INT))) AS h FROM events)
  SELECT event_id, lpad(lower(h), 32, '0') AS trace_id, lpad(lower(h), 16, '0') AS span_id FROM h""")
def hex_pad(spark, sf):
    h = table(spark, sf, "events").select(
        "event_id", F.expr("upper(substr(md5(props), 1, CAST(5 + event_id % 12 AS INT))) AS h"))
    return h.select("event_id", O.hex_pad("h", 32).alias("trace_id"), O.hex_pad("h", 16).alias("span_id"))


@query("f10_message_key", "SELECT event_id, 'key-' || CAST(user_id AS VARCHAR) AS key FROM events")
def message_key(spark, sf):
    return table(spark, sf, "events").select("event_id", O.message_key("user_id").alias("key"))


@query("f11_wire_forms", _V(["spans"], """
  SELECT event_id, kind AS span_kind, status_code FROM spans"""))
def wire_forms(spark, sf):
    sdk = view(spark, sf, "spans").select(
        "event_id",
        F.when(F.col("event_id") % 2 == 0, F.initcap(F.replace("kind", F.lit("SPAN_KIND_"), F.lit(""))))
        .otherwise(F.col("kind")).alias("k"),
        F.when(F.col("event_id") % 2 == 0, F.replace("status_code", F.lit("STATUS_CODE_"), F.lit("")))
        .otherwise(F.col("status_code")).alias("s"),
    )
    return sdk.select("event_id", O.span_kind("k").alias("span_kind"), O.status_code("s").alias("status_code"))


@query("f12_level_rank", _V(["logs"], """
  SELECT event_id, CASE severity_text WHEN 'ERROR' THEN 1 WHEN 'WARN' THEN 2 WHEN 'INFO' THEN 3
    WHEN 'DEBUG' THEN 4 ELSE 5 END AS rank FROM logs"""))
def level_rank(spark, sf):
    return view(spark, sf, "logs").select("event_id", O.level_rank("severity_text").alias("rank"))


@query("f13_span_context_valid", _V(["logs"], """
  SELECT event_id, trace_id IS NOT NULL AS valid FROM logs"""))
def span_context_valid(spark, sf):
    return view(spark, sf, "logs").select("event_id", is_valid_span_context("trace_id", "span_id").alias("valid"))
