"""Log and event rewrites, routing, filters and sampling."""

from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.functions.bags import value_of
from obsframe.operators import attributes as A
from obsframe.operators import routing as R
from workload.registry import query
from workload.views import as_logs, as_points, view, with_views

_V = with_views
_RX = r"^(?:event\s+)?([^\s:]+):(\d+)"


def _logs(spark, sf):
    return as_logs(view(spark, sf, "logs"))


def _attr(key, out=None):
    return value_of("attributes", key).alias(out or key)


def _res(key, out):
    return value_of("resource", key).alias(out)


@query("p3_attr_insert", _V(["logs"], """
  SELECT event_id, 'otel-collector' AS injected, host_name AS kept FROM logs"""))
def attr_insert(spark, sf):
    df = A.attr_insert(_logs(spark, sf), "resource", fixed.LOG_RESOURCE_KEY, fixed.LOG_RESOURCE_VALUE)
    df = A.attr_insert(df, "resource", "host.name", "never")
    return df.select("event_id", _res(fixed.LOG_RESOURCE_KEY, "injected"), _res("host.name", "kept"))


@query("p4_attr_extract", _V(["logs"], rf"""
  SELECT event_id, name, nullif(regexp_extract(name, '{_RX}', 1), '') AS file_path,
         nullif(regexp_extract(name, '{_RX}', 2), '') AS line_number FROM logs"""))
def attr_extract(spark, sf):
    df = A.attr_extract(
        _logs(spark, sf), "attributes", "name", fixed.LOG_LOCATION_PATTERN, fixed.LOG_LOCATION_KEYS)
    return df.select("event_id", _attr("name"), _attr("file_path"), _attr("line_number"))


@query("p5_attr_convert_int", _V(["logs"], """
  SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(event_id % 300 AS VARCHAR) WHEN 1 THEN 'x1' END AS line_number,
         CASE event_id % 3 WHEN 0 THEN event_id % 300 END AS line FROM logs"""))
def attr_convert_int(spark, sf):
    raw = F.expr("CASE event_id % 3 WHEN 0 THEN '00' || CAST(event_id % 300 AS STRING) WHEN 1 THEN 'x1' END")
    df = A.attr_set(_logs(spark, sf), "attributes", "line_number", raw)
    df = A.attr_convert_int(df, "attributes", "line_number", typed="line")
    return df.select("event_id", _attr("line_number"), "line")


@query("p6_attr_upsert_from", _V(["logs"], """
  SELECT event_id, name AS copied, CAST(NULL AS VARCHAR) AS missing FROM logs"""))
def attr_upsert_from(spark, sf):
    df = A.attr_upsert_from(_logs(spark, sf), "attributes", "name-copied", "name")
    df = A.attr_upsert_from(df, "attributes", "missing", "not there")
    return df.select("event_id", _attr("name-copied", "copied"), _attr("missing"))


@query("p7_attr_delete", _V(["logs"], """
  SELECT event_id, CAST(0 AS INT) AS attributes_left, service_name AS kept FROM logs"""))
def attr_delete(spark, sf):
    df = A.attr_delete(A.attr_delete(_logs(spark, sf), "attributes", "name"), "resource", "host.name")
    return df.select("event_id", F.size("attributes").alias("attributes_left"), _res("service.name", "kept"))


@query("p8_attr_set", _V(["logs"], """
  SELECT event_id, host_name AS container_id, severity_text AS level, trace_id FROM logs"""))
def attr_set(spark, sf):
    df = A.attr_set(_logs(spark, sf), "resource", "container_id", value_of("resource", "host.name"))
    df = A.attr_set(df, "attributes", "level", F.col("severity_text"))
    df = A.attr_set(df, "attributes", "trace", F.col("trace_id"))
    return df.select("event_id", _res("container_id", "container_id"), _attr("level"), _attr("trace", "trace_id"))


@query("p9_promote_labels", _V(["points"], """
  SELECT event_id, service AS container_name, CAST(NULL AS VARCHAR) AS image_name, series AS cluster_alias FROM points"""))
def promote_labels(spark, sf):
    df = as_points(view(spark, sf, "points"))
    df = A.promote_labels(df, {**fixed.CONTAINER_LABELS, **fixed.QUEUE_LABELS})
    return df.select("event_id", *[
        value_of("labels", k).alias(k) for k in ("container_name", "image_name", "cluster_alias")])


@query("p10_process_logs", _V(["logs"], rf"""
  SELECT event_id, 'otel-collector' AS injected, host_name AS container_id, CAST(NULL AS VARCHAR) AS host_name,
         severity_text AS level, nullif(regexp_extract(name, '{_RX}', 1), '') AS file_path,
         CAST(CAST(nullif(regexp_extract(name, '{_RX}', 2), '') AS BIGINT) AS VARCHAR) AS line_number,
         name AS copied, CAST(NULL AS VARCHAR) AS name FROM logs"""))
def process_logs(spark, sf):
    return A.process_logs(_logs(spark, sf)).select(
        "event_id", _res(fixed.LOG_RESOURCE_KEY, "injected"), _res("container_id", "container_id"),
        _res("host.name", "host_name"), _attr("level"), _attr("file_path"), _attr("line_number"),
        _attr("name-copied", "copied"), _attr("name"))


@query("p11_route_by_level", _V(["logs"], """
  SELECT event_id, CASE severity_text WHEN 'ERROR' THEN 'event' WHEN 'WARN' THEN 'breadcrumb' ELSE 'log' END AS route
  FROM logs WHERE severity_text IN ('ERROR', 'WARN', 'INFO')"""))
def route_by_level(spark, sf):
    return R.route_by_level(view(spark, sf, "logs")).select("event_id", "route")


_RANK = "CASE severity_text WHEN 'ERROR' THEN 1 WHEN 'WARN' THEN 2 WHEN 'INFO' THEN 3 WHEN 'DEBUG' THEN 4 ELSE 5 END"


@query("p12_filter_by_target", _V(["logs"], f"""
  SELECT event_id, 'traces' AS rules FROM logs WHERE {_RANK} <=
    CASE WHEN target LIKE 'bookapp%' THEN 5 WHEN target LIKE 'sqlx%' THEN 4 ELSE 3 END
  UNION ALL
  SELECT event_id, 'logs' AS rules FROM logs WHERE {_RANK} <=
    CASE WHEN target LIKE 'bookapp%' THEN 4 WHEN target LIKE 'sqlx%' THEN 3 WHEN target LIKE 'hyper%' THEN 1 ELSE 3 END"""))
def filter_by_target(spark, sf):
    logs = view(spark, sf, "logs")
    kept = lambda rules, name: R.filter_by_target(logs, rules).select("event_id", F.lit(name).alias("rules"))
    return kept(fixed.TRACE_TARGET_LEVELS, "traces").unionByName(kept(fixed.LOG_TARGET_LEVELS, "logs"))


@query("p13_before_send", _V(["requests"], """
  SELECT request_id, 'bookapp' AS service, method AS method_tag, CAST(NULL AS VARCHAR) AS server_name
  FROM requests WHERE NOT contains(url, '/health') OR request_id % 6 = 0"""))
def before_send(spark, sf):
    events = view(spark, sf, "requests").select(
        "request_id", F.when(F.col("request_id") % 6 != 0, F.col("url")).alias("url"),
        F.create_map(F.lit("method"), F.col("method")).alias("tags"), F.lit("node-1").alias("server_name"))
    return R.before_send(events).select(
        "request_id", value_of("tags", "service").alias("service"),
        value_of("tags", "method").alias("method_tag"), "server_name")


@query("p14_sample_traces", _V(["spans"], """
  SELECT event_id, trace_id FROM spans
  WHERE CAST('0x' || substr(md5(trace_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < 0.1"""))
def sample_traces(spark, sf):
    return R.sample_traces(view(spark, sf, "spans")).select("event_id", "trace_id")


@query("p15_drop_untraced", _V(["requests"], "SELECT request_id, path FROM requests WHERE path <> '/health'"))
def drop_untraced(spark, sf):
    return R.drop_untraced(view(spark, sf, "requests")).select("request_id", "path")
