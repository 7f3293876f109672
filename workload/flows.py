"""Whole flows: raw spans and logs to panels and alert states."""

from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.functions.bags import value_of
from obsframe.operators.series import bound_text
from obsframe.plans import lifecycles as P
from workload.registry import query
from workload.series import _GRID, _HOUR, _STATES, _STREAKS, _rate_ctes, reduced
from workload.spans import _EDGES, _KEYS, _bounds, with_events
from workload.views import as_logs, us, view, with_views

_V = with_views
_W = 6 * _HOUR
_TOTALS = f"""SELECT {_KEYS}, w + INTERVAL 1 HOUR AS ts,
    CAST(sum(calls) OVER (PARTITION BY {_KEYS} ORDER BY w) AS DOUBLE) AS value
  FROM (SELECT {_KEYS}, time_bucket(INTERVAL 1 HOUR, start_ts) AS w, count(*) AS calls FROM spans GROUP BY ALL)"""
_RATES = _rate_ctes("f", _KEYS)
_FAILED = "SELECT * FROM totals WHERE status_code = 'STATUS_CODE_ERROR' AND service_name = 'bookapp'"


@query("w1_call_points", _V(["spans"], f"SELECT {_KEYS}, epoch_us(ts) AS ts_us, value FROM totals", totals=_TOTALS))
def call_points(spark, sf):
    points = P.call_points(view(spark, sf, "spans"), "1 hour")
    names = {"service": "service_name", "span_name": "name", "span_kind": "kind", "status_code": "status_code"}
    return points.select(*[value_of("labels", k).alias(c) for k, c in names.items()], us("ts"), "value")


_V_OF_RATES = f"SELECT t_us, round(sum(inc / {_W / 1e6}), 9) AS value FROM r GROUP BY t_us"


@query("w7_error_alert", _V(["spans"], f"SELECT t_us, value, state FROM ({_STATES})",
    totals=_TOTALS, f=_FAILED, **_RATES, v=_V_OF_RATES, grid=_GRID,
    q="SELECT t_us, value, coalesce(value > 0.0002, false) AS breach FROM grid LEFT JOIN v USING (t_us)", b=_STREAKS))
def error_alert(spark, sf):
    out = P.error_alert(view(spark, sf, "spans"), "bookapp", "1 hour", "6 hours", "1 hour", 0.0002, "2 hours",
                        lookback=None)
    return out.select(us("t"), F.round("value", 9).alias("value"), "state")


@query("w7_error_alert_range", _V(["spans"], _STATES,
    totals=_TOTALS, f=_FAILED, **_RATES, v=_V_OF_RATES, grid=_GRID, q=reduced(0.0002), b=_STREAKS))
def error_alert_range(spark, sf):
    out = P.error_alert(view(spark, sf, "spans"), "bookapp", "1 hour", "6 hours", "1 hour", 0.0002, "2 hours",
                        lookback="3 hours")
    return out.select(us("t"), F.round("value", 9).alias("value"), "state", us("since"))


@query("w6_latest_error_rate", _V(["spans"], f"""
  SELECT max(t_us) AS t_us, arg_max(value, t_us) AS value FROM
    (SELECT t_us, round(sum(inc / {_W / 1e6}), 9) AS value FROM r GROUP BY t_us)""", totals=_TOTALS, f=_FAILED, **_RATES))
def latest_error_rate(spark, sf):
    out = P.latest_error_rate(view(spark, sf, "spans"), "bookapp", "1 hour", "6 hours", "1 hour")
    return out.select(us("t"), F.round("value", 9).alias("value"))


_DAY = 24 * _HOUR


@query("w4_request_heatmap", _V(["spans"], """
  SELECT client, connection_type, le, t_us, round(cell, 9) AS cell FROM c WHERE cell > 1e-9""",
    e=_EDGES.replace("SELECT s.trace_id,", "SELECT s.start_ts AS server_ts, s.trace_id,"),
    bounds=_bounds(fixed.EDGE_BOUNDS),
    d="""SELECT client, connection_type, le, le_ns, time_bucket(INTERVAL 1 DAY, server_ts) AS w,
      count(*) FILTER (WHERE server_ns <= le_ns) AS n FROM e CROSS JOIN bounds WHERE server = 'bookapp' GROUP BY ALL""",
    f="""SELECT client, connection_type, le, le_ns, w + INTERVAL 1 DAY AS ts,
      CAST(sum(n) OVER (PARTITION BY client, connection_type, le ORDER BY w) AS DOUBLE) AS value FROM d""",
    **_rate_ctes("f", "client, connection_type, le, le_ns", 3 * _DAY, _DAY),
    c=f"""SELECT *, inc / {3 * _DAY / 1e6} - coalesce(lag(inc / {3 * _DAY / 1e6}) OVER
      (PARTITION BY client, connection_type, t_us ORDER BY le_ns), 0) AS cell FROM r"""))
def request_heatmap(spark, sf):
    out = P.request_heatmap(view(spark, sf, "spans"), "bookapp", "1 day", "3 days", "1 day")
    return out.select("client", "connection_type", bound_text("le").alias("le"), us("t"),
                      F.round("cell", 9).alias("cell"))


@query("w4_edge_latency_points", _V(["spans"], """
  SELECT client, server, connection_type, le, epoch_us(w) + 86400000000 AS ts_us,
    CAST(sum(n) OVER (PARTITION BY client, server, connection_type, le ORDER BY w) AS DOUBLE) AS value FROM d""",
    e=_EDGES.replace("SELECT s.trace_id,", "SELECT s.start_ts AS server_ts, s.trace_id,"),
    bounds=_bounds(fixed.EDGE_BOUNDS),
    d="""SELECT client, server, connection_type, le, time_bucket(INTERVAL 1 DAY, server_ts) AS w,
      count(*) FILTER (WHERE server_ns <= le_ns) AS n FROM e CROSS JOIN bounds GROUP BY ALL"""))
def edge_latency_points(spark, sf):
    points = P.edge_latency_points(view(spark, sf, "spans"), "1 day")
    return points.select(*[value_of("labels", k).alias(k) for k in ("client", "server", "connection_type", "le")],
                         us("ts"), "value")


_SPAN_LABELS = {"service": "service_name", "span_name": "name", "span_kind": "kind", "status_code": "status_code"}
_OVER = f"OVER (PARTITION BY {_KEYS}, le ORDER BY w)"


@query("w1_latency_points", _V(["spans"], f"""
  SELECT 'traces_spanmetrics_latency_bucket' AS metric, {_KEYS}, le, epoch_us(w) + 86400000000 AS ts_us,
    CAST(sum(n) {_OVER} AS DOUBLE) AS value FROM d
  UNION ALL SELECT 'traces_spanmetrics_latency_count', {_KEYS}, NULL, epoch_us(w) + 86400000000,
    CAST(sum(n) {_OVER} AS DOUBLE) FROM d WHERE le = '+Inf'
  UNION ALL SELECT 'traces_spanmetrics_latency_sum', {_KEYS}, NULL, epoch_us(w) + 86400000000,
    CAST(sum(ns) {_OVER} AS DOUBLE) / 1e9 FROM d WHERE le = '+Inf'""",
    bounds=_bounds(fixed.SPAN_BOUNDS),
    d=f"""SELECT {_KEYS}, le, time_bucket(INTERVAL 1 DAY, start_ts) AS w, count(*) FILTER (WHERE duration_ns <= le_ns) AS n,
      sum(duration_ns) AS ns FROM spans CROSS JOIN bounds GROUP BY ALL"""))
def latency_points(spark, sf):
    points = P.latency_points(view(spark, sf, "spans"), "1 day")
    return points.select("metric", *[value_of("labels", k).alias(c) for k, c in (_SPAN_LABELS | {"le": "le"}).items()],
                         us("ts"), "value")


@query("w4_edge_client_points", _V(["spans"], """
  SELECT client, server, connection_type, le, epoch_us(w) + 86400000000 AS ts_us,
    CAST(sum(n) OVER (PARTITION BY client, server, connection_type, le ORDER BY w) AS DOUBLE) AS value FROM d""",
    e=_EDGES.replace("SELECT s.trace_id,", "SELECT c.start_ts AS client_ts, s.trace_id,"),
    bounds=_bounds(fixed.EDGE_BOUNDS),
    d="""SELECT client, server, connection_type, le, time_bucket(INTERVAL 1 DAY, client_ts) AS w,
      count(*) FILTER (WHERE client_ns <= le_ns) AS n FROM e CROSS JOIN bounds GROUP BY ALL"""))
def edge_client_points(spark, sf):
    points = P.edge_latency_points(view(spark, sf, "spans"), "1 day", side="client")
    return points.select(*[value_of("labels", k).alias(k) for k in ("client", "server", "connection_type", "le")],
                         us("ts"), "value")


@query("w1_edge_request_points", _V(["spans"], """
  SELECT metric, client, server, connection_type, epoch_us(w) + 86400000000 AS ts_us,
    CAST(sum(n) OVER (PARTITION BY metric, client, server, connection_type ORDER BY w) AS DOUBLE) AS value FROM d""",
    e=_EDGES.replace("SELECT s.trace_id,", "SELECT s.start_ts AS server_ts, s.trace_id,"),
    d="""SELECT metric, client, server, connection_type, time_bucket(INTERVAL 1 DAY, server_ts) AS w,
      CAST(sum(CASE WHEN metric = 'traces_service_graph_request_total' OR failed THEN 1 ELSE 0 END) AS BIGINT) AS n
      FROM e CROSS JOIN (VALUES ('traces_service_graph_request_total'), ('traces_service_graph_request_failed_total')) m(metric)
      GROUP BY ALL"""))
def edge_request_points(spark, sf):
    points = P.edge_request_points(view(spark, sf, "spans"), "1 day")
    return points.select("metric", *[value_of("labels", k).alias(k) for k in ("client", "server", "connection_type")],
                         us("ts"), "value")


@query("w1_span_event_points", _V(["spans"], """
  SELECT 'bt.span.event.count' AS metric, epoch_us(w) + 86400000000 AS ts_us, CAST(sum(n) OVER (ORDER BY w) AS DOUBLE) AS value
  FROM (SELECT time_bucket(INTERVAL 1 DAY, start_ts) AS w, sum(CASE WHEN event_id % 3 = 0 THEN 2 ELSE 0 END) AS n
    FROM spans GROUP BY 1)"""))
def span_event_points(spark, sf):
    return P.span_event_points(with_events(view(spark, sf, "spans")), "1 day").select("metric", us("ts"), "value")


@query("a5_log_count_points", _V(["logs"], r"""
  SELECT file_path, epoch_us(w) + 86400000000 AS ts_us, CAST(sum(n) OVER (PARTITION BY file_path ORDER BY w) AS DOUBLE) AS value
  FROM (SELECT coalesce(nullif(regexp_extract(name, '^(?:event\s+)?([^\s:]+):(\d+)', 1), ''), 'unspecified_file_path') AS file_path,
    time_bucket(INTERVAL 1 DAY, ts) AS w, count(*) AS n FROM logs GROUP BY ALL)"""))
def log_count_points(spark, sf):
    points = P.log_count_points(as_logs(view(spark, sf, "logs")), "1 day")
    return points.select(value_of("labels", "file_path").alias("file_path"), us("ts"), "value")
