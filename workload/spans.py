"""Span metrics, service graph, log and event counts."""

from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.operators import attributes as A
from obsframe.operators import servicegraph as G
from obsframe.operators import spanmetrics as M
from obsframe.operators.routes import route_template
from obsframe.operators.series import bound_text
from workload.registry import query
from workload.views import as_logs, us, view, with_views

_V = with_views
_KEYS = "service_name, name, kind, status_code"


def _bounds(bounds):
    rows = ", ".join(f"('{b}', CAST({round(b * 1e9)} AS BIGINT))" for b in bounds)
    return f"SELECT * FROM (VALUES {rows}, ('+Inf', 9223372036854775807)) t(le, le_ns)"


def _spans(spark, sf):
    return view(spark, sf, "spans")


@query("a1_span_calls", _V(["spans"], f"SELECT {_KEYS}, count(*) AS calls FROM spans GROUP BY ALL"))
def span_calls(spark, sf):
    return M.span_calls(_spans(spark, sf))


@query("a1_span_calls_windowed", _V(["spans"], f"""
  SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, start_ts)) AS window_us, {_KEYS}, count(*) AS calls FROM spans GROUP BY ALL"""))
def span_calls_windowed(spark, sf):
    return M.span_calls(_spans(spark, sf), window="1 hour").select(
        us("window_start", "window_us"), *M.CALL_KEYS, "calls")


@query("a2_span_latency", _V(["spans"], f"""
  SELECT {_KEYS}, le, count(*) FILTER (WHERE duration_ns <= le_ns) AS bucket_count, count(*) AS count,
         CAST(sum(duration_ns) AS DOUBLE) AS sum_ns FROM spans CROSS JOIN b GROUP BY ALL""",
    b=_bounds(fixed.SPAN_BOUNDS)))
def span_latency(spark, sf):
    return M.span_latency(_spans(spark, sf)).withColumn("le", bound_text("le"))


_EDGES = """SELECT s.trace_id, c.service_name AS client, s.service_name AS server, c.span_id AS client_span_id,
    s.span_id AS server_span_id, CASE WHEN c.kind = 'SPAN_KIND_PRODUCER' THEN 'messaging_system' ELSE '' END AS connection_type,
    c.duration_ns AS client_ns, s.duration_ns AS server_ns,
    c.status_code = 'STATUS_CODE_ERROR' OR s.status_code = 'STATUS_CODE_ERROR' AS failed
  FROM spans s JOIN spans c ON c.trace_id = s.trace_id AND c.span_id = s.parent_span_id
  WHERE (c.kind = 'SPAN_KIND_CLIENT' AND s.kind = 'SPAN_KIND_SERVER')
     OR (c.kind = 'SPAN_KIND_PRODUCER' AND s.kind = 'SPAN_KIND_CONSUMER')"""


@query("j5_service_edges", _V(["spans"], _EDGES))
def service_edges(spark, sf):
    return G.service_edges(_spans(spark, sf)).drop("client_ts", "server_ts")


@query("a3_service_graph", _V(["spans"], """
  SELECT client, server, connection_type, le, count(*) AS request_total, count(*) FILTER (WHERE failed) AS failed_total,
    count(*) FILTER (WHERE server_ns <= le_ns) AS server_count, count(*) FILTER (WHERE client_ns <= le_ns) AS client_count,
    CAST(sum(server_ns) AS DOUBLE) AS server_sum_ns, CAST(sum(client_ns) AS DOUBLE) AS client_sum_ns
  FROM e CROSS JOIN b GROUP BY ALL""", e=_EDGES, b=_bounds(fixed.EDGE_BOUNDS)))
def service_graph(spark, sf):
    return G.service_graph(_spans(spark, sf)).withColumn("le", bound_text("le"))


def _pick(q, keys):
    return f"max(CASE WHEN rn = greatest(CAST(ceil({q}::DOUBLE * n) AS BIGINT), 1) THEN duration_ns END)"


_RANKED = """SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY duration_ns) AS rn, count(*) OVER (PARTITION BY {k}) AS n
  FROM {src}"""


@query("a4_red_summary", _V(["spans"], f"""
  SELECT service_name, name, count(*) AS calls, count(*) FILTER (WHERE status_code = 'STATUS_CODE_ERROR') AS errors,
    count(*) FILTER (WHERE status_code = 'STATUS_CODE_ERROR') / count(*) AS error_ratio, avg(duration_ns) AS avg_ns,
    {_pick(0.5, '')} AS p50_ns, {_pick(0.95, '')} AS p95_ns, {_pick(0.99, '')} AS p99_ns
  FROM r GROUP BY service_name, name""", r=_RANKED.format(k="service_name, name", src="spans")))
def red_summary(spark, sf):
    return M.red_summary(_spans(spark, sf))


@query("a4_red_summary_approx", _V(["spans"], """
  SELECT DISTINCT service_name, name, TRUE AS p50_in_bound, TRUE AS p99_in_bound FROM spans"""))
def red_summary_approx(spark, sf):
    """Whether approximate quantiles are within their bound: a thousandth of the rows, in rank."""
    spans, accuracy, keys = _spans(spark, sf), 1000, ["service_name", "name"]
    found = M.red_summary(spans, keys, (0.5, 0.99), accuracy)
    within = []
    for q, name in ((0.5, "p50"), (0.99, "p99")):
        below, upto = (F.count_if(F.col("duration_ns") < F.col(f"{name}_ns")), F.count_if(F.col("duration_ns") <= F.col(f"{name}_ns")))
        slack = F.greatest(F.count(F.lit(1)) / accuracy, F.lit(1))
        within.append(((below <= q * F.count(F.lit(1)) + slack) & (upto >= q * F.count(F.lit(1)) - slack)).alias(f"{name}_in_bound"))
    return spans.select(*keys, "duration_ns").join(found.select(*keys, "p50_ns", "p99_ns"), keys).groupBy(*keys).agg(*within)


@query("a5_log_count", _V(["logs"], r"""
  SELECT coalesce(nullif(regexp_extract(name, '^(?:event\s+)?([^\s:]+):(\d+)', 1), ''), 'unspecified_file_path') AS file_path,
    count(*) AS logs FROM logs GROUP BY 1"""))
def log_count(spark, sf):
    return M.log_count(A.process_logs(as_logs(view(spark, sf, "logs"))))


def with_events(spans):
    """Each span raises an exception event if it failed, and some database events."""
    event = lambda name, **a: F.struct(
        F.lit(name).alias("name"), F.col("start_ts").alias("ts"),
        F.create_map(*[x for k, v in a.items() for x in (F.lit(k.replace("__", ".")), v)]).alias("attributes"))
    raised = event("exception", exception__type=F.lit("DbError"),
                   exception__message=F.concat(F.lit("at "), F.col("name")))
    db = event("query", code__namespace=F.lit("bookapp::db"))
    other = event("query", code__namespace=F.lit("bookapp::rest"))
    none = F.array().cast("array<struct<name:string,ts:timestamp,attributes:map<string,string>>>")
    return spans.withColumn("events", F.concat(
        F.when(F.col("status_code") == "STATUS_CODE_ERROR", F.array(raised)).otherwise(none),
        F.when(F.col("event_id") % 3 == 0, F.array(db, other, db)).otherwise(F.array(other))))


@query("a6_span_event_count", _V(["spans"], """
  SELECT epoch_us(time_bucket(INTERVAL 1 DAY, start_ts)) AS window_us,
    CAST(sum(CASE WHEN event_id % 3 = 0 THEN 2 ELSE 0 END) AS BIGINT) AS events FROM spans GROUP BY 1"""))
def span_event_count(spark, sf):
    return M.span_event_count(with_events(_spans(spark, sf)), window="1 day").select(
        us("window_start", "window_us"), "events")


@query("a7_exception_count", _V(["spans"], f"""
  SELECT {_KEYS}, 'DbError' AS exception_type, 'at ' || name AS exception_message, count(*) AS exceptions
  FROM spans WHERE status_code = 'STATUS_CODE_ERROR' GROUP BY ALL"""))
def exception_count(spark, sf):
    return M.exception_count(with_events(_spans(spark, sf)))


@query("a8_event_counter", """
  SELECT 'my_book_counter' AS metric, CAST(user_id AS VARCHAR) AS book_id, CAST(count(*) AS DOUBLE) AS value
  FROM events GROUP BY user_id
  UNION ALL SELECT 'queried_books', NULL, CAST(count(*) AS DOUBLE) FROM events""")
def event_counter(spark, sf):
    from workload.views import table

    got = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("book_id"))
    return M.event_counter(got, "my_book_counter", ["book_id"]).unionByName(
        M.event_counter(got, "queried_books"), allowMissingColumns=True)


@query("a9_http_metrics", _V(["requests"], """
  SELECT method, CASE WHEN path = '/books' THEN '/books' WHEN path = '/books/add' THEN '/books/add'
    WHEN regexp_full_match(path, '/books/[^/]+') THEN '/books/{id}' END AS route, status, le,
    count(*) FILTER (WHERE duration_ns <= le_ns) AS bucket_count, count(*) AS count, CAST(sum(duration_ns) AS DOUBLE) AS sum_ns
  FROM requests CROSS JOIN b GROUP BY ALL""", b=_bounds(fixed.HTTP_BOUNDS)))
def http_metrics(spark, sf):
    df = view(spark, sf, "requests").withColumn(
        "route", route_template("path", ["/books", "/books/add", "/books/{id}"]))
    return M.http_metrics(df).withColumn("le", bound_text("le"))


@query("a10_active_requests", _V(["spans"], """
  SELECT service_name, at_us, CAST(sum(delta) OVER (PARTITION BY service_name ORDER BY at_us) AS BIGINT) AS active
  FROM s QUALIFY delta <> 0""",
    c="""SELECT service_name, epoch_us(start_ts) AS at_us, 1 AS d FROM spans WHERE duration_ns > 0 UNION ALL
      SELECT service_name, epoch_us(start_ts) + CAST(ceil(duration_ns / 1000) AS BIGINT), -1 FROM spans WHERE duration_ns > 0""",
    s="SELECT service_name, at_us, sum(d) AS delta FROM c GROUP BY ALL"))
def active_requests(spark, sf):
    return M.active_requests(_spans(spark, sf)).select("service_name", us("at"), "active")


@query("a12_quantile_over_time", _V(["spans"], f"""
  SELECT step_us, name, {_pick(0.95, '')} AS quantile_ns FROM r GROUP BY step_us, name""",
    f="""SELECT *, epoch_us(time_bucket(INTERVAL 6 HOUR, start_ts)) AS step_us FROM spans
         WHERE event_target = 'sqlx::query' AND regexp_full_match(name, 'POST.*')""",
    r=_RANKED.format(k="step_us, name", src="f")))
def quantile_over_time(spark, sf):
    predicate = (F.col("event_target") == "sqlx::query") & M.matches_fully("name", "POST.*")
    return M.quantile_over_time(_spans(spark, sf), 0.95, ["name"], "6 hours", predicate).select(
        us("step"), "name", "quantile_ns")


@query("a13_exemplars", _V(["spans"], f"""
  SELECT epoch_us(w) AS window_us, {_KEYS}, le, trace_id, span_id, duration_ns FROM x
  QUALIFY row_number() OVER (PARTITION BY w, {_KEYS}, le ORDER BY duration_ns DESC, span_id DESC, trace_id DESC) = 1""",
    b=_bounds(fixed.SPAN_BOUNDS),
    x="""SELECT s.*, time_bucket(INTERVAL 1 DAY, start_ts) AS w,
      (SELECT arg_min(le, le_ns) FROM b WHERE s.duration_ns <= b.le_ns) AS le FROM spans s"""))
def exemplars(spark, sf):
    return M.exemplars(_spans(spark, sf), window="1 day").select(
        us("window_start", "window_us"), *M.CALL_KEYS, bound_text("le").alias("le"), "trace_id", "span_id", "duration_ns")
