"""Signals derived from the test tables.

Each view is a projection of one table, written in expressions that Spark and
DuckDB both read, so the library's input and the SQL's input are the same rows.
Event ids are dense and in time order; eight neighbouring events form a trace in
which span n has span n/2 as its parent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.plans.session import configure

_TRACE_NO = "CAST(floor(event_id / 8.0) AS BIGINT)"
_PARENT = "event_id - event_id % 8 + CAST(floor((event_id % 8 + 1) / 2.0) AS BIGINT) - 1"
_TRACE_ID = f"md5('trace-' || CAST({_TRACE_NO} AS STRING))"
_SPAN_ID = "substr(md5('span-' || CAST(event_id AS STRING)), 1, 16)"
_PARENT_ID = (
    f"CASE WHEN event_id % 8 = 0 THEN NULL ELSE substr(md5('span-' || CAST({_PARENT} AS STRING)), 1, 16) END"
)
_SERVICE = "CASE event_id % 3 WHEN 2 THEN 'backend' ELSE 'bookapp' END"
_NAME = (
    "CASE event_type WHEN 'view' THEN 'GET /books' WHEN 'purchase' THEN 'POST /books/add' "
    "WHEN 'signup' THEN 'POST /books/bulk_add' ELSE 'GET /books/{id}' END"
)
_KIND = (
    "CASE event_id % 5 WHEN 0 THEN 'SPAN_KIND_SERVER' WHEN 1 THEN 'SPAN_KIND_CLIENT' "
    "WHEN 2 THEN 'SPAN_KIND_INTERNAL' WHEN 3 THEN 'SPAN_KIND_PRODUCER' ELSE 'SPAN_KIND_CONSUMER' END"
)
_STATUS = (
    "CASE event_type WHEN 'error' THEN 'STATUS_CODE_ERROR' WHEN 'purchase' THEN 'STATUS_CODE_OK' "
    "ELSE 'STATUS_CODE_UNSET' END"
)
_LEVEL = (
    "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' WHEN 'purchase' THEN 'INFO' "
    "WHEN 'click' THEN 'DEBUG' ELSE 'TRACE' END"
)
_PATH = (
    "CASE event_type WHEN 'view' THEN '/books' WHEN 'purchase' THEN '/books/add' "
    "WHEN 'signup' THEN '/books/' || CAST(user_id AS STRING) || '/' WHEN 'error' THEN '/health' "
    "ELSE '/books/' || CAST(user_id AS STRING) END"
)
_UNLINKED = "event_id % 7 = 0"

VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "spans": ("events", {
        "event_id": "event_id",
        "trace_id": _TRACE_ID,
        "span_id": _SPAN_ID,
        "parent_span_id": _PARENT_ID,
        "service_name": _SERVICE,
        "name": _NAME,
        "kind": _KIND,
        "status_code": _STATUS,
        "start_ts": "ts",
        "duration_ns": "CAST(round(value * 1000000) AS BIGINT)",
        "event_target": "CASE event_id % 4 WHEN 2 THEN 'sqlx::query' ELSE 'bookapp::rest' END",
    }),
    "logs": ("events", {
        "event_id": "event_id",
        "ts": "ts",
        "severity_text": _LEVEL,
        "target": (
            "CASE event_id % 4 WHEN 0 THEN 'bookapp::rest' WHEN 1 THEN 'bookapp::db' "
            "WHEN 2 THEN 'sqlx::query' ELSE 'hyper::client' END"
        ),
        "name": (
            "CASE event_id % 4 WHEN 3 THEN 'no location' "
            "WHEN 2 THEN 'src/' || event_type || '.rs:' || CAST(event_id % 300 AS STRING) "
            "ELSE 'event src/' || event_type || '.rs:' || CAST(event_id % 300 AS STRING) END"
        ),
        "host_name": "'host-' || CAST(user_id % 7 AS STRING)",
        "service_name": _SERVICE,
        "body": "'line ' || CAST(event_id AS STRING)",
        "trace_id": f"CASE WHEN {_UNLINKED} THEN NULL ELSE {_TRACE_ID} END",
        "span_id": f"CASE WHEN {_UNLINKED} THEN NULL ELSE {_SPAN_ID} END",
    }),
    "points": ("events", {
        "event_id": "event_id",
        "series": "event_type",
        "service": _SERVICE,
        "span_name": _NAME,
        "span_kind": "CASE event_id % 2 WHEN 0 THEN 'SPAN_KIND_SERVER' ELSE 'SPAN_KIND_INTERNAL' END",
        "status_code": _STATUS,
        "ts": "ts",
        "value": "CAST(event_id % 977 AS DOUBLE)",
    }),
    "requests": ("events", {
        "request_id": "event_id",
        "ts": "ts",
        "method": "CASE event_id % 4 WHEN 0 THEN 'POST' WHEN 1 THEN 'DELETE' ELSE 'GET' END",
        "path": _PATH,
        "url": f"'http://app:8000' || {_PATH}",
        "status": "CASE event_type WHEN 'error' THEN 500 ELSE 200 END",
        "start_ts": "ts",
        "duration_ns": "CAST(round(value * 1000000) AS BIGINT)",
    }),
    "books": ("part", {
        "id": "p_partkey",
        "title": "p_name",
        "author": "p_brand",
        "status": "CASE p_partkey % 3 WHEN 0 THEN 'available' WHEN 1 THEN 'borrowed' ELSE 'lost' END",
    }),
    "changes": ("orders", {
        "seq": "o_orderkey",
        "op": "CASE o_orderstatus WHEN 'P' THEN 'insert' WHEN 'F' THEN 'update' ELSE 'delete' END",
        "id": "CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(o_custkey * 2 AS BIGINT) END",
        "title": "'Title ' || CAST(o_orderkey AS STRING)",
        "author": "'Author ' || CAST(o_custkey AS STRING)",
    }),
    "rules": ("orders", {
        "id": "o_orderkey",
        "endpoint_pattern": (
            "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE '/books/' || CAST(o_orderkey % 5003 AS STRING) END"
        ),
        "http_method": (
            "CASE o_orderstatus WHEN 'P' THEN 'POST' WHEN 'F' THEN 'GET' ELSE 'DELETE' END"
        ),
        "error_rate": "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_totalprice / 300000.0 END",
        "error_code": "CAST(390 + o_orderkey % 220 AS INT)",
        "error_message": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE NULL END",
    }),
    "messages": ("events", {
        "key": "'key-' || CAST(user_id AS STRING)",
        "value": (
            "CASE WHEN event_id % 11 = 0 THEN '{\"book_id\": ' WHEN event_id % 13 = 0 THEN NULL "
            "WHEN event_id % 17 = 0 THEN '{\"book_id\":\"' || CAST(user_id AS STRING) || '\"}' "
            "ELSE '{\"book_id\":' || CAST(user_id AS STRING) || '}' END"
        ),
        "traceparent": (
            f"CASE WHEN {_UNLINKED} THEN NULL WHEN event_id % 19 = 0 THEN '00-xyz-abc-01' "
            f"WHEN event_id % 23 = 0 THEN '00-{'0' * 32}-' || {_SPAN_ID} || '-01' "
            f"ELSE '00-' || {_TRACE_ID} || '-' || {_SPAN_ID} || '-01' END"
        ),
        "topic": "CASE WHEN event_id >= 0 THEN 'book_ingestion' ELSE 'other' END",
        "part": "CAST(event_id % 3 AS INT)",
        "off": "CAST(floor(event_id / 3.0) AS BIGINT)",
        "ts": "ts",
        "event_id": "event_id",
    }),
}

CONFIG_ROWS = """
  (1, '/books/{id}', 'GET', 0.5, 500, 'Injected Internal Server Error'),
  (2, '/books/add', 'POST', 0.25, 503, NULL),
  (3, '/books/add', 'GET', 1.0, 418, NULL),
  (4, '/books', 'GET', 0.0, 404, 'never'),
  (5, '/{*rest}', 'DELETE', 0.025, 599, NULL)"""
CONFIGS = (
    "SELECT CAST(id AS BIGINT) AS id, endpoint_pattern, http_method, CAST(error_rate AS DOUBLE) AS error_rate, "
    f"CAST(error_code AS INT) AS error_code, error_message FROM (VALUES {CONFIG_ROWS}) "
    "AS t(id, endpoint_pattern, http_method, error_rate, error_code, error_message)"
)


def sql_of(view: str) -> str:
    if view == "configs":
        return CONFIGS
    table, columns = VIEWS[view]
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table}"


def with_views(views, body: str, **ctes: str) -> str:
    """SQL text with the named views, then further common tables, in front."""
    parts = [f"{v} AS ({sql_of(v)})" for v in views] + [f"{k} AS ({v})" for k, v in ctes.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; zoneless times become UTC instants."""
    df = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def project(df: DataFrame, view: str) -> DataFrame:
    """The view's columns over its table, batch or stream."""
    return df.select(*[F.expr(e).alias(c) for c, e in VIEWS[view][1].items()])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "configs":
        return configure(spark).sql(CONFIGS)
    return project(table(spark, sf_dir, VIEWS[name][0]), name)


# -- canonical forms: flat view columns packed into bags ----------------------


def _bag(columns: dict[str, str]):
    """Map of columns that are never NULL."""
    return F.create_map(*[x for k, c in columns.items() for x in (F.lit(k), F.col(c))])


def as_logs(flat: DataFrame) -> DataFrame:
    return flat.select(
        "event_id", "ts", "severity_text", "target", "body", "trace_id", "span_id",
        _bag({"name": "name"}).alias("attributes"),
        _bag({"host.name": "host_name", "service.name": "service_name"}).alias("resource"),
    )


def as_points(flat: DataFrame, metric: str = "traces_spanmetrics_calls_total") -> DataFrame:
    labels = ("service", "span_name", "span_kind", "status_code")
    return flat.select(
        F.lit(metric).alias("metric"),
        _bag({c: c for c in labels}).alias("labels"),
        "ts", "value",
        F.lit("cumulative").alias("temporality"),
        _bag({"container.name": "service", "kafka.cluster.alias": "series"}).alias("resource"),
        "event_id",
    )


def as_records(flat: DataFrame) -> DataFrame:
    header = F.struct(
        F.lit("TraceParent").alias("key"), F.encode("traceparent", "UTF-8").alias("value")
    )
    none = F.array().cast("array<struct<key:string,value:binary>>")
    return flat.select(
        "key", "value",
        F.when(F.col("traceparent").isNotNull(), F.array(header)).otherwise(none).alias("headers"),
        "topic",
        F.col("part").alias("partition"),
        F.col("off").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def us(col: str, out: str | None = None):
    """Time column as BIGINT microseconds, the form results are compared in."""
    return F.unix_micros(col).alias(out or f"{col}_us")
