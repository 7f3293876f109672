"""Scans of trace, log and metric documents, and their flattening to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe import schemas
from obsframe.functions.bags import kv_to_map, value_of
from obsframe.functions.scalars import div, duration_ns, nano_to_ts


def _read_json(spark: SparkSession, path: str, schema, multi_line: bool) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_trace_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw trace documents.  ``multi_line=False`` reads one document per line, which splits."""
    return _read_json(spark, path, schemas.TRACE_DOCUMENT, multi_line)


def read_trace_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Trace documents as span rows."""
    return flatten_spans(read_trace_documents(spark, path, multi_line))


def flatten_spans(docs: DataFrame) -> DataFrame:
    """One row per span; the service is the resource attribute ``service.name``."""
    resource = kv_to_map("batch.resource.attributes")
    batches = docs.select(F.explode("batches").alias("batch")).select(
        resource.alias("resource"), F.explode("batch.scopeSpans").alias("scoped")
    )
    spans = batches.select(
        "resource",
        F.col("scoped.scope.name").alias("scope_name"),
        F.explode("scoped.spans").alias("s"),
    )
    events = F.transform(
        "s.events",
        lambda e: F.struct(
            e["name"].alias("name"),
            nano_to_ts(e["timeUnixNano"]).alias("ts"),
            kv_to_map(e["attributes"]).alias("attributes"),
        ),
    )
    links = F.transform(
        "s.links",
        lambda x: F.struct(
            x["traceId"].alias("trace_id"),
            x["spanId"].alias("span_id"),
            kv_to_map(x["attributes"]).alias("attributes"),
        ),
    )
    return spans.select(
        F.col("s.traceId").alias("trace_id"),
        F.col("s.spanId").alias("span_id"),
        F.nullif(F.col("s.parentSpanId"), F.lit("")).alias("parent_span_id"),
        value_of("resource", "service.name").alias("service_name"),
        "scope_name",
        F.col("s.name").alias("name"),
        F.col("s.kind").alias("kind"),
        F.col("s.status.code").alias("status_code"),
        nano_to_ts("s.startTimeUnixNano").alias("start_ts"),
        duration_ns("s.startTimeUnixNano", "s.endTimeUnixNano").alias("duration_ns"),
        kv_to_map("s.attributes").alias("attributes"),
        "resource",
        F.coalesce(events, F.array().cast("array<" + schemas.SPAN_EVENT.simpleString() + ">")).alias("events"),
        F.coalesce(links, F.array().cast("array<" + schemas.SPAN_LINK.simpleString() + ">")).alias("links"),
    )


def read_log_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Log query results as rows of stream labels, time and line."""
    docs = _read_json(spark, path, schemas.LOG_RESULT, multi_line)
    streams = docs.select(F.explode("data.result").alias("r"))
    lines = streams.select(F.col("r.stream").alias("labels"), F.explode("r.values").alias("v"))
    nanos = F.get("v", F.lit(0)).try_cast("bigint")
    return lines.select(
        "labels",
        F.timestamp_micros(div(nanos, 1000)).alias("ts"),
        nanos.alias("ts_ns"),
        F.get("v", F.lit(1)).alias("line"),
    )


def read_metric_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Metric query results as samples; a value that is not a number is NULL."""
    docs = _read_json(spark, path, schemas.METRIC_RESULT, multi_line)
    samples = docs.select("status", F.explode("data.result").alias("r"))
    epoch = F.get("r.value", F.lit(0)).try_cast("decimal(20,6)")
    return samples.select(
        "status",
        value_of("r.metric", "__name__").alias("metric"),
        F.col("r.metric").alias("labels"),
        F.timestamp_micros((epoch * 1000000).cast("bigint")).alias("ts"),
        F.get("r.value", F.lit(1)).try_cast("double").alias("value"),
    )
