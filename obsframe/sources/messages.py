"""Queue messages: source, sink, and parsing of ingestion records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe import fixed, schemas
from obsframe.functions.scalars import (
    is_valid_span_context,
    header_get,
    json_value,
    message_key,
    traceparent_format,
    traceparent_parse,
)


def _queue_options(options: dict) -> dict:
    return {
        "subscribe": fixed.INGESTION_TOPIC,
        "startingOffsets": "earliest",
        "includeHeaders": "true",
        **options,
    }


def _as_records(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        "headers",
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def read_ingestion_stream(spark: SparkSession, fmt: str = "kafka", **options) -> DataFrame:
    """Stream of ingestion records: a queue topic, or files of the same schema.

    For a queue pass ``kafka.bootstrap.servers`` and, where wanted, ``kafka.group.id``;
    it reads the ingestion topic from its earliest offset unless options say otherwise.
    """
    if fmt == "kafka":
        return _as_records(
            spark.readStream.format("kafka").options(**_queue_options(options)).load()
        )
    path = options.pop("path")
    return spark.readStream.format(fmt).schema(schemas.RECORDS).options(**options).load(path)


def read_ingestion(spark: SparkSession, fmt: str = "parquet", **options) -> DataFrame:
    """Batch form of :func:`read_ingestion_stream`."""
    if fmt == "kafka":
        return _as_records(spark.read.format("kafka").options(**_queue_options(options)).load())
    path = options.pop("path")
    return spark.read.format(fmt).schema(schemas.RECORDS).options(**options).load(path)


def to_ingestion_records(df: DataFrame, topic: str = fixed.INGESTION_TOPIC) -> DataFrame:
    """Messages for ``book_id`` rows; trace headers when the row has a span context."""
    traceparent = traceparent_format("trace_id", "span_id")
    header = F.struct(
        F.lit("traceparent").alias("key"), F.encode(traceparent, "UTF-8").alias("value")
    )
    no_headers = F.array().cast("array<struct<key:string,value:binary>>")
    has_context = "trace_id" in df.columns and "span_id" in df.columns
    headers = (
        F.when(traceparent.isNotNull(), F.array(header)).otherwise(no_headers)
        if has_context
        else no_headers
    )
    return df.select(
        message_key("book_id").alias("key"),
        F.to_json(F.struct("book_id")).alias("value"),
        headers.alias("headers"),
        F.lit(topic).alias("topic"),
    )


def write_ingestion(records: DataFrame, fmt: str = "kafka", **options):
    """Write records to a queue or files; a stream returns its query."""
    if records.isStreaming:
        return records.writeStream.format(fmt).options(**options).start()
    path = options.pop("path", None)
    writer = records.write.format(fmt).mode(options.pop("mode", "append")).options(**options)
    return writer.save(path) if path else writer.save()


def parse_ingestion(records: DataFrame) -> DataFrame:
    """Add ``book_id``, ``error`` and the producer's span context to each record.

    A missing payload counts as empty text.  ``error`` is NULL for good rows; the
    others are dead letters.  The id must be a whole JSON number in the INT range.
    """
    payload = F.coalesce("value", F.lit(""))
    raw_id = F.try_variant_get("_doc", "$.book_id", "variant")
    is_int = F.coalesce(F.schema_of_variant(raw_id) == "BIGINT", F.lit(False))
    # Columns used more than once are computed in a step of their own.
    read = records.withColumns({
        "_doc": json_value(payload), "_traceparent": header_get("headers", "traceparent")
    })
    found = read.withColumns({
        "book_id": F.when(is_int, F.try_variant_get("_doc", "$.book_id", "int")),
        "_context": traceparent_parse("_traceparent"),
    })
    error = F.when(F.col("_doc").isNull(), "malformed payload").when(
        F.col("book_id").isNull(), "no valid book_id"
    )
    valid = is_valid_span_context("_context.trace_id", "_context.span_id")
    return found.select(
        *records.columns,
        "book_id",
        error.alias("error"),
        F.when(valid, F.col("_context.trace_id")).alias("linked_trace_id"),
        F.when(valid, F.col("_context.span_id")).alias("linked_span_id"),
    )


def split_ingestion(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and dead letters."""
    return parsed.filter(F.col("error").isNull()), parsed.filter(F.col("error").isNotNull())
