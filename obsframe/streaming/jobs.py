"""Streams of messages, spans, logs and points.

Jobs that write keep their checkpoint next to their output, in a folder every
executor reaches.  Output written by ``foreachBatch`` is published batch by batch
(``streaming/batches.py``), so a repeated batch leaves no duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from obsframe import fixed
from obsframe.functions.bags import value_of
from obsframe.functions.scalars import seconds
from obsframe.operators.attributes import process_logs
from obsframe.operators.servicegraph import callees, callers, edge_rows, paired
from obsframe.operators.spanmetrics import CALL_KEYS, bucket_counts, bucket_rows
from obsframe.sources.messages import parse_ingestion
from obsframe.sources.tables import dated
from obsframe.streaming.batches import commit_batch, read_committed

_INGESTED = {
    "key": "string", "value": "string", "headers": "array<struct<key:string,value:binary>>", "topic": "string",
    "partition": "int", "offset": "bigint", "timestamp": "timestamp", "book_id": "int", "error": "string",
    "linked_trace_id": "string", "linked_span_id": "string",
}


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run on an interval, or once over all that is available."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def ingestion_job(
    records_stream: DataFrame, out: str, checkpoint: str, every: str | None = "10 seconds"
) -> StreamingQuery:
    """Parse messages into the sinks ``good`` and ``dead`` of ``out``, which commit together.

    ``read_ingested`` reads them back.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        failed = F.col("error").isNotNull()
        commit_batch(parse_ingestion(batch), out, batch_id, {"good": ~failed, "dead": failed})

    writer = records_stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start()


def read_ingested(spark: SparkSession, out: str, sink: str) -> DataFrame:
    """Messages that ``ingestion_job`` has committed: ``good`` or ``dead``."""
    schema = ", ".join(f"`{c}` {t}" for c, t in _INGESTED.items())
    rows = read_committed(spark, out, schema, sink)
    return rows.drop("error") if sink == "good" else rows


def stream_span_metrics(
    spans_stream: DataFrame,
    window: str = "1 minute",
    delay: str = "30 seconds",
    bounds: Sequence[float] = fixed.SPAN_BOUNDS,
    keys: Sequence[str] = CALL_KEYS,
) -> DataFrame:
    """Calls and latency histogram per key and tumbling window; late spans are dropped.

    ``count`` is the number of calls.  A window is emitted once, when it is over.
    """
    agg = (
        spans_stream.withWatermark("start_ts", delay)
        .groupBy(F.window("start_ts", window), *keys)
        .agg(*bucket_counts(F.col("duration_ns"), bounds), F.count(F.lit(1)).alias("calls"))
    )
    flat = agg.withColumn("window_start", F.col("window.start"))
    return bucket_rows(flat, ["window_start", *keys, "calls"], bounds)


def stream_service_edges(
    spans_stream: DataFrame, wait: str = "10 seconds", delay: str = "10 seconds"
) -> DataFrame:
    """Edges of calling and called spans that start within ``wait`` of each other.

    Each side is kept only as long as its partner may still come; then it expires.  A
    caller that arrives again within the delay is one caller.
    """
    left = callees(spans_stream).withWatermark("server_ts", delay)
    right = callers(spans_stream).withWatermark("client_ts", delay).dropDuplicatesWithinWatermark(
        ["c_trace_id", "c_span_id"]
    )
    apart = F.expr(f"INTERVAL {seconds(wait)} SECONDS")
    near = (F.col("server_ts") >= F.col("client_ts") - apart) & (
        F.col("server_ts") <= F.col("client_ts") + apart
    )
    return edge_rows(left.join(right, paired() & near, "inner"))


def stream_logs(
    logs_stream: DataFrame,
    out: str,
    checkpoint: str,
    window: str = "1 minute",
    delay: str = "30 seconds",
    every: str | None = "10 seconds",
) -> tuple[StreamingQuery, StreamingQuery]:
    """Rewrite logs, store them by day, and count them per window and source file.

    The source is read and rewritten once; what is counted are the stored logs, of which
    only the time and the source file are read.  Returns the query that writes
    ``out/logs`` and the one that writes ``out/counts``.  With ``every=None`` the logs
    are stored before the second begins.
    """
    processed = dated(process_logs(logs_stream), "logs")
    file_path = F.coalesce(value_of("attributes", "file_path"), F.lit(fixed.UNSPECIFIED_FILE))
    store = _triggered(
        processed.withColumn("file_path", file_path)
        .writeStream.partitionBy("date")
        .format("parquet")
        .option("path", f"{out}/logs")
        .option("checkpointLocation", f"{checkpoint}/logs"),
        every,
    ).start()
    if every is None:
        store.awaitTermination()
    else:
        store.processAllAvailable()
    stored = processed.withColumn("file_path", file_path).schema
    counts = (
        logs_stream.sparkSession.readStream.schema(stored)
        .parquet(f"{out}/logs")
        .select("ts", "file_path")
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", window), "file_path")
        .agg(F.count(F.lit(1)).alias("logs"))
        .select(F.col("window.start").alias("window_start"), "file_path", "logs")
    )
    count = (
        counts.writeStream.format("parquet")
        .option("path", f"{out}/counts")
        .option("checkpointLocation", f"{checkpoint}/counts")
    )
    return store, _triggered(count, every).start()
