"""Service graph: edges between services and their request metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.operators.correlate import one_row_per
from obsframe.operators.spanmetrics import bucket_counts

# Kind of the calling span and of the span it causes.
PAIRS = (
    ("SPAN_KIND_CLIENT", "SPAN_KIND_SERVER"),
    ("SPAN_KIND_PRODUCER", "SPAN_KIND_CONSUMER"),
)


def callers(spans: DataFrame) -> DataFrame:
    """Spans that can call, by the key their callee refers to."""
    return spans.filter(F.col("kind").isin([a for a, _ in PAIRS])).select(
        F.col("trace_id").alias("c_trace_id"),
        F.col("span_id").alias("c_span_id"),
        F.col("kind").alias("c_kind"),
        F.col("service_name").alias("client"),
        (F.col("status_code") == "STATUS_CODE_ERROR").alias("client_failed"),
        F.col("start_ts").alias("client_ts"),
        F.col("duration_ns").alias("client_ns"),
    )


def callees(spans: DataFrame) -> DataFrame:
    """Spans that can be called and have a parent."""
    return spans.filter(
        F.col("kind").isin([b for _, b in PAIRS]) & F.col("parent_span_id").isNotNull()
    ).select(
        "trace_id",
        F.col("parent_span_id"),
        F.col("span_id").alias("server_span_id"),
        F.col("kind").alias("s_kind"),
        F.col("service_name").alias("server"),
        (F.col("status_code") == "STATUS_CODE_ERROR").alias("server_failed"),
        F.col("start_ts").alias("server_ts"),
        F.col("duration_ns").alias("server_ns"),
    )


def paired():
    """Join condition of a caller and its callee."""
    kinds = F.lit(False)
    for a, b in PAIRS:
        kinds = kinds | ((F.col("c_kind") == a) & (F.col("s_kind") == b))
    return (
        (F.col("trace_id") == F.col("c_trace_id"))
        & (F.col("parent_span_id") == F.col("c_span_id"))
        & kinds
    )


EDGE_COLUMNS = (
    "trace_id", "client", "server", "client_span_id", "server_span_id", "connection_type",
    "client_ts", "server_ts", "client_ns", "server_ns", "failed",
)


def edge_rows(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "trace_id", "client", "server",
        F.col("c_span_id").alias("client_span_id"),
        "server_span_id",
        F.when(F.col("c_kind") == "SPAN_KIND_PRODUCER", "messaging_system").otherwise("").alias("connection_type"),
        "client_ts", "server_ts", "client_ns", "server_ns",
        (F.coalesce("client_failed", F.lit(False)) | F.coalesce("server_failed", F.lit(False))).alias("failed"),
    )


def service_edges(spans: DataFrame) -> DataFrame:
    """Calling span and called span, where one is the parent of the other.

    Both sides are cut to their kinds and columns before the one shuffle on
    (trace, span).  A caller that arrived more than once is one caller, by its smallest
    values, so pairs do not multiply.  A caller with very many callees is split by Spark's
    skew join.
    """
    return edge_rows(callees(spans).join(one_row_per(callers(spans), ["c_trace_id", "c_span_id"]), paired(), "inner"))


def service_graph(spans: DataFrame, bounds: Sequence[float] = fixed.EDGE_BOUNDS) -> DataFrame:
    """Requests, failures and client and server histograms per edge and bound."""
    keys = ["client", "server", "connection_type"]
    edges = service_edges(spans)
    agg = edges.groupBy(*keys).agg(
        F.count_if("failed").alias("failed_total"),
        *bucket_counts(F.col("server_ns"), bounds, prefix="s"),
        *bucket_counts(F.col("client_ns"), bounds, prefix="c"),
        F.count(F.lit(1)).alias("request_total"),
    )
    rows = [
        F.struct(
            F.lit(float(b)).alias("le"),
            F.col(f"s_b{i}").alias("server_count"),
            F.col(f"c_b{i}").alias("client_count"),
        )
        for i, b in enumerate(bounds)
    ]
    rows.append(F.struct(
        F.lit(float("inf")).alias("le"),
        F.col("s_count").alias("server_count"),
        F.col("c_count").alias("client_count"),
    ))
    return agg.select(
        *keys, "request_total", "failed_total",
        F.col("s_sum_ns").alias("server_sum_ns"),
        F.col("c_sum_ns").alias("client_sum_ns"),
        F.inline(F.array(*rows)),
    )
