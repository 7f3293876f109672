"""Whole flows from signals to panels and alerts, as one lazy DataFrame each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.functions.scalars import micros
from obsframe.operators.alerts import alert_states
from obsframe.operators.attributes import process_logs
from obsframe.operators.series import (
    bound_number,
    bound_text,
    delta_to_cumulative,
    heatmap_cells,
    points_from,
    rate,
    reduce_last,
)
from obsframe.operators.servicegraph import service_edges
from obsframe.operators.spanmetrics import (
    CALL_KEYS,
    log_count,
    span_calls,
    span_event_count,
    span_latency,
    window_start,
)

_SPAN_LABELS = {
    "service": "service_name", "span_name": "name", "span_kind": "kind", "status_code": "status_code",
}


def _accumulated(deltas: DataFrame, keys: Sequence[str], value: str, window: str | float) -> DataFrame:
    """Per-window deltas as a running total, timed at the end of each window."""
    end = F.timestamp_micros(F.unix_micros("window_start") + micros(window))
    return delta_to_cumulative(
        deltas.select(*keys, end.alias("ts"), F.col(value).cast("double").alias("value")),
        keys,
        merged=True,
    )


def call_points(spans: DataFrame, window: str | float = "1 minute") -> DataFrame:
    """Cumulative call counters of all spans."""
    totals = _accumulated(span_calls(spans, window), CALL_KEYS, "calls", window)
    return points_from(totals, fixed.CALLS_METRIC, _SPAN_LABELS, "value", "ts")


def latency_points(
    spans: DataFrame, window: str | float = "1 minute", bounds: Sequence[float] = fixed.SPAN_BOUNDS
) -> DataFrame:
    """Cumulative latency histogram of all spans: buckets, counts and sums in seconds."""
    rows = span_latency(spans, bounds, window).withColumn("le", bound_text("le"))
    # The last bucket of a histogram has its count and its sum, so no span is read twice.
    whole = rows.filter("le = '+Inf'")
    buckets = _accumulated(rows, [*CALL_KEYS, "le"], "bucket_count", window)
    counts = _accumulated(whole, CALL_KEYS, "count", window)
    sums = _accumulated(whole, CALL_KEYS, "sum_ns", window).withColumn("value", F.col("value") / 1e9)
    name = fixed.LATENCY_METRIC
    return (
        points_from(buckets, f"{name}_bucket", _SPAN_LABELS | {"le": "le"}, "value", "ts")
        .unionByName(points_from(counts, f"{name}_count", _SPAN_LABELS, "value", "ts"))
        .unionByName(points_from(sums, f"{name}_sum", _SPAN_LABELS, "value", "ts"))
    )


def span_event_points(spans: DataFrame, window: str | float = "1 minute", cond=None) -> DataFrame:
    """Cumulative counter of the span events that meet a condition, by default the database's."""
    totals = _accumulated(span_event_count(spans, cond, window), [], "events", window)
    return points_from(totals, fixed.SPAN_EVENT_COUNT_METRIC, {}, "value", "ts")


_EDGE_KEYS = ["client", "server", "connection_type"]


_EDGE_METRICS = {"server": fixed.EDGE_SERVER_METRIC, "client": fixed.EDGE_CLIENT_METRIC}


def _edge_buckets(
    edges: DataFrame, window: str | float, bounds: Sequence[float], side: str = "server"
) -> DataFrame:
    buckets = span_latency(
        edges, bounds, window, _EDGE_KEYS, duration=f"{side}_ns", ts=f"{side}_ts"
    ).withColumn("le", bound_text("le"))
    return _accumulated(buckets, [*_EDGE_KEYS, "le"], "bucket_count", window)


def edge_latency_points(
    spans: DataFrame, window: str | float = "1 minute", bounds: Sequence[float] = fixed.EDGE_BOUNDS,
    side: str = "server",
) -> DataFrame:
    """Cumulative latency buckets of all service-graph edges, as their server or client saw them."""
    totals = _edge_buckets(service_edges(spans), window, bounds, side)
    labels = {k: k for k in [*_EDGE_KEYS, "le"]}
    return points_from(totals, _EDGE_METRICS[side] + "_bucket", labels, "value", "ts")


def edge_request_points(spans: DataFrame, window: str | float = "1 minute") -> DataFrame:
    """Cumulative request and failure totals of all service-graph edges, timed by the server."""
    edges = service_edges(spans).withColumn("window_start", window_start("server_ts", window))
    counts = edges.groupBy("window_start", *_EDGE_KEYS).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("failed").alias("failures")
    )
    labels = {k: k for k in _EDGE_KEYS}
    named = {fixed.EDGE_REQUESTS_METRIC: "requests", fixed.EDGE_FAILED_METRIC: "failures"}
    parts = [
        points_from(_accumulated(counts, _EDGE_KEYS, column, window), metric, labels, "value", "ts")
        for metric, column in named.items()
    ]
    return parts[0].unionByName(parts[1])


def log_count_points(logs: DataFrame, window: str | float = "1 minute") -> DataFrame:
    """Cumulative log counters by source file, from raw logs."""
    totals = _accumulated(log_count(process_logs(logs), window), ["file_path"], "logs", window)
    return points_from(totals, fixed.LOG_COUNT_METRIC, {"file_path": "file_path"}, "value", "ts")


def span_error_rate(
    spans: DataFrame,
    service: str = fixed.SERVICE,
    window: str | float = "1 minute",
    rate_window: str | float = "5 minutes",
    step: str | float = "1 minute",
) -> DataFrame:
    """A service's error rate from raw spans: ``error_rate`` of their call points.

    The selector is applied to the spans, where it reaches the scan, and the series
    stay in plain columns instead of label maps.
    """
    failed = spans.filter(
        (F.col("status_code") == "STATUS_CODE_ERROR") & (F.col("service_name") == service)
    )
    totals = _accumulated(span_calls(failed, window), CALL_KEYS, "calls", window)
    return rate(totals, CALL_KEYS, rate_window, step).groupBy("t").agg(F.sum("rate").alias("value"))


def error_alert(
    spans: DataFrame,
    service: str = fixed.SERVICE,
    window: str | float = "1 minute",
    rate_window: str | float = "5 minutes",
    step: str | float = "1 minute",
    threshold: float = fixed.ALERT_THRESHOLD,
    for_: str | float = "1 minute",
    lookback: str | float | None = fixed.ALERT_RANGE,
) -> DataFrame:
    """Alert states of a service's error rate, from raw spans.

    Each evaluation takes the last rate within ``lookback``; None takes only the rate
    of the evaluation's own time.
    """
    values = span_error_rate(spans, service, window, rate_window, step)
    return alert_states(values, threshold=threshold, for_=for_, interval=step, lookback=lookback)


def latest_error_rate(
    spans: DataFrame,
    service: str = fixed.SERVICE,
    window: str | float = "1 minute",
    rate_window: str | float = "5 minutes",
    step: str | float = "1 minute",
) -> DataFrame:
    """Last value of a service's error rate, which an alert compares."""
    return reduce_last(span_error_rate(spans, service, window, rate_window, step))


def request_heatmap(
    spans: DataFrame,
    server: str = fixed.SERVICE,
    window: str | float = "1 minute",
    rate_window: str | float = "8 minutes",
    step: str | float = "2 minutes",
    bounds: Sequence[float] = fixed.EDGE_BOUNDS,
) -> DataFrame:
    """Heatmap cells of a server's request processing time, per edge, from raw spans."""
    edges = service_edges(spans).filter(F.col("server") == server)
    rates = rate(_edge_buckets(edges, window, bounds), [*_EDGE_KEYS, "le"], rate_window, step)
    return heatmap_cells(rates.withColumn("le", bound_number("le")), _EDGE_KEYS)
