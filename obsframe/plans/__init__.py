"""Session settings and whole flows over the operators."""

from obsframe.plans.lifecycles import (
    call_points,
    edge_latency_points,
    edge_request_points,
    error_alert,
    latency_points,
    latest_error_rate,
    log_count_points,
    request_heatmap,
    span_error_rate,
    span_event_points,
)
from obsframe.plans.session import configure, fresh_dir, shared_dir, written_once

__all__ = [
    "call_points", "configure", "edge_latency_points", "edge_request_points", "error_alert", "fresh_dir",
    "latency_points", "latest_error_rate", "log_count_points", "request_heatmap", "shared_dir",
    "span_error_rate", "span_event_points", "written_once",
]
