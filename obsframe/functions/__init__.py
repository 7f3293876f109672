"""Column functions."""

from obsframe.functions.bags import kv_to_map
from obsframe.functions.scalars import (
    duration_ns,
    header_get,
    hex_pad,
    http_reason,
    is_valid_span_context,
    is_valid_trace_id,
    label_map,
    level_rank,
    message_key,
    nano_to_ts,
    series_key,
    span_kind,
    status_code,
    status_to_db,
    status_to_json,
    traceparent_format,
    traceparent_parse,
    uniform_draw,
)

__all__ = [
    "duration_ns", "header_get", "hex_pad", "http_reason", "is_valid_span_context",
    "is_valid_trace_id", "kv_to_map", "label_map", "level_rank", "message_key", "nano_to_ts",
    "series_key", "span_kind", "status_code", "status_to_db", "status_to_json",
    "traceparent_format", "traceparent_parse", "uniform_draw",
]
