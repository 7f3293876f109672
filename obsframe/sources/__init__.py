"""Sources and sinks."""

from obsframe.sources.documents import (
    flatten_spans,
    read_log_json,
    read_metric_json,
    read_trace_documents,
    read_trace_json,
)
from obsframe.sources.messages import (
    parse_ingestion,
    read_ingestion,
    read_ingestion_stream,
    split_ingestion,
    to_ingestion_records,
    write_ingestion,
)
from obsframe.sources.tables import (
    fan_in,
    fan_out,
    read_table,
    route_out,
    sql_gauge,
    stream_signal,
    write_signal,
)

__all__ = [
    "fan_in", "fan_out", "flatten_spans", "parse_ingestion", "read_ingestion",
    "read_ingestion_stream", "read_log_json", "read_metric_json", "read_table",
    "read_trace_documents", "read_trace_json", "route_out", "split_ingestion", "sql_gauge", "stream_signal",
    "to_ingestion_records", "write_ingestion", "write_signal",
]
