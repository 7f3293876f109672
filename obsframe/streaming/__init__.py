"""Structured Streaming jobs built from the batch operators.

State functions run inside Python tasks and are shipped by value, so executors need no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

from obsframe.streaming.alerts import stream_alerts, stream_error_alert  # noqa: E402
from obsframe.streaming.batches import commit_batch, compact, read_committed  # noqa: E402
from obsframe.streaming.jobs import (  # noqa: E402
    ingestion_job,
    read_ingested,
    stream_logs,
    stream_service_edges,
    stream_span_metrics,
)
from obsframe.streaming.rates import stream_error_rate  # noqa: E402
from obsframe.streaming.totals import stream_delta_to_cumulative  # noqa: E402

__all__ = [
    "commit_batch", "compact", "ingestion_job", "read_committed", "read_ingested", "stream_alerts", "stream_delta_to_cumulative", "stream_error_alert",
    "stream_error_rate", "stream_logs", "stream_service_edges", "stream_span_metrics",
]
