"""Canonical schemas of the signals and tables."""

from pyspark.sql import types as T

_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampType()
BAG = T.MapType(_S, _S)


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


SPAN_EVENT = _struct(("name", _S), ("ts", _TS), ("attributes", BAG))
SPAN_LINK = _struct(("trace_id", _S), ("span_id", _S), ("attributes", BAG))

SPANS = _struct(
    ("trace_id", _S),
    ("span_id", _S),
    ("parent_span_id", _S),
    ("service_name", _S),
    ("scope_name", _S),
    ("name", _S),
    ("kind", _S),
    ("status_code", _S),
    ("start_ts", _TS),
    ("duration_ns", _L),
    ("attributes", BAG),
    ("resource", BAG),
    ("events", T.ArrayType(SPAN_EVENT)),
    ("links", T.ArrayType(SPAN_LINK)),
)

LOGS = _struct(
    ("ts", _TS),
    ("severity_text", _S),
    ("target", _S),
    ("body", _S),
    ("trace_id", _S),
    ("span_id", _S),
    ("attributes", BAG),
    ("resource", BAG),
)

POINTS = _struct(
    ("metric", _S),
    ("labels", BAG),
    ("ts", _TS),
    ("value", T.DoubleType()),
    ("temporality", _S),
    ("resource", BAG),
)

HEADER = _struct(("key", _S), ("value", T.BinaryType()))
RECORDS = _struct(
    ("key", _S),
    ("value", _S),
    ("headers", T.ArrayType(HEADER)),
    ("topic", _S),
    ("partition", T.IntegerType()),
    ("offset", _L),
    ("timestamp", _TS),
)

# Ids are BIGINT: a table of this size class outgrows INT.
BOOKS = _struct(("id", _L), ("title", _S), ("author", _S), ("status", _S))

CONFIGS = _struct(
    ("id", _L),
    ("endpoint_pattern", _S),
    ("http_method", _S),
    ("error_rate", T.DoubleType()),
    ("error_code", T.IntegerType()),
    ("error_message", _S),
    ("created_at", _TS),
)

# Wire form of a trace document: every leaf is text except the flags.
_KV = T.ArrayType(_struct(("key", _S), ("value", _struct(("stringValue", _S), ("intValue", _S)))))
_DOC_SPAN = _struct(
    ("traceId", _S),
    ("spanId", _S),
    ("parentSpanId", _S),
    ("flags", T.IntegerType()),
    ("name", _S),
    ("kind", _S),
    ("startTimeUnixNano", _S),
    ("endTimeUnixNano", _S),
    ("attributes", _KV),
    ("events", T.ArrayType(_struct(("name", _S), ("timeUnixNano", _S), ("attributes", _KV)))),
    ("links", T.ArrayType(_struct(("traceId", _S), ("spanId", _S), ("attributes", _KV)))),
    ("status", _struct(("code", _S))),
)
TRACE_DOCUMENT = _struct(
    (
        "batches",
        T.ArrayType(
            _struct(
                ("resource", _struct(("attributes", _KV))),
                (
                    "scopeSpans",
                    T.ArrayType(
                        _struct(("scope", _struct(("name", _S))), ("spans", T.ArrayType(_DOC_SPAN)))
                    ),
                ),
            )
        ),
    )
)

LOG_RESULT = _struct(
    (
        "data",
        _struct(
            (
                "result",
                T.ArrayType(_struct(("stream", BAG), ("values", T.ArrayType(T.ArrayType(_S))))),
            )
        ),
    )
)

METRIC_RESULT = _struct(
    ("status", _S),
    ("data", _struct(("result", T.ArrayType(_struct(("metric", BAG), ("value", T.ArrayType(_S))))))),
)
