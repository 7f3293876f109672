"""Scalar functions over trace context, headers, ids, levels and HTTP values.

All are plain column expressions that stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from obsframe import fixed


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def traceparent_parse(s) -> Column:
    """Split a ``traceparent`` header; NULL when it has fewer than two parts."""
    parts = F.split(as_col(s), "-")
    fields = [
        F.get(parts, F.lit(i)).alias(name)
        for i, name in enumerate(("version", "trace_id", "span_id", "flags"))
    ]
    return F.when(F.size(parts) >= 2, F.struct(*fields))


def traceparent_format(trace_id, span_id, flags="01") -> Column:
    flags = F.lit(flags) if isinstance(flags, str) else as_col(flags)
    return F.concat(
        F.lit("00-"), as_col(trace_id), F.lit("-"), as_col(span_id), F.lit("-"), flags
    )


def is_valid_trace_id(s) -> Column:
    return as_col(s).rlike("^[0-9a-fA-F]{32}\\z")


def is_valid_span_context(trace_id, span_id) -> Column:
    """Both ids are hex of the right length and neither is all zeros."""
    t, s = as_col(trace_id), as_col(span_id)
    return F.coalesce(
        is_valid_trace_id(t)
        & s.rlike("^[0-9a-fA-F]{16}\\z")
        & (t != "0" * 32)
        & (s != "0" * 16),
        F.lit(False),
    )


def header_get(headers, key: str) -> Column:
    """Value of the first header with that name (any case) whose bytes are UTF-8."""
    hits = F.filter(
        as_col(headers),
        lambda h: (F.lower(h["key"]) == key.lower()) & F.is_valid_utf8(h["value"].cast("string")),
    )
    return F.get(hits, F.lit(0))["value"].cast("string")


def div(a, b) -> Column:
    """Integral division on BIGINT."""
    return F.call_function("div", as_col(a), F.lit(b) if isinstance(b, int) else b)


def nano_to_ts(nanos) -> Column:
    """Unix nanoseconds, possibly as text, to TIMESTAMP (microseconds)."""
    return F.timestamp_micros(div(as_col(nanos).try_cast("bigint"), 1000))


def duration_ns(start_nanos, end_nanos) -> Column:
    return as_col(end_nanos).try_cast("bigint") - as_col(start_nanos).try_cast("bigint")


def json_value(text) -> Column:
    """VARIANT of a text that is exactly one JSON value, else NULL.

    The parser alone ignores what follows the first value.  Inside both an array and
    an object, anything but one whole value is an error.
    """
    t = as_col(text)
    listed = F.try_parse_json(F.concat(F.lit("["), t, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"v":'), t, F.lit("}")))
    return F.when(
        (F.length(F.trim(t)) > 0) & named.isNotNull(), F.try_variant_get(listed, "$[0]", "variant")
    )


def http_reason(code, fallback: str = fixed.INJECTED_REASON) -> Column:
    reasons = F.create_map(*[F.lit(x) for kv in fixed.HTTP_REASONS.items() for x in kv])
    return F.coalesce(F.try_element_at(reasons, as_col(code).cast("int")), F.lit(fallback))


def status_to_db(s, allowed: Sequence[str] = fixed.BOOK_STATUS) -> Column:
    """``Available`` to ``available``; anything but the exact wire form is NULL."""
    c = as_col(s)
    return F.when(c.isin([a.capitalize() for a in allowed]), F.lower(c))


def status_to_json(s, allowed: Sequence[str] = fixed.BOOK_STATUS) -> Column:
    c = as_col(s)
    return F.when(c.isin(list(allowed)), F.initcap(c))


def hex_pad(hex_id, width: int) -> Column:
    return F.lpad(F.lower(as_col(hex_id)), width, "0")


def message_key(book_id) -> Column:
    return F.concat(F.lit("key-"), as_col(book_id).cast("string"))


def _wire(value, prefix: str) -> Column:
    c = F.upper(as_col(value))
    return F.when(c.startswith(prefix), c).otherwise(F.concat(F.lit(prefix), c))


def span_kind(s) -> Column:
    """``Consumer`` to ``SPAN_KIND_CONSUMER``; wire forms pass unchanged."""
    return _wire(s, "SPAN_KIND_")


def status_code(s) -> Column:
    return _wire(s, "STATUS_CODE_")


def level_rank(level, levels: Sequence[str] = fixed.LEVELS) -> Column:
    """ERROR = 1 to TRACE = 5; unknown levels are NULL."""
    c = F.upper(as_col(level))
    out = F.when(c == levels[0], 1)
    for i, name in enumerate(levels[1:], start=2):
        out = out.when(c == name, i)
    return out


def uniform_draw(key) -> Column:
    """Repeatable uniform number in [0, 1) from the md5 of a text key."""
    head = F.conv(F.substring(F.md5(as_col(key)), 1, 8), 16, 10).cast("double")
    return head / F.lit(4294967296.0)


def label_map(labels: Mapping[str, object]) -> Column:
    """MAP<STRING,STRING> of labels; values are columns, NULL values are left out."""
    none = F.expr("cast(array() as array<struct<key:string,value:string>>)")
    pairs = []
    for key, value in labels.items():
        text = as_col(value).cast("string")
        pair = F.struct(F.lit(key).alias("key"), text.alias("value"))
        pairs.append(F.when(text.isNotNull(), F.array(pair)).otherwise(none))
    return F.map_from_entries(F.concat(none, *pairs))


def series_entries(labels) -> Column:
    """Groupable form of a label map: its entries in order."""
    return F.sort_array(F.map_entries(as_col(labels)))


def series_key(labels) -> Column:
    """Text form of a label map: the same labels give the same text.

    Making the text costs more than all else that is done with a point; where rows are
    aggregated first, group them by ``series_entries`` and make the text of the result.
    """
    return F.to_json(series_entries(labels))


def seconds(interval: str | int | float) -> float:
    """``'5 minutes'``, ``'30s'`` or a number of seconds."""
    if isinstance(interval, (int, float)):
        return float(interval)
    units = {"s": 1, "sec": 1, "second": 1, "m": 60, "min": 60, "minute": 60, "h": 3600,
             "hour": 3600, "d": 86400, "day": 86400, "ms": 0.001, "millisecond": 0.001}
    text = interval.strip()
    digits = text.rstrip("abcdefghijklmnopqrstuvwxyz ")
    unit = text[len(digits):].strip()
    unit = unit[:-1] if len(unit) > 2 and unit.endswith("s") else unit
    if unit not in units:
        raise ValueError(f"not an interval: {interval!r}")
    return float(digits) * units[unit]


def micros(interval: str | int | float) -> int:
    return round(seconds(interval) * 1_000_000)
