"""Counters, histograms and summaries over spans, requests and logs.

Every aggregate here is one hash aggregation with a partial stage, so a key that
holds most of the rows costs no more than any other.  A histogram keeps one counter
per bound in the aggregation buffer instead of turning a span into many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.functions.bags import value_of
from obsframe.functions.scalars import as_col, micros
from obsframe.operators.ordered import chunk_index, even_chunks, exact_quantiles, running_sum

CALL_KEYS = ("service_name", "name", "kind", "status_code")
NANOS = 1_000_000_000


def bound_nanos(bounds: Sequence[float]) -> list[int]:
    return [round(b * NANOS) for b in bounds]


def bucket_counts(duration: Column, bounds: Sequence[float], prefix: str = "") -> list[Column]:
    """Aggregates ``_b0.._bn`` (rows at or below each bound), ``_count`` and ``_sum_ns``."""
    cols = [
        F.count_if(duration <= b).alias(f"{prefix}_b{i}") for i, b in enumerate(bound_nanos(bounds))
    ]
    total = F.coalesce(exact_sum(duration), F.lit(0)).cast("double")
    return [*cols, F.count(duration).alias(f"{prefix}_count"), total.alias(f"{prefix}_sum_ns")]


def exact_sum(value: Column) -> Column:
    """Aggregate: DECIMAL sum of a BIGINT column, the same in any order of rows.

    Nanoseconds of many spans overflow BIGINT, and a DOUBLE sum depends on task order
    above 2^53.  The upper and lower 32 bits are summed apart, as BIGINT.
    """
    value = value.cast("bigint")
    upper = F.sum(F.shiftright(value, 32)).cast("decimal(38,0)")
    lower = F.sum(value.bitwiseAND(F.lit(0xFFFFFFFF))).cast("decimal(38,0)")
    return upper * F.lit(1 << 32).cast("decimal(10,0)") + lower


def bucket_rows(agg: DataFrame, keys: Sequence[str], bounds: Sequence[float]) -> DataFrame:
    """One row per key and bound (``le``, +Inf last) with the cumulative count."""
    rows = [
        F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("bucket_count"))
        for i, b in enumerate(bounds)
    ]
    rows.append(F.struct(F.lit(float("inf")).alias("le"), F.col("_count").alias("bucket_count")))
    return agg.select(
        *keys,
        F.inline(F.array(*rows)),
        F.col("_count").alias("count"),
        F.col("_sum_ns").alias("sum_ns"),
    )


def window_start(ts, window: str | float) -> Column:
    """Start of the tumbling window a time falls into, as TIMESTAMP."""
    width = micros(window)
    us = F.unix_micros(as_col(ts))
    return F.timestamp_micros(us - F.pmod(us, F.lit(width)))


def _grouping(df: DataFrame, keys: Sequence[str], window, ts: str) -> tuple[DataFrame, list[str]]:
    if window is None:
        return df, list(keys)
    return df.withColumn("window_start", window_start(ts, window)), ["window_start", *keys]


def span_calls(spans: DataFrame, window=None, keys: Sequence[str] = CALL_KEYS) -> DataFrame:
    """Number of spans by service, name, kind and status, optionally per window."""
    df, by = _grouping(spans, keys, window, "start_ts")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("calls"))


def span_latency(
    spans: DataFrame,
    bounds: Sequence[float] = fixed.SPAN_BOUNDS,
    window=None,
    keys: Sequence[str] = CALL_KEYS,
    duration: str = "duration_ns",
    ts: str = "start_ts",
) -> DataFrame:
    """Cumulative latency histogram per key, with count and sum."""
    df, by = _grouping(spans, keys, window, ts)
    agg = df.groupBy(*by).agg(*bucket_counts(F.col(duration), bounds))
    return bucket_rows(agg, by, bounds)


def red_summary(
    spans: DataFrame,
    by: Sequence[str] = ("service_name", "name"),
    qs: Sequence[float] = (0.5, 0.95, 0.99),
    accuracy: int | None = None,
) -> DataFrame:
    """Calls, errors, error ratio, mean and quantiles of the duration per key.

    Quantiles are exact nearest-rank values.  ``accuracy`` switches them to Spark's
    approximate percentiles, which need a single pass.
    """
    names = [f"p{q * 100:g}_ns".replace(".", "_") for q in qs]
    base = [
        F.count(F.lit(1)).alias("calls"),
        F.count_if(F.col("status_code") == "STATUS_CODE_ERROR").alias("errors"),
        (exact_sum(F.col("duration_ns")).cast("double") / F.count("duration_ns")).alias("avg_ns"),
    ]
    if accuracy is not None:
        base += [
            F.percentile_approx("duration_ns", q, accuracy).alias(n) for q, n in zip(qs, names)
        ]
    out = spans.groupBy(*by).agg(*base)
    if accuracy is None:
        quantiles = exact_quantiles(spans, by, "duration_ns", qs, names)
        right = quantiles.withColumnsRenamed({k: f"_q_{k}" for k in by})
        on = [out[k].eqNullSafe(right[f"_q_{k}"]) for k in by]
        out = out.join(right, on, "left")
    return out.select(
        *by,
        "calls",
        "errors",
        (F.col("errors") / F.col("calls")).alias("error_ratio"),
        "avg_ns",
        *names,
    )


def quantile_over_time(
    spans: DataFrame,
    q: float,
    by: Sequence[str],
    step: str | float,
    predicate: Column | None = None,
    accuracy: int | None = None,
) -> DataFrame:
    """Duration quantile per step window and attribute, of the spans that pass."""
    df = spans if predicate is None else spans.filter(predicate)
    df = df.withColumn("step_us", F.unix_micros(window_start("start_ts", step)))
    keys = ["step_us", *by]
    if accuracy is not None:
        out = df.groupBy(*keys).agg(
            F.percentile_approx("duration_ns", float(q), accuracy).alias("quantile_ns")
        )
    else:
        out = exact_quantiles(df, keys, "duration_ns", [q], ["quantile_ns"])
    return out.select(
        F.timestamp_micros("step_us").alias("step"), *by, "quantile_ns"
    )


def matches_fully(col, pattern: str) -> Column:
    """Regular expression over the whole value, as in label and span matchers."""
    return F.coalesce(as_col(col).rlike(f"^(?s:{pattern})\\z"), F.lit(False))


def log_count(logs: DataFrame, window=None, default: str = fixed.UNSPECIFIED_FILE) -> DataFrame:
    """Number of logs by source file; logs without one share the default."""
    df = logs.withColumn("file_path", F.coalesce(value_of("attributes", "file_path"), F.lit(default)))
    df, by = _grouping(df, ["file_path"], window, "ts")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("logs"))


def span_event_count(spans: DataFrame, cond=None, window=None) -> DataFrame:
    """Number of span events that meet a condition on their struct.

    Events are counted inside their array; no row per event is made.
    """
    key, wanted = fixed.COUNTED_NAMESPACE
    cond = cond or (lambda e: value_of(e["attributes"], key) == wanted)
    df, by = _grouping(spans, [], window, "start_ts")
    hits = F.size(F.filter(F.coalesce("events", F.array()), cond))
    return df.groupBy(*by).agg(F.coalesce(F.sum(hits), F.lit(0)).alias("events"))


def exception_count(spans: DataFrame) -> DataFrame:
    """Exception events by service, span and exception type and message."""
    raised = spans.select(
        *CALL_KEYS, F.explode(F.filter("events", lambda e: e["name"] == fixed.EXCEPTION_EVENT)).alias("e")
    )
    return raised.groupBy(
        *CALL_KEYS,
        value_of("e.attributes", "exception.type").alias("exception_type"),
        value_of("e.attributes", "exception.message").alias("exception_message"),
    ).agg(F.count(F.lit(1)).alias("exceptions"))


def event_counter(df: DataFrame, metric: str, labels: Sequence[str] = ()) -> DataFrame:
    """A counter that adds one per row, by label columns."""
    return df.groupBy(*labels).agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit(metric).alias("metric"), *labels, "value"
    )


def http_metrics(
    requests: DataFrame,
    bounds: Sequence[float] = fixed.HTTP_BOUNDS,
    keys: Sequence[str] = ("method", "route", "status"),
) -> DataFrame:
    """Request count and duration histogram by method, route and status."""
    return span_latency(requests, bounds, keys=keys)


def active_requests(
    spans: DataFrame, by: Sequence[str] = ("service_name",), pieces: int | None = None
) -> DataFrame:
    """Spans running at each moment the number changes (a span ends before another starts).

    Changes at the same microsecond are added up first, and the running sum is cut
    into ``pieces`` stretches of time with about as many starts, so neither a busy
    service nor a busy minute is one task.
    """
    by = list(by)
    start = F.unix_micros("start_ts")
    end = start + F.ceil(F.col("duration_ns") / 1000).cast("bigint")
    changes = (
        spans.filter("duration_ns > 0")
        .select(
            *by,
            F.inline(F.array(
                F.struct(start.alias("at_us"), F.lit(1).cast("bigint").alias("delta")),
                F.struct(end.alias("at_us"), F.lit(-1).cast("bigint").alias("delta")),
            )),
        )
        .groupBy(*by, "at_us")
        .agg(F.sum("delta").alias("delta"))
    )
    running = running_sum(
        changes, by, ["at_us"], even_chunks(spans, start, pieces)("at_us"), "delta", "active",
        blocked=False,
    )
    return running.filter("delta <> 0").select(
        *by, F.timestamp_micros("at_us").alias("at"), "active"
    )


def exemplars(
    spans: DataFrame,
    bounds: Sequence[float] = fixed.SPAN_BOUNDS,
    window: str | float = "1 minute",
    keys: Sequence[str] = CALL_KEYS,
) -> DataFrame:
    """One trace per series, bucket and window: the slowest span, then the largest id."""
    le = None
    for b, n in zip(bounds, bound_nanos(bounds)):
        fits = F.col("duration_ns") <= n
        le = F.when(fits, float(b)) if le is None else le.when(fits, float(b))
    df = spans.withColumns(
        {"le": le.otherwise(float("inf")), "window_start": window_start("start_ts", window)}
    )
    best = F.max(F.struct("duration_ns", "span_id", "trace_id")).alias("best")
    return df.groupBy("window_start", *keys, "le").agg(best).select(
        "window_start", *keys, "le",
        F.col("best.trace_id").alias("trace_id"),
        F.col("best.span_id").alias("span_id"),
        F.col("best.duration_ns").alias("duration_ns"),
    )
