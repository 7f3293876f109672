"""Correlation of traces, logs, error events and metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.functions.bags import bag_or_empty, edit
from obsframe.functions.scalars import hex_pad, is_valid_span_context, micros
from obsframe.operators.ordered import chunk_index, even_chunks, running_sum
from obsframe.operators.series import matching, sum_by

ENTRY_KINDS = ("SPAN_KIND_SERVER", "SPAN_KIND_INTERNAL")


def spread_nulls(key, by) -> Column:
    """Join key with NULLs replaced by values that match nothing and spread evenly.

    An outer join sends all NULL keys to one task; rows without trace context can be
    a large share of a signal.
    """
    scattered = F.concat(F.lit("\x00"), F.xxhash64(by).cast("string"))
    return F.coalesce(F.col(key) if isinstance(key, str) else key, scattered)


def one_row_per(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of each key, with the smallest value of every other column.

    Column by column, so that columns nobody asks for are not read.  Rows with a NULL key
    match nothing and are left out.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*[F.min(c).alias(c) for c in rest])


def left_join_span(
    df: DataFrame, spans: DataFrame, trace_id: str, span_id: str, spread_by: str
) -> DataFrame:
    """Left join on (trace, span).  ``spans`` has these as ``j_trace_id, j_span_id``.

    A span that arrived more than once is one span, so rows do not multiply: of its rows
    the smallest values count.  They are combined on the map side, and the join needs the same
    shuffle.  Many rows of one span are split by Spark's skew join, against one row.
    """
    spans = one_row_per(spans, ["j_trace_id", "j_span_id"])
    keyed = df.withColumn("_join_span", spread_nulls(span_id, spread_by))
    on = (keyed["_join_span"] == spans["j_span_id"]) & (
        spread_nulls(keyed[trace_id], keyed[spread_by]) == spans["j_trace_id"]
    )
    return keyed.join(spans, on, "left").drop("_join_span", "j_trace_id", "j_span_id")


def find_spans(
    spans: DataFrame,
    trace_id: str | None = None,
    service: str | None = None,
    name: str | None = None,
    kinds: Sequence[str] = ENTRY_KINDS,
) -> DataFrame:
    """Spans of a trace by service, name and kind."""
    wanted = {"trace_id": trace_id, "service_name": service, "name": name}
    out = spans.filter(F.col("kind").isin(list(kinds)))
    for column, value in wanted.items():
        if value is not None:
            out = out.filter(F.col(column) == value)
    return out


def traces_with_error(spans: DataFrame, service: str) -> DataFrame:
    """Every trace with whether any span of the service failed."""
    failed = (F.col("service_name") == service) & (F.col("status_code") == "STATUS_CODE_ERROR")
    return spans.groupBy("trace_id").agg(
        F.coalesce(F.bool_or(failed), F.lit(False)).alias("has_error")
    )


def logs_between(logs: DataFrame, matchers: Mapping[str, str], start, end) -> DataFrame:
    """Logs whose resource labels match, in ``[start, end]``."""
    lo, hi = [x if isinstance(x, Column) else F.lit(x).cast("timestamp") for x in (start, end)]
    return logs.filter((F.col("ts") >= lo) & (F.col("ts") <= hi) & matching("resource", matchers))


def log_range(logs: DataFrame, matchers: Mapping[str, str], start, end) -> DataFrame:
    """:func:`logs_between`, oldest first."""
    return logs_between(logs, matchers, start, end).orderBy("ts")


def count_logs(logs: DataFrame, matchers: Mapping[str, str], start, end) -> DataFrame:
    return logs_between(logs, matchers, start, end).agg(F.count(F.lit(1)).alias("logs"))


def logs_for_traces(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """Each log with its span's name and service; logs without a known span stay."""
    owners = spans.select(
        F.col("trace_id").alias("j_trace_id"),
        F.col("span_id").alias("j_span_id"),
        F.col("name").alias("span_name"),
        F.col("service_name").alias("span_service"),
    )
    return left_join_span(logs, owners, "trace_id", "span_id", "ts")


def correlate_errors(
    events: DataFrame,
    spans: DataFrame | None = None,
    use: str = "span",
    levels: Sequence[str] = ("ERROR", "WARN"),
    level: str = "severity_text",
) -> DataFrame:
    """Tag severe events with the trace and span id of a valid span context.

    ``use='span'`` takes the event's own span and needs no join.  ``use='parent'``
    takes the parent of that span, looked up in ``spans``; only severe events go
    through the join.
    """
    severe = F.coalesce(F.upper(F.col(level)).isin(list(levels)), F.lit(False))

    def tagged(df: DataFrame, trace_id: str, span_id: str, when: Column) -> DataFrame:
        ok = when & is_valid_span_context(trace_id, span_id)
        ids = {"otel.trace_id": hex_pad(trace_id, 32), "otel.span_id": hex_pad(span_id, 16)}
        return df.withColumn("tags", F.when(ok, edit("tags", ids)).otherwise(bag_or_empty("tags")))

    if use == "span":
        return tagged(events, "trace_id", "span_id", severe)
    if use != "parent":
        raise ValueError(f"use must be 'span' or 'parent', not {use!r}")
    parents = spans.select(
        F.col("trace_id").alias("j_trace_id"),
        F.col("span_id").alias("j_span_id"),
        F.col("parent_span_id").alias("_parent"),
    )
    joined = left_join_span(events.filter(severe), parents, "trace_id", "span_id", "ts")
    found = tagged(joined, "trace_id", "_parent", F.lit(True)).drop("_parent")
    rest = events.filter(~severe).withColumn("tags", bag_or_empty("tags"))
    return found.select(*rest.columns).unionByName(rest)


def telemetry_coverage(
    ids: DataFrame,
    spans: DataFrame,
    logs: DataFrame,
    points: DataFrame,
    service: str,
    span_name: str,
    metric: str,
    matchers: Mapping[str, str],
    now,
    lookback: str | float = "5 minutes",
) -> DataFrame:
    """Per trace id: expected span present, service logging, metric at least 1.

    Logs are optional, span and metric decide ``ok``.
    """
    now = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    start = F.timestamp_micros(F.unix_micros(now) - micros(lookback))
    seen = (
        find_spans(spans, service=service, name=span_name)
        .select(F.col("trace_id").alias("_seen"))
        .distinct()
    )
    n_logs = count_logs(logs, {"service.name": service}, start, now).scalar()
    value = sum_by(points, metric, matchers, [], now, lookback).scalar()
    flagged = ids.join(seen, ids["trace_id"] == seen["_seen"], "left")
    return flagged.select(
        *ids.columns,
        F.col("_seen").isNotNull().alias("has_span"),
        (n_logs > 0).alias("has_logs"),
        F.coalesce(value >= 1, F.lit(False)).alias("has_metric"),
    ).withColumn("ok", F.col("has_span") & F.col("has_metric"))


def link_ingestion(consumer_spans: DataFrame, producer_spans: DataFrame) -> DataFrame:
    """Consumer spans with the producer span each of their links points to.

    Without a link, or when its span is unknown, the producer columns are NULL.
    """
    linked = consumer_spans.select(
        F.col("trace_id").alias("consumer_trace_id"),
        F.col("span_id").alias("consumer_span_id"),
        "start_ts",
        F.explode_outer("links").alias("link"),
    ).select(
        "consumer_trace_id",
        "consumer_span_id",
        "start_ts",
        F.col("link.trace_id").alias("linked_trace_id"),
        F.col("link.span_id").alias("linked_span_id"),
    )
    producers = producer_spans.select(
        F.col("trace_id").alias("j_trace_id"),
        F.col("span_id").alias("j_span_id"),
        F.col("service_name").alias("producer_service"),
        F.col("name").alias("producer_name"),
    )
    return left_join_span(linked, producers, "linked_trace_id", "linked_span_id", "consumer_span_id")


def attach_breadcrumbs(
    events: DataFrame,
    scope: str,
    n: int = 100,
    seq: str = "event_id",
    level: str = "severity_text",
    keep: Sequence[str] = ("ts", "body"),
    pieces: int | None = None,
) -> DataFrame:
    """ERROR events with the last ``n`` WARN events of their scope before them.

    WARN events are numbered within their scope and packed into blocks of ``n``.  An
    error that follows ``c`` warnings needs at most two blocks, found by equality;
    no task holds a whole scope.  ``seq`` is a unique integer event order, sparse or
    crowded: it is scanned in ``pieces`` stretches of about as many events.
    """
    name = F.upper(F.col(level))
    relevant = events.filter(name.isin("ERROR", "WARN")).withColumn(
        "_warn", (name == "WARN").cast("bigint")
    )
    numbered = running_sum(
        relevant, [scope], [seq], even_chunks(relevant, seq, pieces)(seq), "_warn", "_n", blocked=False
    )
    crumb = F.struct(F.col(seq).alias("seq"), *[F.col(c) for c in keep])
    blocks = (
        numbered.filter("_warn = 1")
        .groupBy(F.col(scope).alias("_scope"), chunk_index(F.col("_n") - 1, n).alias("_block"))
        .agg(F.sort_array(F.collect_list(crumb)).alias("_crumbs"))
    )
    # Each block with the one before it: this joins blocks, not events.
    prev = blocks.select(
        F.col("_scope").alias("_s0"), (F.col("_block") + 1).alias("_b0"), F.col("_crumbs").alias("_prev")
    )
    blocks = blocks.join(
        prev, blocks["_scope"].eqNullSafe(prev["_s0"]) & (blocks["_block"] == prev["_b0"]), "left"
    ).drop("_s0", "_b0")
    errors = numbered.filter("_warn = 0").withColumn("_last", chunk_index(F.col("_n") - 1, n))
    joined = errors.join(
        blocks,
        errors[scope].eqNullSafe(blocks["_scope"]) & (errors["_last"] == blocks["_block"]),
        "left",
    )
    none = F.array().cast(blocks.schema["_crumbs"].dataType)
    both = F.concat(F.coalesce("_prev", none), F.coalesce("_crumbs", none))
    before = F.filter(both, lambda c: c["seq"] < F.col(seq))
    crumbs = F.slice(before, F.greatest(F.size(before) - n + 1, F.lit(1)), n)
    return joined.select(*events.columns, crumbs.alias("breadcrumbs"))
