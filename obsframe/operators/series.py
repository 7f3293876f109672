"""Time series over metric points: accumulation, rates, heatmaps, instant values.

``series`` names the STRING columns, or label entries, that identify a series.  Points are
pre-aggregated to (series, time) or (series, step) before anything is ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.functions.bags import value_of
from obsframe.functions.scalars import as_col, label_map, micros, seconds, series_entries, series_key
from obsframe.operators.ordered import chunk_index, even_chunks, fill_keys, restore_keys, running_sum


def matching(labels, matchers: Mapping[str, str]) -> Column:
    """Equality matchers on a label map; an empty text also matches a missing label."""
    out = F.lit(True)
    for key, wanted in matchers.items():
        out = out & (F.coalesce(value_of(labels, key), F.lit("")) == wanted)
    return out


def select_series(points: DataFrame, metric: str, matchers: Mapping[str, str] | None = None) -> DataFrame:
    """Points of one metric whose labels match, with ``series`` as their identity."""
    return points.filter((F.col("metric") == metric) & matching("labels", matchers or {})).withColumn(
        "series", series_key("labels")
    )


def drop_out_of_order(
    points: DataFrame, series: Sequence[str], arrival: str, pieces: int | None = None
) -> DataFrame:
    """Drop points not later than every earlier arrival of their series."""
    series = list(series)
    chunk = even_chunks(points, arrival, pieces)
    rows = fill_keys(points, series).withColumn("_chunk", chunk(arrival))
    peaks = rows.groupBy(*series, "_chunk").agg(F.max("ts").alias("_peak"))
    earlier = W.partitionBy(*series).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    peaks = peaks.withColumn("_before", F.max("_peak").over(earlier)).drop("_peak")
    inside = W.partitionBy(*series, "_chunk").orderBy(arrival).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.max("ts").over(inside)).join(peaks, [*series, "_chunk"], "left")
    kept = rows.filter(F.coalesce(F.col("ts") > F.greatest("_inside", "_before"), F.lit(True)))
    return restore_keys(kept.drop("_chunk", "_inside", "_before"), series)


def delta_to_cumulative(
    points: DataFrame,
    series: Sequence[str],
    arrival: str | None = None,
    chunk: str | float = "10 minutes",
    pieces: int | None = None,
    merged: bool = False,
) -> DataFrame:
    """Running total of delta points per series, as (series.., ts, value).

    With an integer ``arrival`` column, points that arrive at or before the latest
    time already seen in their series are dropped; arrivals are scanned in ``pieces``
    chunks of about as many points.  Without one, points are taken in
    time order and those of the same time are added up; ``merged`` skips that where a
    series is known to have one point per time.
    """
    series = list(series)
    if arrival is not None:
        points = drop_out_of_order(points, series, arrival, pieces)
    at = F.unix_micros("ts").alias("ts_us")
    if merged:
        deltas = points.select(*series, at, F.col("value").alias("_delta"))
    else:
        deltas = points.groupBy(*series, at).agg(F.sum("value").alias("_delta"))
    out = running_sum(
        deltas, series, ["ts_us"], chunk_index(F.col("ts_us"), micros(chunk)), "_delta", "value",
        blocked=False,
    )
    return out.select(*series, F.timestamp_micros("ts_us").alias("ts"), "value")


def _panes(points: DataFrame, series: Sequence[str], window: int, step: int) -> DataFrame:
    """Per series and pane: first, last, count and reset losses.

    Windows of a step grid begin and end at two places of a step at most; a pane is what
    lies between, ``(.., end]``, so there are two panes a step whatever the window.  The
    only ordered scan of raw points, and it is over one pane of one series.
    """
    us = F.unix_micros("ts")
    rows = fill_keys(points, series).select(
        *series, us.alias("us"), F.col("value").cast("double").alias("v")
    ).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    end, cut = _on_grid(F.col("us"), step), window % step
    if cut:
        end = F.when(F.col("us") <= end - cut, end - cut).otherwise(end)
    rows = rows.withColumn("end", end)
    prev = F.lag("v").over(W.partitionBy(*series, "end").orderBy("us"))
    return (
        rows.withColumn("lost", F.when(F.col("v") < prev, prev).otherwise(0.0))
        .groupBy(*series, "end")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("us").alias("first_us"),
            F.max("us").alias("last_us"),
            F.min_by("v", "us").alias("first_v"),
            F.max_by("v", "us").alias("last_v"),
            F.sum("lost").alias("lost"),
        )
    )


def _on_grid(us: Column, step: int) -> Column:
    """The first time of the step grid that is not before ``us``."""
    return us + F.pmod(-us, F.lit(step))


def increases(
    points: DataFrame, series: Sequence[str], window: str | float, step: str | float
) -> DataFrame:
    """Reset-aware increase of each series in ``(t - window, t]`` on a step grid.

    Points are reduced to panes, and running sums over the panes of a series make each
    counter one that never resets.  A window's increase is then a difference between
    its last and its first pane.  A pane is the last one of the windows up to the next
    pane, and the first one of those that the pane before has left; so each window gets
    two rows, however many panes it covers, and they meet without another shuffle.
    """
    series = list(series)
    w, s = micros(window), micros(step)
    in_order = W.partitionBy(*series).orderBy("end")
    so_far = in_order.rowsBetween(W.unboundedPreceding, 0)
    before = F.lag("last_v").over(in_order)
    panes = (
        _panes(points, series, w, s)
        .withColumns({
            "gap": F.when(F.col("first_v") < before, before).otherwise(0.0),
            "earlier": F.lag("end").over(in_order),
            "later": F.lead("end").over(in_order),
        })
        .withColumns({
            "losses": F.sum(F.col("gap") + F.col("lost")).over(so_far),
            "points": F.sum("n").over(so_far),
        })
    )
    start, final = _on_grid(F.col("end"), s), F.col("end") + w - 1
    left = _on_grid(F.col("earlier") + w, s)
    last_of = (start, F.least(final, _on_grid(F.col("later"), s) - s))
    first_of = (F.greatest(start, left), final)

    def windows(span: tuple[Column, Column], **state: Column) -> Column:
        grid = F.when(span[0] <= span[1], F.sequence(*span, F.lit(s).cast("bigint")))
        fields = ("first_us", "first_v", "last_us", "last_v", "raised", "counted")
        kinds = {"first_us": "bigint", "last_us": "bigint", "counted": "bigint"}
        values = [
            state.get(f, F.lit(None)).cast(kinds.get(f, "double")).alias(f) for f in fields
        ]
        rows = F.transform(grid, lambda t: F.struct(t.alias("t_us"), *values))
        return F.coalesce(rows, F.array().cast(
            "array<struct<t_us:bigint,first_us:bigint,first_v:double,last_us:bigint,last_v:double,"
            "raised:double,counted:bigint>>"))

    as_last = windows(
        last_of, last_us=F.col("last_us"), last_v=F.col("last_v"),
        raised=F.col("last_v") + F.col("losses"), counted=F.col("points"),
    )
    as_first = windows(
        first_of, first_us=F.col("first_us"), first_v=F.col("first_v"),
        raised=-(F.col("first_v") + F.col("losses") - F.col("lost")), counted=F.col("n") - F.col("points"),
    )
    out = (
        panes.select(*series, F.inline(F.concat(as_last, as_first)))
        .groupBy(*series, "t_us")
        .agg(
            F.sum("counted").alias("n"),
            *[F.max(c).alias(c) for c in ("first_us", "last_us", "first_v", "last_v")],
            F.sum("raised").alias("increase"),
        )
        .filter("n >= 2")
    )
    return restore_keys(out, series)


def rate(
    points: DataFrame,
    series: Sequence[str],
    window: str | float,
    step: str | float,
    mode: str = "simple",
) -> DataFrame:
    """Per-second rate of counters as (series.., t, rate).

    ``simple`` divides the increase by the window; ``prometheus`` extrapolates it to
    the window's edges first.  Fewer than two points in the window give no row.
    """
    inc = increases(points, series, window, step)
    w = seconds(window)
    if mode == "simple":
        value = F.col("increase") / w
    elif mode == "prometheus":
        sampled = (F.col("last_us") - F.col("first_us")) / 1e6
        mean_gap = sampled / (F.col("n") - 1)
        to_start = (F.col("first_us") - (F.col("t_us") - micros(window))) / 1e6
        to_end = (F.col("t_us") - F.col("last_us")) / 1e6
        clip = lambda d: F.when(d >= 1.1 * mean_gap, mean_gap / 2).otherwise(d)
        to_zero = sampled * F.col("first_v") / F.col("increase")
        start = F.when(
            (F.col("increase") > 0) & (F.col("first_v") >= 0), F.least(clip(to_start), to_zero)
        ).otherwise(clip(to_start))
        value = F.col("increase") * (sampled + start + clip(to_end)) / sampled / w
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return inc.select(*series, F.timestamp_micros("t_us").alias("t"), value.alias("rate"))


def rate_interval(step: str | float, scrape: str | float) -> float:
    """Window in seconds a panel uses for a step and a scrape interval."""
    return max(seconds(step) + seconds(scrape), 4 * seconds(scrape))


def error_rate(
    points: DataFrame,
    service: str,
    window: str | float,
    step: str | float,
    mode: str = "simple",
    metric: str = fixed.CALLS_METRIC,
) -> DataFrame:
    """Summed rate of a service's failed calls, as (t, value)."""
    wanted = {"status_code": "STATUS_CODE_ERROR", "service": service}
    failed = points.filter((F.col("metric") == metric) & matching("labels", wanted)).withColumn(
        "series", series_entries("labels")
    )
    return rate(failed, ["series"], window, step, mode).groupBy("t").agg(F.sum("rate").alias("value"))


def latency_heatmap(
    points: DataFrame,
    server: str,
    window: str | float,
    step: str | float = "120 seconds",
    mode: str = "simple",
    metric: str = fixed.EDGE_SERVER_METRIC + "_bucket",
    hide_below: float = fixed.HEATMAP_HIDE_BELOW,
) -> DataFrame:
    """Rate of requests per latency cell: (series, t, le, cell).

    Each cumulative bucket's rate minus that of the next smaller bound of the same
    histogram; cells at or below ``hide_below`` are left out.
    """
    buckets = points.filter((F.col("metric") == metric) & matching("labels", {"server": server}))
    buckets = buckets.withColumns({
        "series": series_entries(F.map_filter("labels", lambda k, _: k != "le")),
        "le": value_of("labels", "le"),
    })
    rates = rate(buckets, ["series", "le"], window, step, mode)
    cells = heatmap_cells(rates.withColumn("le", bound_number("le")), ["series"], hide_below)
    return cells.withColumn("series", F.to_json("series"))


def heatmap_cells(
    rates: DataFrame, series: Sequence[str], hide_below: float = fixed.HEATMAP_HIDE_BELOW
) -> DataFrame:
    """Cells from cumulative bucket rates; one group is one histogram at one time."""
    order = W.partitionBy(*series, "t").orderBy("le")
    cell = F.col("rate") - F.coalesce(F.lag("rate").over(order), F.lit(0.0))
    return (
        rates.withColumn("cell", cell)
        .filter(F.col("cell") > hide_below)
        .select(*series, "t", "le", "cell")
    )


def instant(
    points: DataFrame, series: Sequence[str], t, lookback: str | float = "5 minutes"
) -> DataFrame:
    """Latest point of each series in ``(t - lookback, t]``; one point per time is assumed."""
    t = t if isinstance(t, Column) else F.lit(t).cast("timestamp")
    oldest = F.timestamp_micros(F.unix_micros(t) - micros(lookback))
    return (
        points.filter((F.col("ts") <= t) & (F.col("ts") > oldest))
        .groupBy(*series)
        .agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts"))
        .select(*series, "ts", "value")
    )


def sum_by(
    points: DataFrame,
    metric: str,
    matchers: Mapping[str, str],
    by: Sequence[str],
    t,
    lookback: str | float = "5 minutes",
) -> DataFrame:
    """``sum by (labels)`` of a selector at an instant."""
    chosen = select_series(points, metric, matchers).withColumns(
        {label: value_of("labels", label) for label in by}
    )
    latest = instant(chosen, ["series", *by], t, lookback)
    return latest.groupBy(*by).agg(F.sum("value").alias("value"))


def reduce_last(values: DataFrame, keys: Sequence[str] = (), ts: str = "t", value: str = "value") -> DataFrame:
    """Last value of each series of a range."""
    last = values.groupBy(*keys).agg(F.max(ts).alias("_ts"), F.max_by(value, ts).alias("_value"))
    return last.select(*keys, F.col("_ts").alias(ts), F.col("_value").alias(value))


def threshold_steps(
    df: DataFrame, col: str, steps: Sequence[tuple[float | None, str]] = fixed.THRESHOLD_STEPS,
    out: str = "color",
) -> DataFrame:
    """Colour of the highest step a value reaches; the step without a bound is the base."""
    base = next((c for bound, c in steps if bound is None), None)
    rising = sorted((s for s in steps if s[0] is not None), reverse=True)
    color = None
    for bound, name in rising:
        reached = F.col(col) >= bound
        color = F.when(reached, name) if color is None else color.when(reached, name)
    color = F.lit(base) if color is None else color.otherwise(F.lit(base))
    return df.withColumn(out, color)


def points_from(
    df: DataFrame,
    metric: str,
    labels: Mapping[str, object],
    value,
    ts,
    temporality: str = "cumulative",
) -> DataFrame:
    """Rows of an aggregate as canonical metric points."""
    return df.select(
        F.lit(metric).alias("metric"),
        label_map(labels).alias("labels"),
        as_col(ts).alias("ts"),
        as_col(value).cast("double").alias("value"),
        F.lit(temporality).alias("temporality"),
        F.expr("cast(map() as map<string,string>)").alias("resource"),
    )


def bound_text(le) -> Column:
    """Histogram bound as label text."""
    le = as_col(le)
    return F.when(le == float("inf"), "+Inf").otherwise(le.cast("string"))


def bound_number(le) -> Column:
    """Histogram bound from label text."""
    le = as_col(le)
    return F.when(le.isin("+Inf", "Inf"), float("inf")).otherwise(le.try_cast("double"))
