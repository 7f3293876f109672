"""Error rates of a stream of spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from obsframe.functions.scalars import micros
from obsframe.operators.spanmetrics import CALL_KEYS
from obsframe.streaming.state import keep_state, wake_at

_RATED = "service_name string, t timestamp, value double"


def summed_rates(
    series: np.ndarray, at: np.ndarray, calls: np.ndarray, grid: np.ndarray, window_us: int
) -> tuple[np.ndarray, np.ndarray]:
    """Per time of the grid, the sum of the series' rates and whether there is any.

    Counts are the steps of counters that never reset: a counter's increase within
    ``(t - window, t]`` is what it gained after its first point there; a series with
    fewer than two points has no rate.
    """
    total, some = np.zeros(len(grid)), np.zeros(len(grid), bool)
    for name in np.unique(series):
        own = np.flatnonzero(series == name)
        own = own[np.argsort(at[own], kind="stable")]
        gained = np.concatenate([[0], np.cumsum(calls[own])])
        low = np.searchsorted(at[own], grid - window_us, side="right")
        high = np.searchsorted(at[own], grid, side="right")
        rated = high - low >= 2
        total[rated] += (gained[high[rated]] - gained[low[rated] + 1]) / (window_us / 1e6)
        some |= rated
    return total, some


class ErrorRates(StatefulProcessor):
    """One service: the call counts that a rate can still reach, and the last time rated."""

    def __init__(self, window_us: int, step_us: int) -> None:
        self.window_us, self.step_us = window_us, step_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "t_us bigint")
        self.counts = handle.getListState("counts", "series string, ts_us bigint, calls bigint")

    def handleInputRows(  # noqa: N802
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues  # noqa: N803
    ) -> Iterator[pd.DataFrame]:
        for frame in rows:
            self.counts.appendList([
                (s, int(t), int(n)) for s, t, n in zip(frame["series"], frame["ts_us"], frame["calls"])
            ])
        yield from self._rate(key, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(  # noqa: N802
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo  # noqa: N803
    ) -> Iterator[pd.DataFrame]:
        yield from self._rate(key, timerValues.getCurrentWatermarkInMs() * 1000)

    def _rate(self, key: tuple, until: int) -> Iterator[pd.DataFrame]:
        held = list(self.counts.get()) if self.counts.exists() else []
        if not held:
            return
        series = np.array([row[0] for row in held], dtype=object).astype(str)
        at, calls = (np.array([row[k] for row in held], np.int64) for k in (1, 2))
        step, window = self.step_us, self.window_us
        first = -(-int(at.min()) // step) * step
        if self.last.exists():
            first = max(first, self.last.get()[0] + step)
        grid = np.arange(first, min(until, int(at.max()) + window - 1) + 1, step, dtype=np.int64)
        after = first - step
        if len(grid):
            after = int(grid[-1])
            total, some = summed_rates(series, at, calls, grid, window)
            if some.any():
                yield pd.DataFrame({
                    "service_name": pd.Series([key[0]] * int(some.sum()), dtype=object),
                    "t": pd.to_datetime(grid[some], unit="us"), "value": total[some],
                })
            self.last.update((after,))
            kept = [row for row in held if row[1] > after + step - window]
            self.counts.put(kept) if kept else self.counts.clear()
            held = kept
        wake_at(self.handle, after + step if held else None)

    def close(self) -> None:
        pass


def stream_error_rate(
    spans_stream: DataFrame,
    service: str | None = None,
    window: str | float = "1 minute",
    rate_window: str | float = "5 minutes",
    step: str | float = "1 minute",
    delay: str = "30 seconds",
) -> DataFrame:
    """Streaming form of ``span_error_rate``: (service_name, t, value) of each service.

    Failed calls are counted per series and tumbling window by Spark's windowed
    aggregate, with partial counts before the shuffle; what reaches a service's state
    is a row per series and window, kept as long as a rate reaches it.  Times are
    rated when the watermark has passed them; spans behind it are late and dropped.
    """
    keep_state(spans_stream.sparkSession)
    failed = F.col("status_code") == "STATUS_CODE_ERROR"
    if service is not None:
        failed = failed & (F.col("service_name") == service)
    failed = F.coalesce(failed, F.lit(False))
    # Healthy spans move the watermark too: as a filter, the condition would be pushed
    # under it.  They share one group per window, which holds no failed call.
    keys = [F.when(failed, F.col(k)).alias(k) for k in CALL_KEYS]
    width = f"{micros(window)} microseconds"
    calls = (
        spans_stream.withWatermark("start_ts", delay)
        .groupBy(F.window("start_ts", width), *keys)
        .agg(F.count_if(failed).alias("calls"))
        .filter("calls > 0")
    )
    series = F.to_json(F.struct(*[F.col(k) for k in CALL_KEYS]))
    counts = calls.select(
        F.window_time("window").alias("at"),
        "service_name",
        series.alias("series"),
        F.unix_micros("window.end").alias("ts_us"),
        "calls",
    )
    return counts.groupBy("service_name").transformWithStateInPandas(
        ErrorRates(micros(rate_window), micros(step)), _RATED, "Append", "EventTime", eventTimeColumnName="t"
    )
