"""Running totals of delta points across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from obsframe.streaming.state import keep_state

_FIRST = -(2**63)


class RunningTotals(StatefulProcessor):
    """Latest time and total of one series."""

    def __init__(self, series: Sequence[str]) -> None:
        self.series = list(series)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("total", "last_us bigint, total double")

    def handleInputRows(  # noqa: N802
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues  # noqa: N803
    ) -> Iterator[pd.DataFrame]:
        last, total = self.held.get() if self.held.exists() else (_FIRST, 0.0)
        points = pd.concat(list(rows)).sort_values(["arrival", "ts_us"], kind="stable")
        at = points["ts_us"].to_numpy(np.int64)
        before = np.maximum.accumulate(np.concatenate([[last], at[:-1]]))
        kept = at > before
        sums = total + np.cumsum(points["value"].to_numpy(np.float64)[kept])
        if not len(sums):
            return
        self.held.update((int(at[kept][-1]), float(sums[-1])))
        yield pd.DataFrame({
            **{name: pd.Series([part] * len(sums), dtype=object) for name, part in zip(self.series, key)},
            "ts_us": at[kept], "value": sums,
        })

    def close(self) -> None:
        pass


def stream_delta_to_cumulative(
    points_stream: DataFrame, series: Sequence[str], arrival: str
) -> DataFrame:
    """Streaming form of ``delta_to_cumulative`` with an ``arrival`` order.

    One rule decides what is late: a point at or before the latest time that arrived
    earlier in its series.  It needs no watermark and does not know micro-batches, so
    however the input is cut, as long as earlier arrivals come in earlier batches, the
    rows are the same, and they are those of the batch operator.

    State is a time and a total per series.  The points of a series in one micro-batch
    meet in one task, 24 bytes each: the running total needs them in order, and the
    source bounds a micro-batch (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``).

    Points without a time are dropped; a point without a value adds nothing; points
    without an arrival count as the first of their micro-batch; a NULL in ``series``
    is a value like others.
    """
    series = list(series)
    keep_state(points_stream.sparkSession)
    rows = points_stream.filter(F.col("ts").isNotNull()).select(
        *series,
        F.unix_micros("ts").alias("ts_us"),
        F.coalesce(F.col(arrival).cast("bigint"), F.lit(_FIRST)).alias("arrival"),
        F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"),
    )
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*series).schema)
    totals = rows.groupBy(*series).transformWithStateInPandas(
        RunningTotals(series), f"{names}, ts_us bigint, value double", "Append", "None"
    )
    return totals.select(*series, F.timestamp_micros("ts_us").alias("ts"), "value")
