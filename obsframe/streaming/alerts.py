"""Alert states of a stream of values, evaluated by event time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

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

from obsframe import fixed
from obsframe.functions.scalars import micros
from obsframe.operators.alerts import ALERTING, ERROR, NO_DATA, NORMAL, PENDING
from obsframe.streaming.rates import stream_error_rate
from obsframe.streaming.state import keep_state, wake_at

#: Evaluations that are made at a time.
_PIECE = 1 << 15


class Held(NamedTuple):
    """Where a rule's evaluations have come to."""

    last_us: int  # the last evaluation
    since_us: int | None  # the start of the present streak
    seen_us: int | None  # the last value, and when
    seen: float | None


class Rule(NamedTuple):
    threshold: float
    for_us: int
    step_us: int
    lookback_us: int | None
    states: tuple[str, str, str, str, str]
    piece: int


def evaluated(held: Held | None, rows: Sequence[tuple], until: int, rule: Rule) -> tuple[pd.DataFrame, Held | None]:
    """All evaluations after the held one up to ``until``.

    ``rows`` are (time, value, whether there is a value, whether it failed), by time.  An
    evaluation fills the steps up to the next one.
    """
    normal, pending, alerting, no_data, error = rule.states
    times, values, present, failed = (
        np.array(column, kind) for column, kind in zip(zip(*rows) if rows else ((),) * 4, ("i8", "f8", "?", "?"))
    )
    own = np.ones(len(times), np.int64)
    starts, first_row = times, 0
    if held is not None:
        starts, own, first_row = np.append(held.last_us, times), np.append(0, own), 1
    if not len(starts):
        return pd.DataFrame(), held
    ends = np.append(starts[1:], until + 1)
    sizes = own + np.maximum(ends - starts - 1, 0) // rule.step_us
    n = int(sizes.sum())
    if not n:
        return pd.DataFrame(), held
    group = np.repeat(np.arange(len(starts)), sizes)
    offset = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1 - own[group]
    at, given = starts[group] + offset * rule.step_us, offset == 0
    value, has, fails = np.full(n, np.nan), np.zeros(n, bool), np.zeros(n, bool)
    row = group[given] - first_row
    value[given], has[given], fails[given] = values[row], present[row], failed[row]
    seen_us, seen = (held.seen_us, held.seen) if held is not None else (None, None)
    if rule.lookback_us is not None:
        good = np.maximum.accumulate(np.where(has & ~fails, np.arange(n), -1))
        earlier = seen_us is not None
        when = np.where(good >= 0, at[good], seen_us if earlier else 0)
        value = np.where(good >= 0, value[good], seen if earlier else np.nan)
        has = ((good >= 0) | earlier) & (at - when < rule.lookback_us)
        if has[-1]:
            seen_us, seen = int(when[-1]), float(value[-1])
        else:
            seen_us = seen = None
    breach = has & ~fails & (value > rule.threshold)
    calm = np.maximum.accumulate(np.where(breach, -1, np.arange(n)))
    streak = held.since_us if held is not None and held.since_us is not None else int(at[0])
    since = np.where(calm >= 0, at[np.minimum(calm + 1, n - 1)], streak)
    state = np.select(
        [fails, ~has, breach & (at - since >= rule.for_us), breach], [error, no_data, alerting, pending], normal
    )
    out = pd.DataFrame({
        "t_us": at, "value": value, "present": has, "state": state, "since_us": since, "breach": breach,
    })
    return out, Held(int(at[-1]), int(since[-1]) if breach[-1] else None, seen_us, seen)


class AlertStates(StatefulProcessor):
    """One rule: the last evaluation, and the values that wait for the watermark.

    A timer is set to the next evaluation, so a rule without values is evaluated too.
    """

    def __init__(self, rule: Rule) -> None:
        self.rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState(
            "held", "last_us bigint, since_us bigint, seen_us bigint, seen double"
        )
        self.waiting = handle.getListState(
            "waiting", "t_us bigint, value double, present boolean, failed boolean"
        )

    def handleInputRows(  # noqa: N802
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues  # noqa: N803
    ) -> Iterator[pd.DataFrame]:
        held = Held(*self.held.get()) if self.held.exists() else None
        for frame in rows:
            if held is not None:
                frame = frame[frame["t_us"] > held.last_us]
            if len(frame):
                self.waiting.appendList([
                    (int(t), float(v), bool(p), bool(f))
                    for t, v, p, f in zip(frame["t_us"], frame["value"], frame["present"], frame["failed"])
                ])
        yield from self._evaluate(key, held, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(  # noqa: N802
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo  # noqa: N803
    ) -> Iterator[pd.DataFrame]:
        held = Held(*self.held.get()) if self.held.exists() else None
        yield from self._evaluate(key, held, timerValues.getCurrentWatermarkInMs() * 1000)

    def _evaluate(self, key: tuple, held: Held | None, until: int) -> Iterator[pd.DataFrame]:
        rows = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: r[0]) if self.waiting.exists() else []
        due = [r for r in rows if r[0] <= until]
        rest = rows[len(due):]
        before, done = held, 0
        while True:
            begin = held.last_us if held is not None else due[0][0] if due else until
            horizon = min(until, begin + self.rule.step_us * self.rule.piece)
            part = [r for r in due[done:done + self.rule.piece] if r[0] <= horizon]
            done += len(part)
            if done < len(due) and due[done][0] <= horizon:  # the piece ends before the next value
                horizon = part[-1][0]
            frame, held = evaluated(held, part, horizon, self.rule)
            if len(frame):
                yield frame.assign(rule=pd.Series([key[0]] * len(frame), dtype=object))
            if horizon >= until:
                break
        if due:
            self.waiting.put(rest) if rest else self.waiting.clear()
        if held is not None and held != before:
            self.held.update(tuple(held))
        next_us = [rest[0][0]] if rest else []
        if held is not None:
            next_us.append(held.last_us + self.rule.step_us)
        wake_at(self.handle, min(next_us, default=None))

    def close(self) -> None:
        pass


def stream_alerts(
    values_stream: DataFrame,
    threshold: float = fixed.ALERT_THRESHOLD,
    for_: str | float = "1 minute",
    interval: str | float = "1 minute",
    rule: str = "rule",
    failed: str | None = None,
    lookback: str | float | None = None,
    delay: str | None = "0 seconds",
) -> DataFrame:
    """Streaming form of ``alert_states``: one state row per evaluation.

    ``values_stream`` has (rule, t, value).  Evaluations are made when the watermark,
    ``delay`` behind the latest time, has passed them; values that come behind it are
    late and dropped.  A rule that falls silent is evaluated on: to NoData, or to its
    last value for as long as ``lookback`` reaches.  ``delay=None`` takes the watermark
    that the stream has, as of ``stream_error_rate``.

    A rule's state is its last evaluation and the values within the delay.  Evaluations
    are made in pieces, so a long silence is never one list.
    """
    keep_state(values_stream.sparkSession)
    timed = values_stream if delay is None else values_stream.withWatermark("t", delay)
    value = F.col("value").cast("double")
    src = timed.filter(F.col("t").isNotNull()).select(
        F.col(rule).alias("rule"),
        "t",
        F.unix_micros("t").alias("t_us"),
        F.coalesce(value, F.lit(0.0)).alias("value"),
        value.isNotNull().alias("present"),
        (F.coalesce(F.col(failed), F.lit(False)) if failed else F.lit(False)).alias("failed"),
    )
    settings = Rule(
        float(threshold), micros(for_), micros(interval), None if lookback is None else micros(lookback),
        (NORMAL, PENDING, ALERTING, NO_DATA, ERROR), _PIECE,
    )
    kind = src.schema["rule"].dataType.simpleString()
    states = src.groupBy("rule").transformWithStateInPandas(
        AlertStates(settings),
        f"rule {kind}, t_us bigint, value double, present boolean, state string, since_us bigint, breach boolean",
        "Append",
        "EventTime",
    )
    return states.select(
        F.col("rule").alias(rule),
        F.timestamp_micros("t_us").alias("t"),
        F.when(F.col("present"), F.coalesce("value", F.lit(float("nan")))).alias("value"),
        "state",
        F.when(F.col("breach"), F.timestamp_micros("since_us")).alias("since"),
    )


def stream_error_alert(
    spans_stream: DataFrame,
    service: str | None = fixed.SERVICE,
    window: str | float = "1 minute",
    rate_window: str | float = "5 minutes",
    step: str | float = "1 minute",
    threshold: float = fixed.ALERT_THRESHOLD,
    for_: str | float = "1 minute",
    lookback: str | float | None = fixed.ALERT_RANGE,
    delay: str = "30 seconds",
) -> DataFrame:
    """Alert states of error rates from a stream of raw spans: calls, rates, states.

    Three stateful operators under the one watermark of the spans; all services have a
    state each if ``service`` is None.
    """
    rates = stream_error_rate(spans_stream, service, window, rate_window, step, delay)
    return stream_alerts(
        rates, threshold, for_, step, rule="service_name", lookback=lookback, delay=None
    )
