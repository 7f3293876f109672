"""Alert states over an evaluated value series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.functions.scalars import micros

NORMAL, PENDING, ALERTING, NO_DATA, ERROR = "Normal", "Pending", "Alerting", "NoData", "Error"


def alert_states(
    values: DataFrame,
    keys: Sequence[str] = (),
    threshold: float = fixed.ALERT_THRESHOLD,
    for_: str | float = "1 minute",
    interval: str | float = "1 minute",
    failed: str | None = None,
    lookback: str | float | None = None,
    until=None,
) -> DataFrame:
    """State at every evaluation from a rule's first time ``t`` to its last, or to ``until``.

    A value above the threshold is Pending until it has been so for ``for_``, then
    Alerting.  An evaluation without value is NoData; one whose ``failed`` column is
    true is Error.  Both end a streak.

    With a ``lookback``, an evaluation asks for that range and takes its last value: the
    last one that did not fail, in ``(t - lookback, t]``.  So gaps shorter than the range
    carry a value on, and only longer ones are NoData.

    ``values`` has one row per rule and evaluation, so a rule's window is bounded by
    the time range over the interval and not by the data behind the values.
    """
    keys, step = list(keys), micros(interval)
    src = values.filter(F.col("t").isNotNull()).select(
        *keys,
        F.unix_micros("t").alias("at_us"),
        F.col("value").cast("double").alias("value"),
        (F.coalesce(F.col(failed), F.lit(False)) if failed else F.lit(False)).alias("failed"),
    )
    rule = W.partitionBy(*(keys or [F.lit(0)]))
    # An evaluation fills the steps up to the next one; all but the first have no value.
    end = F.col("at_us") if until is None else F.unix_micros(F.lit(until).cast("timestamp"))
    until = F.coalesce(F.lead("at_us").over(rule.orderBy("at_us")) - 1, end)
    filled = src.withColumn("_until", F.greatest(until, F.col("at_us"))).withColumn(
        "t_us", F.explode(F.sequence("at_us", "_until", F.lit(step).cast("bigint")))
    )
    given = F.col("t_us") == F.col("at_us")
    steps = filled.withColumns({
        "value": F.when(given, F.col("value")), "failed": given & F.col("failed"),
    })
    order = rule.orderBy("t_us")
    if lookback is not None:
        reached = order.rangeBetween(1 - micros(lookback), 0)
        steps = steps.withColumn(
            "value", F.last(F.when(~F.col("failed"), F.col("value")), ignorenulls=True).over(reached)
        )
    breach = (
        ~F.col("failed") & F.col("value").isNotNull() & ~F.isnan("value") & (F.col("value") > threshold)
    )
    steps = steps.withColumn("breach", F.coalesce(breach, F.lit(False)))
    steps = steps.withColumn(
        "_calm",
        F.max(F.when(~F.col("breach"), F.col("t_us"))).over(order.rowsBetween(W.unboundedPreceding, 0)),
    )
    streak = W.partitionBy(*keys, "_calm", "breach")
    since = F.min(F.when(F.col("breach"), F.col("t_us"))).over(streak)
    steps = steps.withColumn("since_us", F.when(F.col("breach"), since))
    state = (
        F.when(F.col("failed"), ERROR)
        .when(F.col("value").isNull(), NO_DATA)
        .when(F.col("breach") & (F.col("t_us") - F.col("since_us") >= micros(for_)), ALERTING)
        .when(F.col("breach"), PENDING)
        .otherwise(NORMAL)
    )
    return steps.select(
        *keys,
        F.timestamp_micros("t_us").alias("t"),
        "value",
        state.alias("state"),
        F.timestamp_micros("since_us").alias("since"),
    )
