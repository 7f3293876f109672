"""Row routing, level filters, scrubbing and sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.functions.bags import bag_or_empty, put
from obsframe.functions.scalars import as_col, level_rank, uniform_draw


def route_by_level(events: DataFrame, level: str = "severity_text", out: str = "route") -> DataFrame:
    """ERROR to ``event``, WARN to ``breadcrumb``, INFO to ``log``; the rest is dropped."""
    name = F.upper(F.col(level))
    route = F.when(name == "ERROR", "event").when(name == "WARN", "breadcrumb").when(name == "INFO", "log")
    return events.withColumn(out, route).filter(F.col(out).isNotNull())


def filter_by_target(
    df: DataFrame,
    rules: Mapping[str, str],
    default: str = fixed.DEFAULT_LEVEL,
    target: str = "target",
    level: str = "severity_text",
) -> DataFrame:
    """Keep rows whose level the longest matching target prefix lets through."""
    verbosity = {name: i for i, name in enumerate(fixed.LEVELS, 1)}
    limit = None
    for prefix in sorted(rules, key=len, reverse=True):
        starts, most = F.col(target).startswith(prefix), verbosity[rules[prefix].upper()]
        limit = F.when(starts, most) if limit is None else limit.when(starts, most)
    fallback = F.lit(verbosity[default.upper()])
    limit = fallback if limit is None else limit.otherwise(fallback)
    return df.filter(level_rank(level) <= limit)


def before_send(
    events: DataFrame,
    dropped: Sequence[str] = fixed.DROPPED_URL_PARTS,
    service: str = fixed.SERVICE,
) -> DataFrame:
    """Drop health and metrics requests, tag the service, blank the server name."""
    noisy = F.lit(False)
    for part in dropped:
        noisy = noisy | F.coalesce(F.col("url").contains(part), F.lit(False))
    return (
        events.filter(~noisy)
        .withColumn("tags", put(bag_or_empty("tags"), "service", F.lit(service)))
        .withColumn("server_name", F.lit(None).cast("string"))
    )


def sample_traces(df: DataFrame, rate: float = fixed.TRACE_SAMPLE_RATE, key: str = "trace_id") -> DataFrame:
    """Keep a fixed share of traces; all rows of a trace share its fate."""
    return df.filter(uniform_draw(as_col(key).cast("string")) < F.lit(rate))


def drop_untraced(
    requests: DataFrame, paths: Sequence[str] = fixed.UNTRACED_PATHS, path: str = "path"
) -> DataFrame:
    return requests.filter(~F.coalesce(F.col(path).isin(list(paths)), F.lit(False)))
