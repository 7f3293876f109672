"""Attribute rewrites on the bags of spans, logs and points."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.functions import bags
from obsframe.functions.scalars import as_col


def attr_insert(df: DataFrame, bag: str, key: str, value: str) -> DataFrame:
    """Add ``key`` with a fixed value unless the bag already has it."""
    return df.withColumn(bag, bags.put_if_absent(bag, key, F.lit(value)))


def attr_extract(df: DataFrame, bag: str, src: str, pattern: str, groups: Sequence[str]) -> DataFrame:
    """Set one key per capture group of ``pattern`` matched on attribute ``src``.

    Groups are named by position.  Without a match the bag stays as it is.
    """
    text = bags.value_of(bag, src)
    found = {g: F.regexp_extract(text, pattern, i) for i, g in enumerate(groups, 1)}
    return df.withColumn(
        bag, F.when(text.rlike(pattern), bags.edit(bag, found)).otherwise(F.col(bag))
    )


def attr_convert_int(df: DataFrame, bag: str, key: str, typed: str | None = None) -> DataFrame:
    """Normalise an attribute to integer text; text that is no integer stays.

    The bag holds text, so ``typed`` names an extra BIGINT column for the number.
    """
    number = bags.value_of(bag, key).try_cast("bigint")
    out = df.withColumn(bag, bags.put(bag, key, number))
    return out.withColumn(typed, bags.value_of(bag, key).try_cast("bigint")) if typed else out


def attr_upsert_from(df: DataFrame, bag: str, key: str, src: str) -> DataFrame:
    """Copy attribute ``src`` to ``key``; nothing happens when it is missing."""
    return df.withColumn(bag, bags.put(bag, key, bags.value_of(bag, src)))


def attr_delete(df: DataFrame, bag: str, *keys: str) -> DataFrame:
    return df.withColumn(bag, bags.without(bag, *keys))


def attr_set(df: DataFrame, bag: str, key: str, value: Column | str) -> DataFrame:
    """Set ``key`` from an expression over the row; NULL leaves the bag as it is."""
    return df.withColumn(bag, bags.put(bag, key, as_col(value)))


def promote_labels(points: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Copy resource attributes to point labels: ``{label: resource key}``."""
    found = {label: bags.value_of("resource", key) for label, key in mapping.items()}
    return points.withColumn("labels", bags.edit("labels", found))


def process_logs(
    logs: DataFrame,
    marker: tuple[str, str] = (fixed.LOG_RESOURCE_KEY, fixed.LOG_RESOURCE_VALUE),
    pattern: str = fixed.LOG_LOCATION_PATTERN,
    location: tuple[str, str] = fixed.LOG_LOCATION_KEYS,
    host: tuple[str, str] = ("host.name", "container_id"),
    level: str = "level",
    name: tuple[str, str] = ("name", "name-copied"),
) -> DataFrame:
    """The whole log rewrite, each bag rebuilt once.

    Same result as the single steps in order: insert the resource marker; container
    id from the host name, which is deleted; level from the severity; file path and
    line number from ``name``; the line as integer text; ``name`` copied and deleted.

    ``pattern`` has a group for the path and one for the line, which ``location``
    names; ``host`` and ``name`` are the key that is read and the one that keeps it.
    """
    path_key, line_key = location
    marked = bags.has("resource", marker[0])
    read = logs.withColumns({
        "_host": bags.value_of("resource", host[0]),
        "_name": bags.value_of("attributes", name[0]),
        "_line": bags.value_of("attributes", line_key),
        "_marker": F.when(~marked, F.lit(marker[1])),
    })
    # Both groups of the pattern are non-empty where it matches.
    found = read.withColumns({
        "_path": F.nullif(F.regexp_extract("_name", pattern, 1), F.lit("")),
        "_line": F.coalesce(
            F.nullif(F.regexp_extract("_name", pattern, 2), F.lit("")), "_line"
        ),
    })
    line = F.coalesce(F.col("_line").try_cast("bigint").cast("string"), "_line")
    resource = bags.edit(
        "resource", {marker[0]: "_marker", host[1]: "_host"}, [host[0]]
    )
    attributes = bags.edit(
        "attributes",
        {level: "severity_text", path_key: "_path", line_key: "_line", name[1]: "_name"},
        [name[0]],
    )
    return (
        found.withColumn("_line", line)
        .withColumns({"resource": resource, "attributes": attributes})
        .drop("_host", "_name", "_line", "_marker", "_path")
    )


def process_logs_stepwise(logs: DataFrame) -> DataFrame:
    """:func:`process_logs` as its single steps, for pipelines that change some of them."""
    return (
        logs.transform(
            attr_insert, "resource", fixed.LOG_RESOURCE_KEY, fixed.LOG_RESOURCE_VALUE
        )
        .transform(attr_set, "resource", "container_id", bags.value_of("resource", "host.name"))
        .transform(attr_delete, "resource", "host.name")
        .transform(attr_set, "attributes", "level", F.col("severity_text"))
        .transform(
            attr_extract, "attributes", "name", fixed.LOG_LOCATION_PATTERN, fixed.LOG_LOCATION_KEYS
        )
        .transform(attr_convert_int, "attributes", "line_number")
        .transform(attr_upsert_from, "attributes", "name-copied", "name")
        .transform(attr_delete, "attributes", "name")
    )
