"""Attribute bags: MAP<STRING,STRING> column expressions.

None of them adds a key twice, so the session's duplicate-key policy never matters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from obsframe.functions.scalars import as_col


def empty_bag() -> Column:
    return F.expr("cast(map() as map<string,string>)")


def bag_or_empty(bag) -> Column:
    return F.coalesce(as_col(bag), empty_bag())


def value_of(bag, key: str) -> Column:
    return F.try_element_at(as_col(bag), F.lit(key))


def has(bag, key: str) -> Column:
    return F.coalesce(F.map_contains_key(as_col(bag), F.lit(key)), F.lit(False))


def without(bag, *keys: str) -> Column:
    return F.map_filter(as_col(bag), lambda k, _: ~k.isin(list(keys)))


def edit(bag, puts: Mapping[str, object], drop: Sequence[str] = ()) -> Column:
    """Set and drop several keys in one rebuild of the bag.

    A NULL value leaves its key as it was.  Rebuilding a map is the dear part of a
    rewrite, so steps on the same bag are best gathered into one call.
    """
    source = bag_or_empty(bag)
    kept = F.filter(F.map_entries(source), lambda e: ~e["key"].isin([*puts, *drop]))
    parts = [kept]
    for key, value in puts.items():
        new = as_col(value).cast("string")
        pair = F.struct(
            F.lit(key).alias("key"), F.coalesce(new, value_of(source, key)).alias("value")
        )
        parts.append(
            F.when(new.isNotNull() | has(source, key), F.array(pair)).otherwise(_no_pairs())
        )
    return F.map_from_entries(F.concat(*parts))


def _no_pairs() -> Column:
    return F.expr("cast(array() as array<struct<key:string,value:string>>)")


def put(bag, key: str, value) -> Column:
    """Set ``key``; a NULL value leaves the bag as it is."""
    return F.when(as_col(value).isNull(), as_col(bag)).otherwise(edit(bag, {key: value}))


def put_if_absent(bag, key: str, value) -> Column:
    bag = bag_or_empty(bag)
    return F.when(has(bag, key), bag).otherwise(
        F.map_concat(bag, F.create_map(F.lit(key), as_col(value).cast("string")))
    )


def kv_to_map(kvs) -> Column:
    """Key-value list to a map; text wins over int, the last of equal keys wins."""
    entry = lambda e, i: F.named_struct(
        F.lit("key"), e["key"],
        F.lit("place"), i,
        F.lit("value"), F.coalesce(e["value"]["stringValue"], e["value"]["intValue"]),
    )
    # In order of key and place, an entry counts if the next one has another key.
    in_order = F.sort_array(F.transform(F.filter(as_col(kvs), lambda e: e["key"].isNotNull()), entry))
    after = F.slice(in_order, 2, F.greatest(F.size(in_order), F.lit(1)))
    pairs = F.zip_with(
        in_order,
        after,
        lambda e, later: F.when(
            e["key"].eqNullSafe(later["key"]), F.lit(None)
        ).otherwise(F.named_struct(F.lit("key"), e["key"], F.lit("value"), e["value"])),
    )
    return F.coalesce(F.map_from_entries(F.array_compact(pairs)), empty_bag())
