"""Ordered computations over groups of any size.

A window ordered over a whole series puts that series into one task.  Here a group
is cut into chunks of its order column; each chunk is scanned on its own and what
the chunks before it contribute is joined in from a table with one row per chunk.
The widest task therefore holds one chunk, or one row per chunk of one group.

Chunks of an order that may be sparse or crowded (sequence numbers, microseconds) are
cut at quantiles of the rows that are there: ``even_chunks``.  There are as many as
shuffle partitions, each with about as many rows.  Chunks of a fixed width
(``chunk_index``) are for times of rows that were aggregated before.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.functions.scalars import div

_FAN_OUT = 4096
#: ``monotonically_increasing_id`` numbers the rows of a task in its lower bits.
_RANGE_BITS = 33
#: Quantile sketches are right to one rank in so many.
_ACCURACY = 10_000
_MISSING_TEXT = "\x00missing"
_MISSING_INT = -(2**63)


def chunk_index(order: Column, width: int) -> Column:
    """Chunk number of an integer order column."""
    return div(order.cast("bigint") - F.pmod(order.cast("bigint"), F.lit(width)), width)


def even_chunks(
    df: DataFrame, order: str | Column, pieces: int | None = None
) -> Callable[[str | Column], Column]:
    """Chunk numbers that give each of ``pieces`` chunks about as many rows of ``df``.

    Reads the approximate quantiles of an integer column, which is one pass over that
    column with a sketch per task, and at most ``pieces - 1`` numbers on the driver.  The
    function it returns numbers any value of that order, 0 for NULL.  A bound is found
    in two steps, among every k-th and then among k, with k the root of ``pieces``.
    """
    if pieces is None:
        pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col(order) if isinstance(order, str) else order
    shares = [i / pieces for i in range(1, pieces)]
    found = df.agg(
        F.percentile_approx(order.cast("bigint"), shares, max(10_000, 100 * pieces))
    ).first()[0] if shares else None
    bounds = sorted(set(found or []))
    k = math.isqrt(len(bounds)) or 1
    groups = [bounds[i:i + k] for i in range(0, len(bounds), k)]

    def chunk(value: str | Column) -> Column:
        if not bounds:
            return F.lit(0).cast("bigint")
        value = (F.col(value) if isinstance(value, str) else value).cast("bigint")
        reached = lambda array: F.size(F.filter(array, lambda bound: bound <= value))
        coarse = reached(F.lit([group[0] for group in groups]).cast("array<bigint>"))
        fine = F.array(*[F.lit(group).cast("array<bigint>") for group in groups])
        within = F.coalesce(reached(F.get(fine, coarse - 1)), F.lit(0))
        return F.when(coarse > 0, (coarse - 1) * k + within).otherwise(0).cast("bigint")

    return chunk


def _known(chunk: Column) -> Column:
    """A chunk number that is never NULL.

    Chunks are join keys.  For a nullable key Spark infers a filter on one side of the
    join; the rows and their totals then come from different plans, and the shuffle
    under them is not reused but done twice.
    """
    return F.coalesce(chunk, F.lit(_MISSING_INT))


def fill_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace NULL keys by a marker so that keys can be joined by plain equality."""
    return df.withColumns({k: F.coalesce(F.col(k), _marker(df, k)) for k in keys}) if keys else df


def restore_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumns({k: F.nullif(F.col(k), _marker(df, k)) for k in keys}) if keys else df


def _marker(df: DataFrame, key: str) -> Column:
    dtype = df.schema[key].dataType
    if isinstance(dtype, T.StringType):
        return F.lit(_MISSING_TEXT)
    if isinstance(dtype, T.LongType):
        return F.lit(_MISSING_INT)
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        entry = F.struct(F.lit(_MISSING_TEXT).alias("key"), F.lit("").alias("value"))
        return F.array(entry).cast(dtype)
    raise TypeError(f"key {key} must be STRING, BIGINT or label entries, not {dtype.simpleString()}")


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join with the right side's keys renamed away."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [left[k] == renamed[f"_r_{k}"] for k in keys]
    return left.join(renamed, on, "left").drop(*[f"_r_{k}" for k in keys])


def totals_before(
    totals: DataFrame, keys: Sequence[str], chunk: str, value: str, out: str, blocked: bool
) -> DataFrame:
    """Sum of ``value`` over the earlier chunks of each key.

    ``totals`` has one row per (keys, chunk).  ``blocked`` is for chunk numbers without
    a bound: chunks are grouped by 4,096 in turn, so that a group with very many chunks
    is not scanned in one task either.
    """
    whole = keys or [F.lit(0)]
    if not blocked:
        earlier = W.partitionBy(*whole).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
        return totals.withColumn(out, F.coalesce(F.sum(value).over(earlier), F.lit(0)))
    block = f"_{chunk}_block"
    totals = totals.withColumn(block, chunk_index(F.col(chunk), _FAN_OUT))
    per_block = totals.groupBy(*keys, block).agg(F.sum(value).alias("_block_total"))
    across = W.partitionBy(*whole).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    per_block = per_block.withColumn(
        "_blocks_before", F.coalesce(F.sum("_block_total").over(across), F.lit(0))
    ).drop("_block_total")
    inside = W.partitionBy(*keys, block).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    scanned = totals.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = _join_on(scanned, per_block, [*keys, block])
    return joined.withColumn(out, F.col("_inside") + F.col("_blocks_before")).drop(
        block, "_inside", "_blocks_before"
    )


def join_per_chunk(df: DataFrame, keys: Sequence[str], chunk: Column, table: DataFrame) -> DataFrame:
    """Left join of ``table``, which has one row per key, without a task per key.

    The table is first joined to the distinct (keys, chunk) pairs; rows then meet it
    on keys and chunk, so a key that holds most rows is spread over its chunks.
    """
    keys = list(keys)
    rows = df.withColumn("_chunk", _known(chunk))
    pairs = _join_on(rows.select(*keys, "_chunk").distinct(), table, keys)
    return _join_on(rows, pairs, [*keys, "_chunk"]).drop("_chunk")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    value: str,
    out: str,
    include_current: bool = True,
    blocked: bool = True,
) -> DataFrame:
    """Running sum of ``value`` per key in ``order``.

    ``chunk`` must not decrease in ``order`` and the pair (keys, order) must be
    unique.  ``include_current=False`` sums the earlier rows only.  ``blocked=False``
    saves three small shuffles where the number of chunks is bounded, as for chunks of
    time: ten years hold 525,600 chunks of ten minutes, whatever the data.
    """
    keys = list(keys)
    rows = fill_keys(df, keys).withColumn("_chunk", _known(chunk))
    totals = rows.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_chunk_total"))
    before = totals_before(totals, keys, "_chunk", "_chunk_total", "_before", blocked).drop(
        "_chunk_total"
    )
    last = 0 if include_current else -1
    inside = (
        W.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, last)
    )
    rows = rows.withColumn("_running", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = _join_on(rows, before, [*keys, "_chunk"])
    joined = joined.withColumn(out, F.col("_running") + F.col("_before"))
    return restore_keys(joined.drop("_chunk", "_running", "_before"), keys)


def range_rank(df: DataFrame, order: Sequence[Column], out: str, label: str = "ranks") -> DataFrame:
    """1-based position of each row in ``order``, over the whole table.

    Rows are dealt to as many ranges as there are shuffle partitions; Spark samples the
    bounds from the data, so neither sparse nor crowded values matter.  Each range is
    sorted and numbered in its task; what the ranges before it hold is a prefix sum over
    one row per range.  Rows that are equal in ``order`` share a range: give it a last
    column that tells them apart.

    The numbered rows are written once to the shared folder, as another run of the same
    plan may sample other bounds.
    """
    from obsframe.plans.session import written_once  # plans are made of operators

    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = (
        df.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("_number", F.monotonically_increasing_id())
    )
    rows = written_once(numbered, label).withColumns({
        "_range": F.shiftright("_number", _RANGE_BITS).cast("int"),
        "_place": F.col("_number").bitwiseAND(F.lit((1 << _RANGE_BITS) - 1)) + 1,
    })
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("_range").alias("_r_range"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    # one row per range, so its size is that of the shuffle settings
    ranked = rows.join(F.broadcast(before), F.col("_range") == F.col("_r_range"))
    return ranked.withColumn(out, F.col("_before") + F.col("_place")).drop(
        "_number", "_range", "_r_range", "_place", "_before"
    )


def bracketed_counts(
    df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float], accuracy: int = _ACCURACY
) -> DataFrame:
    """How often each value occurs that may be a wanted quantile: (keys, _v, _side, _n).

    A quantile sketch per key, merged from one per task, gives each wanted rank a lower
    and an upper bound that differ by a few times ``1 / accuracy`` of the key's rows.
    Only values between bounds are counted apart (``_side`` 0).  All others are added up
    by the bounds they lie between, as rows after a bound (``_side`` 1) or before the
    first (``_side`` -1), before anything is shuffled.

    The bounds are written once, a row per key, so Spark knows their size: small ones
    are broadcast, and only with very many keys do rows meet them by a shuffle.
    """
    from obsframe.plans.session import written_once  # plans are made of operators

    keys = list(keys)
    rows = fill_keys(df.filter(F.col(value).isNotNull()), keys).select(
        *keys, F.col(value).cast("bigint").alias("_v")
    )
    margin = 3 / accuracy
    ends = [(max(q - margin, 0.0), min(q + margin, 1.0)) for q in map(float, qs)]
    sketch = F.percentile_approx("_v", [e for pair in ends for e in pair], accuracy)
    # ranks at the ends of all rows are exact only as the minimum and the maximum
    aggregates = [sketch.alias("_at"), F.min("_v").alias("_least"), F.max("_v").alias("_most")]
    sketched = rows.groupBy(*keys).agg(*aggregates)
    low = [F.col("_least") if a == 0 else F.get("_at", F.lit(2 * i)) for i, (a, _) in enumerate(ends)]
    high = [F.col("_most") if b == 1 else F.get("_at", F.lit(2 * i + 1)) for i, (_, b) in enumerate(ends)]
    names = [f"_{side}{i}" for i in range(len(ends)) for side in ("low", "high")]
    bounds = written_once(
        sketched.select(*keys, *[c.alias(n) for n, c in zip(names, [c for pair in zip(low, high) for c in pair])]),
        "quantile-bounds",
    )
    if keys:
        met = _join_on(rows, bounds, keys)
    else:
        met = rows.withColumns({n: bounds.select(n).scalar() for n in names})
    v, pairs = F.col("_v"), range(len(ends))
    inside = F.lit(False)
    for i in pairs:
        inside = inside | v.between(F.col(f"_low{i}"), F.col(f"_high{i}"))
    below = F.greatest(*[F.when(F.col(f"_high{i}") < v, F.col(f"_high{i}")) for i in pairs], F.lit(None).cast("bigint"))
    first = F.least(*[F.col(f"_low{i}") for i in pairs], F.lit(None).cast("bigint"))
    return (
        met.select(
            *keys,
            F.when(inside, v).otherwise(F.coalesce(below, first)).alias("_v"),
            F.when(inside, 0).when(below.isNull(), -1).otherwise(1).alias("_side"),
        )
        .groupBy(*keys, "_v", "_side")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    qs: Sequence[float],
    names: Sequence[str],
    width: int = 1_000_000,
    accuracy: int = _ACCURACY,
) -> DataFrame:
    """Nearest-rank quantiles of an integer column per key, exact and distributed.

    A sketch brackets each wanted rank; what is shuffled and ordered are counts of the
    values inside the brackets, and the sums of all others.  These are cut into chunks
    of ``width`` values, the chunk holding each rank is found from the chunk totals, and
    only those chunks are scanned.  A task sees at most ``width`` distinct values of a
    group, or its chunk totals.  A rank outside its bracket, which the sketch's bound
    excludes, is an error and never a wrong value.
    """
    keys = list(keys)
    counts = bracketed_counts(df, keys, value, qs, accuracy).withColumn(
        "_chunk", _known(chunk_index(F.col("_v"), width))
    )
    totals = counts.groupBy(*keys, "_chunk").agg(F.sum("_n").alias("_chunk_n"))
    before = totals_before(totals, keys, "_chunk", "_chunk_n", "_before", blocked=False).withColumn(
        "_total", F.sum("_chunk_n").over(W.partitionBy(*(keys or [F.lit(0)])))
    )
    wanted = F.array(*[
        F.struct(
            F.lit(i).alias("q"),
            F.greatest(F.ceil(F.lit(float(q)) * F.col("_total")), F.lit(1)).cast("bigint").alias("rank"),
        )
        for i, q in enumerate(qs)
    ])
    chosen = before.withColumn(
        "_ranks",
        F.filter(
            wanted,
            lambda w: (w["rank"] > F.col("_before"))
            & (w["rank"] <= F.col("_before") + F.col("_chunk_n")),
        ),
    ).filter(F.size("_ranks") > 0).select(*keys, "_chunk", "_before", "_ranks")
    renamed = chosen.withColumnsRenamed({k: f"_r_{k}" for k in [*keys, "_chunk"]})
    scanned = counts.join(
        renamed, [counts[k] == renamed[f"_r_{k}"] for k in [*keys, "_chunk"]], "inner"
    ).drop(*[f"_r_{k}" for k in [*keys, "_chunk"]])
    inside = W.partitionBy(*keys, "_chunk").orderBy("_v", "_side").rowsBetween(W.unboundedPreceding, 0)
    scanned = scanned.withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
    hit = lambda i: F.exists(
        "_ranks",
        lambda w: (w["q"] == i)
        & (w["rank"] <= F.col("_upto"))
        & (w["rank"] > F.col("_upto") - F.col("_n")),
    )
    found = F.when(F.col("_side") == 0, F.col("_v")).otherwise(
        F.raise_error(F.lit("a rank lies outside its bracket")).cast("bigint")
    )
    out = scanned.groupBy(*keys).agg(
        *[F.max(F.when(hit(i), found)).alias(name) for i, name in enumerate(names)]
    )
    return restore_keys(out, keys)
