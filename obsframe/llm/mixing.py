"""Mixing sources to target weights by a low-discrepancy schedule.

``source_targets`` gives each source its share of the total and refills what sources
cannot supply. ``schedule`` maps van der Corput points through the cumulative targets:
point k names the source of slot k, and the r-th slot of a source takes its r-th block.
``mix`` shuffles each source's documents by a hash, cuts that stream into blocks of equal
token counts and joins them with the schedule, so any prefix of the slots is already near
the target weights. ``words_taken`` has the words of each document without the slots: how many
slots a source has is found by arithmetic, so no slot is made.

Scale. Offsets in a source come from prefix sums in two steps: over (source, bucket)
totals, at most ``BUCKETS`` rows a source, and inside a bucket; a source that holds a third
of all rows is spread over all buckets. The join is on (source, block). Slots are ranked in
the same two steps. Windows that run over a whole source see only bucket totals. One row per
source (configuration-sized) passes through windows without a key.

Defined cases: NULL text has size 0; size 0 takes nothing; a NULL source is a source of its
own and the last in order; a total of 0 gives targets of 0.0; repeated rows are documents of
their own; order and results depend on values only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsframe.llm.common import set_aside, word_count, written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: A block is the total divided by this, or less where a source needs it: each source's target
#: has ``LEAST_BLOCKS`` blocks at least, or blocks of one word. A source is some twenty blocks
#: from its target at most, so a small source among large ones makes more slots.
SLOTS = 1 << 20
LEAST_BLOCKS = 1 << 10
#: Buckets of the shuffled order inside a source: three hex digits of a digest.
BUCKET_DIGITS = 3
BUCKETS = 16 ** BUCKET_DIGITS
#: Grid points that one row is exploded into, at a time.
PIECE = 4096


def sized(docs: DataFrame, size: Column | None = None) -> DataFrame:
    """doc_id, source, size, and the place in the shuffled order (shuffle_key, bucket)."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select(
        "doc_id", "source",
        F.coalesce(size if size is not None else word_count(F.col("text")), F.lit(0)).cast("bigint").alias("size"),
        key.alias("shuffle_key"), F.substring(key, 1, BUCKET_DIGITS).alias("bucket"),
    )


def _slots_before(limit: Column, bound: Column, bits: Column) -> Column:
    """How many of the slots 0 to limit - 1 have a grid point below ``bound``.

    The slots are cut into runs that share their high bits, one for each bit set in ``limit``.
    A run's points are equal modulo a power of two, the high bits reversed, so they are counted
    by a division.
    """
    def run(j: Column) -> Column:
        width = bits - j
        high = F.call_function("shiftright", limit, j)
        rest = F.coalesce(
            F.conv(F.reverse(F.lpad(F.bin(high - 1), width, F.lit("0"))), 2, 10).cast("bigint"), F.lit(0))
        step = F.call_function("shiftleft", F.lit(1).cast("bigint"), width)
        points = F.call_function("shiftright", bound - rest + step - 1, width)
        return F.when((high % 2 == 1) & (bound > rest), points).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), bits), F.lit(0).cast("bigint"), lambda held, j: held + run(j))


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, slots: int = SLOTS,
) -> DataFrame:
    """Per source: target words, its interval of the slot grid, and how many slots fall to it.

    ``totals`` has source and source_size. Water filling in one pass: sources by rising
    capacity per weight are full as long as their capacity is no more than their share of
    what is left.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("position", F.row_number().over(by_name)).withColumns({
        "weight": F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]),
                               (F.col("position") - 1) % len(weights) + 1),
        "capacity": F.col("source_size") * max_epochs,
        "total": F.sum("source_size").over(everything),
    })
    filling = Window.orderBy((F.col("capacity") / F.col("weight")).asc(), "position")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = ranked.withColumns({
        "left": F.col("total") - F.coalesce(F.sum("capacity").over(before), F.lit(0)),
        "weight_left": F.sum("weight").over(after),
    }).withColumn("full", F.col("capacity") * F.col("weight_left") <= F.col("weight") * F.col("left"))
    shared = filled.withColumns({
        "rest": F.col("total") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(everything),
        "rest_weight": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything),
    }).withColumn(
        "target",
        F.when(F.col("full"), F.col("capacity").cast("double"))
        .otherwise(F.col("rest").cast("double") * F.col("weight") / F.col("rest_weight")),
    )
    upto = by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = F.min(F.when(F.col("target") > 0, F.floor(F.col("target") / LEAST_BLOCKS))).over(everything)
    cut = shared.withColumns({
        "block": F.greatest(F.least(F.ceil(F.col("total") / F.lit(slots)), least), F.lit(1)).cast("bigint"),
        "whole": F.floor("target"),
    }).withColumns({
        "n_slots": F.ceil(F.col("total") / F.col("block")),
        "cumulative": F.sum("whole").over(upto),
        "last": F.max("position").over(everything) == F.col("position"),
    }).withColumn("bits", F.length(F.bin(F.greatest(F.col("n_slots") - 1, F.lit(0)))))
    grid = F.pow(F.lit(2.0), F.col("bits"))
    ends = cut.withColumn(
        "high",
        F.when(F.col("last"), grid)
        .otherwise(F.ceil(F.col("cumulative").cast("double") / F.greatest("total", F.lit(1)) * grid)).cast("bigint"),
    )
    bounds = ends.select(
        "source", "source_size", "target", "total", "block", F.col("n_slots").cast("bigint").alias("n_slots"), "bits",
        F.coalesce(F.lag("high").over(by_name), F.lit(0)).cast("bigint").alias("low"), "high",
    )
    return bounds.withColumn("n_blocks", F.greatest(
        _slots_before(F.col("n_slots"), F.col("high"), F.col("bits"))
        - _slots_before(F.col("n_slots"), F.col("low"), F.col("bits")), F.lit(0)).cast("bigint"))


def schedule(targets: DataFrame) -> DataFrame:
    """slot, source, rank: slot k takes the rank-th block of its source.

    Slot k is van der Corput point k, the bits of k reversed; a source owns the grid points
    of its interval. At most two grid points per slot are made, in pieces of ``PIECE``.
    """
    pieces = targets.where("n_slots > 0 and high > low").select(
        "source", "n_slots", "bits", "high",
        F.explode(F.sequence(F.col("low"), F.col("high") - 1, F.lit(PIECE).cast("bigint"))).alias("first"),
    ).repartition("source", "first")
    points = pieces.select(
        "source", "n_slots", "bits",
        F.explode(F.sequence("first", F.least(F.col("first") + PIECE, F.col("high")) - 1)).alias("point"),
    )
    reverse = F.conv(F.reverse(F.lpad(F.bin("point"), F.col("bits"), F.lit("0"))), 2, 10).cast("bigint")
    slots = points.select("source", "n_slots", reverse.alias("slot")).where("slot < n_slots").select(
        "source", "slot", F.floor(F.col("slot") / F.ceil(F.col("n_slots") / BUCKETS)).alias("part"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = slots.groupBy("source", "part").agg(F.count("*").alias("held")).select(
        F.col("source").alias("s"), F.col("part").alias("p"),
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("source", "part").orderBy("slot"))
    return slots.withColumn("inside", inside).join(
        bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")),
    ).select("slot", "source", (F.col("base") + F.col("inside") - 1).cast("bigint").alias("rank"))


def _placed(sizes: DataFrame, targets: DataFrame, buckets: DataFrame) -> DataFrame:
    """The documents with their offsets in their source's stream, and what is taken of the source."""
    supply = targets.select("source", "source_size", "target", "block", "n_blocks")
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = buckets.withColumn("base", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
    per_bucket = bases.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "base").join(
        supply, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    inside = (
        Window.partitionBy("source", "bucket").orderBy("shuffle_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return sizes.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        per_bucket, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")),
    ).select(
        "doc_id", "source", "size", "source_size", "target", "block", "n_blocks",
        (F.col("base") + F.col("inside")).alias("offset"),
    )


def _bucket_sizes(sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words per (source, bucket) and per source."""
    buckets = sizes.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    return buckets, buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))


def words_taken(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, slots: int = SLOTS,
) -> DataFrame:
    """The sums of ``mix``, a row per row of ``sizes``: words taken, repeats counted."""
    buckets, totals = _bucket_sizes(sizes)
    placed = _placed(sizes, source_targets(totals, weights, max_epochs, slots), buckets)
    left = F.col("n_blocks") * F.col("block") - F.col("offset")
    epochs = [F.least(F.greatest(left - e * F.col("source_size"), F.lit(0)), F.col("size")) for e in range(max_epochs)]
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", sum(epochs[1:], epochs[0]).cast("bigint").alias("taken"))


def mix(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, slots: int = SLOTS,
) -> DataFrame:
    """The pieces of documents that the mix takes, in slot order.

    ``sizes`` is ``sized(docs)``, best ``written``, as it is read twice. A row per piece:
    doc_id, source, size, source_size, target, offset (the document's place in its source's
    stream), epoch, start and length (words in the document), slot. Documents of which
    nothing is taken stay, with one row, NULL slot and length 0.
    """
    buckets, totals = _bucket_sizes(sizes)
    targets = source_targets(totals, weights, max_epochs, slots)
    planned = schedule(targets)
    placed = _placed(sizes, targets, buckets)

    def taken_blocks(epoch: int) -> Column:
        start = F.col("offset") + epoch * F.col("source_size")
        first = F.floor(start / F.col("block"))
        last = F.least(F.floor((start + F.col("size") - 1) / F.col("block")), F.col("n_blocks") - 1)
        return F.when(
            (F.col("size") > 0) & (first <= last),
            F.transform(F.sequence(first, last), lambda b: F.struct(
                F.lit(epoch).alias("epoch"), b.alias("rank"),
                F.greatest(b * F.col("block") - start, F.lit(0)).cast("bigint").alias("start"),
                F.least((b + 1) * F.col("block") - start, F.col("size")).cast("bigint").alias("end"),
            )),
        )

    empty = F.array().cast("array<struct<epoch:int,rank:bigint,start:bigint,end:bigint>>")
    pieces = placed.withColumn(
        "piece", F.explode_outer(F.concat(*[F.coalesce(taken_blocks(e), empty) for e in range(max_epochs)])),
    ).select("doc_id", "source", "size", "source_size", "target", "offset", "piece.*")
    slot_of = planned.select("slot", F.col("source").alias("s"), F.col("rank").alias("r"))
    return pieces.join(
        slot_of, F.col("source").eqNullSafe(F.col("s")) & (F.col("rank") == F.col("r")), "left",
    ).select(
        "doc_id", "source", "size", "source_size", "target", "offset", "epoch", "start",
        F.when(F.col("slot").isNull(), 0).otherwise(F.col("end") - F.col("start")).cast("bigint").alias("length"), "slot",
    )


def taken(pieces: DataFrame) -> DataFrame:
    """Words taken per document, repeats counted."""
    names = ("doc_id", "source", "size", "source_size", "target")
    # rows of size 0 share offsets, and each has one piece
    held = pieces.where("size > 0").groupBy(*names, "offset").agg(F.sum("length").alias("taken"))
    empty = pieces.where("size = 0").select(*names, F.col("length").alias("taken"))
    return held.select(*names, "taken").union(empty)


def beginning(text: Column, count: Column) -> Column:
    """The text up to the end of its ``count``-th word, as it is."""
    ends = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
    return F.array_join(F.slice(F.split(text, ends, -1), F.lit(1), count.cast("int")), "")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix: one row per copy, the last copy cut to the words taken.

    A source's blocks are taken from the front of its stream, so a document taken in part
    is taken from its start, with its lines and spaces as they are. ``n_chars``, if there, is
    counted anew where the text was cut. Columns come back as they came, whatever their names.

    Texts are shuffled once, to meet what is taken of them. Rows that are equal in all columns
    are dealt their takes in any order; of such a group there are four different takes at
    most, as a source's stream is cut at one place, so what a text meets is one short row.
    """
    known, given_back = set_aside(docs, "doc_id", "source", "text", "n_chars")
    row = F.md5(F.concat_ws(
        "\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in known.columns]).cast("binary"))
    named = known.withColumn("_row", row)
    sizes = written(sized(named.withColumn("doc_id", F.col("_row"))), "mix-sizes")
    takes = words_taken(sizes, **settings).groupBy(F.col("doc_id").alias("_of"), "size", "taken").agg(
        F.count("*").alias("held")).groupBy("_of").agg(
        F.first("size").alias("_size"), F.sort_array(F.collect_list(F.struct("taken", "held"))).alias("_takes"))
    copy = F.row_number().over(Window.partitionBy("_row").orderBy("_row"))
    met = named.join(takes.where(F.exists("_takes", lambda t: t["taken"] > 0)), F.col("_row") == F.col("_of")).withColumn(
        "_n", copy)
    # the take of the n-th of equal rows: the first whose running count reaches n
    none = F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(None).cast("bigint").alias("taken"))
    dealt = F.aggregate("_takes", none, lambda held, t: F.struct(
        (held["upto"] + t["held"]).alias("upto"),
        F.when(held["taken"].isNull() & (held["upto"] + t["held"] >= F.col("_n")), t["taken"]).otherwise(held["taken"]).alias("taken"),
    ))["taken"]
    taken_rows = met.withColumn("_taken", dealt).where("_taken > 0")
    epochs = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_taken") - 1) / F.col("_size")))
    copies = taken_rows.withColumn("_epoch", F.explode(epochs)).withColumn(
        "_words", F.least(F.col("_size"), F.col("_taken") - F.col("_epoch") * F.col("_size")))
    is_cut = F.col("_words") < F.col("_size")
    changed = copies.withColumn("text", F.when(is_cut, beginning(F.col("text"), F.col("_words"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(
            is_cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return given_back(changed)
