"""Near-duplicate documents by SetSketch registers, banded, estimated and verified.

1. A document is the set of its distinct ``shingle``-word shingles; documents with equal sets
   are one class, whose smallest doc_id stands for it. Copies never meet in pairs.
2. A class has ``REGISTERS`` registers: exponentially spaced truncated minima. Each shingle
   makes a rising random walk of exponential steps; every step falls on one register, which
   keeps the smallest value seen, stored as an exponent of ``BASE``. Registers of a union are
   the element-wise larger exponents (``merge``), so sketches merge. A shingle stops when its
   walk is above all registers.
3. Bands of registers are bucket keys, as long as two sets at the threshold miss each other in
   all bands with a chance of at most ``MISSED``: 36 bands of 7 for 0.85, 42 of 6 for 0.8.
4. In a bucket, leaders are compared with the members of other components: one leader in the
   first round, 8 in the next (all, in small buckets), then 512. First come those that meet
   most members in all their buckets: the original of many edited copies is nearer to each
   than they are to each other. Members whose set sizes rule a link out are not compared, nor
   are those whose part counts do: shingles are dealt to ``PARTS`` parts by their hash, and two
   sets have no more shingles in common than the sum over the parts of the smaller of their two
   counts. Edited copies of one text have lost and gained shingles in different parts, so
   this leaves few pairs without a link, and loses none with one. Compared leaders retire, pairs within one
   component are never made, and a bucket ends when all its members are of one component
   or all but one component's have been leaders. So every pair of a bucket is linked, in
   one component already, or was compared; without making all pairs of a group of copies.
5. A pair whose likelihood estimate from the joint registers lies ``MARGIN`` below the
   threshold (six standard errors) is given up; the others are confirmed on the full sets.
6. Links become components by star rounds; component_id is the smallest doc_id.

Defined cases: NULL text, empty text and text without words have an empty set and are linked
with nothing; a NULL doc_id is linked with nothing, has a NULL component and is kept; rows
that repeat a doc_id stand for the same node. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsframe.llm.common import in_batches, set_aside, written
from obsframe.llm.components import connected_components
from obsframe.llm.hashing import GOLDEN, mixed, word_hashes

REGISTERS = 256
MISSED = 1e-5
BASE = 1.001
#: The walk value at which an exponent is 0; beyond any value that fills a register.
CEILING = 2.0 ** 14
MARGIN = 0.14
LEADERS = (1, 8, 512)
#: A bucket that needs no more pairs than this is finished in one round.
AT_ONCE = 4096
#: Parts that the shingles of a set are counted in, for an upper bound of what two sets share.
PARTS = 128
#: Bits that tell which documents' texts are needed again; 8 MB.
ID_BITS = 1 << 26
#: Documents that are sketched together inside a task, and the shingles they may have.
GROUP_DOCS, GROUP_SHINGLES = 2048, 1 << 21


def shingle_set(raw: bytes | None, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z are lower-cased."""
    words = raw.lower().split() if raw else []  # bytes split at the six ASCII spaces only
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    size = min(shingle, len(words))
    rolled = np.full(len(words) - size + 1, np.uint64(size))
    for k in range(size):
        rolled = mixed(rolled * GOLDEN + hashes[k:len(hashes) - size + 1 + k])
    return np.unique(rolled)


def sketch(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """Register exponents, a uint16 row per set; a merged sketch is the element-wise maximum."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate([np.empty(0, np.uint64), *sets])
    least = np.full(len(sets) * registers, np.inf)
    value = np.zeros(len(element))
    step = 0
    while len(element):
        draw = mixed(element + np.uint64((step + 1) * int(GOLDEN) % (1 << 64)))
        value = value - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53)
        place = owner * registers + (draw & np.uint64(0x7FF)).astype(np.int64) % registers
        np.minimum.at(least, place, value)
        step += 1
        if step < 8 or step % 8 == 0:
            going = value < least.reshape(len(sets), registers).max(axis=1)[owner]
            element, owner, value = element[going], owner[going], value[going]
    with np.errstate(divide="ignore"):
        exponent = np.floor(1 - np.log(least / CEILING) / np.log(BASE))
    return np.clip(exponent, 0, 65535).astype(np.uint16).reshape(len(sets), registers)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def band_rows(threshold: float, registers: int = REGISTERS) -> int:
    """The longest bands that miss a pair at the threshold with a chance of at most ``MISSED``."""
    return max((rows for rows in range(1, registers + 1)
                if (1 - threshold ** rows) ** (registers // rows) <= MISSED), default=1)


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """A signed 64-bit bucket key per band."""
    bands = sketches.shape[1] // rows
    cut = sketches[:, :bands * rows].astype(np.uint64).reshape(len(sketches), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cut.shape[:2])
    for k in range(rows):
        key = mixed(key * GOLDEN + cut[:, :, k])
    return key.view(np.int64)


def part_counts(hashes: np.ndarray) -> list[int] | None:
    """How many shingles of a set are in each part; None for sets too large to be counted in 16 bits."""
    counts = np.bincount((hashes >> np.uint64(57)).astype(np.int64), minlength=PARTS)
    return counts.astype(np.int16) if counts.max() < 1 << 15 else None


def in_common_at_most(a: str, b: str) -> Column:
    """Upper bound of the shingles that two sets share, by their part counts."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda total, n: total + n.cast("int"))


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity from which registers are larger, smaller and equal.

    With relative sizes u and v, a register of a is larger with chance p(u - vJ) and smaller
    with p(v - uJ), where p(x) = -log(1 - x (b-1)/b) / log b. The log-likelihood is concave in J;
    its maximum is found by golden sections on 0 <= J <= min(u/v, v/u).
    """
    more = (a > b).sum(axis=1)
    less = (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u = size_a / (size_a + size_b)
    v = 1 - u

    def chance(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = chance(u - v * j), chance(v - u * j)
        return more * np.log(up) + less * np.log(down) + same * np.log(np.clip(1 - up - down, 1e-12, 1))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    section = (5 ** 0.5 - 1) / 2
    for _ in range(30):
        left, right = high - section * (high - low), low + section * (high - low)
        rises = likelihood(left) < likelihood(right)
        low, high = np.where(rises, left, low), np.where(rises, high, right)
    return (low + high) / 2


def _grouped(texts: pd.Series, shingle: int) -> Iterator[tuple[slice, list[np.ndarray]]]:
    begin, sets, held = 0, [], 0
    for n, raw in enumerate(texts):
        sets.append(shingle_set(raw, shingle))
        held += len(sets[-1])
        if len(sets) == GROUP_DOCS or held >= GROUP_SHINGLES or n == len(texts) - 1:
            yield slice(begin, n + 1), sets
            begin, sets, held = n + 1, [], 0


def _profile(shingle: int, rows: int | None = None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def profiles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, sets in _grouped(frame["raw"], shingle):
                registers = sketch(sets)
                out = pd.DataFrame({"doc_id": frame["doc_id"].iloc[part].array, "n": [len(s) for s in sets]})
                if rows is None:
                    out["registers"] = [r.tobytes() for r in registers]
                    out["hashes"] = [s.view(np.int64) for s in sets]
                    out["parts"] = [part_counts(s) for s in sets]
                else:
                    whole = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                    out["d1"] = [int.from_bytes(d[:8], "little", signed=True) for d in whole]
                    out["d2"] = [int.from_bytes(d[8:], "little", signed=True) for d in whole]
                    out["bands"] = list(band_keys(registers, rows))
                yield out
    return profiles


def _raw(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("raw"))


def _maybe_among(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is one of the ids, and few others: those that share a bit of ``ID_BITS``.

    So the texts of all other documents are not shuffled. With more ids than bits, more of the
    others stay, but what is broadcast does not grow.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(ID_BITS)) + 1
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    maps = ids.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    octet = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = octet.bitwiseAND(F.element_at(F.array(*[F.lit(1 << n) for n in range(8)]), (bit % 8).cast("int") + 1)) != 0
    return raw.join(F.broadcast(maps), (bucket == F.col("_bucket")) & is_set, "left_semi")


def _likely(threshold: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def likely(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                a, b = (np.frombuffer(b"".join(frame[c]), np.uint16).reshape(len(frame), -1) for c in ("ra", "rb"))
                found = estimate(a, b, frame["na"].to_numpy(float), frame["nb"].to_numpy(float))
                yield frame.loc[found >= threshold - MARGIN, ["a", "b"]]
    return likely


def _links(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    brief = nodes.select("cid", "n", "registers")
    sides = pairs.join(brief.toDF("a", "na", "ra"), "a").join(brief.toDF("b", "nb", "rb"), "b").where(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    likely = sides.mapInPandas(_likely(percent / 100), "a bigint, b bigint").distinct()
    full = nodes.select("cid", "n", "hashes")
    common = F.size(F.array_intersect("sa", "sb"))
    return likely.join(full.toDF("a", "na", "sa"), "a").join(full.toDF("b", "nb", "sb"), "b").where(
        100 * common >= percent * (F.col("na") + F.col("nb") - common)).select("a", "b").distinct()


def _pairs(live: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """Leaders with the members of other components of their bucket, each pair once."""
    led = leaders.toDF(*[c if c == "key" else f"leader_{c}" for c in leaders.columns])
    may = (F.col("comp") != F.col("leader_comp")) & (
        100 * F.least("n", "leader_n") >= percent * F.greatest("n", "leader_n"))
    if "parts" in leaders.columns:
        enough = (100 + percent) * in_common_at_most("parts", "leader_parts") >= percent * (F.col("n") + F.col("leader_n"))
        may = may & F.coalesce(enough, F.lit(True))
    met = live.drop("degree", "retired").join(led, "key").where(may)
    return met.select(F.least("cid", "leader_cid").alias("a"), F.greatest("cid", "leader_cid").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id is its component's smallest).

    Links documents with 100 * intersection >= percent * union of their shingle sets.
    """
    docs = in_batches(docs)
    profiles = written(
        _raw(docs).mapInPandas(
            _profile(shingle, band_rows(percent / 100)), "doc_id bigint, n bigint, d1 bigint, d2 bigint, bands array<bigint>"),
        "neardup-profiles")
    filled = profiles.where("n > 0 AND doc_id IS NOT NULL")
    classes = written(
        filled.groupBy("d1", "d2").agg(F.min("doc_id").alias("cid")), "neardup-classes")
    heads = filled.select("doc_id", "n", "d1", "d2", "bands").join(
        classes.select(F.col("cid").alias("doc_id"), "d1", "d2"), ["doc_id", "d1", "d2"], "left_semi")
    keyed = heads.select(F.col("doc_id").alias("cid"), "n", F.explode("bands").alias("key"))
    busy = keyed.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    # at most one row a band and class, or two where two bands have the same key by chance
    per_class = Window.partitionBy("cid")
    live = written(keyed.join(busy, "key").select(
        "key", "cid", "n", F.col("cid").alias("comp"), F.sum("held").over(per_class).alias("degree"),
        F.lit(False).alias("retired")).distinct(), "neardup-buckets")
    involved = live.select(F.col("cid").alias("doc_id")).distinct()
    nodes = written(
        _maybe_among(_raw(docs), involved).join(involved, "doc_id").mapInPandas(
            _profile(shingle), "doc_id bigint, n bigint, registers binary, hashes array<bigint>, parts array<smallint>"
        ).withColumnRenamed("doc_id", "cid"), "neardup-sets")
    leaders = live.withColumn("rank", _rank()).where("rank = 1").select("key", "cid", "n", "comp")
    # a doc_id that stands for several texts has no counts, so nothing is ruled out for it
    counted = nodes.groupBy("cid").agg(F.when(F.count("*") == 1, F.first("parts")).alias("parts"))
    parts, turn = None, 0
    while True:
        found = written(_links(_pairs(live, leaders, percent), nodes, percent), "neardup-links")
        if parts is None:
            parts = written(connected_components(found), "neardup-components")
        elif not found.isEmpty():
            stars = parts.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
            parts = written(connected_components(stars.union(found)), "neardup-components")
        live = _continued(live, leaders, parts)
        if not turn:  # what is left in the buckets now are mostly pairs without a link
            live = live.join(counted, "cid")
        live = written(live, "neardup-buckets")
        turn += 1
        leaders = written(_next_leaders(live, LEADERS[min(turn, len(LEADERS) - 1)]), "neardup-leaders")
        if leaders.isEmpty():
            break
    part_of = parts.select(F.col("node").alias("cid"), "root")
    result = profiles.select("doc_id", "n", "d1", "d2").join(
        classes, ["d1", "d2"], "left").join(part_of, "cid", "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("root", "cid")).otherwise(F.col("doc_id"))
    return result.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _rank() -> Column:
    """Rank in the bucket: members that meet most others in all their buckets come first."""
    return F.row_number().over(Window.partitionBy("key").orderBy(F.desc("degree"), "cid"))


def _next_leaders(live: DataFrame, count: int) -> DataFrame:
    """Members outside their bucket's largest component that have not led yet.

    ``count`` a bucket, or all of them where that makes at most ``AT_ONCE`` pairs. Spark keeps
    so many rows of a key per task before the shuffle, so busy buckets are not gathered.
    """
    held = live.groupBy("key", "comp").agg(F.count("*").alias("held"))
    buckets = held.groupBy("key").agg(
        F.max_by("comp", F.struct("held", -F.col("comp"))).alias("largest"),
        ((F.sum("held") - F.max("held")) * F.sum("held")).alias("pairs"))
    minor = live.where("NOT retired").join(buckets, "key").where("comp <> largest")
    # the members outside the largest component are fewer than the root of the pairs
    return minor.withColumn("rank", _rank()).where(F.col("rank") <= max(count, math.isqrt(AT_ONCE))).where(
        (F.col("rank") <= count) | (F.col("pairs") <= AT_ONCE)).select("key", "cid", "n", "comp", "parts")


def _continued(live: DataFrame, leaders: DataFrame, parts: DataFrame) -> DataFrame:
    """The buckets that still hold several components, with new components and retired leaders."""
    # a bucket without leaders has none to come: all pairs across its components were compared
    open_ones = live.join(leaders.select("key").distinct(), "key", "left_semi")
    moved = open_ones.drop("comp").join(parts.select(F.col("node").alias("cid"), "root"), "cid", "left").select(
        "key", "n", F.coalesce("root", "cid").alias("comp"), "cid", *[c for c in live.columns if c not in ("key", "cid", "n", "comp")])
    several = moved.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where(
        "low <> high").select("key")
    led = leaders.select("key", "cid", F.lit(True).alias("led"))
    return moved.join(several, "key").join(led, ["key", "cid"], "left").select(
        *[c for c in moved.columns if c != "retired"], (F.col("retired") | F.col("led").isNotNull()).alias("retired"))


def deduplicated(docs: DataFrame, **settings) -> DataFrame:
    """One document of each group, with its columns: the one with the smallest doc_id, NULL last.

    A row is known by a 64-bit hash of all its columns, so rows that share a doc_id, or have
    none, are documents of their own. Of equal rows one stays.
    """
    known, given_back = set_aside(docs, "doc_id", "text")
    row = F.md5(F.concat_ws(
        "\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in known.columns]).cast("binary"))
    named = known.withColumn("_row", F.xxhash64(row))
    parts = near_duplicates(named.select(F.col("_row").alias("doc_id"), "text"), **settings).select(
        F.col("doc_id").alias("_row"), "component_id")
    kept = named.select("_row", "doc_id").join(parts.distinct(), "_row").groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row")).alias("first")).select("first._row")
    # equal rows have met in the join, so telling them apart needs no further shuffle
    copy = F.row_number().over(Window.partitionBy("_row").orderBy("_row"))
    return given_back(named.join(kept, "_row", "left_semi").withColumn("_copy", copy).where("_copy = 1"))
