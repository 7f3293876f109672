"""Target-distribution importance resampling of documents by hashed word n-grams.

Features of a text are all runs of 1 to ``longest`` consecutive words, repeats counted; a
feature's bucket is the CRC-32 of its bytes modulo ``buckets``. The distinct features of a
piece of texts are grouped by length into two-dimensional arrays of bytes; the CRCs of a
group are updated together, column by column, and scattered back to their features.

One pass counts the buckets of all documents and of all target texts, with partial counts per
task; the gain of a bucket is its log-ratio of the two, smoothed by one. A second pass takes
every document's mean gain as its weight and adds Gumbel noise that depends on its doc_id, so
that the highest scores are a sample without replacement in proportion to exp(weight / 1000).
The scored rows are written to the shared folder and ranked by sampled ranges.

Scale. What a task holds is bounded by ``PIECE`` bytes of features and two numbers a bucket;
what the driver gets is a row per bucket. Words of one document beyond ``PIECE`` come
together, as a text is one row. A word of n bytes that is alone with its length costs n steps.

Defined cases: NULL and empty texts and texts without a word have no features, weight 0 and a
score; an empty target or table gives gains by the same formula; a NULL doc_id draws its noise
as the empty text and is last among ties; repeated rows are documents of their own, in either
order among themselves; other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import written
from obsframe.operators.ordered import range_rank

BUCKETS = 10_000
SCALE = 1000
SEED = 2024
#: Bytes of words whose distinct features a task holds at a time.
PIECE = 1 << 24
#: In UTF-8, with A-Z in lower case: digits, a-z, and all bytes of characters beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SCHEMA = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"


def crc_table() -> np.ndarray:
    """The CRC-32 (reflected, polynomial 0xEDB88320) of every byte."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


def crc_buckets(features: list[bytes], buckets: int) -> np.ndarray:
    """The bucket of every feature."""
    table = crc_table()
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    out = np.empty(len(features), np.uint32)
    for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if not len(group):
            continue
        joined = b"".join([features[i] for i in group])
        columns = np.frombuffer(joined, np.uint8).reshape(len(group), -1).T.copy()
        crc = np.full(len(group), 0xFFFFFFFF, np.uint32)
        for column in columns:
            crc = table[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        out[group] = ~crc
    return (out % np.uint32(buckets)).astype(np.int64)


def words(raw: bytes | None) -> list[bytes]:
    return WORD.findall(raw.lower()) if raw else []


def features(found: list[bytes], longest: int) -> list[bytes]:
    out = list(found)
    for n in range(2, longest + 1):
        out += map(b" ".join, zip(*(found[k:] for k in range(n))))
    return out


def _counter(buckets: int, longest: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def tally(held: Counter, counts: np.ndarray) -> None:
        if held:
            np.add.at(counts, crc_buckets(list(held), buckets), np.fromiter(held.values(), np.int64, len(held)))
            held.clear()

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, held, size = np.zeros(buckets, np.int64), Counter(), 0
        for frame in frames:
            for raw in frame["raw"]:
                held.update(features(words(raw), longest))
                size += len(raw or b"")
                if size >= PIECE:
                    tally(held, counts)
                    size = 0
        tally(held, counts)
        some = np.flatnonzero(counts)
        yield pd.DataFrame({"bucket": some, "n": counts[some]})
    return count


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = 1, text: str = "text") -> np.ndarray:
    """How many features of all texts are in each bucket."""
    raw = texts.select(F.col(text).cast("string").cast("binary").alias("raw"))
    rows = raw.mapInPandas(_counter(buckets, longest), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():  # a row per bucket at most
        out[row.bucket] = row.n
    return out


def gains(source: Iterable[int], target: Iterable[int]) -> np.ndarray:
    """Per bucket, a thousand times the smoothed log-ratio of target to source, rounded down."""
    source, target = list(map(int, source)), list(map(int, target))
    source_all, target_all = sum(source) + len(source), sum(target) + len(target)
    return np.array([
        math.floor(SCALE * math.log(float((t + 1) * source_all) / float((s + 1) * target_all)))
        for s, t in zip(source, target)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document, rounded down."""
    name = "" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def _scorer(gain: np.ndarray, longest: int, seed: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def scored(ids: list, found: list[list[bytes]]) -> pd.DataFrame:
        rows = [features(x, longest) for x in found]
        distinct = list(set().union(*rows))
        gain_of = dict(zip(distinct, gain[crc_buckets(distinct, len(gain))].tolist()))
        weights = [sum(map(gain_of.__getitem__, row)) // len(row) if row else 0 for row in rows]
        return pd.DataFrame({
            "doc_id": pd.array(ids, "Int64"), "n_words": [len(x) for x in found], "n_features": [len(x) for x in rows],
            "weight": weights, "score": [w + noise(i, seed) for i, w in zip(ids, weights)]})

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, found, size = [], [], 0
            for doc_id, raw in zip(frame["doc_id"], frame["raw"]):
                ids.append(None if doc_id == "" else int(doc_id))
                found.append(words(raw))
                size += len(raw or b"")
                if size >= PIECE:
                    yield scored(ids, found)
                    ids, found, size = [], [], 0
            if ids:
                yield scored(ids, found)
    return score


def scored(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = 1, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    known = F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit(""))
    raw = docs.select(known.alias("doc_id"), F.col("text").cast("string").cast("binary").alias("raw"))
    return raw.mapInPandas(_scorer(gain, longest, seed), SCHEMA)


def resampled(
    docs: DataFrame, target: DataFrame, percent: int, least_words: int, buckets: int = BUCKETS, longest: int = 1,
    seed: int = SEED,
) -> DataFrame:
    """The scores of all documents, and ``rank`` from 1 of those drawn (NULL for the others).

    Drawn are the highest scores, ``percent`` of the documents with ``least_words`` words.
    """
    rows = written(scored(docs, target, buckets, longest, seed), "importance-scores")
    long_enough = F.col("n_words") >= least_words
    wanted = rows.where(long_enough).count() * percent // 100
    # the row number spreads repeated rows, which are equal in all else
    numbered = rows.where(long_enough).withColumn("row", F.monotonically_increasing_id())
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranked = range_rank(numbered, order, "place", "importance-ranks")
    rank = F.when(F.col("place") <= wanted, F.col("place")).alias("rank")
    return ranked.select(*rows.columns, rank).unionByName(
        rows.where(~long_enough).withColumn("rank", F.lit(None).cast("bigint")))
