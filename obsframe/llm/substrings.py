"""Removal of passages that occur more than once, by hashes of every fixed-length word window.

Documents are dealt into chunks of about ``CHUNK_BYTES`` of text. A chunk hashes every window
by a rolling polynomial over word hashes (Rabin-Karp: prefix sums times powers of an odd base
modulo 2**64, finished by a mixer), with 16 more bits from a second base, so two different
windows agree with a chance of 2**-80. Each chunk sends its distinct hashes, sorted and cut
into hash ranges, as one binary value per range; Spark shuffles these by range and counts in
how many chunks a hash occurs. What goes back is one bit per hash sent. The chunk then knows
which of its windows occur again, in the chunk or elsewhere, and merges them into maximal
intervals.

So every window is counted, while a window costs some ten bytes in one shuffle, and a text is
shuffled once (both readers of the chunks share it). A passage that a third of all documents
hold is one hash per chunk. Ranges and chunks grow in number with the input, not in size.

Defined cases: NULL, empty and short texts have no windows and keep all words; windows never
cross documents; repeated rows are documents of their own, so they lose each other's windows;
NULL doc_ids are kept as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import compress

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import in_batches
from obsframe.llm.hashing import mixed, word_hashes

WINDOW = 35
CHUNK_BYTES = 16 << 20
#: Odd bases of the two rolling hashes.
FIRST_BASE, SECOND_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, np.uint64(base))
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def rolling(hashes: np.ndarray, window: int, base: int) -> np.ndarray:
    """The polynomial hash of every window of word hashes."""
    if len(hashes) < window:
        return np.empty(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(base, len(hashes)), dtype=np.uint64)])
    return mixed((sums[window:] - sums[:-window]) * _powers(_inverse(base), len(hashes) - window + 1))


def _windows(texts: pd.Series, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and windows per text, and the hashes of all windows: uint64, and 16 bits more."""
    n_words, first, second = [], [], []
    for raw in texts:
        hashes = word_hashes(raw.split() if raw else [])  # bytes split at the six ASCII spaces only
        n_words.append(len(hashes))
        first.append(rolling(hashes, window, FIRST_BASE))
        second.append((rolling(hashes, window, SECOND_BASE) >> np.uint64(48)).astype(np.uint16))
    return (np.array(n_words, np.int64), np.concatenate([np.empty(0, np.uint64), *first]),
            np.concatenate([np.empty(0, np.uint16), *second]))


def _runs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorting order, and where in it a new (first, second) begins."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, new


def _packed(first: np.ndarray, second: np.ndarray) -> bytes:
    """Hashes byte plane by byte plane: the upper planes of sorted hashes compress well."""
    planes = first.view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes + second.tobytes())


def _unpacked(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    planes = np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel(), np.frombuffer(raw, np.uint16, n, 8 * n)


def _sender(window: int, bits: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def send(docs: pd.DataFrame) -> pd.DataFrame:
        _, first, second = _windows(docs["raw"], window)
        order, new = _runs(first, second)
        distinct = order[new]
        first, second = first[distinct], second[distinct]
        ranges = (first >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(first), np.int64)
        named, starts = np.unique(ranges, return_index=True)
        ends = np.append(starts[1:], len(first))
        return pd.DataFrame({
            "range": named, "chunk": docs["chunk"].iloc[0], "n": ends - starts,
            "hashes": [_packed(first[a:b], second[a:b]) for a, b in zip(starts, ends)],
        })
    return send


def _mark_repeated(sent: pd.DataFrame) -> pd.DataFrame:
    """For each chunk, one bit per hash it sent: does another chunk hold it?"""
    arrays = [_unpacked(blob, n) for blob, n in zip(sent["hashes"], sent["n"])]
    order, new = _runs(np.concatenate([a for a, _ in arrays]), np.concatenate([b for _, b in arrays]))
    run = np.cumsum(new) - 1
    marks = np.empty(len(order), bool)
    marks[order] = np.bincount(run)[run] > 1
    cuts = np.cumsum(sent["n"].to_numpy())[:-1]
    return pd.DataFrame({
        "chunk": sent["chunk"], "range": sent["range"], "n": sent["n"],
        "marks": [np.packbits(m).tobytes() for m in np.split(marks, cuts)],
    })


def _remover(window: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def remove(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        n_words, first, second = _windows(docs["raw"], window)
        order, new = _runs(first, second)
        run = np.cumsum(new) - 1
        answers = answers.sort_values("range")
        elsewhere = np.concatenate([np.empty(0, bool), *[
            np.unpackbits(np.frombuffer(m, np.uint8), count=n).astype(bool)
            for m, n in zip(answers["marks"], answers["n"])]])
        repeated = np.empty(len(order), bool)
        repeated[order] = ((np.bincount(run) > 1) | elsewhere)[run] if len(run) else False
        kept, removed, spans, at = [], [], [], 0
        for raw, n in zip(docs["raw"], n_words):
            n_windows = max(n - window + 1, 0)
            starts = np.flatnonzero(repeated[at:at + n_windows])
            at += n_windows
            if not len(starts):
                kept.append(b" ".join(raw.split()) if raw else b"")
                removed.append(0)
                spans.append([])
                continue
            # windows that overlap or touch merge into one interval
            breaks = np.flatnonzero(np.diff(starts) > window)
            begins = starts[np.append(0, breaks + 1)]
            ends = starts[np.append(breaks, len(starts) - 1)] + window
            keep = np.ones(n, bool)
            for a, b in zip(begins, ends):
                keep[a:b] = False
            kept.append(b" ".join(compress(raw.split(), keep)))
            removed.append(int((ends - begins).sum()))
            spans.append([int(x) for pair in zip(begins, ends) for x in pair])
        return pd.DataFrame({
            "doc_id": docs["doc_id"], "n_words": n_words, "n_removed": removed, "spans": spans, "kept": kept})
    return remove


def without_repeats(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by a space) and spans.

    ``spans`` holds the removed word intervals: start, end, start, end ... A word goes if a
    window of ``window`` words over it occurs anywhere else in ``docs``.
    """
    docs = in_batches(docs)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = max(1, -(-size // chunk_bytes))
    bits = (chunks - 1).bit_length()  # as many hash ranges as chunks, or up to twice
    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"),
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("raw"))
    sent = dealt.groupBy("chunk").applyInPandas(
        _sender(window, bits), "range bigint, chunk bigint, n bigint, hashes binary")
    answers = sent.groupBy("range").applyInPandas(
        _mark_repeated, "chunk bigint, range bigint, n bigint, marks binary")
    cut = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        _remover(window), "doc_id bigint, n_words bigint, n_removed bigint, spans array<bigint>, kept binary")
    return cut.withColumn("kept_text", F.col("kept").cast("string")).drop("kept")
