"""Text quality by votes of the nearest labelled documents in a latent semantic space.

A document's terms are what can be said of a text in any language: the trigrams of its shape
(letters, capitals and digits by class, other ASCII as it is, runs of spaces as one), hashed
into ``TERMS`` buckets, and how many of its words, word triples and lines repeat, by kind of
repeat. Its vector holds the square roots of the terms' shares, weighted by rarity among the
labelled documents. The ``DIMENSIONS`` largest singular vectors of the labelled documents span
the latent space. Every document's cosine with every labelled vector is computed in blocks; its
``NEIGHBOURS`` nearest vote with a power of their similarity, and its score is the share of
label 1 in the votes.

The classifier is fitted on a sample: of each label, the ``labelled`` documents with the least
hash of their doc_id. A vote counts as many times as its label was sampled too little, so that
the score is a share among all labelled documents. The model is bounded by ``labelled`` and
``DIMENSIONS`` (less than 2 MB) and is broadcast. All documents are scored over whole texts, one
pass, without a shuffle.

Defined cases: texts without a term (NULL or empty), and all texts if nothing was learned,
score the share of label 1 among the labelled documents (0.5 if there are none); labels other
than 0 and 1 and rows without a doc_id or a label teach nothing; labels of one doc_id count as
their mean, rounded half up; a doc_id that is in several rows of documents teaches with as many
rows as fit in the sample; at equal similarity the vector that comes first in the order of
hashes votes; other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.llm.hashing import GOLDEN, mixed

TERMS = 2048
DIMENSIONS = 48
LABELLED = 1024
NEIGHBOURS = 15
POWER = 4
#: Repeats: words, word triples and lines, new or seen before in the text, and words like the last.
REPEATS = 7
#: Documents whose similarities are computed at a time.
BLOCK = 512


class Model(NamedTuple):
    rarity: np.ndarray  # per term
    axes: np.ndarray  # (terms, dimensions)
    vectors: np.ndarray  # (labelled documents, dimensions), of length 1
    votes: np.ndarray  # per labelled document, what its vote weighs
    labels: np.ndarray  # 0.0 or 1.0
    prior: float


def shape_classes() -> np.ndarray:
    """The class of every byte of a UTF-8 text."""
    classes = np.arange(256, dtype=np.uint8)
    classes[ord("a"):ord("z") + 1] = ord("a")
    classes[128:] = ord("a")
    classes[ord("A"):ord("Z") + 1] = ord("A")
    classes[ord("0"):ord("9") + 1] = ord("0")
    classes[[9, 11, 12, 13]] = ord(" ")
    return classes


SHAPES = shape_classes()


def _repeated(items: list) -> tuple[int, int]:
    """How many items are new, and how many were seen before."""
    new = len(set(items))
    return new, len(items) - new


def terms(text: str | None) -> np.ndarray:
    """Square roots of the shares of a text's terms: shapes and repeats are one half each."""
    out = np.zeros(TERMS + REPEATS)
    raw = (text or "").encode("utf-8", "replace")
    found = raw.split()
    if not found:
        return out
    shape = SHAPES[np.frombuffer(raw, np.uint8)]
    gap = (shape == ord(" ")) | (shape == 10)
    shape = np.concatenate([[32], shape[~(gap & np.concatenate([[False], gap[:-1]]))], [32]]).astype(np.uint64)
    grams = (shape[:-2] << np.uint64(16)) | (shape[1:-1] << np.uint64(8)) | shape[2:]
    kinds, counts = np.unique(grams, return_counts=True)
    np.add.at(out, (mixed(kinds * GOLDEN) % np.uint64(TERMS)).astype(np.int64), counts)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeats = [
        *_repeated(found), *_repeated(list(zip(found, found[1:], found[2:]))), *_repeated(lines),
        sum(a == b for a, b in zip(found, found[1:]))]
    out[:TERMS] /= 2 * out[:TERMS].sum()
    for at, size in ((0, len(found)), (2, max(len(found) - 2, 1)), (4, len(lines))):
        out[TERMS + at:TERMS + at + 2] = np.array(repeats[at:at + 2]) / size / 8
    out[TERMS + 6] = repeats[6] / len(found) / 8
    return np.sqrt(out)


def _vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for begin in range(0, len(frame), BLOCK):
            part = frame.iloc[begin:begin + BLOCK]
            yield pd.DataFrame({
                "place": part["place"], "doc_id": part["doc_id"], "label": part["label"],
                "terms": [terms(text).astype(np.float32) for text in part["text"]]})


def _projected(x: np.ndarray, rarity: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Latent vectors of length 1; zero for documents without a term."""
    y = (x * rarity) @ axes
    length = np.linalg.norm(y, axis=1, keepdims=True)
    return np.divide(y, length, out=np.zeros_like(y), where=length > 0)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED) -> Model:
    """Fit on ``labelled`` documents of each label at most; ``labels`` has doc_id and the label."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(
        F.floor(F.avg("label") + 0.5).cast("int").alias("label")).withColumn("place", F.xxhash64("doc_id"))
    totals = {row.label: row.n for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = ["place", "doc_id"]
    picked = None
    for value in sorted(totals):
        some = known.where(F.col("label") == value).orderBy(*order).limit(labelled)
        picked = some if picked is None else picked.unionByName(some)
    prior = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
    nothing = Model(np.ones(TERMS + REPEATS), np.zeros((TERMS + REPEATS, 1)), np.zeros((0, 1)), np.zeros(0), np.zeros(0), prior)
    if picked is None:
        return nothing
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the sample has 2 * labelled rows at most
    found = rows.join(F.broadcast(picked), "doc_id").select("place", "doc_id", "label", "text").mapInPandas(
        _vectors, "place bigint, doc_id bigint, label int, terms array<float>")
    held = found.orderBy(*order, "terms").limit(2 * labelled).toPandas()
    if held.empty:
        return nothing
    x, y = np.array(held["terms"].tolist(), np.float64), held["label"].to_numpy(np.float64)
    rarity = np.log1p(len(x) / (1 + np.count_nonzero(x, axis=0)))
    _, axes = np.linalg.eigh((x * rarity).T @ (x * rarity))
    axes = axes[:, ::-1][:, :min(DIMENSIONS, len(x))]
    sampled = np.bincount(y.astype(int), minlength=2)
    votes = np.array([totals.get(k, 0) / max(sampled[k], 1) for k in (0, 1)])[y.astype(int)]
    return Model(rarity, axes, _projected(x, rarity, axes), votes, y, prior)


def scores(x: np.ndarray, model: Model, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores of documents by their terms."""
    out = np.full(len(x), model.prior)
    if not len(model.vectors):
        return out
    latent = _projected(x, model.rarity, model.axes)
    near = latent @ model.vectors.T
    order = np.argsort(-near, axis=1, kind="stable")[:, :neighbours]
    weight = np.maximum(np.take_along_axis(near, order, axis=1), 0) ** POWER * model.votes[order]
    total = weight.sum(axis=1)
    voted = total > 0
    out[voted] = (weight * model.labels[order]).sum(axis=1)[voted] / total[voted]
    return np.clip(out, 0, 1)


def _scorer(model: Broadcast) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for begin in range(0, len(frame), BLOCK):
                part = frame.iloc[begin:begin + BLOCK]
                x = np.stack([terms(text) for text in part["text"]])
                yield pd.DataFrame({
                    "doc_id": part["doc_id"], "held_out": part["held_out"], "score": scores(x, Model(*model.value))})
    return score


def scored(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """doc_id, held_out and score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))  # plain arrays need no module on executors
    return docs.select(
        F.col("doc_id").cast("bigint").cast("string").alias("doc_id"), held_out.alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).mapInPandas(_scorer(sent), "doc_id string, held_out boolean, score double").withColumn(
        "doc_id", F.col("doc_id").cast("bigint"))
