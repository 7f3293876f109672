"""Language by n-gram filters that answer with a bitmask of languages.

Training counts the ``n``-grams of each language's texts (letters in lower case, words apart by
single spaces) in Spark, with partial counts per task. An n-gram belongs to a language if
it makes up at least ``SHARE`` of that language's n-grams, and at least ``RELATIVE`` of its
share in the language where it is commonest. So a language has at most ``1 / SHARE`` of them
at any size of the corpus, and a few mislabelled texts change nothing.

The filters of all languages are one table of ``rows`` words of 64 bits: bit l of a row
belongs to language l (bit-sliced Bloom filters). The conjunction of the ``HASHES`` rows of
an n-gram is the bitmask of all languages that contain it. A prediction adds these bits per
language over the whole text, takes off what filters as full as theirs answer by chance, and
names the language with the most; its score is its part of all n-grams.

The model is bounded: rows * 8 bytes per 64 languages (8 MB); it travels in the task.

Defined cases: NULL texts and texts without a letter, and all texts where nothing was learned,
are ``und`` with score 0.0; ties go to the smaller language name; NULL doc_ids count as text
'' for the fold; repeated rows count each time; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsframe.llm.common import in_batches
from obsframe.llm.hashing import GOLDEN, mixed

N = 3
SHARE = 2e-5
RELATIVE = 0.1
ROWS = 1 << 20
HASHES = 4
UNKNOWN = "und"
#: N-grams that a task looks up or counts at a time.
PIECE = 1 << 20


class Model(NamedTuple):
    languages: list[str]
    filters: np.ndarray  # (rows, words of 64 bits)
    chance: np.ndarray  # per language: that an n-gram it lacks is answered with yes


def grams(text: str | None) -> np.ndarray:
    """The n-grams of a text, 21 bits a character; none without a letter."""
    plain = "".join([c if c.isalpha() else " " for c in (text or "").lower()]) if text else ""
    plain = " ".join(plain.split())
    if not plain:
        return np.empty(0, np.uint64)
    codes = np.frombuffer(f" {plain} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    out = np.zeros(len(codes) - N + 1, np.uint64)
    for k in range(N):
        out = (out << np.uint64(21)) | codes[k:len(codes) - N + 1 + k]
    return out


def _counter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def counted(language: str, held: list[np.ndarray]) -> pd.DataFrame:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return pd.DataFrame({"lang": language, "gram": keys.view(np.int64), "n": counts})

    waiting: dict[str, list[np.ndarray]] = {}
    size: dict[str, int] = {}
    for frame in frames:
        for language, text in zip(frame["lang"], frame["text"]):
            found = grams(text)
            waiting.setdefault(language, []).append(found)
            size[language] = size.get(language, 0) + len(found)
            if sum(size.values()) >= PIECE:
                for name in list(waiting):
                    yield counted(name, waiting.pop(name))
                size.clear()
    for name in waiting:
        yield counted(name, waiting[name])


def places(found: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    """The filter rows of n-grams, one array per hash."""
    for k in range(HASHES):
        yield (mixed(found * GOLDEN + np.uint64(k + 1)) % np.uint64(rows)).astype(np.int64)


def train(labelled: DataFrame, share: float = SHARE, relative: float = RELATIVE, rows: int = ROWS) -> Model:
    """Learn from ``text`` and ``lang``; rows without a language teach nothing."""
    known = in_batches(labelled).select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    counts = known.mapInPandas(_counter, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    # window over a language's distinct n-grams would gather them; sums are joined back instead
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(totals, "lang").withColumn("share", F.col("n") / F.col("total"))
    best = F.max("share").over(Window.partitionBy("gram"))  # a row per language
    chosen = shares.withColumn("best", best).where(
        (F.col("share") >= share) & (F.col("share") >= relative * F.col("best"))).select("lang", "gram")
    learned = chosen.toPandas()  # at most 1 / share rows a language
    languages = sorted(learned["lang"].unique())
    filters = np.zeros((rows, -(-max(len(languages), 1) // 64)), np.uint64)
    for number, language in enumerate(languages):
        bit = np.uint64(1 << (number % 64))
        for place in places(learned.loc[learned["lang"] == language, "gram"].to_numpy(np.int64).view(np.uint64), rows):
            filters[place, number // 64] |= bit
    full = np.array([
        np.count_nonzero(filters[:, n // 64] & np.uint64(1 << (n % 64))) / rows for n in range(len(languages))])
    return Model(languages, filters, full ** HASHES)


def popcounts(found: np.ndarray, model: Model) -> np.ndarray:
    """Per language, how many of the n-grams its filter holds."""
    total = np.zeros(len(model.languages), np.int64)
    for begin in range(0, len(found), PIECE):
        mask = None
        for place in places(found[begin:begin + PIECE], len(model.filters)):
            answer = model.filters[place]
            mask = answer if mask is None else mask & answer
        for n in range(len(total)):
            total[n] += np.count_nonzero(mask[:, n // 64] & np.uint64(1 << (n % 64)))
    return total


def decide(found: np.ndarray, model: Model) -> tuple[str, float]:
    if not len(found) or not model.languages:
        return UNKNOWN, 0.0
    held = (popcounts(found, model) - len(found) * model.chance) / (1 - np.minimum(model.chance, 0.99))
    best = int(held.argmax())
    return model.languages[best], float(np.clip(held[best] / len(found), 0, 1))


def _predictor(model: Model) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def predict(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [decide(grams(text), model) for text in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "held_out": frame["held_out"],
                "lang_pred": [m[0] for m in made], "score": [m[1] for m in made]})
    return predict


def fold(doc_id: Column, folds: int = 4) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def identified(docs: DataFrame, held_fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score; the held-out fold teaches nothing."""
    held = (fold(F.col("doc_id")) == held_fold).alias("held_out")
    model = train(docs.where(~held))
    return in_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), held, "text").mapInPandas(
        _predictor(model), "doc_id bigint, held_out boolean, lang_pred string, score double")
