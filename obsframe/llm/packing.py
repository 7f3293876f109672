"""Packing by concatenate and cut.

Pass 1 tokenises every document once and writes its ids with its place in its partition.
Pass 2 turns the partitions' token totals into global offsets by a prefix sum, so every
document knows where it starts in one endless stream, and cuts that stream into windows of
``length`` tokens. Only the last sequence can be shorter: padding is less than one sequence.

The prefix sum is over one row per partition of pass 1 (the input splits), not per document;
that table is joined back by partition and is small (24 bytes per 128 MB of input) at any
size. Documents are never shuffled. A text is tokenised in its own task; the table of pass 1
is in the shared folder, so a lost executor costs a re-read.

Defined cases: NULL and empty texts are the end id alone; repeated rows and NULL doc_ids are
packed like any other; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsframe.llm.common import in_batches, written

LENGTH = 2048
END_ID = 1
#: Pieces of text whose ids a worker remembers, at most; then it forgets all and goes on.
REMEMBERED = 1_000_000
#: New pieces that are encoded as one string.
TOGETHER = 1000
#: How the vocabulary writes the byte of a space.
SPACE_MARK = "\u0120"
#: Texts whose new pieces are learnt together.
AT_A_TIME = 64


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)  # a worker keeps it for its next tasks
def encoder(path: str, remembered: int = REMEMBERED) -> Callable[[list[str]], list[np.ndarray]]:
    """Texts to uint32 ids, the same as encoding each text whole without special tokens added.

    The pre-tokenizer of this byte-level vocabulary never joins across a single space between
    two characters that are not white space: the space begins the next piece. So a text whose
    spaces all stand alone is the concatenation of its pieces ' word', and pieces seen before
    need no encoding. New pieces are encoded together and cut before each id that begins with
    a space. Other texts, and those that hold a special token, are encoded whole.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    vocabulary = tokenizer.get_vocab()
    begins = np.zeros(max(vocabulary.values()) + 1, bool)
    begins[[i for piece, i in vocabulary.items() if piece.startswith(SPACE_MARK)]] = True
    known: dict[str, bytes] = {}

    def whole(texts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32).tobytes() for x in found]

    def learn(new: list[str]) -> None:
        groups = [new[i:i + TOGETHER] for i in range(0, len(new), TOGETHER)]
        for group, raw in zip(groups, whole(["".join([" " + w for w in g]) for g in groups])):
            starts = 4 * np.flatnonzero(begins[np.frombuffer(raw, np.uint32)])
            if len(starts) == len(group):
                cuts = [*starts.tolist(), len(raw)]
                known.update((w, raw[cuts[k]:cuts[k + 1]]) for k, w in enumerate(group))
            else:
                known.update(zip(group, whole([" " + w for w in group])))

    def parts(text: str) -> tuple[list[str], list[str]] | None:
        """The pieces of a text without, and with, a space before them; None: encode it whole."""
        words = text.split(" ")
        if "" in words or any(s in text for s in special):
            return None
        first, rest = words[0], words[1:]
        # white space may stand at either end of a text, but not next to a space
        inner = rest[:-1]
        if rest and (first != first.rstrip() or rest[-1] != rest[-1].lstrip()):
            return None
        new = [w for w in dict.fromkeys(inner) if w not in known]
        if any(w != w.strip() for w in new):
            return None
        return new, words

    def encode_some(texts: list[str]) -> list[bytes]:
        cut = [parts(t) if t else None for t in texts]
        learn(list(dict.fromkeys(w for c in cut if c for w in c[0])))
        alone = iter(whole([x for t, c in zip(texts, cut) for x in (
            (t,) if c is None else (c[1][0], " " + c[1][-1] if len(c[1]) > 1 else ""))]))
        out = []
        for c in cut:
            first = next(alone)
            out.append(first if c is None else b"".join([first, *map(known.__getitem__, c[1][1:-1]), next(alone)]))
        return out

    def encode(texts: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(texts), AT_A_TIME):
            if len(known) > remembered:
                known.clear()
            out += encode_some(texts[i:i + AT_A_TIME])
        return [np.frombuffer(x, np.uint32) for x in out]

    return encode


def _tokenise(path: str, end_id: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def tokenise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        part, place = TaskContext.get().partitionId(), 0
        for frame in frames:
            ids = [np.append(x, np.uint32(end_id)) for x in encode([t or "" for t in frame["text"]])]
            sizes = np.array([len(x) for x in ids], np.int64)
            ends = place + np.cumsum(sizes)
            yield pd.DataFrame({
                "part": part, "place": ends - sizes, "doc_id": frame["doc_id"], "doc_tokens": sizes,
                # ids below 65,536 take two bytes; wider vocabularies four
                "ids": [(x.astype(np.uint16) if x.max() < 65536 else x).tobytes() for x in ids],
            })
            place = int(ends[-1]) if len(ends) else place
    return tokenise


def tokenised(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """part, place (tokens before it in the partition), doc_id, doc_tokens, ids; not yet written."""
    return in_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(
        _tokenise(path or tokenizer_path(), end_id),
        "part bigint, place bigint, doc_id bigint, doc_tokens bigint, ids binary")


def _cutter(length: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc_id, first, size, raw in zip(
                    frame["doc_id"], frame["first"], frame["doc_tokens"], frame["ids"]):
                ids = np.frombuffer(raw, np.uint16 if len(raw) == 2 * size else np.uint32).astype("<u4")
                at = 0
                while at < size:
                    sequence, offset = divmod(first + at, length)
                    n = min(length - offset, size - at)
                    rows.append((doc_id, at, n, zlib.crc32(ids[at:at + n].tobytes()), size, sequence, offset, at + n < size))
                    at += n
            yield pd.DataFrame(rows, columns=[
                "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "continued"]
            ).astype({"doc_id": frame["doc_id"].dtype})
    return cut


def packed(tokens: DataFrame, length: int = LENGTH) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, continued.

    ``tokens`` must be a written table of ``tokenised``: its partition numbers and places are
    then fixed. ``continued`` marks the boundary records, pieces that go on in the next sequence.
    """
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # bounded: a row of 16 bytes for each task of pass 1
    offsets = tokens.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("place")).alias("first"), "doc_tokens", "ids")
    return offsets.mapInPandas(
        _cutter(length),
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint, continued boolean")


def pack(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    return packed(written(tokenised(docs, path), "pack-tokens"), length)
