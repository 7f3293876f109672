"""Periodic runs in the words of a text, by suffix trees and Lyndon roots.

A run is a stretch of words that repeats with smallest period q, ``LEAST_COPIES`` times or
more and ``LEAST_WORDS`` words at least, and that no neighbouring word extends. Each run has a
Lyndon root under the order of words or under the reversed order: the longest Lyndon word that
starts there. It ends where the next smaller suffix starts, and suffixes are ranked by walking
Ukkonen's suffix tree. From each root, the run is extended to the right by the longest common
extension of two suffixes, to the left by that of the reversal's suffixes. An extension is the
string depth of the lowest common ancestor of two leaves: the least depth between them on the
tree's Euler tour, which a sparse table gives in constant time for all candidates at once.

Each word of a run occurs in it ``LEAST_COPIES`` times, so a run never holds a word that is
rarer in its text. The text is cut at such words first, again inside each stretch, and trees
are built of the stretches that are left; this loses no run.

Scale. A row is one task's work and no row meets another: no shuffle. Time is in proportion to
the words, but for the tables' logarithm; memory is about 2 KB per word of the longest
stretch, whatever the batch, so a text of a million words that are all common needs 2 GB.

Defined cases: NULL and empty texts have no words and no runs; repeated rows each give a row;
runs are listed by start, then period; other columns do not matter; an empty table gives none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_COPIES = 4
LEAST_WORDS = 6
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUN = "struct<start: bigint, length: bigint, period: bigint>"
#: Characters of texts that are handed on at a time.
PIECE = 1 << 24


def suffix_tree(text: list[int]) -> tuple[list[int], list[int], dict[int, int]]:
    """Ukkonen's tree of a text whose last code occurs once.

    Node 0 is the root. Returns where the label of the edge into each node starts and ends,
    and the children by ``node * width + code`` with width = max(text) + 1.
    """
    n, width = len(text), max(text) + 1
    start, end, link, children = [0], [0], [0], {}
    node = edge = length = pending = 0
    for i, code in enumerate(text):
        pending += 1
        unlinked = 0
        while pending:
            if not length:
                edge = i
            key = node * width + text[edge]
            child = children.get(key)
            if child is None:
                children[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                begin = start[child]
                span = min(end[child], i + 1) - begin
                if length >= span:
                    node, edge, length = child, edge + span, length - span
                    continue
                at = begin + length
                if text[at] == code:
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                inner = len(start)
                start += (begin, i)
                end += (at, n)
                link += (0, 0)
                start[child] = at
                children[key] = inner
                children[inner * width + text[at]] = child
                children[inner * width + code] = inner + 1
                if unlinked:
                    link[unlinked] = inner
                unlinked = inner
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    return start, end, children


class Extensions:
    """Longest common extensions of the suffixes of a text of codes from 1 up."""

    def __init__(self, codes: list[int]) -> None:
        n, text = len(codes), [*codes, 0]
        start, end, children = suffix_tree(text)
        width = max(text) + 1
        keys = np.fromiter(children.keys(), np.int64, len(children))
        below = np.fromiter(children.values(), np.int64, len(children))
        order = np.argsort(keys)
        parents = keys[order] // width
        self.bounds = np.searchsorted(parents, np.arange(len(start) + 1)).tolist()
        self.below = below[order].tolist()
        self.first_code = (keys[order] % width).tolist()
        self.length = n
        tour, self.first = [], [0] * (n + 1)
        self.rank = [0] * (n + 1)
        for node, depth, leaf in self._walk(start, end):
            if leaf:
                self.first[n + 1 - depth] = len(tour)
                self.rank[n + 1 - depth] = len(tour)
            tour.append(depth)
        self.start, self.end = start, end
        levels = [np.array(tour, np.int32)]
        while 2 << (len(levels) - 1) <= len(tour):
            half = 1 << (len(levels) - 1)
            last = levels[-1]
            levels.append(np.concatenate([np.minimum(last[:-half], last[half:]), last[-half:]]))
        self.levels = np.stack(levels)
        self.first = np.array(self.first, np.int64)

    def _walk(self, start: list[int], end: list[int], reverse: bool = False) -> Iterator[tuple[int, int, bool]]:
        """The Euler tour: node, string depth and whether it is a leaf, at every visit.

        Children come by the order of their first words, or the reversed one; the text's
        end is before all words in both.
        """
        bounds, below = self.bounds, self.below
        stack = [(0, 0, bounds[0])]
        yield 0, 0, False
        while stack:
            node, depth, at = stack[-1]
            low, high = bounds[node], bounds[node + 1]
            if at == high:
                stack.pop()
                if stack:
                    yield stack[-1][0], stack[-1][1], False
                continue
            stack[-1] = (node, depth, at + 1)
            if reverse:
                ends = self.first_code[low] == 0
                place = at if ends and at == low else high - 1 - (at - low) + ends
            else:
                place = at
            child = below[place]
            deeper = depth + end[child] - start[child]
            leaf = bounds[child] == bounds[child + 1]
            yield child, deeper, leaf
            if leaf:
                yield node, depth, False
            else:
                stack.append((child, deeper, bounds[child]))

    def reverse_rank(self) -> list[int]:
        """The rank of each suffix when words are in reversed order."""
        out = [0] * (self.length + 1)
        for place, (_, depth, leaf) in enumerate(self._walk(self.start, self.end, reverse=True)):
            if leaf:
                out[self.length + 1 - depth] = place
        return out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words the suffixes from ``a`` and from ``b`` (never equal) have in common."""
        low, high = np.minimum(self.first[a], self.first[b]), np.maximum(self.first[a], self.first[b])
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        return np.minimum(self.levels[level, low], self.levels[level, high - (1 << level) + 1]).astype(np.int64)


def next_smaller(rank: list[int]) -> np.ndarray:
    """Where the next smaller suffix starts; the last rank is that of the empty suffix."""
    n = len(rank) - 1
    out, stack = np.empty(n, np.int64), [n]
    for i in range(n - 1, -1, -1):
        while rank[stack[-1]] > rank[i]:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return out


def runs_of_codes(codes: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text of codes from 1 up."""
    n = len(codes)
    forward = Extensions(codes)
    found = []
    for rank in (forward.rank, forward.reverse_rank()):
        period = next_smaller(rank) - np.arange(n)
        at = np.flatnonzero(period * LEAST_COPIES <= n)
        found.append(np.stack([at, period[at]]))
    at, period = np.unique(np.concatenate(found, axis=1), axis=1)
    if not len(at):
        return []
    right = forward.common(at, at + period)
    del forward
    # a run of LEAST_COPIES periods whose first root is at most one period from its start
    some = right + 2 * period >= LEAST_COPIES * period
    at, period, right = at[some], period[some], right[some]
    if not len(at):
        return []
    left = Extensions(codes[::-1]).common(n - at, n - at - period)
    length = left + period + right
    some = length >= np.maximum(LEAST_WORDS, LEAST_COPIES * period)
    return sorted(set(zip((at - left)[some].tolist(), length[some].tolist(), period[some].tolist())), key=lambda r: (r[0], r[2]))


def stretches(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Start and words of the stretches in which every word is common enough for a run."""
    waiting = [(0, words)]
    while waiting:
        begin, part = waiting.pop()
        counts = Counter(part)
        if not part or min(counts.values()) >= LEAST_COPIES:
            if len(part) >= LEAST_WORDS:
                yield begin, part
            continue
        rare = [i for i, word in enumerate(part) if counts[word] < LEAST_COPIES]
        rare.append(len(part))
        after = 0
        for i in rare:
            if i - after >= LEAST_WORDS:
                waiting.append((begin + after, part[after:i]))
            after = i + 1


def runs(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text, by start, then period."""
    found = []
    for begin, part in stretches(words):
        names = {word: code for code, word in enumerate(dict.fromkeys(part), 1)}
        found += [(begin + s, n, q) for s, n, q in runs_of_codes([names[word] for word in part])]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], found: list[tuple[int, int, int]]) -> str:
    """The words outside runs and the first period of each run, apart by single spaces."""
    if not found:
        return " ".join(words)
    ends = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        ends[start + period] += 1
        ends[start + length] -= 1
    kept = np.cumsum(ends[:-1]) == 0
    return " ".join([word for word, stays in zip(words, kept.tolist()) if stays])


Rewrite = Callable[[int | None, list[str]], list[str]]


def _finder(rewrite: Rewrite | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def made(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["doc_id", "n_words", "runs", "collapsed_text"])
        return frame.assign(doc_id=frame["doc_id"].astype("Int64"))

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, size = [], 0
            for name, text in zip(frame["doc_id"], frame["text"]):
                doc_id, words = None if name is None else int(name), WORD.findall(text or "")
                if rewrite:
                    words = rewrite(doc_id, words)
                found = runs(words)
                listed = [{"start": s, "length": n, "period": q} for s, n, q in found]
                rows.append((doc_id, len(words), listed, collapsed(words, found)))
                size += len(text or "")
                if size >= PIECE:
                    yield made(rows)
                    rows, size = [], 0
            if rows:
                yield made(rows)
    return find


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period in words) and collapsed_text.

    ``rewrite`` may change a document's words, given with its doc_id, before they are searched.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(_finder(rewrite), f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed_text string")
