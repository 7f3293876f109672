"""Periodic runs, quality votes and importance resampling against brute force and held-out labels."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obsframe.llm import importance, periodic, voting
from obsframe.llm import queries as registered
from pyspark.sql import functions as F

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ODD = "doc_id bigint, text string, runs string, score double, place int, label int, raw string, n_words int"


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs, empty and very long texts, repeated rows, and columns named like the operators' own."""
    texts = [
        None, "", " \t\n", "one", "a a a a a a", "x " * 5 + "y", "é 日本 é 日本 é 日本 é 日本", "Ab cd\u0085ef gh-ij 12",
        "p q r " * 7000, " ".join(f"w{i}" for i in range(30_000)), "z" * 3000 + " b b b b b b b",
    ]
    rows = [(i, t, "x", 0.5, 1, 1, "r", 9) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4], rows[4], (None, "a a a a a a", None, None, None, None, None, None)], ODD).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD)


# ---- periodic runs ----------------------------------------------------------------------


def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            smaller = any(all(w[k] == w[k + d] for k in range(i, i + n - d)) for d in range(1, q))
            if j > i and n >= max(6, 4 * q) and not smaller:
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, plant):
    w = SPACED.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if plant and doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.integers(0, 40), st.integers(1, 9), st.integers(0, 40))
def test_runs_of_any_words(head, begin, period, length):
    words = head + [head[(begin + i % period) % len(head)] for i in range(length)] if head else head
    assert periodic.runs(words) == brute_runs(words)


def test_suffix_tree_holds_every_suffix():
    draw = random.Random(3)
    for _ in range(200):
        text = [draw.randrange(1, 4) for _ in range(draw.randrange(1, 40))]
        start, end, children = periodic.suffix_tree([*text, 0])
        width = max(text) + 1

        def spelt(node):
            below = [c for key, c in children.items() if key // width == node]
            whole = [*text, 0]
            return [tuple(whole[start[c]:end[c]]) + rest for c in below for rest in spelt(c)] if below else [()]
        assert sorted(spelt(0)) == sorted(tuple([*text, 0][i:]) for i in range(len(text) + 1))
        tree = periodic.Extensions(text)
        for i in range(len(text)):
            for j in range(i + 1, len(text) + 1):
                same = 0
                while j + same < len(text) and text[i + same] == text[j + same]:
                    same += 1
                assert tree.common(np.array([i]), np.array([j]))[0] == same


def test_runs_of_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = registered.QUERIES["op11_periodic_runs"](spark, sf_dir).collect()
    # brute force is quadratic: texts of up to 600 words, and all planted ones
    small = {r.doc_id: r.text for r in docs if len((r.text or "").split()) <= 600 or not zlib.crc32(str(r.doc_id).encode()) % 10}
    want = {tuple(brute_row(i, t, True)) for i, t in small.items()}
    assert len(got) == len(docs) and {tuple(r) for r in got if r.doc_id in small} == want
    assert any(r[1] for r in want)


def test_runs_of_odd_rows(odd, none):
    rows = periodic.periodic_runs(odd).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == odd.count() and [r.doc_id for r in rows].count(4) == 3
    listed = {i: [tuple(x) for x in r.runs] for i, r in by_id.items()}
    assert listed[4] == listed[None] == [(0, 6, 1)] and listed[6] == [(0, 8, 2)] and listed[10] == [(1, 7, 1)]
    assert listed[8] == [(0, 21_000, 3)] and by_id[8].collapsed_text == "p q r"
    assert all(not listed[i] for i in (0, 1, 2, 3, 5, 7, 9)) and by_id[0].collapsed_text == "" and by_id[0].n_words == 0
    assert by_id[7].n_words == 3 and by_id[9].n_words == 30_000
    assert periodic.periodic_runs(none).count() == 0


# ---- quality votes ----------------------------------------------------------------------


def test_votes_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = registered.QUERIES["op12_quality_votes"](spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    good, bad = ([r for r in held if labels[r.doc_id] == q] for q in (1, 0))
    assert good and bad
    pairs = [(a.score > b.score) + (a.score == b.score) / 2 for a in good for b in bad]
    assert sum(pairs) / len(pairs) >= 0.95
    assert sum(r.predicted for r in good) >= 0.97 * len(good) and sum(1 - r.predicted for r in bad) >= 0.7 * len(bad)


def test_scores_are_the_votes_of_the_nearest():
    draw = np.random.default_rng(4)
    x = np.abs(draw.normal(size=(60, voting.TERMS + voting.REPEATS)))
    axes = np.linalg.qr(draw.normal(size=(x.shape[1], 8)))[0]
    rarity = np.ones(x.shape[1])
    model = voting.Model(rarity, axes, voting._projected(x[:40], rarity, axes), draw.uniform(1, 2, 40), draw.integers(0, 2, 40) * 1.0, 0.7)
    got = voting.scores(np.vstack([x[40:], np.zeros((1, x.shape[1]))]), model, neighbours=5)
    unit = lambda v: v / math.sqrt(sum(c * c for c in v))
    for row, score in zip(x[40:], got):
        near = sorted(((float(unit(row @ axes) @ v), -k) for k, v in enumerate(model.vectors)), reverse=True)[:5]
        votes = [(max(s, 0) ** voting.POWER * model.votes[-k], model.labels[-k]) for s, k in near]
        assert score == pytest.approx(sum(w * q for w, q in votes) / sum(w for w, _ in votes))
    assert got[-1] == 0.7


def test_votes_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame(
        [(3, 1), (5, 0), (5, 0), (9, 1), (9, None), (None, 0), (10, 7), (77, 0), (4, 1)], "doc_id bigint, quality int")
    for known in (labels, labels.limit(0), labels.where("doc_id = 77")):
        model = voting.train(odd, known, labelled=3)
        rows = voting.scored(odd, model, F.lit(False)).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert {r.score for r in rows if r.doc_id in (0, 1, 2)} == {model.prior}
    assert voting.train(odd, labels).prior == 3 / 5
    assert voting.train(odd, labels.limit(0)).prior == 0.5 and len(voting.train(odd, labels, labelled=1).vectors) <= 2
    assert voting.scored(none, voting.train(none, labels), F.lit(True)).count() == 0


# ---- importance resampling --------------------------------------------------------------

LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_drawn(docs, target, percent=10, least=20, buckets=10_000, longest=1):
    def parts(text):
        w = LETTERS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        return w, [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    source = Counter(bucket(f) for _, t in docs for f in parts(t)[1])
    aim = Counter(bucket(f) for t in target for f in parts(t)[1])
    s_all, t_all = sum(source.values()) + buckets, sum(aim.values()) + buckets
    gain = [math.floor(1000 * math.log((aim[b] + 1) * s_all / ((source[b] + 1) * t_all))) for b in range(buckets)]
    rows = []
    for i, t in docs:
        w, f = parts(t)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    long_enough = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    place = {id(r): n for n, r in enumerate(long_enough[:len(long_enough) * percent // 100], 1)}
    return Counter((*r[:4], place.get(id(r))) for r in rows)


def test_crcs_by_columns():
    draw = random.Random(2)
    features = [bytes(draw.choices(range(256), k=draw.randrange(0, 40))) for _ in range(2000)] + [b"x" * 5000]
    assert importance.crc_buckets(features, 10_000).tolist() == [zlib.crc32(f) % 10_000 for f in features]
    assert importance.crc_buckets([], 10).tolist() == []


def test_drawn_documents(spark, sf_dir):
    got = registered.QUERIES["op13_importance"](spark, sf_dir).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    assert Counter(map(tuple, got)) == brute_drawn(docs, target)
    assert got and max(r.rank or 0 for r in got) == sum(len(LETTERS.findall(t.lower())) >= 20 for _, t in docs) // 10


@pytest.mark.parametrize("longest, percent, least", [(1, 50, 1), (2, 34, 3), (3, 100, 0)])
def test_drawn_odd_rows(spark, odd, none, longest, percent, least):
    target = spark.createDataFrame([("One b B",), (None,), ("p q r",)], "text string")
    made = importance.resampled(odd, target, percent, least, buckets=50, longest=longest)
    assert made.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    rows = [(r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in made.collect()]
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert Counter(rows) == brute_drawn(docs, [r.text for r in target.collect()], percent, least, 50, longest)
    assert importance.resampled(none, target, percent, least).count() == 0
    assert importance.resampled(odd, target.limit(0), percent, least).count() == len(docs)


def test_pieces_change_nothing(odd, monkeypatch):
    whole = importance.bucket_counts(odd, 50, 2)
    runs = sorted(map(str, periodic.periodic_runs(odd).collect()))
    monkeypatch.setattr(importance, "PIECE", 10)
    monkeypatch.setattr(periodic, "PIECE", 10)
    assert (importance.bucket_counts(odd, 50, 2) == whole).all()
    assert sorted(map(str, periodic.periodic_runs(odd).collect())) == runs
