import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsframe.operators import ordered as R


def _brute(rows):
    total, out = {}, []
    for k, t, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        total[k] = total.get(k, 0) + v
        out.append((k, t, total[k]))
    return sorted(out, key=str)


@pytest.mark.parametrize("blocked", [True, False])
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_running_sum_crosses_chunks_and_blocks(spark, width, blocked, monkeypatch):
    monkeypatch.setattr(R, "_FAN_OUT", 3)
    rng = random.Random(width)
    rows = [(k, t, rng.randint(-5, 5)) for k in ("a", "b", None) for t in rng.sample(range(-200, 200), 60)]
    df = spark.createDataFrame(rows, "k string, t bigint, v bigint")
    got = R.running_sum(df, ["k"], ["t"], R.chunk_index(F.col("t"), width), "v", "s", blocked=blocked)
    assert sorted(((r.k, r.t, r.s) for r in got.collect()), key=str) == _brute(rows)


def test_running_sum_of_earlier_rows(spark):
    df = spark.createDataFrame([("a", t, 1) for t in range(10)], "k string, t bigint, v bigint")
    got = R.running_sum(df, ["k"], ["t"], R.chunk_index(F.col("t"), 4), "v", "s", include_current=False)
    assert all(r.s == r.t for r in got.collect())


def test_even_chunks(spark):
    rng = random.Random(3)
    sparse = [1_700_000_000_000_000 + i * 10**9 for i in range(300)]
    values = [*range(700), *sparse]
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v bigint")
    for pieces in (1, 2, 8, 50):
        chunk = R.even_chunks(df, "v", pieces)
        rows = df.select("v", chunk("v").alias("c")).collect()
        ordered = [r.c for r in sorted((r for r in rows if r.v is not None), key=lambda r: r.v)]
        assert ordered == sorted(ordered) and [r.c for r in rows if r.v is None] == [0]
        sizes = [ordered.count(c) for c in range(pieces)]
        assert sum(sizes) == 1000 and max(sizes) <= 1000 / pieces + 2
    assert [r.c for r in df.limit(1).select(R.even_chunks(df.limit(0), "v")("v").alias("c")).collect()] == [0]


@pytest.mark.parametrize("pieces", [1, 5, 200])
def test_running_sum_over_even_chunks(spark, pieces):
    rng = random.Random(pieces)
    times = [*rng.sample(range(200), 60), *rng.sample(range(10**15, 10**15 + 10**9), 60)]
    rows = [(k, t, rng.randint(-5, 5)) for k in ("a", "b", None) for t in times]
    df = spark.createDataFrame(rows, "k string, t bigint, v bigint")
    got = R.running_sum(df, ["k"], ["t"], R.even_chunks(df, "t", pieces)("t"), "v", "s", blocked=False)
    assert sorted(((r.k, r.t, r.s) for r in got.collect()), key=str) == _brute(rows)


def test_range_rank(spark):
    rng = random.Random(4)
    crowded = [(10**15 + rng.randint(0, 50), i) for i in range(400)]
    sparse = [(rng.choice((-1, 1)) * 10 ** rng.randint(0, 17), 1000 + i) for i in range(200)]
    rows = [*crowded, *sparse, (None, 1), (None, 2), *[(7, 5000 + i) for i in range(300)]]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "v bigint, id bigint").repartition(5)
    got = R.range_rank(df, [F.desc_nulls_last("v"), F.asc("id")], "place").orderBy("place").collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.v, r.id) for r in got] == want and [r.place for r in got] == list(range(1, len(rows) + 1))
    assert R.range_rank(df.limit(0), [F.asc("v")], "place").count() == 0


@pytest.mark.parametrize("width", [1, 50, 10**6])
def test_exact_quantiles(spark, width):
    rng = np.random.default_rng(0)
    groups = {"hot": rng.integers(0, 400, 900), "one": np.array([42]), None: rng.integers(-50, 50, 33)}
    rows = [(k, int(v)) for k, vs in groups.items() for v in vs]
    qs = [0.0, 0.5, 0.95, 1.0]
    out = R.exact_quantiles(
        spark.createDataFrame(rows, "k string, v bigint"), ["k"], "v", qs, ["a", "b", "c", "d"], width
    ).collect()
    for r in out:
        ordered = sorted(groups[r.k])
        want = [int(ordered[max(int(np.ceil(q * len(ordered))), 1) - 1]) for q in qs]
        assert [r.a, r.b, r.c, r.d] == want
    assert len(out) == 3


def test_only_bracketed_values_are_shuffled(spark):
    rows = spark.range(200_000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 2 = 0 THEN 'cold' END as k", "xxhash64(id) as v")
    counts = R.bracketed_counts(rows, ["k"], "v", [0.5, 0.99], accuracy=1000).collect()
    assert sum(r._n for r in counts) == 200_000
    assert len(counts) < 200_000 * 2 * 8 / 1000  # of as many distinct values
    text = R.bracketed_counts(rows, ["k"], "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text.split("Exchange hashpartitioning")[1]
    got = {r.k: (r.a, r.b) for r in R.exact_quantiles(rows, ["k"], "v", [0.5, 0.99], ["a", "b"], 2**52, accuracy=1000).collect()}
    by_key = {}
    for r in rows.collect():
        by_key.setdefault(r.k, []).append(r.v)
    for k, values in by_key.items():
        values.sort()
        assert got[k] == tuple(values[int(np.ceil(q * len(values))) - 1] for q in (0.5, 0.99))


@pytest.mark.parametrize("qs", [[0.0, 1.0], [0.001, 0.999, 0.5]])
def test_quantiles_of_large_groups_with_ties(spark, qs):
    rows = spark.range(60_000).selectExpr("id % 2 as k", "CASE WHEN id % 5 < 2 THEN 7 ELSE id * id % 100003 END as v")
    names = [f"q{i}" for i in range(len(qs))]
    got = {r.k: [r[n] for n in names] for r in R.exact_quantiles(rows, ["k"], "v", qs, names, accuracy=200).collect()}
    for k in (0, 1):
        values = sorted(r.v for r in rows.filter(F.col("k") == k).collect())
        assert got[k] == [values[max(int(np.ceil(q * len(values))), 1) - 1] for q in qs]
    one = R.exact_quantiles(rows.filter("k = 0"), [], "v", qs, names, accuracy=200).first()
    assert [one[n] for n in names] == got[0]


def test_exact_quantiles_without_keys(spark):
    out = R.exact_quantiles(spark.range(101), [], "id", [0.5], ["m"]).collect()
    assert [r.m for r in out] == [50]


def test_join_per_chunk_keeps_every_row(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(100)] + [("x", 1), ("y", 2)], "k string, t bigint")
    table = spark.createDataFrame([("hot", 7), ("x", 8)], "k string, v int")
    got = R.join_per_chunk(rows, ["k"], R.chunk_index(F.col("t"), 10), table)
    assert {(r.k, r.v): r.n for r in got.groupBy("k", "v").agg(F.count("*").alias("n")).collect()} == {
        ("hot", 7): 100, ("x", 8): 1, ("y", None): 1}


def test_keys_of_other_types_are_refused(spark):
    with pytest.raises(TypeError):
        R.fill_keys(spark.sql("select 1.5d as k"), ["k"])
