import random

import pytest
from pyspark.sql import functions as F

from obsframe.operators import series as S
from obsframe.operators.alerts import alert_states

SEC = 1_000_000


def points(spark, rows):
    return spark.createDataFrame([(k, t, float(v)) for k, t, v in rows], "series string, us bigint, value double").select(
        "series", F.timestamp_micros("us").alias("ts"), "value")


def brute_rate(rows, w, step, mode):
    out = {}
    for key in {k for k, _, _ in rows}:
        pts = sorted((t, v) for k, t, v in rows if k == key)
        lo, hi = pts[0][0], pts[-1][0]
        t = -(-lo // step) * step
        while t < hi + w:
            inside = [(a, v) for a, v in pts if t - w < a <= t]
            if len(inside) >= 2:
                inc = inside[-1][1] - inside[0][1] + sum(a for (_, a), (_, b) in zip(inside, inside[1:]) if b < a)
                if mode == "simple":
                    out[key, t] = inc / (w / SEC)
                else:
                    sampled = (inside[-1][0] - inside[0][0]) / SEC
                    avg = sampled / (len(inside) - 1)
                    ds, de = (inside[0][0] - (t - w)) / SEC, (t - inside[-1][0]) / SEC
                    ds, de = (avg / 2 if d >= 1.1 * avg else d for d in (ds, de))
                    if inc > 0 and inside[0][1] >= 0:
                        ds = min(ds, sampled * inside[0][1] / inc)
                    out[key, t] = inc * (sampled + ds + de) / sampled / (w / SEC)
            t += step
    return out


@pytest.mark.parametrize("mode", ["simple", "prometheus"])
@pytest.mark.parametrize("window, step", [(60, 60), (60, 15), (50, 70), (30, 90), (45, 20)])
def test_rate_equals_brute_force(spark, mode, window, step):
    rng = random.Random(window * 1000 + step)
    rows = []
    for key, gap in (("a", 10), ("b", 33), ("c", 200)):
        t, v = 1_000_000 * SEC, 0
        for _ in range(60):
            t += rng.randint(1, gap * SEC)
            t = t // SEC * SEC if rng.random() < 0.3 else t
            v = 0 if rng.random() < 0.1 else v + rng.randint(0, 9)
            rows.append((key, t, v))
    rows = list({(k, t): (k, t, v) for k, t, v in rows}.values())
    want = brute_rate(rows, window * SEC, step * SEC, mode)
    got = S.rate(points(spark, rows), ["series"], window, step, mode).select(
        "series", F.unix_micros("t").alias("t"), "rate").collect()
    assert {(r.series, r.t): pytest.approx(r.rate, abs=1e-12) for r in got} == want


def test_rate_literals(spark):
    t0 = 1_000_000 * SEC
    rate = lambda rows, mode="prometheus": [
        r.rate for r in S.rate(points(spark, rows), ["series"], 60, 60, mode).collect()]
    assert rate([("a", t0 + 10 * SEC, 5)]) == []
    two = [("a", t0 + 1 * SEC, 100), ("a", t0 + 19 * SEC, 118)]
    # 18 s sampled, no extrapolation beyond half a gap at the far end.
    first = S.rate(points(spark, two), ["series"], 20, 20, "prometheus").collect()
    assert [round(r.rate, 6) for r in first] == [1.0]
    near_zero = [("a", t0 + 10 * SEC, 1), ("a", t0 + 20 * SEC, 11)]
    got = S.rate(points(spark, near_zero), ["series"], 20, 20, "prometheus").collect()
    assert [round(r.rate, 6) for r in got] == [round(10 * (10 + 1 + 0) / 10 / 20, 6)]
    with pytest.raises(ValueError):
        rate(two, "other")


def test_values_that_are_not_numbers_are_skipped(spark):
    t0 = 1_000_000 * SEC
    rows = [("a", t0 + SEC, 1), ("a", t0 + 2 * SEC, float("nan")), ("a", t0 + 3 * SEC, 4)]
    assert [r.rate for r in S.rate(points(spark, rows), ["series"], 60, 60).collect()] == [3 / 60]


def test_delta_to_cumulative_by_time_and_by_arrival(spark):
    rows = [("a", 5, 1), ("a", 5, 2), ("a", 3, 4), ("b", 1, 8), ("a", 9, 16)]
    got = S.delta_to_cumulative(points(spark, rows), ["series"], chunk=0.000002).select("series", F.unix_micros("ts"), "value")
    assert sorted(map(tuple, got.collect())) == [("a", 3, 4.0), ("a", 5, 7.0), ("a", 9, 23.0), ("b", 1, 8.0)]
    arrived = points(spark, rows).withColumn("n", F.monotonically_increasing_id())
    arrived = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n bigint, series string, us bigint, value int").select(
        "n", "series", F.timestamp_micros("us").alias("ts"), F.col("value").cast("double"))
    got = S.delta_to_cumulative(arrived, ["series"], arrival="n", pieces=3).select("series", F.unix_micros("ts"), "value")
    assert sorted(map(tuple, got.collect())) == [("a", 5, 1.0), ("a", 9, 17.0), ("b", 1, 8.0)]


def test_instant_look_back(spark):
    rows = [("old", 0, 1), ("edge", 10 * SEC, 2), ("in", 11 * SEC, 3), ("in", 310 * SEC, 4), ("later", 311 * SEC, 5)]
    got = S.instant(points(spark, rows), ["series"], F.timestamp_micros(F.lit(310 * SEC)), "5 minutes").collect()
    assert [(r.series, r.value) for r in got] == [("in", 4.0)]


def test_missing_label_matches_empty_text(spark):
    df = spark.sql("select map('a','1') as labels")
    hit = lambda m: df.filter(S.matching("labels", m)).count()
    assert (hit({"a": "1"}), hit({"a": "2"}), hit({"b": ""}), hit({"b": "x"}), hit({})) == (1, 0, 1, 0, 1)


def test_threshold_steps(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 4.999, 5.0, 14.9, 15.0, None)], "value double")
    assert [r.color for r in S.threshold_steps(df, "value").collect()] == ["green", "green", "#EAB839", "#EAB839", "red", "green"]


def test_heatmap_hides_empty_cells(spark):
    rates = spark.createDataFrame([("s", 1, 0.1, 0.0), ("s", 1, 0.4, 2.0), ("s", 1, float("inf"), 2.0), ("s", 2, 0.1, 1.0)],
                                  "series string, t int, le double, rate double")
    got = sorted((r.t, r.le, r.cell) for r in S.heatmap_cells(rates, ["series"]).collect())
    assert got == [(1, 0.4, 2.0), (2, 0.1, 1.0)]


def test_rate_interval():
    assert S.rate_interval("1 minute", "10 seconds") == 70 and S.rate_interval("5s", "10s") == 40


ALERT_CASES = [
    ([1, 11, 12, 13, 3], ["Normal", "Pending", "Alerting", "Alerting", "Normal"], 60),
    ([1, 11, 2, 11, 2], ["Normal", "Pending", "Normal", "Pending", "Normal"], 60),
    ([11, 11, 11, 11], ["Pending", "Pending", "Alerting", "Alerting"], 120),
    ([11, 11], ["Alerting", "Alerting"], 0),
    ([10, 10.5], ["Normal", "Pending"], 60),
    ([11, "gap", 11, 11], ["Pending", "NoData", "Pending", "Alerting"], 60),
    ([11, None, 11], ["Pending", "NoData", "Pending"], 60),
    ([11, "fail", 11, 11], ["Pending", "Error", "Pending", "Alerting"], 60),
    ([float("nan"), 11], ["Normal", "Pending"], 60),
]


@pytest.mark.parametrize("values, states, for_", ALERT_CASES)
def test_alert_states(spark, values, states, for_):
    rows = [("r", i * 60 * SEC, None if v in ("fail", None) else float(v), v == "fail")
            for i, v in enumerate(values) if v != "gap"]
    df = spark.createDataFrame(rows, "rule string, us bigint, value double, failed boolean").withColumn(
        "t", F.timestamp_micros("us"))
    got = alert_states(df, ["rule"], threshold=10, for_=for_, failed="failed").orderBy("t").collect()
    assert [r.state for r in got] == states
    assert [r.state for r in alert_states(df, threshold=10, for_=for_, failed="failed").orderBy("t").collect()] == states


def test_alert_rules_are_separate(spark):
    df = spark.createDataFrame([("a", 0, 11.0), ("a", 60 * SEC, 11.0), ("b", 60 * SEC, 11.0)], "rule string, us bigint, value double")
    got = alert_states(df.withColumn("t", F.timestamp_micros("us")), ["rule"], threshold=10).collect()
    assert sorted((r.rule, r.state) for r in got) == [("a", "Alerting"), ("a", "Pending"), ("b", "Pending")]


def test_sums_do_not_depend_on_order(spark):
    from obsframe.operators.spanmetrics import exact_sum

    values = [2**62, -(2**62) + 1, 2**63 - 1, -(2**63), 2**53 + 1, 1, -1, 2**63 - 1, 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v bigint").repartition(4)
    assert int(df.agg(exact_sum(F.col("v"))).first()[0]) == sum(values)
    assert df.filter("v is null").agg(exact_sum(F.col("v"))).first()[0] is None
