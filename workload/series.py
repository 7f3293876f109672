"""Accumulation, rates, heatmaps, instants and alert states."""

from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.operators import alerts as AL
from obsframe.operators import series as S
from workload.registry import query
from workload.views import as_points, us, view, with_views

_V = with_views
_HOUR = 3_600_000_000
_W, _STEP = 6 * _HOUR, _HOUR


def _rate_ctes(src, keys, w=_W, step=_STEP):
    """Brute force: join every point to every window end it lies in."""
    return dict(
        p=f"SELECT {keys}, epoch_us(ts) AS us, value, lag(value) OVER (PARTITION BY {keys} ORDER BY ts) AS prev FROM {src}",
        g=f"""SELECT unnest(generate_series((SELECT min(us) FROM p) // {step} * {step},
              (SELECT max(us) FROM p) // {step} * {step} + {w} + {step}, {step})) AS t_us""",
        j=f"""SELECT p.*, t_us, min(us) OVER (PARTITION BY {keys}, t_us) AS first_us
              FROM p JOIN g ON p.us > g.t_us - {w} AND p.us <= g.t_us""",
        r=f"""SELECT {keys}, t_us, arg_max(value, us) - arg_min(value, us)
                + sum(CASE WHEN value < prev AND us > first_us THEN prev ELSE 0 END) AS inc,
                count(*) AS n, min(us) AS a_us, max(us) AS b_us, arg_min(value, us) AS v0
              FROM j GROUP BY {keys}, t_us HAVING count(*) >= 2""",
    )


@query("w1_delta_to_cumulative", _V(["points"], """
  SELECT series, epoch_us(ts) AS ts_us, sum(value) OVER (PARTITION BY series ORDER BY ts) AS value FROM points"""))
def delta_to_cumulative(spark, sf):
    out = S.delta_to_cumulative(view(spark, sf, "points"), ["series"])
    return out.select("series", us("ts"), "value")


@query("w1_delta_out_of_order", _V([], """
  SELECT series, epoch_us(t) AS ts_us, sum(value) OVER (PARTITION BY series ORDER BY t) AS value
  FROM seen WHERE before IS NULL OR t > before""",
    late="""SELECT event_type AS series, event_id, value AS raw, CAST(event_id % 10 AS DOUBLE) AS value,
      CASE WHEN event_id % 9 = 0 THEN ts - INTERVAL 12 HOUR ELSE ts END AS t FROM events""",
    seen="""SELECT *, max(t) OVER (PARTITION BY series ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      AS before FROM late"""))
def delta_out_of_order(spark, sf):
    from workload.views import table

    late = table(spark, sf, "events").select(
        F.col("event_type").alias("series"), "event_id", (F.col("event_id") % 10).cast("double").alias("value"),
        F.expr("CASE WHEN event_id % 9 = 0 THEN ts - INTERVAL 12 HOUR ELSE ts END").alias("ts"))
    out = S.delta_to_cumulative(late, ["series"], arrival="event_id")
    return out.select("series", us("ts"), "value")


@query("w2_rate", _V(["points"], f"SELECT series, t_us, inc / {_W / 1e6} AS rate FROM r", **_rate_ctes("points", "series")))
def rate(spark, sf):
    return S.rate(view(spark, sf, "points"), ["series"], "6 hours", "1 hour").select("series", us("t"), "rate")


@query("w2_rate_uneven_step", _V(["points"], "SELECT series, t_us, inc / 3000.0 AS rate FROM r",
    **_rate_ctes("points", "series", 3_000_000_000, 4_200_000_000)))
def rate_uneven_step(spark, sf):
    return S.rate(view(spark, sf, "points"), ["series"], "50 minutes", "70 minutes").select("series", us("t"), "rate")


@query("w2_rate_70s_every_60s", _V(["points"], "SELECT span_kind, t_us, inc / 70.0 AS rate FROM r",
    **_rate_ctes("points", "span_kind", 70_000_000, 60_000_000)))
def rate_70s_every_60s(spark, sf):
    """A window that is no multiple of its step, as a panel's rate interval is."""
    return S.rate(view(spark, sf, "points"), ["span_kind"], S.rate_interval(60, 10), 60).select("span_kind", us("t"), "rate")


_EDGE = """CASE WHEN {d} >= 1.1 * avg_gap THEN avg_gap / 2 ELSE {d} END"""


@query("w2_rate_prometheus", _V(["points"], f"""
  SELECT series, t_us, round(inc * (sampled + CASE WHEN inc > 0 AND v0 >= 0 THEN least(ds, sampled * v0 / inc) ELSE ds END + de)
    / sampled / {_W / 1e6}, 9) AS rate FROM y""",
    **_rate_ctes("points", "series"),
    x=f"""SELECT *, (b_us - a_us) / 1e6 AS sampled, (b_us - a_us) / 1e6 / (n - 1) AS avg_gap,
      (a_us - (t_us - {_W})) / 1e6 AS ds0, (t_us - b_us) / 1e6 AS de0 FROM r""",
    y=f"SELECT *, {_EDGE.format(d='ds0')} AS ds, {_EDGE.format(d='de0')} AS de FROM x"))
def rate_prometheus(spark, sf):
    out = S.rate(view(spark, sf, "points"), ["series"], "6 hours", "1 hour", mode="prometheus")
    return out.select("series", us("t"), F.round("rate", 9).alias("rate"))


_FAILED = "SELECT * FROM points WHERE service = 'bookapp' AND status_code = 'STATUS_CODE_ERROR'"
_SUMMED = f"SELECT t_us, round(sum(inc / {_W / 1e6}), 9) AS value FROM r GROUP BY t_us"


def _error_rate(spark, sf):
    out = S.error_rate(as_points(view(spark, sf, "points")), "bookapp", "6 hours", "1 hour")
    return out.withColumn("value", F.round("value", 9))


@query("w3_error_rate", _V(["points"], _SUMMED, f=_FAILED, **_rate_ctes("f", "service, span_name, span_kind, status_code")))
def error_rate(spark, sf):
    return _error_rate(spark, sf).select(us("t"), "value")


@query("p20_threshold_steps", _V(["points"], f"""
  SELECT t_us, value, CASE WHEN value >= 0.02 THEN 'red' WHEN value >= 0.01 THEN '#EAB839' ELSE 'green' END AS color
  FROM ({_SUMMED})""", f=_FAILED, **_rate_ctes("f", "service, span_name, span_kind, status_code")))
def threshold_steps(spark, sf):
    steps = ((None, "green"), (0.01, "#EAB839"), (0.02, "red"))
    return S.threshold_steps(_error_rate(spark, sf), "value", steps).select(us("t"), "value", "color")


_LES = ("0.1", "0.4", "1.6", "+Inf")


def _bucket_points(spark, sf):
    """Four cumulative buckets per scrape of a server's histogram."""
    flat = view(spark, sf, "points")
    rows = F.array(*[
        F.struct(F.lit(le).alias("le"), (F.col("value") * (i + 1)).alias("bucket")) for i, le in enumerate(_LES)])
    flat = flat.select("service", "series", "ts", F.inline(rows))
    return flat.select(
        F.lit(fixed.EDGE_SERVER_METRIC + "_bucket").alias("metric"),
        F.create_map(F.lit("server"), "service", F.lit("client"), "series", F.lit("le"), "le").alias("labels"),
        "ts", F.col("bucket").alias("value"))


@query("w4_latency_heatmap", _V(["points"], """
  SELECT client, t_us, le, round(cell, 9) AS cell FROM c WHERE cell > 1e-9""",
    f="""SELECT service, series AS client, ts, l.i, l.le, value * l.i AS value FROM points
      CROSS JOIN (VALUES (1, '0.1'), (2, '0.4'), (3, '1.6'), (4, '+Inf')) l(i, le) WHERE service = 'bookapp'""",
    **_rate_ctes("f", "client, i, le"),
    c=f"""SELECT *, inc / {_W / 1e6} - coalesce(lag(inc / {_W / 1e6}) OVER (PARTITION BY client, t_us ORDER BY i), 0) AS cell
      FROM r"""))
def latency_heatmap(spark, sf):
    cells = S.latency_heatmap(_bucket_points(spark, sf), "bookapp", "6 hours", "1 hour")
    return cells.select(
        F.regexp_extract("series", '"client","value":"([^"]*)"', 1).alias("client"), us("t"),
        S.bound_text("le").alias("le"), F.round("cell", 9).alias("cell"))


_AT = "TIMESTAMP '2024-01-15 12:00:00'"


@query("w5_instant", _V(["points"], f"""
  SELECT series, span_kind, epoch_us(max(ts)) AS ts_us, arg_max(value, ts) AS value FROM points
  WHERE ts <= {_AT} AND ts > {_AT} - INTERVAL 6 HOUR GROUP BY ALL"""))
def instant(spark, sf):
    out = S.instant(view(spark, sf, "points"), ["series", "span_kind"], "2024-01-15 12:00:00", "6 hours")
    return out.select("series", "span_kind", us("ts"), "value")


@query("a11_sum_by", _V(["points"], f"""
  SELECT span_name, sum(v) AS value FROM (
    SELECT span_name, status_code, arg_max(value, ts) AS v FROM points
    WHERE ts <= {_AT} AND ts > {_AT} - INTERVAL 12 HOUR AND service = 'bookapp' AND span_kind = 'SPAN_KIND_SERVER'
    GROUP BY ALL) GROUP BY span_name"""))
def sum_by(spark, sf):
    matchers = {"service": "bookapp", "span_kind": "SPAN_KIND_SERVER"}
    return S.sum_by(as_points(view(spark, sf, "points")), fixed.CALLS_METRIC, matchers, ["span_name"],
                    "2024-01-15 12:00:00", "12 hours")


@query("w6_reduce_last", _V(["points"], """
  SELECT series, epoch_us(max(ts)) AS ts_us, arg_max(value, ts) AS value FROM points GROUP BY series"""))
def reduce_last(spark, sf):
    return S.reduce_last(view(spark, sf, "points"), ["series"], ts="ts").select("series", us("ts"), "value")


_GRID = f"SELECT unnest(generate_series((SELECT min(t_us) FROM v), (SELECT max(t_us) FROM v), {_HOUR})) AS t_us"
_STREAKS = """SELECT q.*, (SELECT min(s.t_us) FROM q s WHERE s.breach AND s.t_us <= q.t_us AND s.t_us >
        coalesce((SELECT max(c.t_us) FROM q c WHERE NOT c.breach AND c.t_us <= q.t_us), -1)) AS since_us FROM q"""
_STATES = f"""
  SELECT b.t_us, b.value, CASE WHEN b.value IS NULL THEN 'NoData' WHEN NOT b.breach THEN 'Normal'
      WHEN b.t_us - b.since_us >= {2 * _HOUR} THEN 'Alerting' ELSE 'Pending' END AS state,
    CASE WHEN b.breach THEN b.since_us END AS since_us FROM b"""
#: Hours without a value: gaps of two and of four, where an evaluation looks back three.
_GAPS = (2, 3, 5, 6, 7, 8)


def reduced(threshold):
    """Range, last, threshold: each evaluation takes the last value of three hours."""
    return f"""SELECT g.t_us, arg_max(v.value, v.t_us) AS value, coalesce(arg_max(v.value, v.t_us) > {threshold}, false) AS breach
      FROM grid g LEFT JOIN v ON v.t_us <= g.t_us AND v.t_us > g.t_us - {3 * _HOUR} GROUP BY g.t_us"""


@query("w7_alert_states", _V(["points"], _STATES,
    f=_FAILED, **_rate_ctes("f", "service, span_name, span_kind, status_code"), v=_SUMMED, grid=_GRID,
    q="SELECT t_us, value, coalesce(value > 0.012, false) AS breach FROM grid LEFT JOIN v USING (t_us)", b=_STREAKS))
def alert_states(spark, sf):
    out = AL.alert_states(_error_rate(spark, sf), threshold=0.012, for_="2 hours", interval="1 hour")
    return out.select(us("t"), "value", "state", us("since"))


def _gappy_rate(spark, sf):
    hour = F.expr(f"unix_micros(t) div {_HOUR} % 11")
    return _error_rate(spark, sf).filter(~hour.isin(*_GAPS))


@query("w7_alert_states_range", _V(["points"], _STATES,
    f=_FAILED, **_rate_ctes("f", "service, span_name, span_kind, status_code"), summed=_SUMMED,
    v=f"SELECT * FROM summed WHERE t_us // {_HOUR} % 11 NOT IN {_GAPS}", grid=_GRID, q=reduced(0.012), b=_STREAKS))
def alert_states_range(spark, sf):
    out = AL.alert_states(
        _gappy_rate(spark, sf), threshold=0.012, for_="2 hours", interval="1 hour", lookback="3 hours")
    return out.select(us("t"), "value", "state", us("since"))


@query("u1_fan_in", _V(["points", "requests"], """
  SELECT metric, service, epoch_us(ts) AS ts_us, value FROM (
    SELECT 'calls' AS metric, service, ts, value FROM points
    UNION ALL SELECT 'http' AS metric, NULL, ts, CAST(duration_ns AS DOUBLE) FROM requests
    UNION ALL SELECT 'size' AS metric, NULL, ts, CAST(user_id AS DOUBLE) FROM events)"""))
def fan_in(spark, sf):
    from obsframe.sources import fan_in as merge
    from workload.views import table

    calls = view(spark, sf, "points").select(F.lit("calls").alias("metric"), "service", "ts", "value")
    http = view(spark, sf, "requests").select(
        F.lit("http").alias("metric"), "ts", F.col("duration_ns").cast("double").alias("value"))
    size = table(spark, sf, "events").select(
        F.lit("size").alias("metric"), F.col("user_id").cast("double").alias("value"), "ts")
    return merge(calls, http, size).select("metric", "service", us("ts"), "value")


@query("s8_sql_gauge", """
  SELECT 'bt.sql_books_count' AS metric, epoch_us(TIMESTAMP '2024-01-31 00:00:00') AS ts_us,
    CAST(count(*) AS DOUBLE) AS value, 'gauge' AS temporality FROM part""")
def sql_gauge(spark, sf):
    from obsframe.sources import sql_gauge as gauge

    view(spark, sf, "books").createOrReplaceTempView("gauge_books")
    out = gauge(spark, "select count(*) as count from gauge_books", fixed.SQL_BOOKS_METRIC, "count", "2024-01-31 00:00:00")
    return out.select("metric", us("ts"), "value", "temporality")
