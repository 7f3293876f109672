"""Streaming jobs run once over the tables; results are read back as tables."""

from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.operators.series import bound_text
from obsframe.plans.session import configure, fresh_dir
from obsframe.sources import messages as MS
from obsframe.sources import tables as T
from obsframe.streaming import jobs as J
from obsframe import streaming as ST
from workload import flows, series
from workload.registry import ORACLES, query
from workload.spans import _EDGES, _KEYS, _bounds
from workload.views import VIEWS, as_logs, as_records, project, table, us, view, with_views

_V = with_views


#: Micro-batches that a table is read in.
BATCHES = 3
#: Rows of a file, about; what a task of a stream holds grows with them.
FILE_ROWS = 100_000


def arriving(df, spark, by, label):
    """A table as a stream of ``BATCHES`` micro-batches, in the order of an integer column.

    A micro-batch is as many files as its rows need, each a range of the column.
    """
    low, high, held = df.agg(F.min(by), F.max(by), F.count(F.lit(1))).first()
    cuts = [] if low is None else [low + (high + 1 - low) * i // BATCHES for i in range(1, BATCHES)]
    files = max(1, -(-held // (BATCHES * FILE_ROWS)))
    batch = F.lit(0)
    for cut in cuts:
        batch = batch + (F.col(by) >= cut).cast("int")
    path = fresh_dir(spark, label)
    for i in range(BATCHES):  # files are read in the order they were written in
        rows = df.filter(F.coalesce(batch, F.lit(0)) == i)
        rows = rows.coalesce(1) if files == 1 else rows.repartitionByRange(files, by)
        rows.write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def stream_of(spark, sf, name):
    """A view as a stream over its table, in several micro-batches."""
    return project(arriving(table(spark, sf, VIEWS[name][0]), spark, "event_id", f"stream-{name}"), name)


def run_once(df, spark, label):
    """Run a stream over what is there and read its output back."""
    root = fresh_dir(spark, label)
    df.writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/out")


@query("s1_ingestion_stream", _V(["messages"], """
  SELECT key, value, traceparent, topic, part AS partition, off AS "offset", epoch_us(ts) AS timestamp_us FROM messages"""))
def ingestion_stream(spark, sf):
    path = fresh_dir(spark, "topic")
    as_records(view(spark, sf, "messages")).write.parquet(path)
    got = run_once(MS.read_ingestion_stream(spark, "parquet", path=path), spark, "consumed")
    return got.select("key", "value", F.get("headers", F.lit(0))["value"].cast("string").alias("traceparent"),
                      "topic", "partition", "offset", us("timestamp"))


@query("st1_ingestion_job", _V(["messages"], """
  SELECT CASE WHEN bad THEN 'dead' ELSE 'good' END AS sink, event_id,
    CASE WHEN NOT bad THEN CAST(substr(key, 5) AS INT) END AS book_id, CASE WHEN event_id % 19 <> 0 AND event_id % 23 <> 0 THEN split_part(traceparent, '-', 3) END AS linked_span_id
  FROM (SELECT *, event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 AS bad FROM messages)"""))
def ingestion_job(spark, sf):
    root = fresh_dir(spark, "ingest")
    as_records(view(spark, sf, "messages")).write.parquet(f"{root}/topic")
    stream = MS.read_ingestion_stream(spark, "parquet", path=f"{root}/topic")
    J.ingestion_job(stream, f"{root}/out", f"{root}/checkpoint", every=None).awaitTermination()
    event_id = (F.col("offset") * 3 + F.col("partition")).alias("event_id")
    read = lambda name: J.read_ingested(spark, f"{root}/out", name).select(
        F.lit(name).alias("sink"), event_id, "book_id", "linked_span_id")
    return read("good").unionByName(read("dead"))


@query("st2_stream_span_metrics", _V(["spans"], f"""
  SELECT epoch_us(w) AS window_us, {_KEYS}, le, count(*) AS calls, count(*) FILTER (WHERE duration_ns <= le_ns) AS bucket_count,
    CAST(sum(duration_ns) AS DOUBLE) AS sum_ns FROM x CROSS JOIN b GROUP BY ALL""",
    b=_bounds(fixed.SPAN_BOUNDS),
    x="""SELECT *, time_bucket(INTERVAL 1 HOUR, start_ts) AS w FROM spans
      WHERE time_bucket(INTERVAL 1 HOUR, start_ts) + INTERVAL 1 HOUR <= (SELECT max(start_ts) FROM spans) - INTERVAL 10 MINUTE"""))
def stream_span_metrics(spark, sf):
    out = J.stream_span_metrics(stream_of(spark, sf, "spans"), "1 hour", "10 minutes")
    return run_once(out, spark, "spanmetrics").select(
        us("window_start", "window_us"), "service_name", "name", "kind", "status_code",
        bound_text("le").alias("le"), "calls", "bucket_count", "sum_ns")


@query("st3_stream_delta_to_cumulative", ORACLES["w1_delta_out_of_order"])
def stream_delta_to_cumulative(spark, sf):
    late = F.expr("CASE WHEN event_id % 9 = 0 THEN ts - INTERVAL 12 HOUR ELSE ts END")
    points = arriving(table(spark, sf, "events"), spark, "event_id", "deltas").select(
        F.col("event_type").alias("series"), "event_id", late.alias("ts"), (F.col("event_id") % 10).alias("value"))
    out = run_once(ST.stream_delta_to_cumulative(points, ["series"], "event_id"), spark, "totals")
    return out.select("series", us("ts"), "value")


@query("st4_stream_service_edges", _V(["spans"], f"""
  SELECT e.* FROM e JOIN spans c ON c.span_id = e.client_span_id JOIN spans s ON s.span_id = e.server_span_id
  WHERE s.start_ts BETWEEN c.start_ts - INTERVAL 10 MINUTE AND c.start_ts + INTERVAL 10 MINUTE""", e=_EDGES))
def stream_service_edges(spark, sf):
    out = J.stream_service_edges(stream_of(spark, sf, "spans"), "10 minutes", "1 minute")
    return run_once(out, spark, "edges").drop("client_ts", "server_ts")


def _alerts(spark, values, **options):
    numbered = values.withColumns({"rule": F.lit("Error rate"), "t_us": F.unix_micros("t")})
    path = fresh_dir(spark, "values")
    numbered.write.parquet(path)
    held = spark.read.schema(numbered.schema).parquet(path)
    stream = arriving(held, spark, "t_us", "values-in-order")
    out = run_once(ST.stream_alerts(stream, 0.012, "2 hours", "1 hour", **options), spark, "alerts")
    return out.select(us("t"), "value", "state", us("since"))


@query("st5_stream_alerts", ORACLES["w7_alert_states"])
def stream_alerts(spark, sf):
    return _alerts(spark, series._error_rate(spark, sf))


@query("st5_stream_alerts_range", ORACLES["w7_alert_states_range"])
def stream_alerts_range(spark, sf):
    return _alerts(spark, series._gappy_rate(spark, sf), lookback="3 hours")


_SEEN = "(SELECT epoch_ms(max(start_ts)) * 1000 - 600000000 FROM spans)"


@query("st7_stream_error_alert", _V(["spans"], series._STATES,
    totals=flows._TOTALS, f=flows._FAILED, **flows._RATES, v=flows._V_OF_RATES,
    grid=f"SELECT unnest(generate_series((SELECT min(t_us) FROM v), {_SEEN}, {series._HOUR})) AS t_us",
    q=series.reduced(0.0002), b=series._STREAKS))
def stream_error_alert(spark, sf):
    states = ST.stream_error_alert(
        stream_of(spark, sf, "spans"), "bookapp", "1 hour", "6 hours", "1 hour", 0.0002, "2 hours",
        lookback="3 hours", delay="10 minutes")
    out = run_once(states, spark, "error-alert")
    return out.select(us("t"), F.round("value", 9).alias("value"), "state", us("since"))


@query("st6_stream_logs", _V(["logs"], r"""
  SELECT 'count' AS what, epoch_us(w) AS window_us,
    coalesce(nullif(regexp_extract(name, '^(?:event\s+)?([^\s:]+):(\d+)', 1), ''), 'unspecified_file_path') AS file_path, count(*) AS logs
  FROM x WHERE w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM logs) - INTERVAL 10 MINUTE GROUP BY ALL
  UNION ALL SELECT 'stored', epoch_us(date_trunc('day', ts)), NULL, count(*) FROM logs GROUP BY ALL""",
    x="SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS w FROM logs"))
def stream_logs(spark, sf):
    root = fresh_dir(spark, "logstream")
    for running in J.stream_logs(as_logs(stream_of(spark, sf, "logs")), f"{root}/out", f"{root}/checkpoint",
                                 "1 hour", "10 minutes", every=None):
        running.awaitTermination()
    counts = spark.read.parquet(f"{root}/out/counts").select(
        F.lit("count").alias("what"), us("window_start", "window_us"), "file_path", "logs")
    stored = spark.read.parquet(f"{root}/out/logs").groupBy("date").agg(F.count(F.lit(1)).alias("logs"))
    return counts.unionByName(stored.select(
        F.lit("stored").alias("what"), F.unix_micros(F.col("date").cast("timestamp")).alias("window_us"),
        F.lit(None).cast("string").alias("file_path"), "logs"))


@query("s7_stream_signal", _V(["spans"], """
  SELECT CAST(CAST(start_ts AS DATE) AS VARCHAR) AS date, count(*) AS spans FROM spans GROUP BY 1"""))
def stream_signal(spark, sf):
    root = fresh_dir(spark, "signal")
    writer = T.stream_signal(stream_of(spark, sf, "spans"), "traces", f"{root}/out", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("spans"))
