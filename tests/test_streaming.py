"""Streams over several micro-batches equal the batch operators."""

import pytest
from pyspark.sql import functions as F

from obsframe.operators import series as S
from obsframe.operators import servicegraph as G
from obsframe.operators import spanmetrics as M
from obsframe.operators.alerts import alert_states
from obsframe.plans import lifecycles as P
from obsframe.plans.session import fresh_dir
from obsframe.sources import fan_out, read_ingestion_stream, stream_signal, write_ingestion, write_signal
from obsframe.streaming import (
    ingestion_job,
    stream_alerts,
    stream_delta_to_cumulative,
    stream_error_alert,
    stream_logs,
    stream_service_edges,
    stream_span_metrics,
)
from obsframe.streaming import alerts as A
from obsframe.streaming import batches as B
from obsframe.streaming import commit_batch, compact, read_committed, read_ingested
from workload import QUERIES, streams
from workload.views import as_logs, as_records, view

MIN = 60_000_000


class Feed:
    """A folder that is given one file per micro-batch."""

    def __init__(self, spark, label, schema):
        self.spark, self.path, self.schema = spark, fresh_dir(spark, label), schema

    def add(self, df):
        df.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def drain(df, root):
    df.writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/cp").trigger(availableNow=True).start().awaitTermination()


def slices(df, n, key="event_id"):
    top = df.agg(F.max(key)).first()[0] + 1
    return [df.filter((F.col(key) >= i * top // n) & (F.col(key) < (i + 1) * top // n)) for i in range(n)]


@pytest.fixture(scope="module")
def spans(spark, sf_dir):
    return view(spark, sf_dir, "spans")


def test_span_metrics_equal_batch_and_late_spans_are_dropped(spark, spans):
    feed, root = Feed(spark, "spans", spans.schema), fresh_dir(spark, "st2")
    for part in slices(spans, 4):
        feed.add(part)
        drain(stream_span_metrics(feed.stream(), "1 hour", "10 minutes"), root)
    late = spans.limit(5)
    feed.add(late)
    drain(stream_span_metrics(feed.stream(), "1 hour", "10 minutes"), root)
    got = spark.read.parquet(f"{root}/out")
    end = got.agg(F.max("window_start")).first()[0]
    want = M.span_latency(spans, window="1 hour").filter(F.col("window_start") <= end)
    cols = ["window_start", "service_name", "name", "kind", "status_code", "le", "bucket_count", "count", "sum_ns"]
    assert got.count() == want.count() > 0
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert got.filter("calls <> count").count() == 0


@pytest.mark.parametrize("cuts", [(1,), (2, 3), (1, 2, 3, 4, 5, 6)])
def test_totals_do_not_know_micro_batches(spark, sf_dir, cuts):
    """The same points, cut in different ways and with restarts, late ones among them."""
    late = F.expr("CASE WHEN event_id % 9 = 0 THEN ts - INTERVAL 3 HOUR WHEN event_id % 50 = 1 THEN NULL ELSE ts END")
    points = view(spark, sf_dir, "points").select(
        "event_id", F.when(F.col("event_id") % 4 > 0, F.col("series")).alias("series"), late.alias("ts"),
        F.when(F.col("event_id") % 5 > 0, F.col("event_id") % 100).cast("double").alias("value"))
    feed, root = Feed(spark, "points", points.schema), fresh_dir(spark, "st3")
    parts = slices(points, 7)
    bounds = [0, *cuts, len(parts)]
    for low, high in zip(bounds, bounds[1:]):
        for part in parts[low:high]:
            feed.add(part.orderBy(F.desc("value")))
        drain(stream_delta_to_cumulative(feed.stream(), ["series"], "event_id"), root)
    got = spark.read.parquet(f"{root}/out")
    want = S.delta_to_cumulative(points.filter("ts is not null"), ["series"], arrival="event_id")
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    assert want.count() < points.filter("ts is not null").count()


def test_state_grows_with_series_only(spark, sf_dir):
    points = view(spark, sf_dir, "points")
    feed, root = Feed(spark, "points", points.schema), fresh_dir(spark, "st3")
    for part in slices(points, 3):
        feed.add(part)
    out = stream_delta_to_cumulative(feed.stream(), ["series"], "event_id")
    query = out.writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    series = points.select("series").distinct().count()
    assert [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["numInputRows"]] == [series] * 3
    assert query.recentProgress[0]["stateOperators"][0]["operatorName"] == "transformWithStateInPandasExec"


def test_edges_pair_across_batches_and_expire(spark):
    schema = ("trace_id string, span_id string, parent_span_id string, service_name string, kind string, "
              "status_code string, start_ts timestamp, duration_ns bigint")
    def row(trace, span, parent, kind, us):
        return (trace, span, parent, f"svc-{kind[10:]}", kind, None, 1_700_000_000_000_000 + us, 5)
    client, server = "SPAN_KIND_CLIENT", "SPAN_KIND_SERVER"
    batches = [
        [row("t1", "c1", None, client, 0), row("t2", "s2", "c2", server, 1_000_000)],
        [row("t1", "s1", "c1", server, 3_000_000), row("t2", "c2", None, client, 500_000), row("t1", "c1", None, client, 0)],
        [row("t3", "c3", None, client, 600_000_000), row("t1", "s9", "c1", server, 300_000_000)],
    ]
    frames = [spark.createDataFrame(b, schema.replace("start_ts timestamp", "us bigint")).withColumn(
        "start_ts", F.timestamp_micros("us")).drop("us") for b in batches]
    feed, root = Feed(spark, "edges", frames[0].schema), fresh_dir(spark, "st4")
    for frame in frames:
        feed.add(frame)
        drain(stream_service_edges(feed.stream(), "10 seconds", "5 seconds"), root)
    got = sorted(r.server_span_id for r in spark.read.parquet(f"{root}/out").collect())
    assert got == ["s1", "s2"]
    everything = frames[0].unionByName(frames[1]).unionByName(frames[2])
    assert sorted(r.server_span_id for r in G.service_edges(everything).collect()) == ["s1", "s2", "s9"]


def test_alert_states_continue_across_batches(spark):
    values = [1, 11, 12, 3, 11, None, 11, 11, 11, 2]
    rows = [("r", i * MIN, None if v is None else float(v)) for i, v in enumerate(values, 1) if i != 8] + [
        ("q", i * MIN, 11.0) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "rule string, us bigint, value double").withColumn("t", F.timestamp_micros("us"))
    feed, root = Feed(spark, "values", df.schema), fresh_dir(spark, "st5")
    for lo, hi in ((1, 4), (4, 7), (7, 11), (3, 5)):
        feed.add(df.filter((F.col("us") >= lo * MIN) & (F.col("us") < hi * MIN)))
        drain(stream_alerts(feed.stream()), root)
    got = spark.read.parquet(f"{root}/out")
    want = alert_states(df, ["rule"]).select("rule", "t", "value", "state", "since")
    assert got.count() == want.count() == 20
    assert got.exceptAll(want).count() == 0


@pytest.mark.parametrize("lookback, piece", [(None, 1 << 15), ("3 minutes", 1 << 15), ("3 minutes", 4), ("2 hours", 7)])
def test_silence_and_gaps(spark, monkeypatch, lookback, piece):
    """An hour of silence of one rule while another goes on; failures, NULL and NaN values."""
    monkeypatch.setattr(A, "_PIECE", piece)
    nan = float("nan")
    r = [(1, 11.0, False), (2, 12.0, False), (4, 13.0, False), (5, 14.0, True), (6, 14.0, False), (8, None, False),
         (9, nan, False), (10, 20.0, False), (70, 11.0, False), (71, 11.0, None), (73, 1.0, False)]
    rows = [("r", m * MIN, v, f) for m, v, f in r] + [(None, m * MIN, 30.0 if m % 9 else 1.0, False) for m in range(1, 81, 2)]
    df = spark.createDataFrame(rows, "rule string, us bigint, value double, failed boolean").withColumn(
        "t", F.timestamp_micros("us"))
    feed, root = Feed(spark, "values", df.schema), fresh_dir(spark, "st5")
    for lo, hi in ((1, 5), (5, 9), (9, 40), (40, 60), (60, 72), (72, 81)):
        feed.add(df.filter((F.col("us") >= lo * MIN) & (F.col("us") < hi * MIN)))
    options = dict(failed="failed", lookback=lookback)
    drain(stream_alerts(feed.stream(), **options), root)
    got = spark.read.parquet(f"{root}/out")
    end = F.timestamp_micros(F.lit(79 * MIN))
    want = alert_states(df, ["rule"], until=end, **options).select("rule", "t", "value", "state", "since")
    assert got.count() == want.count() == 2 * 79
    assert got.exceptAll(want).count() == 0
    silent = got.filter(f"rule = 'r' and t > timestamp_micros({11 * MIN}) and t < timestamp_micros({70 * MIN})")
    states = {x.state: x["count"] for x in silent.groupBy("state").count().collect()}
    assert states == ({"NoData": 58} if lookback is None else {"Alerting": 1, "NoData": 57} if lookback == "3 minutes" else {"Alerting": 58})


def test_values_within_the_delay_are_in_time(spark):
    df = spark.createDataFrame([("r", m * MIN, float(m % 13)) for m in range(1, 41)], "rule string, us bigint, value double").withColumn(
        "t", F.timestamp_micros("us"))
    out = []
    for order in ([0, 1, 2, 3], [1, 0, 3, 2]):
        feed, root = Feed(spark, "values", df.schema), fresh_dir(spark, "st5")
        for i in order:
            feed.add(df.filter((F.col("us") > i * 10 * MIN) & (F.col("us") <= (i + 1) * 10 * MIN)))
        drain(stream_alerts(feed.stream(), 5.0, delay="20 minutes"), root)
        out.append(sorted(map(str, spark.read.parquet(f"{root}/out").collect())))
    want = alert_states(df, ["rule"], 5.0).filter(F.col("t") <= F.timestamp_micros(F.lit(20 * MIN)))
    assert out[0] == out[1] == sorted(map(str, want.select("rule", "t", "value", "state", "since").collect()))


def test_alert_of_a_span_stream(spark, spans):
    feed, root = Feed(spark, "spans", spans.schema), fresh_dir(spark, "st7")
    settings = dict(window="1 hour", rate_window="6 hours", step="1 hour", threshold=0.0002, for_="2 hours", lookback="3 hours")
    for part in slices(spans, 4):
        feed.add(part)
        drain(stream_error_alert(feed.stream(), None, delay="10 minutes", **settings), root)
    got = spark.read.parquet(f"{root}/out").withColumn("value", F.round("value", 9))
    columns = ["t", "value", "state", "since"]
    end = F.lit(spans.agg(F.max("start_ts")).first()[0]) - F.expr("INTERVAL 10 MINUTES")
    services = [r.service_name for r in got.select("service_name").distinct().collect()]
    assert services
    for service in services:
        rates = P.span_error_rate(spans, service, "1 hour", "6 hours", "1 hour")
        want = alert_states(rates, (), 0.0002, "2 hours", "1 hour", lookback="3 hours", until=end).filter(
            F.col("t") <= end).withColumn("value", F.round("value", 9))
        mine = got.filter(F.col("service_name") == service)
        assert mine.count() == want.count() > 0 and mine.select(columns).exceptAll(want.select(columns)).count() == 0
        batch = P.error_alert(spans, service, **settings).withColumn("value", F.round("value", 9)).filter(F.col("t") <= end)
        assert batch.select(columns).exceptAll(mine.select(columns)).count() == 0


def test_logs_are_stored_and_counted(spark, sf_dir):
    logs = as_logs(view(spark, sf_dir, "logs"))
    feed, root = Feed(spark, "logs", logs.schema), fresh_dir(spark, "st6")
    for part in slices(logs, 2):
        feed.add(part)
    for query in stream_logs(feed.stream(), f"{root}/out", f"{root}/cp", "1 hour", "10 minutes", every=None):
        query.awaitTermination()
    stored = spark.read.parquet(f"{root}/out/logs")
    assert stored.count() == logs.count() and "date" in stored.columns
    counts = spark.read.parquet(f"{root}/out/counts")
    from obsframe.operators.attributes import process_logs

    end = counts.agg(F.max("window_start")).first()[0]
    want = M.log_count(process_logs(logs), "1 hour").filter(F.col("window_start") <= end)
    assert counts.count() == want.count()
    assert counts.select("window_start", "file_path", "logs").exceptAll(want).count() == 0


def test_ingestion_job(spark, sf_dir):
    root = fresh_dir(spark, "st1")
    records = as_records(view(spark, sf_dir, "messages"))
    write_ingestion(records, "parquet", path=f"{root}/topic")
    assert read_ingested(spark, f"{root}/out", "good").count() == 0
    for _ in range(2):
        stream = read_ingestion_stream(spark, "parquet", path=f"{root}/topic")
        ingestion_job(stream, f"{root}/out", f"{root}/cp", every=None).awaitTermination()
    good, dead = (read_ingested(spark, f"{root}/out", sink) for sink in ("good", "dead"))
    assert good.count() + dead.count() == records.count() and dead.count() > 0
    assert good.filter("book_id is null").count() == 0 and dead.filter("error is null").count() == 0
    assert good.schema["headers"].dataType == records.schema["headers"].dataType


def test_a_batch_is_seen_in_all_sinks_or_in_none(spark, monkeypatch):
    root, rows = fresh_dir(spark, "sinks"), spark.range(100)
    sinks = {"all": F.lit(True), "even": F.col("id") % 2 == 0}
    read = lambda sink=None: read_committed(spark, root, "id bigint", sink)
    assert read("all").count() == 0
    commit_batch(rows, root, 0, sinks)
    commit_batch(rows, root, 0, sinks)  # repeated after it was published
    assert (read("all").count(), read("even").count(), read().count()) == (100, 50, 150)
    publish = B._publish

    def killed(*args):
        raise RuntimeError("killed")
    monkeypatch.setattr(B, "_publish", killed)
    with pytest.raises(RuntimeError):
        commit_batch(rows, root, 1, sinks)
    assert (read("all").count(), read("even").count()) == (100, 50)
    monkeypatch.setattr(B, "_publish", publish)
    commit_batch(rows, root, 1, sinks)  # the retry
    commit_batch(rows.filter("id < 10"), root, 2, sinks)
    before = sorted(map(tuple, read().collect()))
    monkeypatch.setattr(B, "_publish", killed)
    with pytest.raises(RuntimeError):
        compact(spark, root, "id bigint")
    assert sorted(map(tuple, read().collect())) == before
    monkeypatch.setattr(B, "_publish", publish)
    assert compact(spark, root, "id bigint", files=2) == 3 and compact(spark, root, "id bigint") == 0
    assert sorted(map(tuple, read().collect())) == before and len(read().inputFiles()) <= 4
    commit_batch(rows, root, 1, sinks)  # covered by the compaction
    commit_batch(rows, root, 3, sinks)
    assert read("all").count() == 310


def test_a_trace_is_found_without_reading_the_others(spark, spans):
    path = fresh_dir(spark, "store")
    many = spans.withColumns({"start_ts": F.lit("2024-01-01").cast("timestamp"), "trace_id": F.md5("span_id")}).unionByName(
        spans.limit(20).withColumns({"start_ts": F.lit("2024-01-02").cast("timestamp"), "trace_id": F.lit(None).cast("string")}))
    write_signal(many.repartition(40), "traces", path, files_per_day=8)
    files = spark.read.parquet(path).select("date", F.input_file_name().alias("f")).distinct().groupBy("date").count().collect()
    assert all(r["count"] <= 8 for r in files) and len(files) == 2
    total = spark.read.parquet(path).count()
    assert total == many.count()
    wanted = many.first().trace_id
    found = spark.read.parquet(path).filter(F.col("trace_id") == wanted).select("span_id")
    assert len(found.collect()) == 1
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() < total / 2


def test_sinks_receive_each_row_once(spark, spans):
    a, b = fresh_dir(spark, "a"), fresh_dir(spark, "b")
    fan_out(spans, {"a": lambda df: write_signal(df, "traces", a), "b": lambda df: df.write.parquet(b)})
    for path in (a, b):
        read = spark.read.parquet(path)
        assert read.count() == read.select("event_id").distinct().count() == spans.count()


def test_signal_stream_flushes_every_ten_seconds(spark, spans):
    feed, root = Feed(spark, "sig", spans.schema), fresh_dir(spark, "s7")
    feed.add(spans)
    query = stream_signal(feed.stream(), "traces", f"{root}/out", f"{root}/cp").start()
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{root}/out").count() == spans.count()


def test_a_table_arrives_in_files_of_bounded_size(spark):
    table = spark.range(900_000).withColumnRenamed("id", "event_id")
    stream, root = streams.arriving(table, spark, "event_id", "arriving"), fresh_dir(spark, "arrived")
    batches = []

    def seen(batch, n):
        batches.append([(r.low, r.high, r.rows) for r in batch.groupBy(F.col("_metadata.file_path")).agg(
            F.min("event_id").alias("low"), F.max("event_id").alias("high"), F.count("*").alias("rows")).collect()])

    stream.select("event_id", "_metadata").writeStream.foreachBatch(seen).option("checkpointLocation", root).trigger(
        availableNow=True).start().awaitTermination()
    assert [sum(f[2] for f in files) for files in batches] == [300_000] * 3
    assert max(f[2] for files in batches for f in files) < 2 * streams.FILE_ROWS
    assert [(min(f[0] for f in files), max(f[1] for f in files)) for files in batches] == [
        (i * 300_000, (i + 1) * 300_000 - 1) for i in range(3)]


@pytest.mark.parametrize("name", ["st3_stream_delta_to_cumulative", "st6_stream_logs"])
def test_streams_of_many_files_equal_those_of_one(spark, sf_dir, monkeypatch, name):
    one = sorted(map(str, QUERIES[name](spark, sf_dir).collect()))
    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    assert sorted(map(str, QUERIES[name](spark, sf_dir).collect())) == one
