"""Relational table scans, gauges from SQL, signal sinks, fan-in and fan-out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from obsframe import schemas

TABLES = {"books": schemas.BOOKS, "error_injection_config": schemas.CONFIGS}
EVENT_TIME = {"traces": "start_ts", "logs": "ts", "metrics": "ts"}


def read_table(spark: SparkSession, name: str, fmt: str = "parquet", **options) -> DataFrame:
    """Scan a catalogue table.

    ``fmt='jdbc'`` reads in parallel ranges of ``id`` when ``lowerBound``,
    ``upperBound`` and ``numPartitions`` are given.
    """
    columns = TABLES[name].fieldNames() if name in TABLES else None
    if fmt == "jdbc":
        options = {"dbtable": name, **options}
        if "numPartitions" in options:
            options.setdefault("partitionColumn", "id")
        df = spark.read.format("jdbc").options(**options).load()
    else:
        path = options.pop("path")
        df = spark.read.format(fmt).options(**options).load(path)
    return df.select(*[c for c in columns if c in df.columns]) if columns else df


def sql_gauge(spark: SparkSession, sql: str, metric: str, value_column: str, ts) -> DataFrame:
    """Run a SQL text and emit each row's value column as a gauge point."""
    ts = ts if isinstance(ts, Column) else F.lit(ts).cast("timestamp")
    empty = F.expr("cast(map() as map<string,string>)")
    return spark.sql(sql).select(
        F.lit(metric).alias("metric"),
        empty.alias("labels"),
        ts.alias("ts"),
        F.col(value_column).cast("double").alias("value"),
        F.lit("gauge").alias("temporality"),
        empty.alias("resource"),
    )


def dated(df: DataFrame, signal: str) -> DataFrame:
    return df.withColumn("date", F.to_date(EVENT_TIME[signal]))


#: The column a stored signal is looked up by.
LOOKUP = {"traces": "trace_id", "logs": "trace_id", "metrics": "metric"}


def clustered(df: DataFrame, signal: str, files_per_day: int) -> DataFrame:
    """Rows of a day in at most ``files_per_day`` tasks, by the lookup column and sorted by it.

    All rows of a trace and day meet in one file.  Rows without a lookup value are dealt
    by their time.
    """
    key, ts = LOOKUP[signal], EVENT_TIME[signal]
    salt = F.pmod(F.coalesce(F.xxhash64(F.col(key)), F.lit(0)), F.lit(files_per_day))
    salt = F.when(F.col(key).isNotNull(), salt).otherwise(F.pmod(F.xxhash64(ts), F.lit(files_per_day)))
    days = dated(df, signal).withColumn("_salt", salt)
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), files_per_day)
    return days.repartition(tasks, "date", "_salt").sortWithinPartitions("date", "_salt", key).drop("_salt")


def write_signal(
    df: DataFrame,
    signal: str,
    path: str,
    fmt: str = "parquet",
    mode: str = "append",
    files_per_day: int = 16,
    distinct: int = 1_000_000,
) -> None:
    """Store one signal, partitioned by the day of its event time, for lookups by trace.

    A write adds at most ``files_per_day`` files to a day, however many tasks read its
    input.  Each is sorted by the lookup column and has a Parquet bloom filter on it,
    for about ``distinct`` values a row group; so a search for one trace reads the
    row groups that hold it.  One write's day is as many tasks: choose more for days
    that do not fit them.
    """
    key = LOOKUP[signal]
    writer = clustered(df, signal, files_per_day).write.partitionBy("date").mode(mode).format(fmt)
    if fmt == "parquet":
        writer = writer.options(**{
            f"parquet.bloom.filter.enabled#{key}": "true",
            f"parquet.bloom.filter.expected.ndv#{key}": str(distinct),
        })
    writer.save(path)


def stream_signal(
    df: DataFrame, signal: str, path: str, checkpoint: str, flush: str = "10 seconds", fmt: str = "parquet"
) -> DataStreamWriter:
    """Streaming form of :func:`write_signal`, flushed on an interval."""
    return (
        dated(df, signal)
        .writeStream.partitionBy("date")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=flush)
    )


def fan_in(*points: DataFrame) -> DataFrame:
    """Merge point sources; columns a source lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), points)


def route_out(batch: DataFrame, path: str, sinks: Mapping[str, Column], mode: str = "errorifexists") -> None:
    """Write each row to all sinks whose condition holds, in one pass and one job.

    The sinks are folders ``sink=<name>`` of one table: nothing is kept between them.
    """
    names = F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, holds in sinks.items()]))
    batch.withColumn("sink", F.explode(names)).write.partitionBy("sink").mode(mode).parquet(path)


def fan_out(batch: DataFrame, sinks: Mapping[str, Callable[[DataFrame], None]]) -> None:
    """Hand one batch to several sinks of any kind, computing it once.

    Tables are better served by ``route_out``, which keeps nothing.  Usable as the body of ``foreachBatch``.  The batch is kept on executor disks
    only while the sinks run; a lost block is recomputed.
    """
    kept = batch.persist(StorageLevel.DISK_ONLY) if len(sinks) > 1 else batch
    try:
        for sink in sinks.values():
            sink(kept)
    finally:
        if len(sinks) > 1:
            kept.unpersist()
