"""Tables that streams write batch by batch, with a manifest that readers honour.

A micro-batch is written in one pass, all its sinks in one job, to a folder of its own
name; then one small file, its manifest, makes it visible.  A batch that dies between
the two leaves a folder that no reader looks at, and is written anew under another
name.  A batch that is repeated after its manifest was written is left as it is.

    <root>/data/part=<batch>-<attempt>/sink=<name>/   the rows
    <root>/manifest/batch=<n>/                        one row: from, upto, part
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.sources.tables import route_out

_MANIFEST = "first bigint, last bigint, part string"


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the manifest; none before the first batch."""
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def _publish(spark: SparkSession, root: str, first: int, last: int, part: str) -> None:
    row = spark.createDataFrame([(first, last, part)], _MANIFEST)
    row.coalesce(1).write.mode("append").parquet(f"{root}/manifest/batch={last}")


def commit_batch(batch: DataFrame, root: str, batch_id: int, sinks: Mapping[str, Column]) -> None:
    """Write a micro-batch to all its sinks at once; the body of a ``foreachBatch``."""
    spark = batch.sparkSession
    if not _manifest(spark, root).filter(F.col("last") >= batch_id).isEmpty():
        return
    part = f"{batch_id}-{uuid.uuid4().hex}"
    route_out(batch, f"{root}/data/part={part}", sinks)
    _publish(spark, root, batch_id, batch_id, part)


def _current(spark: SparkSession, root: str) -> list:
    """Manifest rows that count: those no larger one covers."""
    rows = sorted(_manifest(spark, root).collect(), key=lambda r: (r["first"], -r["last"]))
    kept: list = []
    for row in rows:
        if not kept or row["last"] > kept[-1]["last"]:
            kept.append(row)
    return kept


def read_committed(spark: SparkSession, root: str, schema: str, sink: str | None = None) -> DataFrame:
    """The rows of all published batches, of one sink or of all with ``sink``.

    The driver reads a row per batch since the last compaction.
    """
    parts = [f"{root}/data/part={row['part']}" for row in _current(spark, root)]
    whole = f"{schema}, part string, sink string"
    if parts:
        rows = spark.read.schema(whole).option("basePath", f"{root}/data").parquet(*parts).drop("part")
    else:
        rows = spark.createDataFrame([], whole).drop("part")
    return rows if sink is None else rows.filter(F.col("sink") == sink).drop("sink")


def compact(spark: SparkSession, root: str, schema: str, files: int = 16) -> int:
    """Rewrite all published batches as one part of ``files`` files per sink at most.

    Returns how many parts it replaced.  Readers go on with the old parts until the one
    row that covers them is published; the old folders can be removed when no reader
    that began before is left.
    """
    held = _current(spark, root)
    if len(held) < 2:
        return 0
    part = f"{held[-1]['last']}-{uuid.uuid4().hex}"
    rows = read_committed(spark, root, schema).repartition(files)
    rows.write.partitionBy("sink").parquet(f"{root}/data/part={part}")
    _publish(spark, root, held[0]["first"], held[-1]["last"], part)
    return len(held)
