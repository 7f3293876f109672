"""Queue metrics and the spans of the ingestion consumer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsframe import fixed, schemas
from obsframe.functions.bags import empty_bag


def topic_metrics(records: DataFrame) -> DataFrame:
    """Per topic and partition: oldest and current offset, and messages held."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("oldest_offset"),
        (F.max("offset") + 1).alias("current_offset"),
        F.count(F.lit(1)).alias("messages"),
    )


def topic_partitions(records: DataFrame) -> DataFrame:
    """Number of partitions of each topic that hold messages."""
    held = topic_metrics(records)
    return held.groupBy("topic").agg(F.count(F.lit(1)).alias("partitions"))


def consumer_lag(records: DataFrame, commits: DataFrame) -> DataFrame:
    """Per group, topic and partition: consumer offset, lag, and the group's lag sum.

    ``commits`` has (group, topic, partition, offset) with the next offset to read.
    A group that never committed on a partition has no offset there and lags by all
    the partition holds.
    """
    held = topic_metrics(records)
    latest = commits.groupBy("group", "topic", "partition").agg(F.max("offset").alias("consumer_offset"))
    subscribed = latest.select("group", "topic").distinct()
    lag = (
        subscribed.join(held, "topic")
        .join(latest, ["group", "topic", "partition"], "left")
        .withColumn(
            "lag",
            F.greatest(
                F.col("current_offset") - F.coalesce("consumer_offset", "oldest_offset"), F.lit(0)
            ),
        )
    )
    whole = W.partitionBy("group", "topic")
    return lag.withColumn("lag_sum", F.sum("lag").over(whole)).select(
        "group", "topic", "partition", "current_offset", "consumer_offset", "lag", "lag_sum"
    )


def consumer_spans(
    parsed: DataFrame, service: str = fixed.SERVICE, attribute: tuple[str, str] = fixed.LINK_ATTRIBUTE
) -> DataFrame:
    """Root span of each consumed message, linked to the producer's span context.

    The link carries one ``attribute``; a message without a valid context has no link.
    """
    identity = F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    link = F.struct(
        F.col("linked_trace_id").alias("trace_id"),
        F.col("linked_span_id").alias("span_id"),
        F.create_map(*[F.lit(part) for part in attribute]).alias("attributes"),
    )
    no_links = F.array().cast(f"array<{schemas.SPAN_LINK.simpleString()}>")
    return parsed.select(
        F.md5(F.concat(F.lit("consume:"), identity)).alias("trace_id"),
        F.substring(F.md5(F.concat(F.lit("consume-span:"), identity)), 1, 16).alias("span_id"),
        F.lit(None).cast("string").alias("parent_span_id"),
        F.lit(service).alias("service_name"),
        F.lit(fixed.INGESTION_TOPIC).alias("name"),
        F.lit("SPAN_KIND_CONSUMER").alias("kind"),
        F.when(F.col("error").isNotNull(), "STATUS_CODE_ERROR").otherwise("STATUS_CODE_UNSET").alias("status_code"),
        F.col("timestamp").alias("start_ts"),
        F.when(F.col("linked_span_id").isNotNull(), F.array(link)).otherwise(no_links).alias("links"),
    )
