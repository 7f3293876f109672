"""The ordered and joining operators on tables where one key holds over a third of the rows."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from obsframe.plans.session import fresh_dir
from tests.test_oracle import _rows
from workload import ORACLES, QUERIES

NAMES = sorted(
    n for n in QUERIES if re.match(r"(w\d|a4|a8|a10|a11|a12|a13|a14|a16|j4|j6|j7|j9|p17)", n)
)


@pytest.fixture(scope="module")
def hot_dir(spark, sf_dir):
    root = fresh_dir(spark, "hot")
    hot = lambda key, c, v: F.when(F.col(key) % 5 < 2, F.lit(v)).otherwise(F.col(c)).alias(c)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.select(
        "event_id", "ts", hot("event_id", "user_id", 1).cast("bigint").alias("user_id"),
        hot("event_id", "event_type", "error"), hot("event_id", "value", 5.0), "props",
    ).coalesce(1).write.parquet(f"{root}/events.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    custkey = F.when(F.col("o_orderkey") % 5 < 2, 7).otherwise(F.col("o_custkey")).cast("bigint")
    orders.withColumn("o_custkey", custkey).coalesce(1).write.parquet(f"{root}/orders.parquet")
    spark.read.parquet(f"{sf_dir}/part.parquet").coalesce(1).write.parquet(f"{root}/part.parquet")
    return root


@pytest.fixture(scope="module")
def duck(hot_dir):
    con = duckdb.connect()
    for name in ("events", "orders", "part"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{hot_dir}/{name}.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_change_no_result(spark, hot_dir, duck, name):
    df = QUERIES[name](spark, hot_dir)
    cursor = duck.execute(ORACLES[name])
    assert _rows(df.columns, df.collect()) == _rows([d[0] for d in cursor.description], cursor.fetchall())
