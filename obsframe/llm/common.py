"""Word rules, table readers and the shared-folder tables of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.plans.session import configure, fresh_dir

#: A word is a run of characters other than these six (space, \t, \n, \v, \f, \r).
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, read with the settings that the operators count on."""
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the cluster's shared folder and read back, which cuts the lineage.

    A lost executor then costs a re-read of one file, never a re-run. The folder is that of
    ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def set_aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table with all but the needed columns under generated names, and how to give them back.

    So no column that comes along can clash with one that an operator adds.
    """
    names = [c if c in needed else f"_carried_{i}" for i, c in enumerate(docs.columns)]
    given = list(docs.columns)
    return docs.toDF(*names), lambda df: df.select(*[F.col(n).alias(c) for n, c in zip(names, given)])


def words(text: Column) -> Column:
    """The words of a text, in order; none for NULL."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def word_count(text: Column) -> Column:
    """BIGINT number of words; 0 for NULL. Counts the words' first characters."""
    starts = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return starts.cast("bigint")


def deleted_count(text: Column, characters: str) -> Column:
    """BIGINT number of the given characters in a non-NULL text."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("bigint")


def in_batches(df: DataFrame, rows: int = 2048) -> DataFrame:
    """Bound the rows that one Arrow batch hands to Python, as texts may be long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df
