"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import dealt_ranges as ranged
from ..session import find_package, materialize

#: Runs of what separates words: space and \x09-\x0D.
SPACES = r"[\x20\x09-\x0D]+"
#: Largest table that is broadcast, in rows of a few numbers each (checked by a count).
BROADCAST_ROWS = 20_000
#: Rows of text per Arrow batch handed to Python.
TEXT_ROWS_PER_BATCH = 1_000
#: Whether a query's shuffle files are removed when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Key of the one row with a null id, where no id repeats.
NO_ID = 2**63 - 1


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Settings of the operators with Python tasks.

    Arrow batches of whole texts are kept small (memory follows the batch, not the partition), and
    workers find this package where the driver has it, whatever their working folder.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS_PER_BATCH))
    find_package(spark)


def whole_numbers(values: Iterable) -> pd.arrays.IntegerArray:
    """Ids, given as int, str or None, as nullable 64-bit integers; pandas by itself would make them floats beside a null."""
    return pd.array([None if v is None or v is pd.NA else int(v) for v in values], "Int64")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also when the body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of the maximal runs of non-separator characters; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != F.lit(""))


def small_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join with a written table; broadcast only if a count shows it within ``BROADCAST_ROWS``.

    Beyond the bound the small side is repeated over 64 salts, so that a hot
    key of the big side is spread over as many tasks.
    """
    if small.count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), keys, how)
    salts = 64
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int"))
    return dealt.join(salted, [*keys, "_salt"], how).drop("_salt")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write under the shared folder and read back: cuts lineage and survives lost executors.

    The shuffle files of the write go when it ends.  By default they stay until the driver happens to collect its garbage, and
    those of many writes together are several times the input.
    """
    conf = df.sparkSession.conf
    was = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return materialize(df, name)
    finally:
        conf.unset(SHUFFLE_CLEANUP) if was is None else conf.set(SHUFFLE_CLEANUP, was)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """``docs`` with ``_key``, and whether ids repeat (null ids too).

    Rows equal in id and text share a key, all others have different ones; keys
    are in order of (id, text digest), null ids last.  Where no id repeats
    the id is the key; else the distinct (id, digest) are dealt into ranges and numbered.
    """
    one = F.col(id_col).cast("long")
    plain = F.coalesce(one, F.lit(NO_ID))
    times = docs.select(plain.alias("_id")).groupBy("_id").agg(F.count(F.lit(1)).alias("n"))
    if not times.where("n > 1").limit(1).count():
        return docs.withColumn("_key", plain), False
    place = ["_none", "_id", "_digest"]
    marked = (docs.withColumn("_none", one.isNull()).withColumn("_id", plain)
              .withColumn("_digest", F.coalesce(F.md5(F.col(text_col)), F.lit(""))))
    ranged = written(marked.select(*place).distinct().repartitionByRange(*place).withColumn("_part", F.spark_partition_id()), "key-ranges")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))  # a row per range
    below = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(below, F.lit(0)).alias("_below"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*place))
    numbered = ranged.withColumn("_at", inside).join(starts, "_part").select(*place, (F.col("_below") + F.col("_at")).alias("_key"))
    return marked.join(written(numbered, "keys"), place).drop(*place), True


def one_of_each(rows: DataFrame, repeated: bool, text: Column) -> DataFrame:
    """(id, text) of each key of ``keyed`` rows, once."""
    own = rows.select(F.col("_key").alias("id"), text.alias("text"))
    return own.dropDuplicates(["id"]) if repeated else own


def doc_ids(rows: DataFrame, id_col: str) -> DataFrame:
    """(id, doc_id): the key and the id of each ``keyed`` row."""
    return rows.select(F.col("_key").alias("id"), F.col(id_col).cast("long").alias("doc_id"))


def earlier_ranges(column: str, groups: list[str]) -> Column:
    """Sum of ``column`` over the ranges of the same group that come before."""
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0)).cast("long")


def numbered(rows: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` (a written table) with ``at``: the place of each row in its group by ``order``, from 0.

    Rows are dealt into sorted ranges and numbered there, so no group need meet in one
    task; a group's ranges are then counted (a row for each range it is in).  ``groups`` are never null.
    """
    placed = ranged(rows, [*groups, *order], name)
    runs = placed.groupBy(*groups, "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    starts = runs.withColumn("_before", earlier_ranges("_n", groups)).drop("_n")
    at = F.col("_before") + F.col("_place") - F.col("_first")
    return placed.join(starts, [*groups, "_range"]).withColumn("at", at).drop("_range", "_place", "_first", "_before")
