"""Table scans and the mapping of the driver's tables onto the domain schema.

``equipment_master`` and ``sensor_readings`` are the two inputs every
operator takes.  In production they are stored tables (readings partitioned
by date, see ``sinks.append_batch``); on the test data they are derived from
``supplier``/``nation``/``lineitem`` by the deterministic mapping below, which
DuckDB reproduces in ``gearwatch.oracle`` row for row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField,
                               StructType, TimestampType)

from .. import config as C

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

EQUIPMENT_SCHEMA = StructType([
    StructField("equipment_id", StringType()),
    StructField("equipment_name", StringType()),
    StructField("line", StringType()),
    StructField("criticality", StringType()),
    StructField("operating_hours", IntegerType()),
])

READINGS_SCHEMA = StructType([
    StructField("equipment_id", StringType()),
    StructField("timestamp", TimestampType()),
    StructField("vibration_rms", DoubleType()),
    StructField("temperature_c", DoubleType()),
    StructField("pressure_bar", DoubleType()),
    StructField("current_amp", DoubleType()),
])

DOCUMENT_SCHEMA = "doc_id STRING, title STRING, content STRING"

READING_COLUMNS = [f.name for f in READINGS_SCHEMA.fields]


def scan_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Expose every driver table and the two domain views to Spark SQL."""
    for name in TABLES:
        scan_table(spark, sf_dir, name).createOrReplaceTempView(name)
    equipment_master(spark, sf_dir).createOrReplaceTempView("equipment_master")
    sensor_readings(spark, sf_dir).createOrReplaceTempView("sensor_readings")


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """Inline rows with a StructType or DDL schema (seeds and tests)."""
    return spark.createDataFrame(rows, schema)


def equipment_id_of(key: Column) -> Column:
    """'EQ-' + key left-padded to six digits."""
    return F.concat(F.lit("EQ-"), F.lpad(key.cast("string"), 6, "0"))


def _master_with_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = scan_table(spark, sf_dir, "supplier")
    nation = scan_table(spark, sf_dir, "nation")
    crit = (F.when(F.col("s_nationkey") % 4 == 0, C.CRIT_CORE)
            .when(F.col("s_nationkey") % 4 == 1, C.CRIT_IMPORTANT)
            .when(F.col("s_nationkey") % 4 == 2, C.CRIT_AUXILIARY)
            .otherwise(C.CRIT_CORE))
    # nation is a fixed 25-row table, so broadcasting it is size-safe at any scale.
    return (supplier.join(F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey)
            .select(equipment_id_of(F.col("s_suppkey")).alias("equipment_id"),
                    F.col("s_name").alias("equipment_name"),
                    F.col("n_name").alias("line"),
                    crit.alias("criticality"),
                    F.floor((F.col("s_acctbal") + F.lit(1000.0)) * F.lit(1.5)).cast("int")
                    .alias("operating_hours"),
                    F.col("s_suppkey").alias("_suppkey")))


def equipment_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """equipment_master over the fixture (one row per supplier)."""
    return _master_with_key(spark, sf_dir).drop("_suppkey")


def maintenance_days(equip: DataFrame) -> DataFrame:
    """Fixture ``last_maintenance_days`` (the reference has no such column)."""
    return equip.withColumn("last_maintenance_days", F.col("operating_hours") % 365)


def _grid(x: Column, steps: float) -> Column:
    return F.floor(x * F.lit(steps)) / F.lit(steps)


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sensor_readings over the fixture: one reading per lineitem row.

    The join runs on the numeric supplier key; only the two columns the
    readings need leave the dimension side, so Catalyst prunes the rest and
    AQE picks broadcast or sort-merge from the measured size.
    """
    # Only (key, hours) leave the dimension side.  The nation check is a semi
    # join: its size estimate is the supplier table's, so the optimizer
    # broadcasts this side (an inner join is estimated as the product of its
    # inputs and would make the fact side look smaller).
    supplier, nation = scan_table(spark, sf_dir, "supplier"), scan_table(spark, sf_dir, "nation")
    master = (supplier.join(F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey, "left_semi")
              .select(F.col("s_suppkey").alias("_suppkey"),
                      F.floor((F.col("s_acctbal") + F.lit(1000.0)) * F.lit(1.5)).cast("int").alias("operating_hours")))
    li = scan_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_tax")
    j = li.join(master, li.l_suppkey == master._suppkey)
    d = F.col("operating_hours") / F.lit(15000.0)
    k = F.col("l_orderkey")
    hour_offset = ((k * 7 + F.col("l_linenumber")) % 1000).cast("int")
    ts = F.timestamp_add("HOUR", hour_offset, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    vib = (F.when(k % 211 == 0, F.lit(-1.0))
           .when(k % 503 == 0, F.lit(None).cast("double"))
           .otherwise(_grid(F.lit(2.0) + d * F.lit(8.0) + (F.col("l_quantity") - F.lit(25.0)) / F.lit(12.5), 64.0)))
    temp = (F.when(k % 307 == 0, F.lit(250.0))
            .when(k % 509 == 0, F.lit(None).cast("double"))
            .otherwise(_grid(F.lit(40.0) + d * F.lit(45.0) + (F.col("l_discount") - F.lit(0.05)) * F.lit(200.0), 16.0)))
    press = (F.when(k % 401 == 0, F.lit(-5.0))
             .otherwise(_grid(F.lit(100.0) - d * F.lit(40.0) + (F.col("l_tax") - F.lit(0.04)) * F.lit(250.0), 16.0)))
    cur = _grid(F.lit(10.0) + d * F.lit(5.0) + ((F.col("l_partkey") % 17) - 8) / F.lit(10.0), 64.0)
    return j.select(equipment_id_of(F.col("l_suppkey")).alias("equipment_id"),
                    ts.alias("timestamp"),
                    vib.cast("double").alias("vibration_rms"),
                    temp.cast("double").alias("temperature_c"),
                    press.cast("double").alias("pressure_bar"),
                    cur.cast("double").alias("current_amp"))


def knowledge_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture documents as knowledge docs: doc_id, title = source, content = text."""
    docs = scan_table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                       F.col("source").alias("title"),
                       F.col("text").alias("content"))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search questions from the benchmark items."""
    return scan_table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("b-"), F.col("item_id").cast("string")).alias("query_id"),
        F.col("text").alias("query_text"))


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search/routing questions: benchmark items and user turns of conversations."""
    bench = benchmark_queries(spark, sf_dir)
    conv = (scan_table(spark, sf_dir, "conversations").where(F.col("role") == "user")
            .select(F.concat(F.lit("c-"), F.col("conv_id").cast("string"), F.lit("-"),
                             F.col("turn").cast("string")).alias("query_id"),
                    F.col("text").alias("query_text")))
    return bench.unionByName(conv)
