"""Snapshot, idempotent append and inference-log sinks.

Writes go to paths under the shared checkpoint root (``session.scratch_path``)
or to catalog tables; nothing is collected on the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot(df: DataFrame, target: str, partition_by=None, fmt: str = "parquet") -> str:
    """S3: full replace of a table (name) or folder (path)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if "/" in target:
        w.save(target)
    else:
        w.saveAsTable(target)
    return target


def append_batch(df: DataFrame, target: str, partition_by="date", fmt: str = "parquet",
                 batch_id: str | None = None) -> str:
    """Append one run's rows, idempotently, to a folder or a catalog table.

    The batch replaces exactly the partitions it holds: a rerun writes its own
    rows anew, everything else stays.  With ``batch_id`` the batch is a
    partition of its own below ``partition_by``, so several batches of one day
    (a late half-day file, a second model) coexist and each can be rerun.
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(batch_id))
        cols.append("batch_id")
    if "/" in target:
        (df.write.mode("overwrite").format(fmt).partitionBy(*cols)
         .option("partitionOverwriteMode", "dynamic").save(target))  # per-write, not session-wide
        return target
    spark = df.sparkSession
    if not spark.catalog.tableExists(target):
        df.write.format(fmt).partitionBy(*cols).saveAsTable(target)
        return target
    names = spark.table(target).columns
    if sorted(names) != sorted(df.columns):
        raise ValueError(f"{target} has the columns {names}, the batch has {df.columns}")
    # saveAsTable would replace the whole table; insertInto goes by position and keeps other
    # partitions, but takes the overwrite mode from the session
    mode, before = "spark.sql.sources.partitionOverwriteMode", spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*names).write.mode("overwrite").insertInto(target)
    finally:
        spark.conf.set(mode, before)
    return target


def hadoop_path(spark: SparkSession, path: str):
    """(Hadoop path, its filesystem)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file and put it in the place of the old one by one atomic rename."""
    jvm = spark.sparkContext._jvm
    final, fs = hadoop_path(spark, path)
    draft, _ = hadoop_path(spark, f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(draft), fs.makeQualified(final), how)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists on the (possibly remote) Hadoop filesystem."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def is_partitioned_by(spark: SparkSession, path: str, column: str) -> bool:
    """Whether a folder holds ``column=value`` partition directories."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and any(st.isDirectory() and st.getPath().getName().startswith(f"{column}=")
                                for st in fs.listStatus(p))


def read_table(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(target) if "/" in target else spark.table(target)


def inference_log(scored: DataFrame, feature_cols, model_id: str, as_of_ts, target: str | None = None,
                  prediction_col: str = "prediction", run_id: str | None = None) -> DataFrame:
    """One request/response row per scored record; appended as a run when ``target`` is set.

    Every run stays, also several of one model on one day (``ledger.append_run``).  A retry names the
    ``run_id`` it repeats and replaces that run only; without one the run is a new one.
    """
    log = scored.select(
        F.col("equipment_id"),
        F.to_json(F.struct(*feature_cols)).alias("request"),
        F.to_json(F.struct(F.col(prediction_col).alias("rul_hours"))).alias("response"),
        F.lit(model_id).alias("model_id"),
        as_of_ts.alias("logged_at"),
        F.to_date(as_of_ts).alias("date"))
    if target:
        from .ledger import append_run  # imports this module
        append_run(log, target, run_id or f"{model_id}-{uuid.uuid4().hex}", "date")
    return log
