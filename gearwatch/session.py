"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "gearwatch") -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    UTC session zone (timestamps in the fixture are zone-less), AQE with
    partition coalescing and skew-join splitting, Arrow for pandas transfer
    and no UI server.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # remove RDD checkpoint files once nothing references them (long-lived sessions)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Session settings the operators rely on, applied to any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_root(spark)


def find_package(spark: SparkSession) -> None:
    """Python workers find this package where the driver has it, whatever their working folder."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def local_master(master: str) -> bool:
    """Whether driver and executors are one process (``local`` or ``local[n]``)."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, stream checkpoints and written tables.

    Read from the session (``spark.checkpoint.dir``, as a cluster names it).
    Where it is unset, a local master gets a fresh local folder; on a cluster
    that is an error, as executors would not see such a folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        existing = sc.getCheckpointDir()
        if existing:
            return existing
        if not local_master(sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that the driver and executors of {sc.master} share")
        root = tempfile.mkdtemp(prefix="gearwatch-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/gearwatch/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local filesystem checks."""
    return path[5:] if path.startswith("file:") else path


def ensure_dir(path: str) -> None:
    if "://" not in path or path.startswith("file:"):
        os.makedirs(local_path(path), exist_ok=True)


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared folder and read it back.

    The lineage cut used between expensive stages: columnar, compressed and
    restartable (a lost executor re-reads files instead of recomputing).
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def dealt_ranges(rows, keys: list[str], name: str):
    """``rows`` (a written table) sorted by ``keys`` into dealt ranges, written: ``_range`` and ``_place`` tell where.

    ``_place`` ascends along all rows; ``_range`` is the number of the task that wrote the row.  Rows
    equal in all keys are split between ranges too, by their place in the written table, so
    no key has to fit into one task.
    """
    from pyspark.sql import functions as F

    order = [*keys, "_tie"]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(dealt.drop("_tie").withColumn("_place", F.monotonically_increasing_id()), name)
    return placed.withColumn("_range", F.shiftright("_place", 33))
