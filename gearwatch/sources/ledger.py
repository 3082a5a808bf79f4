"""S4/S9 with every run kept: an append-only table of runs with a commit manifest.

Layout under the target folder::

    runs/attempt=<id>/<partitions>/...   the rows of one attempt of one run
    commits/<run>.json                   which attempt of the run counts

A run writes its attempt first and its commit last, by an atomic rename.  Readers take the
attempts that the commits name, so a run that died half-way is never seen, several runs of one day or
model stand side by side, and a retry under the same run id replaces that run alone, whichever
partitions it holds now.  Attempts that no commit names are removed by ``vacuum``.

The driver reads one small commit per run; rows never pass through it.  The target must be on
storage that driver and executors share.
"""

from __future__ import annotations

import json
import urllib.parse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import hadoop_path, path_exists, replace_file

COMMITS = "commits"


def append_run(df: DataFrame, target: str, run_id: str, partition_by: str | list[str] | None = "date") -> str:
    """Append the rows of run ``run_id``; the same id again replaces that run's rows and no others."""
    attempt = f"a{uuid.uuid4().hex}"
    w = df.withColumn("run_id", F.lit(run_id)).write
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(f"{target}/runs/attempt={attempt}")
    commit = json.dumps({"run_id": run_id, "attempt": attempt}) + "\n"
    replace_file(df.sparkSession, f"{target}/{COMMITS}/{urllib.parse.quote(run_id, safe='')}.json", commit)
    return target


def committed(spark: SparkSession, target: str) -> dict[str, str]:
    """Run id -> the attempt that counts."""
    if not path_exists(spark, f"{target}/{COMMITS}"):
        return {}
    rows = spark.read.schema("run_id string, attempt string").json(f"{target}/{COMMITS}").collect()  # a row per run
    return {r["run_id"]: r["attempt"] for r in rows}


def is_ledger(spark: SparkSession, target: str) -> bool:
    return path_exists(spark, f"{target}/{COMMITS}")


def read_runs(spark: SparkSession, target: str, run_ids: list[str] | None = None) -> DataFrame:
    """The rows of all committed runs (or of ``run_ids``) with their ``run_id``."""
    found = committed(spark, target)
    attempts = [a for r, a in sorted(found.items()) if run_ids is None or r in run_ids]
    if not attempts:
        raise FileNotFoundError(f"no committed run of {run_ids or 'any id'} in {target}")
    paths = [f"{target}/runs/attempt={a}" for a in attempts]
    return spark.read.option("basePath", f"{target}/runs").parquet(*paths).drop("attempt")


def vacuum(spark: SparkSession, target: str) -> int:
    """Remove the attempts that no commit names; readers of replaced attempts must have ended.  How many went."""
    keep = {f"attempt={a}" for a in committed(spark, target).values()}
    folder, fs = hadoop_path(spark, f"{target}/runs")
    old = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in keep] if fs.exists(folder) else []
    for p in old:
        fs.delete(p, True)
    return len(old)
