"""The shared folder, files written by tasks, and the import path of Python workers.

Executors can be lost and share nothing but the folder that the cluster names
in ``spark.checkpoint.dir``; everything written between two jobs goes there.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = str(Path(__file__).resolve().parents[2])


_DEFAULT_BATCH, _BATCH = "67108864b", "4m"


def python_workers(spark: SparkSession) -> None:
    """Settings that the operators' Python workers need, made where they are not made yet.

    Batches: Spark hands up to 64 MB of rows at a time to each Python worker
    of a task, and holds as much beside its heap. Unless the session names
    another size, 4 MB are taken, so that memory does not depend on how long
    documents are.

    Imports: on a cluster the package is installed on the executors; from a
    checkout the workers inherit only the driver's ``PYTHONPATH``, not its
    ``sys.path``.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, _DEFAULT_BATCH) == _DEFAULT_BATCH:
        spark.conf.set(key, _BATCH)
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *have])


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder only where it is unset on a local master (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='concord-llm-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: computed once, lineage cut."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` of narrow rows into the shared folder (set up where it is unset)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def open_folder(uri: str):
    """(file system, path) of a folder URI inside a task: local, object store or HDFS."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)
