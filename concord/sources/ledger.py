"""The verdict ledger: an append-only Parquet dataset, one row per checked pair.

Appends go to a directory; readers use ``mergeSchema`` so a ledger written
before a column was added reads together with newer files (missing columns
are NULL). Counts are ``bigint`` and statuses ``Passed | Failed | NA``.
Older ledgers with the counts stored as text are read with
:func:`typed_counts`, which ``try_cast``\\ s them.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.operators.align import quoted
from concord.session import worker_imports
from concord.sources import layout
from concord.sources.layout_source import listable, open_path

_S, _L = T.StringType(), T.LongType()

# The ledger's column names.
LEDGER_FIELDS = (
    ("env", _S),
    ("dag_id", _S),
    ("gen1_path", _S),
    ("gen2_path", _S),
    ("gen1_count", _L),
    ("gen2_count", _L),
    ("gen1_distinct_count", _L),
    ("gen2_distinct_count", _L),
    ("gen1_except_gen2", _L),
    ("gen2_except_gen1", _L),
    ("files_validation", _S),
    ("count_validation", _S),
    ("dis_count_validation", _S),
    ("except_validation", _S),
    ("schema_validation", _S),
    ("schema_diff", _S),
    ("error_msg", _S),
    ("source_job", _S),
    ("scope", _S),
    ("gen1_partition", _S),
    ("gen2_partition", _S),
    ("partition_validation", _S),
    ("run_id", _S),
)
LEDGER = T.StructType([T.StructField(n, t, True) for n, t in LEDGER_FIELDS])
LEDGER_COLUMNS = tuple(n for n, _ in LEDGER_FIELDS)
COUNT_FIELDS = tuple(n for n, t in LEDGER_FIELDS if t == _L)


def conform(df: DataFrame, keep=()) -> DataFrame:
    """Select the ledger columns in ledger order and types (absent ones as NULL), then ``keep``."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(n).cast(t) if n in have else F.lit(None).cast(t)).alias(n)
            for n, t in LEDGER_FIELDS
        ],
        *keep,
    )


STAGED = "_staged"  # hidden to readers
DAY = "ledger_day"


def append(verdicts: DataFrame, path: str, batch: str | None = None) -> bool:
    """Stamp ``ts`` and append one batch to the ledger directory; False if ``batch`` is there already.

    The batch is written as one file below ``_staged``, which readers do not
    see, and published by a rename to a name of its own (``batch``, by default a
    new one). So a batch is seen whole or not at all, and one that is replayed
    after a lost driver adds nothing, wherever the driver was lost: before the
    rename nothing is published, after it the name is taken.
    """
    spark = verdicts.sparkSession
    root = path.rstrip("/")
    name = f"{_file_name(batch)}.parquet"
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = jvm.Path(f"{root}/{name}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target):
        return False
    stage = f"{root}/{STAGED}/{uuid.uuid4().hex}"
    conform(verdicts).withColumn("ts", F.current_timestamp()).coalesce(1).write.parquet(stage)
    for written in layout.child_names(spark, stage) or ():
        if written.endswith(".parquet"):
            _publish(fs, jvm.Path(f"{stage}/{written}"), target)
    fs.delete(jvm.Path(stage), True)
    return True


def _file_name(batch: str | None) -> str:
    """A batch's name if it can be a file's, else a hash of it; a new one for none."""
    if batch is None:
        return uuid.uuid4().hex
    return batch if re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]{0,150}", batch) else uuid.uuid5(uuid.NAMESPACE_OID, batch).hex


def _publish(fs, staged, target) -> None:
    if not fs.rename(staged, target) and not fs.exists(target):
        raise OSError(f"could not publish {target}")


def write_by_day(ledger: DataFrame, path: str) -> None:
    """A ledger laid out by the day of ``ts`` (partition column ``ledger_day``), for queries by day.

    Queries of one day then read its directory alone. The layout of a ledger
    that has grown: batches go on being appended to a flat one.
    """
    # rebalanced: a day that holds a third of the ledger is written by several tasks
    ledger.withColumn(DAY, F.to_date("ts")).hint("rebalance", DAY).write.mode("error").partitionBy(DAY).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, with columns merged across files written at different times and counts as ``bigint``.

    A directory may mix files with counts as text and as numbers, which a
    merged schema cannot hold: then each kind of file is read by itself, typed
    and unioned.
    """
    try:
        return typed_counts(spark.read.option("mergeSchema", "true").parquet(path))
    except (PySparkException, Py4JJavaError) as e:  # footers are merged by a job, whose errors come as they are
        if "CANNOT_MERGE_" not in str(e):
            raise
    names = [n for n in layout.child_names(spark, path) or [] if not layout.hidden(n)]
    kinds = census(spark, [f"{path.rstrip('/')}/{n}" for n in names])
    frames = [typed_counts(spark.read.parquet(*files)) for files in kinds]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _footer(path: str) -> str:
    """The columns of a Parquet file and their types, as text."""
    import pyarrow.parquet as pq

    fs, at = open_path(path)
    return str(pq.read_schema(at, filesystem=fs).remove_metadata())


def census(spark: SparkSession, files: list[str], per_task: int = 64) -> list[list[str]]:
    """``files`` grouped by their schemas, from one job that reads all footers."""
    if not files:
        return []
    if not all(listable(f) and f.endswith(".parquet") for f in files):  # folders, or what tasks cannot open: by Spark's reader
        kinds: dict[str, list[str]] = {}
        for f in files:
            kinds.setdefault(spark.read.parquet(layout.escaped(f)).schema.simpleString(), []).append(f)
        return list(kinds.values())
    worker_imports(spark)

    def read(batches):
        for b in batches:
            names = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_footer(f) for f in names], pa.string())], ["file", "kind"])

    frame = spark.createDataFrame([(f,) for f in files], "file string").repartition(-(-len(files) // per_task))
    found = frame.mapInArrow(read, "file string, kind string").groupBy("kind").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return sorted(r["files"] for r in found.collect())


def read_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """:func:`read`, or None where no ledger has been written yet; any other failure raises."""
    names = layout.child_names(spark, path)
    if not [n for n in names or [] if not n.startswith(("_", "."))]:
        return None
    return read(spark, path)


def typed_counts(ledger: DataFrame) -> DataFrame:
    """Counts stored as text (older ledgers) as ``bigint``; non-numbers become NULL."""
    out = ledger
    for c in COUNT_FIELDS:
        if c in ledger.columns and ledger.schema[c].dataType != _L:
            out = out.withColumn(c, F.col(c).try_cast("bigint"))
    return out


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A ledger registered in the catalog (``db.table``), e.g. one kept by an older sweep; counts as ``bigint``."""
    return typed_counts(spark.table(name))


def append_table(verdicts: DataFrame, name: str, path: str | None = None) -> None:
    """Stamp ``ts`` and append to a ledger table of the session's catalog, whose columns may grow.

    The table is made where it is missing (an external one with ``path``).
    Columns that it lacks are added to it first, so older rows have them NULL;
    columns of ``verdicts`` beyond the ledger's are kept. Rows are written by name.
    """
    spark = verdicts.sparkSession
    extra = [c for c in verdicts.columns if c not in LEDGER_COLUMNS and c.lower() != "ts"]
    rows = conform(verdicts, keep=[quoted(c) for c in extra]).withColumn("ts", F.current_timestamp())
    if not spark.catalog.tableExists(name):
        writer = rows.write.format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)
        return
    have = {f.name.lower() for f in spark.table(name).schema.fields}
    new = [f for f in rows.schema.fields if f.name.lower() not in have]
    if new:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"alter table {name} add columns ({added})")
    fields = spark.table(name).schema.fields
    there = {c.lower(): c for c in rows.columns}
    rows.select(*[(quoted(there[f.name.lower()]) if f.name.lower() in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]).write.insertInto(name)
