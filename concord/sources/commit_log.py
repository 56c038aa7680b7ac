"""Commit logs of Delta tables read as JSON with Spark: writer jobs, partition columns.

Every commit is a JSON-lines file ``<table>/_delta_log/<version>.json`` of
actions. Two are used:

* ``commitInfo.job.jobName`` — the job that wrote the commit. Writer jobs of
  a table are the distinct names, without a few maintenance jobs.
* ``metaData.partitionColumns`` — the last ``metaData`` action (by version,
  i.e. file name) holds the current partition columns; checkpoints keep it
  when the commit itself has been cleaned up.

The log is scanned with an explicit schema (no inference pass), many tables
in one scan, with the table taken from each row's file path. Log files the
table has already cleaned up are out of reach, as with any history command.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.sources import layout

# Jobs that maintain tables without changing their data; they
# are never reported as writers. Seed row of the multi-table form.
EXCLUDED_JOBS = ("Cloud Migration", "Optimize_nzdata", "my spark task")
SEED_JOB = "Cloud Migration"

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField(
            "commitInfo",
            T.StructType(
                [
                    T.StructField("timestamp", T.LongType()),
                    T.StructField("operation", T.StringType()),
                    T.StructField("job", T.StructType([T.StructField("jobName", T.StringType())])),
                ]
            ),
        ),
        T.StructField(
            "metaData",
            T.StructType([T.StructField("partitionColumns", T.ArrayType(T.StringType()))]),
        ),
    ]
)


def log_glob(path: str) -> str:
    # File listing hides names starting with '_', so the log dir is named explicitly.
    return layout.escaped(path.rstrip("/")) + "/_delta_log/*.json"


def table_of(file_path: Column) -> Column:
    """The table whose log a file lies in, as its path is written (file paths come with escapes)."""
    table = F.regexp_replace(F.regexp_extract(file_path, r"^(.*)/_delta_log/[^/]*$", 1), r"^file:(//)?", "")
    return F.coalesce(F.try_url_decode(F.replace(table, F.lit("+"), F.lit("%2B"))), table)


def read_commits(spark: SparkSession, paths) -> DataFrame:
    """All commit actions of the tables at ``paths``: ``table, version_file, commitInfo, metaData``."""
    if isinstance(paths, str):
        paths = [paths]
    globs = [log_glob(p) for p in paths]
    df = spark.read.schema(COMMIT_SCHEMA).json(globs)
    file_path = F.col("_metadata.file_path")
    return df.select(
        table_of(file_path).alias("table"),
        F.col("_metadata.file_name").alias("version_file"),
        "commitInfo",
        "metaData",
    )


def job_filter(job: Column, excluded=EXCLUDED_JOBS) -> Column:
    """Job set, not NULL and not one of the maintenance jobs."""
    return job.isNotNull() & ~job.isin(*excluded)


def writer_jobs(commits: DataFrame, by_table: bool = True, excluded=EXCLUDED_JOBS) -> DataFrame:
    """Distinct writer jobs (``table, job_name`` or ``job_name``) of a commit frame."""
    job = F.col("commitInfo.job.jobName")
    keys = ["table"] if by_table else []
    return commits.where(job_filter(job, excluded)).select(*keys, job.alias("job_name")).distinct()


def writer_jobs_many(commits: DataFrame, seed: str = SEED_JOB) -> DataFrame:
    """Writer jobs over many tables, unioned, with the ``seed`` row kept, distinct."""
    spark = commits.sparkSession
    seeded = spark.createDataFrame([(seed,)], "job_name string")
    return seeded.unionByName(writer_jobs(commits, by_table=False)).distinct()


def job_lists(commits: DataFrame, excluded=EXCLUDED_JOBS) -> DataFrame:
    """``table, jobs``: writer jobs of every table as display text ``[a, b]`` (sorted); ``[]`` when none."""
    job = F.col("commitInfo.job.jobName")
    names = F.array_sort(F.collect_set(F.when(job_filter(job, excluded), job)))  # as many as a table has writers
    return commits.groupBy("table").agg(F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]")).alias("jobs"))


def job_list(spark: SparkSession, path: str, excluded=EXCLUDED_JOBS) -> str:
    """:func:`job_lists` of one table."""
    row = job_lists(read_commits(spark, path).withColumn("table", F.lit("")), excluded).first()
    return row["jobs"] if row is not None else "[]"


def read_logs(spark: SparkSession, paths) -> DataFrame:
    """``table, version_file, metaData`` of the commits and checkpoints of many tables: one scan of each kind of file.

    Checkpoints (of one part or several) hold the metadata of commits that a
    table has cleaned up. Tables without a log have no rows.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    names = {p: layout.child_names(spark, f"{p.rstrip('/')}/{layout.LOG_DIR}") or [] for p in paths}
    logs = [p for p in paths if any(n.endswith(".json") for n in names[p])]
    kept = [p for p in paths if any(".checkpoint" in n and n.endswith(".parquet") for n in names[p])]
    out = None
    if logs:
        out = read_commits(spark, logs).select("table", "version_file", "metaData")
    if kept:
        globs = [f"{layout.escaped(p.rstrip('/'))}/{layout.LOG_DIR}/*.checkpoint*.parquet" for p in kept]
        found = spark.read.schema(T.StructType([COMMIT_SCHEMA["metaData"]])).parquet(*globs)
        found = found.select(table_of(F.col("_metadata.file_path")).alias("table"), F.col("_metadata.file_name").alias("version_file"), "metaData")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], T.StructType([T.StructField("table", T.StringType()), T.StructField("version_file", T.StringType()), COMMIT_SCHEMA["metaData"]]))
    return out


def table_metadata(log: DataFrame) -> DataFrame:
    """``table, version, partition_columns, first_partition_column`` from the last ``metaData`` action of every table.

    One reduction for all tables; the version is the number that a file's name
    begins with, so commits and checkpoints, of any number of parts, order
    together. A blank first column counts as none. Tables without metadata have no row.
    """
    version = F.regexp_extract("version_file", r"^([0-9]+)", 1).try_cast("bigint")
    columns = F.col("metaData.partitionColumns")
    last = log.where(columns.isNotNull()).groupBy("table").agg(
        F.max(version).alias("version"), F.max_by(columns, F.struct(version, columns)).alias("partition_columns")
    )
    first = F.get("partition_columns", 0)
    return last.withColumn("first_partition_column", F.when(F.trim(first) != "", first))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """``partitionColumns`` of the last ``metaData`` action of one table, or [] when there is none."""
    row = table_metadata(read_logs(spark, path).withColumn("table", F.lit(""))).first()
    return list(row["partition_columns"]) if row is not None else []
