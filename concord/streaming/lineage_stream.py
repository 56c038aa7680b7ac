"""Writer jobs of a lake's tables, kept up to date by a stream over their commit logs.

A log only ever grows by commit files, so the ``_delta_log`` folders of a whole
lake are one file stream: each trigger reads the commits added since the last,
of tables that appear later as well. The stream keeps what ``writer_jobs``
keeps and emits each (table, job) once; its state is one entry per (table, job),
however many commits there are. Rows go to a Parquet report whose log of
batches and the checkpoint beside it make every row appear once, also
after a lost driver.

Commits without a job or of a maintenance job, empty files and lines that
are no JSON add nothing. A lake without a commit file gives an empty report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.sources import commit_log

LINEAGE = "table string, job_name string"


def lineage_stream(spark: SparkSession, tables: str, excluded=commit_log.EXCLUDED_JOBS, files_per_batch: int | None = None) -> DataFrame:
    """Streaming frame ``table, job_name`` of the tables that the pattern ``tables`` names (e.g. ``/lake/*/*``)."""
    source = spark.readStream.schema(commit_log.COMMIT_SCHEMA)
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    rows = source.json(f"{tables.rstrip('/')}/{commit_log.layout.LOG_DIR}/*.json")
    job = F.col("commitInfo.job.jobName")
    found = rows.where(commit_log.job_filter(job, excluded))
    table = commit_log.table_of(F.col("_metadata.file_path"))
    return found.select(table.alias("table"), job.alias("job_name")).dropDuplicates(["table", "job_name"])


def run_lineage(
    spark: SparkSession,
    tables: str,
    report_path: str,
    checkpoint: str | None = None,
    excluded=commit_log.EXCLUDED_JOBS,
    files_per_batch: int | None = None,
) -> None:
    """Append the writer jobs found in all commits available now to ``report_path`` (Parquet)."""
    query = (
        lineage_stream(spark, tables, excluded, files_per_batch)
        .writeStream.format("parquet")
        .option("path", report_path)
        .option("checkpointLocation", checkpoint or report_path.rstrip("/") + ".checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def lineage(spark: SparkSession, report_path: str) -> DataFrame:
    """The report so far: ``table, job_name``."""
    return spark.read.schema(LINEAGE).parquet(report_path)
