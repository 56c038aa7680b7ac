"""Failure report over the ledger with Structured Streaming.

The ledger only ever grows by appended files, so it is a natural file
stream: each trigger reads just the verdict files added since the last one.
The stream keeps the failed pairs (data check Failed, old side non-empty)
and emits each ``gen2_path`` once; the de-duplication state holds one entry
per failing table, bounded by the number of tables, not by the number of
verdicts. Run with ``availableNow`` after a sweep, or continuously next to
one; progress lives in a checkpoint beside the report, so any later run, by a
restarted driver or a new one, goes on where the last one stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.operators.compare import FAILED
from concord.sources.ledger import LEDGER

LEDGER_WITH_TS = T.StructType(LEDGER.fields + [T.StructField("ts", T.TimestampType(), True)])


def failure_stream(spark: SparkSession, ledger_path: str, equal_sizes: bool = False) -> DataFrame:
    """Streaming frame of failing pairs: ``gen2_path, dag_id, gen1_except_gen2, gen2_except_gen1, ts``."""
    rows = spark.readStream.schema(LEDGER_WITH_TS).parquet(ledger_path)
    cond = (F.col("except_validation") == FAILED) & (F.col("gen1_count") != 0)
    if equal_sizes:
        cond = cond & (F.col("gen1_except_gen2") == F.col("gen2_except_gen1"))
    return (
        rows.where(cond)
        .select("gen2_path", "dag_id", "gen1_except_gen2", "gen2_except_gen1", "ts")
        .dropDuplicates(["gen2_path"])
    )


def run_failure_report(
    spark: SparkSession,
    ledger_path: str,
    report_path: str,
    checkpoint: str | None = None,
    equal_sizes: bool = False,
) -> None:
    """Append newly failing pairs to ``report_path`` (Parquet), processing all ledger files available now."""
    if checkpoint is None:
        checkpoint = report_path.rstrip("/") + ".checkpoint"
    query = (
        failure_stream(spark, ledger_path, equal_sizes)
        .writeStream.format("parquet")
        .option("path", report_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
