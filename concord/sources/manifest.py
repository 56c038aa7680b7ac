"""Manifests: which table pairs to reconcile.

A manifest is a DataFrame with a fixed schema. Text manifests are
``env,dag_id,gen1_path,gen2_path[,gen1_hist_path,gen2_hist_path]`` lines:
lines without a comma are skipped and fields are not trimmed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIR_FIELDS = ("env", "dag_id", "gen1_path", "gen2_path")
HISTORY_FIELDS = PAIR_FIELDS + ("gen1_hist_path", "gen2_hist_path")

MANIFEST = T.StructType([T.StructField(n, T.StringType(), True) for n in PAIR_FIELDS])
HISTORY_MANIFEST = T.StructType([T.StructField(n, T.StringType(), True) for n in HISTORY_FIELDS])


def read_manifest(spark: SparkSession, path: str, history: bool = False) -> DataFrame:
    """Read a comma-separated manifest file (no header)."""
    schema = HISTORY_MANIFEST if history else MANIFEST
    raw = spark.read.text(path)
    return parse_manifest_lines(raw, schema)


def parse_manifest_lines(lines: DataFrame, schema: T.StructType = MANIFEST, col: str = "value") -> DataFrame:
    """Split ``col`` text lines on ',' into the manifest columns; lines without ',' are dropped."""
    parts = F.split(F.col(col), ",", -1)
    return lines.where(F.col(col).contains(",")).select(
        *[F.get(parts, i).alias(f.name) for i, f in enumerate(schema.fields)]
    )


def manifest_frame(spark: SparkSession, rows, history: bool = False) -> DataFrame:
    """A manifest from Python tuples (for scripts and tests)."""
    return spark.createDataFrame(list(rows), HISTORY_MANIFEST if history else MANIFEST)


def manifest_text(manifest: DataFrame) -> DataFrame:
    """Manifest rows as one text column ``line`` = ``concat_ws(',', ...)`` (export only).

    NULL fields vanish from ``concat_ws`` and shift the rest; keep manifests
    as DataFrames wherever possible.
    """
    return manifest.select(F.concat_ws(",", *[F.col(c) for c in manifest.columns]).alias("line"))
