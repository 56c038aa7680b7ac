"""File listings as DataFrames: file presence, partition columns, latest partition.

A listing is read with the ``binaryFile`` source without ever selecting
``content``, so it is a pure metadata scan (the source skips reading file
bytes when ``content`` is pruned). Listing goes through Spark's partition
discovery, which gives the partition columns of a hive-style layout
(``key=value`` directories) as typed columns of the listing itself: the
latest partition can then be found from the listing alone, without opening
one data file. The runner looks at one directory level only, without a job
(:mod:`concord.sources.layout`); the functions here are for listings as tables.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.operators.align import quoted
from concord.operators.compare import status
from concord.sources import layout

_LISTING_COLUMNS = ("path", "modificationTime", "length", "content")

LISTING = T.StructType(
    [T.StructField("path", T.StringType(), True), T.StructField("length", T.LongType(), True)]
)


def list_files(spark: SparkSession, path: str, glob: str | None = "*.parquet", recursive: bool = False) -> DataFrame | None:
    """The files under ``path`` (``path, length`` + partition columns), or None if the path is missing.

    ``recursive=True`` drops partition discovery and walks every level.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        df = reader.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise
    keep = [c for c in df.columns if c not in ("modificationTime", "content")]
    return df.select(*[quoted(c) for c in keep])


def partition_columns(listing: DataFrame | None) -> list[str]:
    """Partition columns discovered from the directory layout, in order (schema only, no job)."""
    if listing is None:
        return []
    return [c for c in listing.columns if c not in _LISTING_COLUMNS]


def files_check(spark: SparkSession, gen1_path: str, gen2_path: str, glob: str = "*.parquet") -> DataFrame:
    """``gen1_files, gen2_files, files_validation``: both sides hold at least one data file.

    A missing directory counts as zero files. One job over both listings.
    """
    sides = []
    for tag, p in (("gen1", gen1_path), ("gen2", gen2_path)):
        listing = list_files(spark, p, glob, recursive=True)
        if listing is None:
            listing = spark.createDataFrame([], LISTING)
        sides.append(listing.select(F.lit("").alias("table"), F.lit(tag).alias("side"), "path"))
    tables = spark.createDataFrame([("",)], "table string")
    return files_verdict(tables, sides[0].unionByName(sides[1])).drop("table")


def files_verdict(tables: DataFrame, listing: DataFrame, suffix: str = ".parquet") -> DataFrame:
    """``table, gen1_files, gen2_files, files_validation`` for every row of ``tables(table)``.

    ``listing(table, side, path)`` holds the listed entries of many tables,
    ``side`` being ``gen1`` or ``gen2``; entries that do not end in ``suffix``
    are no data files. A table without any entry counts zero on both sides.
    """
    data = listing.where(F.col("path").endswith(suffix))
    counts = data.groupBy("table").agg(
        F.count_if(F.col("side") == "gen1").alias("gen1_files"), F.count_if(F.col("side") == "gen2").alias("gen2_files")
    )
    both = tables.join(counts, "table", "left").fillna(0, ["gen1_files", "gen2_files"])
    return both.withColumn("files_validation", status((F.col("gen1_files") > 0) & (F.col("gen2_files") > 0)))


def _partition_child(listing: DataFrame, root_col: str, path_col: str) -> DataFrame:
    """``root, child, partition_date`` for every listed file (child NULL when not under a ``key=value`` dir)."""
    root = F.col(root_col)
    rel = F.substring(F.col(path_col), F.length(root) + 2, F.length(F.col(path_col)))
    first = F.substring_index(rel, "/", 1)
    is_part = F.col(path_col).startswith(F.concat(root, F.lit("/"))) & first.contains("=") & (first != rel)
    child = F.when(is_part, F.concat_ws("/", root, first))
    # the runner's rule of what is a date (hive default partition: none)
    value = layout.lenient_date(F.regexp_extract(first, r"^[^=]*=(.*)$", 1))
    return listing.select(
        root,
        child.alias("partition_path"),
        F.when(is_part, value).alias("partition_date"),
    )


def latest_partition_dirs(listing: DataFrame, root_col: str = "root", path_col: str = "path") -> DataFrame:
    """Per root: the ``key=value`` child directory with the greatest date.

    Output ``root, partition_path, partition_date``. A root with no
    ``key=value`` child (or no child with a date) is returned as itself with
    a NULL date, i.e. read unpartitioned. One aggregate over the listing for
    all roots at once; each root keeps a single running maximum.
    """
    parts = _partition_child(listing, root_col, path_col)
    latest = parts.groupBy(root_col).agg(
        F.max_by("partition_path", "partition_date").alias("partition_path"),
        F.max("partition_date").alias("partition_date"),
    )
    return latest.select(
        F.col(root_col),
        F.coalesce(F.col("partition_path"), F.col(root_col)).alias("partition_path"),
        F.col("partition_date"),
    )


def latest_partition_path(spark: SparkSession, path: str) -> str:
    """The directory to read for ``path``: its latest ``key=yyyy-MM-dd`` child, or ``path`` itself. No job."""
    latest = layout.root_latest(spark, path)
    return path.rstrip("/") if latest is None else latest.paths[0]
