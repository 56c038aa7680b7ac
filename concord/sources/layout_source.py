"""The layouts of a whole manifest in one job: a Python data source that lists many roots.

``children`` reads one directory level of every root, ``first_files`` searches
each folder up to its first data file; either runs in tasks of some
``ROOTS_PER_TASK`` roots, and a folder of many partitions is one row per
name, never a list on the driver. :func:`layouts` puts the names of a root
together (one value per root: the names below it) and describes them with the
same steps as a single root (:mod:`concord.sources.layout`).

Roots are opened by pyarrow's file systems (local, HDFS, object stores). A
root of any other scheme raises; such manifests are listed root by root by the
driver (:func:`concord.sources.layout.child_names`).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from concord.session import worker_imports
from concord.sources import layout
from concord.sources.layout import LOG_DIR, first_file, hidden, is_log_file

ROOTS_PER_TASK = 64
_SCHEMES = ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")


def listable(path: str) -> bool:
    """Whether tasks can list ``path``."""
    return "://" not in path and not path.startswith("file:") or path.split(":", 1)[0] in _SCHEMES


def open_path(path: str):
    """(file system, path) of a path inside a task."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class _Folder:
    """Names of one file system, asked for below a root."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.fs, self.at = open_path(self.root)

    def _inside(self, path: str) -> str:
        return self.at + path[len(self.root) :]

    def entries(self, path: str) -> list[tuple[str, bool]] | None:
        """(name, is it a file) below a folder; None if it is missing."""
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(self._inside(path), allow_not_found=True))
        if not found and self.fs.get_file_info(self._inside(path)).type == fs.FileType.NotFound:
            return None
        return sorted((f.base_name, f.type == fs.FileType.File) for f in found)

    def is_file(self, path: str) -> bool:
        from pyarrow import fs

        return self.fs.get_file_info(self._inside(path)).type == fs.FileType.File

    def names(self, path: str) -> list[str] | None:
        found = self.entries(path)
        return None if found is None else [n for n, _ in found]


class _Roots(InputPartition):
    def __init__(self, roots: list[str]):
        super().__init__(roots)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.roots = json.loads(options.get("roots", "[]"))
        self.what = options.get("what", "children")
        self.per_task = int(options.get("rootsPerTask", ROOTS_PER_TASK))

    def partitions(self) -> list[InputPartition]:
        n = self.per_task
        return [_Roots(self.roots[i : i + n]) for i in range(0, len(self.roots), n)] or [_Roots([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for root in partition.value:
            folder = _Folder(root)
            if self.what == "first_files":
                yield root, first_file(folder.root, folder.names, folder.is_file), None
                continue
            if folder.is_file(folder.root):
                yield root, "", "file"
                continue
            found = folder.entries(folder.root)
            if found is None:
                yield root, None, "missing"
                continue
            yield root, None, "folder"
            for name, is_file in found:
                if name == LOG_DIR and any(is_log_file(n) for n in folder.names(f"{folder.root}/{LOG_DIR}") or ()):
                    yield root, None, "log"
                elif not hidden(name):
                    yield root, name, "file" if is_file else "folder"


class LayoutSource(DataSource):
    """``root, name, kind``: what lies below each of the roots in option ``roots`` (a JSON list).

    ``kind``: ``missing``, ``log`` (the root is a Delta table), ``file`` or
    ``folder`` (with a null name: the root itself). With option ``what`` =
    ``first_files``, ``name`` is the root's first data file or null.
    """

    @classmethod
    def name(cls) -> str:
        return "concord_layout"

    def schema(self) -> str:
        return "root string, name string, kind string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def _read(spark: SparkSession, roots: list[str], what: str, per_task: int) -> DataFrame:
    bad = [r for r in roots if not listable(r)]
    if bad:
        raise ValueError(f"tasks cannot list {bad[0]}")
    worker_imports(spark)
    spark.dataSource.register(LayoutSource)
    options = {"roots": json.dumps(sorted(set(roots))), "what": what, "rootsPerTask": str(per_task)}
    return spark.read.format("concord_layout").options(**options).load()


def children(spark: SparkSession, roots: list[str], per_task: int = ROOTS_PER_TASK) -> DataFrame:
    """``root, name, kind`` of what lies directly below each root; one job for all of them."""
    return _read(spark, roots, "children", per_task)


def first_files(spark: SparkSession, folders: list[str], per_task: int = ROOTS_PER_TASK) -> DataFrame:
    """``root, first_file`` for each folder; null where no data file of the table's own lies below."""
    return _read(spark, folders, "first_files", per_task).select("root", F.col("name").alias("first_file"))


def _footer_schema(path: str) -> str:
    """The Spark schema that the footer of one Parquet file states, as JSON text."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    fs, at = open_path(path)
    found = pq.read_schema(at, filesystem=fs)
    written = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    return written.decode() if written else from_arrow_schema(found, prefer_timestamp_ntz=True).json()


def footer_schemas(spark: SparkSession, folders: list[str], per_task: int = ROOTS_PER_TASK) -> DataFrame:
    """``table, schema`` of each folder by the footer of its first data file; one job for all of them.

    The schema is that of the file: without partition columns, nullability as
    written. It is null where there is no data file; a file whose footer cannot be read raises.
    """

    def read(batches):
        for batch in batches:
            batch["schema"] = [None if f is None else _footer_schema(f) for f in batch["first_file"]]
            yield batch.rename(columns={"root": "table"})[["table", "schema"]]

    return first_files(spark, folders, per_task).mapInPandas(read, "table string, schema string")


def layouts(listing: DataFrame) -> DataFrame:
    """``root, found, format, partition_column, n_files, parts`` per root of a listing ``(root, name, kind)``."""
    part = (F.col("kind") == "folder") & F.col("name").contains("=")
    plain = lambda c: F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)
    key = plain(F.substring_index("name", "=", 1))
    value = plain(F.substring("name", F.length(F.substring_index("name", "=", 1)) + 2, F.length("name")))
    by_name = F.struct("name", key.alias("key"), value.alias("text"))
    grouped = listing.groupBy("root").agg(
        F.max(F.col("kind") != "missing").alias("found"),
        F.when(F.max(F.col("kind") == "log"), "delta").otherwise("parquet").alias("format"),
        F.count_if((F.col("kind") == "file") & (F.col("name").endswith(layout.DATA_SUFFIX) | (F.col("name") == ""))).alias("n_files"),
        F.sort_array(F.collect_list(F.when(part, by_name))).alias("p"),
    )
    parts = F.transform("p", lambda p: F.struct(p["key"].alias("key"), p["text"].alias("text"), p["name"].alias("name")))
    return grouped.withColumn("parts", parts).select("root", "found", "format", layout.first_column(F.col("parts")).alias("partition_column"), "n_files", "parts")


def resolved(spark: SparkSession, listing: DataFrame, wanted: DataFrame, by: str = "column") -> DataFrame:
    """``lead, root, found, format, column, latest_text, kind, latest_names`` for every root of ``wanted(lead, root)``.

    ``lead`` is the old side's root: its format and, with ``by="column"``, its
    first partition column hold for all roots of the pair.
    """
    own = Window.partitionBy("lead")
    rows = wanted.select("lead", "root").distinct().join(layouts(listing), "root")
    of_lead = lambda c: F.max(F.when(F.col("root") == F.col("lead"), F.col(c))).over(own)
    rows = rows.withColumns({"format": of_lead("format"), "column": of_lead("partition_column")})
    if by == "date":
        found = layout.latest_by_date(rows).withColumns({"latest_text": F.col("latest_date").cast("string"), "kind": F.lit("day")})
    else:
        found = layout.latest_by_column(rows)
    return found.select("lead", "root", "found", "format", "column", "latest_text", "kind", "latest_names")
