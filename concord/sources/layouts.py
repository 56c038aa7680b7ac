"""What the runner asks about roots: format, partition column, latest partition, presence of data.

:class:`Layouts` lists each root on the driver when it is asked.
:class:`ManifestLayouts` has the answers for many pairs from two jobs
(:mod:`concord.sources.layout_source`) and lists on the driver only what it was not told of.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from concord.sources import layout, layout_source
from concord.sources.layout import Latest
from concord.sources.tables import PARQUET, detect_format, first_partition_column


class Layouts:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def format(self, path: str) -> str:
        return detect_format(self.spark, path)

    def column(self, path: str, fmt: str) -> str | None:
        return first_partition_column(self.spark, path, fmt)

    def latest(self, path: str, column: str | None) -> Latest | None:
        """The latest partition by ``column``, or by date; a missing path raises."""
        return layout.root_latest(self.spark, path, column)

    def has_data(self, path: str) -> bool:
        return layout.has_data_file(self.spark, path)


class ManifestLayouts(Layouts):
    """Layouts of the pairs of a chunk of a manifest: ``pairs`` are (old side's root, roots) of each scope."""

    def __init__(self, spark: SparkSession, pairs: Iterable[tuple[str, Iterable[str]]], by: str = "column"):
        super().__init__(spark)
        wanted = sorted({(lead, root) for lead, roots in pairs for root in (lead, *roots)})
        frame = spark.createDataFrame(wanted, "lead string, root string")
        listing = layout_source.children(spark, [root for _, root in wanted])
        self.by, self.formats, self.columns, self.found = by, {}, {}, {}
        for r in layout_source.resolved(spark, listing, frame, by).toLocalIterator():  # a row per pair and root
            if r["root"] == r["lead"]:
                self.formats[r["root"]], self.columns[r["root"]] = r["format"], r["column"]
            column = None if by == "date" else r["column"]
            key = (r["root"], column and column.lower())
            if r["found"]:
                root = r["root"].rstrip("/")
                paths = tuple(f"{root}/{n}" for n in r["latest_names"] or ())
                self.found[key] = Latest(paths, r["latest_text"], r["kind"], column) if paths else None
        folders = {p for x in self.found.values() if x for p in x.paths} | {root for (root, _), x in self.found.items() if not x}
        found = layout_source.first_files(spark, sorted(folders)).where(F.col("first_file").isNotNull())
        self.with_data = {r["root"] for r in found.select("root").toLocalIterator()}
        self.searched = folders

    def format(self, path: str) -> str:
        return self.formats.get(path) or super().format(path)

    def column(self, path: str, fmt: str) -> str | None:
        if fmt != PARQUET or path not in self.columns:
            return super().column(path, fmt)
        first = self.columns[path]
        return first if first is not None and first.strip() else None

    def latest(self, path: str, column: str | None) -> Latest | None:
        key = (path, column and column.lower())
        return self.found[key] if key in self.found else super().latest(path, column)

    def has_data(self, path: str) -> bool:
        return path in self.with_data if path in self.searched else super().has_data(path)
