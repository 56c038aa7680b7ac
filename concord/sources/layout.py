"""Directory layouts: format, partition column, latest partition, data files.

Two ways give the names directly below a table's root, one for each scale:

* :func:`child_names` lists one root by the Hadoop file system of its path, without a Spark job;
* :func:`concord.sources.layout_source.children` lists the roots of a whole manifest in one job.

What the names mean is written once, as DataFrame steps over one row per root
(:func:`described`, :func:`latest_by_column`, :func:`latest_by_date`), for both. Over a local
row Catalyst works them out at planning time, so a single pair still runs no job.

**Order.** A partition column has the type that Spark's partition discovery
gives it: whole numbers, else numbers, else timestamps and dates, else text; a
directory of the null partition has no value. ``2023_12`` is text, ``01`` and
``1`` are one number. All directories that hold the greatest value are the
latest partition and are read together.

**Dates.** For profiles that go by date, a directory's date is what stands
behind its first ``=``, as year-month-day with or without leading zeros;
trailing text is ignored, and a text that is no date of the calendar is no date.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
DATA_SUFFIX = ".parquet"
LOG_DIR = "_delta_log"

PARTS = "array<struct<key:string,text:string,name:string>>"


def hidden(name: str) -> bool:
    """Names of a table's bookkeeping: logs, temporary folders, markers, checksums."""
    return name.startswith(("_", "."))


# ------------------------------------------------------------------ listing one root, on the driver


def _path(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _missing(e: Py4JJavaError) -> bool:
    return e.java_exception.getClass().getSimpleName() == "FileNotFoundException"


def child_names(spark: SparkSession, path: str) -> list[str] | None:
    """Names of what lies directly below ``path``, sorted; None if the path is missing."""
    jvm = spark.sparkContext._jvm
    jpath, fs = _path(spark, path)
    try:
        found = fs.listStatus(jpath)
    except Py4JJavaError as e:
        if _missing(e):
            return None
        raise
    # one call for all names, not one for each; they all begin with the root
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)
    text = jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)[1:-1]
    root = fs.makeQualified(jpath).toString().rstrip("/") + "/"
    if not text.startswith(root):
        return [text.rsplit("/", 1)[-1]] if text else []
    return sorted(text[len(root) :].split("," + root))


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a file; False if it is missing."""
    jpath, fs = _path(spark, path)
    try:
        return fs.getFileStatus(jpath).isFile()
    except Py4JJavaError as e:
        if _missing(e):
            return False
        raise


def first_file(path: str, names: Callable[[str], Iterable[str] | None], is_a_file: Callable[[str], bool]) -> str | None:
    """The first data file of a table's own at or below ``path``, in order of name; None if there is none.

    Hidden names are no data, at any level; the search stops at the first file.
    """
    if is_a_file(path):
        return path if path.endswith(DATA_SUFFIX) else None
    open_ = [path.rstrip("/")]
    while open_:
        folder = open_.pop()
        below = [f"{folder}/{n}" for n in names(folder) or () if not hidden(n)]
        for p in below:
            if p.endswith(DATA_SUFFIX) and is_a_file(p):
                return p
        open_ += [p for p in reversed(below) if not is_a_file(p)]
    return None


def has_data_file(spark: SparkSession, path: str) -> bool:
    """Whether a data file of the table's own lies at or below ``path``."""
    return first_file(path, lambda p: child_names(spark, p), lambda p: is_file(spark, p)) is not None


def escaped(path: str) -> str:
    """``path`` as a reader takes it that would read ``[ ] { } * ?`` as a pattern."""
    return "".join("\\" + c if c in "[]{}*?\\" else c for c in path)


def is_delta(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` has a log with commits or checkpoints."""
    return any(is_log_file(n) for n in child_names(spark, f"{path.rstrip('/')}/{LOG_DIR}") or ())


def is_log_file(name: str) -> bool:
    return name.endswith(".json") or ".checkpoint" in name and name.endswith(".parquet")


# ------------------------------------------------------------------ what the names mean


def parts_of(names: Iterable[str]) -> list[dict[str, str]]:
    """The ``key=value`` directories among names; ``text`` is the value without escapes."""
    cut = [(n, *n.split("=", 1)) for n in sorted(names) if "=" in n and not hidden(n)]
    return [{"key": unquote(k), "text": unquote(v), "name": n} for n, k, v in cut]


def local(spark: SparkSession, root: str, names: Iterable[str], **more) -> DataFrame:
    """One root as a frame that needs no job: ``root, parts`` and what else is given."""
    parts = pa.array([parts_of(names)], pa.list_(pa.struct([(c, pa.string()) for c in ("key", "text", "name")])))
    columns = {"root": pa.array([root], pa.string()), "parts": parts, **{c: pa.array([v], pa.string()) for c, v in more.items()}}
    return spark.createDataFrame(pa.table(columns))


_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?$"


def _typed(p: Column) -> Column:
    """A partition's text as each type that discovery tries; null where it is none."""
    text = p["text"]
    whole = F.when(text.rlike(r"^[+-]?[0-9]{1,38}$"), text.try_cast("decimal(38,0)"))
    number = F.when(text.rlike(_NUMBER), F.regexp_replace(text, "[dDfF]$", "").try_cast("double")).when(text.isin("NaN", "Infinity", "-Infinity", "+Infinity"), text.try_cast("double"))
    time = F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9])?$"), text.try_cast("timestamp_ntz"))
    day = F.when(time.isNull() & number.isNull(), text.try_cast("date"))
    return F.struct(
        whole.alias("whole"),
        number.alias("number"),
        day.alias("day"),
        F.coalesce(time, day.cast("timestamp_ntz")).alias("time"),
        text.alias("text"),
        p["name"].alias("name"),
    )


KINDS = ("whole", "number", "day", "time", "text")


def first_column(parts: Column) -> Column:
    """The partition column of a root, by the first of its directories; null when it is not partitioned."""
    return F.get(parts, 0)["key"]


def latest_by_column(roots: DataFrame) -> DataFrame:
    """``roots(root, parts, column)`` with ``kind, latest_text, latest_names`` for its ``column``.

    ``latest_names``: all directories whose value is the greatest. Null where
    no directory has a value of the column.
    """
    own = F.filter("parts", lambda p: (F.lower(p["key"]) == F.lower("column")) & (p["text"] != HIVE_NULL))
    typed = roots.withColumn("_own", F.transform(own, _typed))
    kind = F.lit(None).cast("string")
    for k in reversed(KINDS):
        kind = F.when(F.forall("_own", lambda p: p[k].isNotNull()), k).otherwise(kind)
    typed = typed.withColumn("kind", F.when(F.size("_own") > 0, kind))
    best = F.lit(None).cast("array<string>")
    for k in KINDS:
        top = F.array_max(F.transform("_own", lambda p: p[k]))
        best = F.when(F.col("kind") == k, F.transform(F.filter("_own", lambda p: p[k] == top), lambda p: p["name"])).otherwise(best)
    found = typed.withColumn("latest_names", best)
    text = F.get(F.filter("_own", lambda p: p["name"] == F.get("latest_names", 0)), 0)["text"]
    return found.withColumn("latest_text", text).drop("_own")


def lenient_date(text: Column) -> Column:
    """Year, month and day at the head of a text as a date; null for any other text and for no day of the calendar."""
    head = F.regexp_extract(text, r"^([0-9]+-[0-9]+-[0-9]+)", 1)
    return F.when(head != "", head.try_cast("date"))


def latest_by_date(roots: DataFrame) -> DataFrame:
    """``roots(root, parts)`` with ``latest_date, latest_names`` of the greatest date, whatever the column."""
    dated = F.transform("parts", lambda p: F.struct(lenient_date(p["text"]).alias("day"), p["name"].alias("name")))
    found = roots.withColumn("_dated", dated)
    top = F.array_max(F.transform("_dated", lambda p: p["day"]))
    found = found.withColumn("latest_date", top)
    names = F.transform(F.filter("_dated", lambda p: p["day"] == F.col("latest_date")), lambda p: p["name"])
    return found.withColumn("latest_names", F.when(F.col("latest_date").isNotNull(), names)).drop("_dated")


# ------------------------------------------------------------------ one root


@dataclass(frozen=True)
class Latest:
    """The latest partition of a root: its directories, its value as written, the kind of its column."""

    paths: tuple[str, ...]
    text: str
    kind: str
    column: str | None


def _root_parts(spark: SparkSession, path: str) -> list[str]:
    names = child_names(spark, path)
    if names is None:
        raise FileNotFoundError(f"path does not exist: {path}")
    return names


def root_column(spark: SparkSession, path: str) -> str | None:
    """The first partition column of a root, None when it is not partitioned or missing. No job."""
    parts = parts_of(child_names(spark, path) or ())
    return parts[0]["key"] if parts else None


def root_latest(spark: SparkSession, path: str, column: str | None = None) -> Latest | None:
    """The latest partition of one root, by ``column`` or else by date; None if there is none. No job."""
    frame = local(spark, path, _root_parts(spark, path), column=column)
    root = path.rstrip("/")
    if column is None:
        r = latest_by_date(frame).select("latest_names", F.col("latest_date").cast("string").alias("text")).first()
        kind = "day"
    else:
        r = latest_by_column(frame).select("latest_names", F.col("latest_text").alias("text"), "kind").first()
        kind = r["kind"]
    return Latest(tuple(f"{root}/{n}" for n in r["latest_names"]), r["text"], kind, column) if r["latest_names"] else None
