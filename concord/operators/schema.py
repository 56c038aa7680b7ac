"""Schema drift: a table's columns as rows, and the difference of two schemas.

A schema is compared as a map ``lower-cased name -> (type, nullable)``; names
that differ only in case collapse and the last one wins. A column differs
when it is on one side only or its (type, nullable) differ. Nullability
counts, though a Parquet scan reports every column nullable, so it can only
differ for frames built in memory or read from table formats that keep it.

Schemas are metadata held by the driver for any table size; the diff is a
handful of rows, returned as a DataFrame for reports and as a status plus
text for verdicts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from concord.operators.compare import FAILED, PASSED

SCHEMA_FRAME = T.StructType(
    [
        T.StructField("column", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("nullable", T.BooleanType(), False),
    ]
)

SCHEMA_DIFF = T.StructType(
    [
        T.StructField("column", T.StringType(), False),
        T.StructField("left_type", T.StringType(), True),
        T.StructField("left_nullable", T.BooleanType(), True),
        T.StructField("right_type", T.StringType(), True),
        T.StructField("right_nullable", T.BooleanType(), True),
    ]
)


def cleaned_schema(df: DataFrame) -> dict[str, tuple[T.DataType, bool]]:
    """``lower(name) -> (type, nullable)``; later fields win on a case clash."""
    return {f.name.lower(): (f.dataType, f.nullable) for f in df.schema.fields}


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


def schema_frame(df: DataFrame) -> DataFrame:
    """One row per column: ``column, data_type, nullable`` (type as Spark's SQL name)."""
    rows = [(n, t.simpleString(), nb) for n, (t, nb) in cleaned_schema(df).items()]
    return _spark(df).createDataFrame(rows, SCHEMA_FRAME)


def schema_differences(left: DataFrame, right: DataFrame) -> list[tuple]:
    """Columns whose (type, nullable) differ or that exist on one side only, sorted by name."""
    a, b = cleaned_schema(left), cleaned_schema(right)
    out = []
    for name in sorted(set(a) | set(b)):
        x, y = a.get(name), b.get(name)
        if x != y:
            out.append(
                (
                    name,
                    x[0].simpleString() if x else None,
                    x[1] if x else None,
                    y[0].simpleString() if y else None,
                    y[1] if y else None,
                )
            )
    return out


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """The differing columns as rows ``column, left_type, left_nullable, right_type, right_nullable``."""
    return _spark(left).createDataFrame(schema_differences(left, right), SCHEMA_DIFF)


def schema_diffs(spark: SparkSession, pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """:func:`schema_diff` of many named pairs as one frame, with the name as ``table``."""
    rows = [(name, *d) for name, (left, right) in pairs.items() for d in schema_differences(left, right)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("table", T.StringType()), *SCHEMA_DIFF.fields]))


def describe_differences(diff: list[tuple]) -> str:
    """Readable text of a diff, e.g. ``o_totalprice: double/true -> decimal(12,2)/true``."""

    def side(t, nb):
        return "absent" if t is None else f"{t}/{str(nb).lower()}"

    return "; ".join(f"{c}: {side(lt, ln)} -> {side(rt, rn)}" for c, lt, ln, rt, rn in diff)


def schema_check(left: DataFrame, right: DataFrame) -> tuple[str, str]:
    """``("Passed", "")`` when the schemas agree, else ``("Failed", diff text)``."""
    diff = schema_differences(left, right)
    return (PASSED, "") if not diff else (FAILED, describe_differences(diff))
