"""URL rules by a sort-merge range join.

A host's labels in reverse order, ``net.example.a.``, make a key of which every
rule on a parent domain is a prefix: a rule covers an interval of the sorted
keys, and intervals nest. Pages and rules are dealt to cells, ranges of keys,
and sorted; one sweep through a cell keeps the stack of rules whose interval
is open, so a page meets just the rules that cover its host. A rule goes to
every cell that its interval touches.

Cell bounds come from a sample of keys (its size is ``64 x cells``, whatever
the input) and hold a hash of the page id as well as the key, so a host with a
third of all pages is spread over many cells. Results don't depend on them.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.llm.store import python_workers

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = chr(0x10FFFF)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key(host_: Column) -> Column:
    """The host's labels from the last to the first, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host_, r"\.")), "."), F.lit("."))


class Stack:
    """The rules that are open at the place a sweep has reached, outermost host first."""

    def __init__(self):
        self.open: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def move(self, to: str) -> None:
        while self.open and not to.startswith(self.open[-1][0]):
            self.open.pop()

    def rule(self, prefix: str, path_: str, verdict: str, text: str) -> None:
        self.move(prefix)
        if not self.open or self.open[-1][0] != prefix:
            self.open.append((prefix, {}, []))
        _, paths, sizes = self.open[-1]
        if path_ not in paths or verdict == "block":
            paths[path_] = (verdict, text)
        if len(path_) not in sizes:
            bisect.insort(sizes, len(path_))

    def judge(self, key_: str, path_: str) -> tuple[str, str] | None:
        """(verdict, rule) of the longest rule that fits; of equally long ones the longer host's."""
        self.move(key_)
        best = None
        for _, paths, sizes in reversed(self.open):
            for size in reversed(sizes):
                if size <= len(path_) and (found := paths.get(path_[:size])):
                    if best is None or len(found[1]) > len(best[1]):
                        best = found
                    break
        return best


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", cells: int | None = None
) -> DataFrame:
    """``(id, host, path, rule, verdict)``: one row per row of ``pages``.

    ``rules(host, path, verdict)``: a rule fits its host and all subdomains if
    the page's path starts with the rule's. The longest rule text (host and
    path) wins; no rule fits: null and ``default``. Of two rules with one host
    and path ``block`` wins; rules with a null are ignored. A url that is null
    or has no ``://`` has an empty host and path. Repeated and id-less pages
    are judged each by itself; other columns are not looked at.
    """
    spark = pages.sparkSession
    python_workers(spark)
    cells = cells or int(spark.conf.get("spark.sql.shuffle.partitions"))
    url = F.col(url_col).cast("string")
    seen = pages.select(F.col(id_col).alias("id"), host(url).alias("host"), path(url).alias("path"))
    seen = seen.select("*", key(F.col("host")).alias("key"), F.xxhash64("id", "path").alias("salt"))
    rows = seen.count()
    sample = seen.select("key", "salt").sample(min(1.0, 64 * cells / max(rows, 1)), seed=7)
    keys = sorted(tuple(r) for r in sample.collect())
    bounds = sorted({keys[len(keys) * k // cells] for k in range(1, cells)}) if keys else []

    @F.arrow_udf("int")
    def cell(key_: pa.Array, salt: pa.Array) -> pa.Array:
        return pa.array([bisect.bisect_right(bounds, x) for x in zip(key_.to_pylist(), salt.to_pylist(), strict=True)], pa.int32())

    @F.arrow_udf("array<int>")
    def touched(key_: pa.Array) -> pa.Array:
        ends = [(bisect.bisect_left(bounds, (k,)), bisect.bisect_right(bounds, (k + _LAST, 1 << 63))) for k in key_.to_pylist()]
        return pa.array([list(range(a, b + 1)) for a, b in ends], pa.list_(pa.int32()))

    texts = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").dropna()
    opened = (
        texts.select(F.concat("host", "path").alias("rule"), "path", "verdict", key(F.col("host")).alias("key"))
        .withColumn("cell", F.explode(touched("key")))
        .select("cell", "key", F.lit(0).alias("kind"), F.lit(None).cast(seen.schema["id"].dataType).alias("id"), F.lit("").alias("host"), "path", "rule", "verdict")
    )
    none = F.lit(None).cast("string")
    judged = seen.select(cell("key", "salt").alias("cell"), "key", F.lit(1).alias("kind"), "id", "host", "path", none.alias("rule"), none.alias("verdict"))
    merged = opened.unionByName(judged).repartition(cells, "cell").sortWithinPartitions("cell", "key", "kind")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack, at = Stack(), None
        for batch in batches:
            pick, found = [], []
            columns = [batch.column(c).to_pylist() for c in ("cell", "key", "kind", "path", "rule", "verdict")]
            for k, (cell_, key_, kind, path_, rule, verdict) in enumerate(zip(*columns, strict=True)):
                if cell_ != at:
                    stack, at = Stack(), cell_
                if kind == 0:
                    stack.rule(key_, path_, verdict, rule)
                else:
                    pick.append(k)
                    found.append(stack.judge(key_, path_))
            part = batch.take(pa.array(pick, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("host"), part.column("path")]
                + [pa.array([f and f[1] for f in found], pa.string()), pa.array([f[0] if f else default for f in found], pa.string())],
                ["id", "host", "path", "rule", "verdict"],
            )

    out = seen.select("id", "host", "path").schema.add("rule", "string").add("verdict", "string")
    return merged.mapInArrow(sweep, out)
