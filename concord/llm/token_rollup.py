"""Token counts: additive rollups kept up to date by signed batches.

A batch is a set of signed count rows: an insert counts +1 document and +n
tokens, a delete -1 and -n, a revised count the old one with minus and the new
one with plus. A batch is summed by its group keys (source, language, tokenizer
version) and stored as one small table of signed totals; the totals of a state
are the sum over its committed batches, so a batch costs a scan of its own rows
and never of the corpus.

**Commits.** The batch's totals are written to a folder of their own; then a
marker file named after the batch and an attempt, which holds the folder's name, is
created with *fail if it exists*. A marker counts once its text is whole; of a
batch's whole markers the one with the smallest attempt counts, and only folders
that such markers name are read. So a batch that is applied again, by a retry or
by two drivers at once, changes nothing, and a driver lost anywhere leaves no trace
in the totals: before the marker there is none, inside it the marker is
not whole and the retry makes the next attempt. (A driver that was only slow may
still finish its marker; both hold the same batch, and one of them counts.)
``compact`` folds many batches into one base under the same protocol,
and keeps their names, so a late replay is still recognised. A base's marker is
named after its generation, one more than the last base that it saw, so of
compactions that overlap only one counts, whatever batches each saw.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from urllib.parse import quote, unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ("source", "lang", "tokenizer")
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def signed(df: DataFrame, sign: int, tokenizer: str, n_tokens: Column, source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """Signed count rows ``(source, lang, tokenizer, n_docs, n_tokens)`` of documents.

    ``sign`` is 1 for documents that come and -1 for those that go. Null
    sources and languages are groups of their own; a null count counts 0.
    """
    if sign not in (1, -1):
        raise ValueError("sign must be 1 or -1")
    return df.select(
        F.col(source_col).cast("string").alias("source"),
        F.col(lang_col).cast("string").alias("lang"),
        F.lit(tokenizer).alias("tokenizer"),
        F.lit(sign).cast("long").alias("n_docs"),
        (F.coalesce(n_tokens.cast("long"), F.lit(0)) * sign).alias("n_tokens"),
    )


class Rollup:
    """The rollup state below ``folder``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _marker(self, batch: str, attempt: int):
        return self._path(f"{self.folder}/commits/{quote(batch, safe='')}@{attempt}")

    def _read(self, path) -> dict | None:
        """A marker's content; None while its text is not whole."""
        stream = self._fs.open(path)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        try:
            return json.loads(text)
        except json.JSONDecodeError:
            return None

    def _attempts(self) -> dict[str, dict[int, dict | None]]:
        """Batch name -> attempt -> marker; one small file for each batch since the last compaction."""
        root = self._path(f"{self.folder}/commits")
        out: dict[str, dict[int, dict | None]] = {}
        for s in self._fs.listStatus(root) if self._fs.exists(root) else ():
            name, found, attempt = s.getPath().getName().rpartition("@")
            if found:
                out.setdefault(unquote(name), {})[int(attempt)] = self._read(s.getPath())
        return out

    def _markers(self) -> dict[str, dict]:
        """Batch name -> the marker that counts."""
        whole = {b: [m for _, m in sorted(found.items()) if m is not None] for b, found in self._attempts().items()}
        return {b: found[0] for b, found in whole.items() if found}

    def _write(self, stream, text: bytes) -> None:
        stream.write(bytearray(text))
        stream.close()

    def _create(self, batch: str, content: dict) -> bool:
        """Make a marker for ``batch``; False if another one counts."""
        while True:
            found = self._attempts().get(batch, {})
            if any(m is not None for m in found.values()):
                return False
            path = self._marker(batch, max(found, default=-1) + 1)
            try:
                stream = self._fs.create(path, False)
            except Py4JJavaError:
                if self._fs.exists(path):  # another driver was first
                    if self._read(path) is None:
                        time.sleep(0.05)
                    continue
                raise
            self._write(stream, json.dumps(content).encode())
            return self._markers().get(batch) == content

    def committed(self) -> set[str]:
        """Names of the batches that the totals hold."""
        found = self._markers()
        return {b for b in found} | {b for m in found.values() for b in m.get("holds", ())}

    def apply(self, batch: str, rows: DataFrame) -> bool:
        """Add the signed ``rows`` under the name ``batch``; False, and no change, if it is there already."""
        if not batch:
            raise ValueError("a batch needs a name")
        if batch in self.committed():
            return False
        data = f"{self.folder}/data/{uuid.uuid4().hex}"
        delta = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        delta.where("n_docs <> 0 or n_tokens <> 0").write.parquet(data)
        return self._create(batch, {"data": [data]})

    def totals(self) -> DataFrame:
        """``(source, lang, tokenizer, n_docs, n_tokens)`` of all committed batches; empty groups are gone."""
        return self._totals(self._markers())

    def _totals(self, found: dict[str, dict]) -> DataFrame:
        replaced = {b for m in found.values() for b in m.get("holds", ())}
        paths = [p for b, m in found.items() if b not in replaced for p in m["data"]]
        schema = T._parse_datatype_string(TOTALS)
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*sorted(paths))
        sums = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> bool:
        """Fold the batches there are into one; False if another compaction did so first.

        Markers of folded batches stay until a later clean-up of the folder;
        totals skip them, and the base names them, so replays stay without effect.
        """
        found = self._markers()
        replaced = {b for m in found.values() for b in m.get("holds", ())}
        live = sorted(b for b in found if b not in replaced)
        if len(live) < 2:
            return False
        data = f"{self.folder}/data/{uuid.uuid4().hex}"
        self._totals(found).write.parquet(data)  # of these batches, not of those committed since
        held = sorted(set(live) | {b for b in live for b in found[b].get("holds", ())})
        generation = 1 + max(m.get("generation", 0) for m in found.values())
        name = "base:" + uuid.uuid5(uuid.NAMESPACE_OID, f"generation {generation}").hex
        return self._create(name, {"data": [data], "holds": held, "generation": generation})


# ------------------------------------------------------------------ tokenizer versions that SQL can count

WORDS_1 = r"[^\x20\x09-\x0D]+"
WORDS_2 = r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"


def pattern_count(text: Column, pattern: str) -> Column:
    """Number of matches of ``pattern`` in the whole text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))


TOKENIZERS: dict[str, Callable[[Column], Column]] = {
    "words-1": lambda text: pattern_count(text, WORDS_1),
    "words-2": lambda text: pattern_count(text, WORDS_2),
    "bytes-1": lambda text: F.coalesce(F.octet_length(text), F.lit(0)),
}
