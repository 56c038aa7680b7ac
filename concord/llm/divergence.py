"""Divergence of sources by an exact recount of frequent terms through minimal perfect hashes.

Two passes over the texts, both vectorised over the bytes of a batch:

1. **Frequency filter.** Every (language, term) is counted once per document;
   counts are summed by Spark, and terms in ``min_docs`` documents or more are kept.
2. **Recount.** The kept terms of a language are dealt by hash to shards of some
   ``SHARD_TERMS`` terms. Each shard is made a minimal perfect hash: levels of bits in which a
   term that hits a bit alone gets that bit's rank as its slot, the others
   going on to the next level. The term itself, or its digest if it is
   longer, is stored in slot order, so a look-up of any other term is found out.
   The shards lie as a table in the shared folder, and a task reads those of a pass
   and of the languages that it meets. Terms that pass the check add to dense counters, one array
   per group and shard, which leave the task as one row each.

**Bounds.** A shard has a bound on its terms (:func:`shards_of`) and on the bytes of each, so
its size is known; a worker holds at most ``LOADED`` shards at a time. Where a corpus
has more shards than one pass takes (``PASS``), further passes over
the texts count the rest: nothing is dropped at any size. Counters are handed
on when they reach ``COUNTER_BYTES``.

**Numbers.** Shares and divergences are whole numbers, worked out without rounding. Pairs of sources are summed per shard in one matrix
(sources x slots), so a pair costs no row for each term; only shard sums are shuffled.

**Defined results.** Null text, language and source are empty strings. Texts of
any length count whole; repeated rows and ids are documents each; other columns
are ignored. A group without terms has shares like any other (every count 0);
a language without kept terms gives pairs of value 0 and no terms. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concord.llm.store import open_folder, python_workers, written

SHARD_TERMS = 1 << 15  # terms of a shard, on average
KEY_BYTES = 32  # a longer term is stored as its digest
PASS = 128  # shards that one pass over the texts counts
LOADED = 128  # shards that a worker holds (of the languages it meets)
COUNTER_BYTES = 1 << 25
GAMMA = 1.5  # bits of a level for each term that comes to it
SCALE = 1_000_000_000

# Bytes of a term (ASCII letters and all of UTF-8 beyond ASCII), and A-Z in lower case.
_IS_TERM = np.array([chr(b).isascii() and chr(b).isalpha() or b >= 0x80 for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ------------------------------------------------------------------ terms of a batch of texts


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(terms as binary, number of the text that each stands in) of all texts, in order."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    ends = offsets - offsets[0] if len(texts) else np.zeros(1, np.int64)
    inside = _IS_TERM[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < len(raw)]
    begins[heads] = inside[heads]  # a text begins anew
    places = np.flatnonzero(begins)
    letters = _LOWER[raw[inside]]
    starts = np.append(np.cumsum(inside)[places] - 1, len(letters)) if len(places) else np.zeros(1, np.int64)
    terms = pa.Array.from_buffers(pa.large_binary(), len(places), [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(letters)])
    return terms, np.searchsorted(ends, places, side="right") - 1


def _distinct(batch: pa.RecordBatch, group: list[str]) -> tuple[list[tuple], np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(groups, group of each text, distinct terms, term of each occurrence, text of each occurrence)."""
    terms, text = terms_of(batch.column("text"))
    coded = terms.dictionary_encode()
    known: dict[tuple, int] = {}
    of_text = np.array([known.setdefault(k, len(known)) for k in zip(*(batch.column(c).to_pylist() for c in group))], np.int64)
    return list(known), of_text, coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), text


def _named(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))


# ------------------------------------------------------------------ first pass: which terms are kept


def kept_terms(docs: DataFrame, min_docs: int = 3) -> DataFrame:
    """``(lang, term)`` (binary) of the terms in ``min_docs`` or more documents of the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, lang, terms, term, text = _distinct(b, ["lang"])
            if not len(terms):
                continue
            once = np.unique(text * len(terms) + term)  # a term once per document
            pairs, n = np.unique(lang[once // len(terms)] * len(terms) + once % len(terms), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in langs]).take(pa.array(pairs // len(terms))), terms.take(pa.array(pairs % len(terms))).cast(pa.binary()), pa.array(n)],
                names=["lang", "term", "n"],
            )

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, term binary, n bigint")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")


# ------------------------------------------------------------------ minimal perfect hashes


def _hashes(terms: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t, seed) for t in terms), np.uint64, len(terms))


def _mixed(h: np.ndarray, level: int) -> np.ndarray:
    """A hash of the hash for each level (the finaliser of a 64-bit generator)."""
    x = h + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stored_key(term: bytes) -> bytes:
    """What a slot holds of its term: the term, or a mark and its digest if it is longer than ``KEY_BYTES``."""
    return term if len(term) <= KEY_BYTES else b"\0" + hashlib.blake2b(term, digest_size=KEY_BYTES).digest()


class PerfectHash:
    """Slots 0..n-1 of ``n`` distinct terms; any other term gets -1."""

    def __init__(self, seed: int, levels: list[np.ndarray], keys: pa.Array):
        self.seed, self.keys = seed, keys
        self.levels, before = [], 0
        for bits in levels:
            ranks = np.cumsum(np.concatenate([[0], np.bitwise_count(bits)]), dtype=np.int64)[:-1] + before
            before += int(np.bitwise_count(bits).sum())
            self.levels.append((bits, ranks))

    @classmethod
    def build(cls, terms: list[bytes]) -> PerfectHash:
        seed = 0
        while True:
            h, slots = _hashes(terms, seed), np.full(len(terms), -1, np.int64)
            left, levels = np.arange(len(terms)), []
            while len(left) and len(levels) < 64:
                size = max(64, -(-int(GAMMA * len(left)) // 64) * 64)
                place = (_mixed(h[left], len(levels)) % np.uint64(size)).astype(np.int64)
                alone = np.bincount(place, minlength=size) == 1
                levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
                left = left[~alone[place]]
            if not len(left):
                break
            seed += 1  # two terms with one hash
        made = cls(seed, levels, pa.array([], pa.binary()))
        slots = made._slots(h)
        by_slot = np.empty(len(terms), np.int64)
        by_slot[slots] = np.arange(len(terms))
        made.keys = pa.array([stored_key(terms[i]) for i in by_slot], pa.binary())
        made.order = by_slot
        return made

    def _slots(self, h: np.ndarray) -> np.ndarray:
        out, left = np.full(len(h), -1, np.int64), np.arange(len(h))
        for level, (bits, ranks) in enumerate(self.levels):
            place = (_mixed(h[left], level) % np.uint64(len(bits) * 64)).astype(np.int64)
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (ranks[word] + np.bitwise_count(below))[hit]
            left = left[~hit]
        return out

    def slots(self, terms: list[bytes]) -> np.ndarray:
        """The slot of each term, -1 where the stored key is another."""
        out = self._slots(_hashes(terms, self.seed))
        there = np.flatnonzero(out >= 0)
        same = pc.equal(self.keys.take(pa.array(out[there])), pa.array([stored_key(terms[i]) for i in there], pa.binary()))
        out[there[~same.to_numpy(zero_copy_only=False).astype(bool)]] = -1
        return out


def _shard_hash(terms: list[bytes]) -> np.ndarray:
    return (_hashes(terms, 0x5EED) >> np.uint64(1)).astype(np.int64)


SHARD_DDL = "lang string, shard int, seed int, levels array<binary>, keys array<binary>, terms array<binary>"


def perfect_hashes(kept: DataFrame, langs: list[tuple[str, int, int]]) -> DataFrame:
    """One row per shard: the hash, its stored keys and its terms in order of slot.

    ``langs``: (language, shards, number of the first of them). A shard is built by the task that its terms are dealt to.
    """
    spark = kept.sparkSession
    shards = {lang: (n, at) for lang, n, at in langs}
    total = max(1, sum(n for _, n, _ in langs))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, at = (np.array(x, np.int64) for x in zip(*(shards[x] for x in b.column("lang").to_pylist()))) if b.num_rows else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays(
                [b.column("lang"), pa.array((at + _shard_hash(b.column("term").to_pylist()) % n).astype(np.int32)), b.column("term")], names=["lang", "shard", "term"]
            )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(lang, shard, terms):
            p = PerfectHash.build(terms)
            columns = {"lang": [lang], "shard": pa.array([shard], pa.int32()), "seed": pa.array([p.seed], pa.int32())}
            binary = pa.list_(pa.binary())
            columns |= {"levels": pa.array([[bits.tobytes() for bits, _ in p.levels]], binary), "keys": pa.array([p.keys.to_pylist()], binary)}
            return pa.RecordBatch.from_pydict(columns | {"terms": pa.array([[terms[i] for i in p.order]], binary)})

        at, terms = None, []
        for b in batches:
            for lang, shard, term in zip(*(b.column(c).to_pylist() for c in ("lang", "shard", "term"))):
                if at is not None and shard != at[1]:
                    yield made(*at, terms)
                    terms = []
                at = (lang, shard)
                terms.append(term)
        if at is not None:
            yield made(*at, terms)

    numbered = kept.mapInArrow(number, "lang string, shard int, term binary")
    tasks = min(total, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = numbered.repartitionById(tasks, F.col("shard") % tasks).sortWithinPartitions("shard")
    return dealt.mapInArrow(build, SHARD_DDL)


# ------------------------------------------------------------------ second pass: dense counters

_SHARDS: dict[tuple[str, int], PerfectHash] = {}  # of this worker


def _shards(files: str, wanted: list[int]) -> dict[int, PerfectHash]:
    """Shards of the table below ``files``; the worker keeps up to ``LOADED``."""
    import pyarrow.dataset as ds

    missing = [k for k in wanted if (files, k) not in _SHARDS]
    if missing:
        if len(_SHARDS) + len(missing) > LOADED:
            _SHARDS.clear()
            missing = wanted
        fs, path = open_folder(files)
        rows = ds.dataset(path, filesystem=fs, format="parquet").to_batches(columns=["shard", "seed", "levels", "keys"], filter=ds.field("shard").isin(missing), batch_size=4)
        for r in (r for b in rows for r in b.to_pylist()):
            _SHARDS[files, r["shard"]] = PerfectHash(r["seed"], [np.frombuffer(x, np.uint64) for x in r["levels"]], pa.array(r["keys"], pa.binary()))
    return {k: _SHARDS[files, k] for k in wanted}


COUNT_DDL = "lang string, source string, shard int, slots binary, counts binary"


def recount(docs: DataFrame, files: str, langs: list[tuple[str, int, int]], first: int = 0, last: int = 1 << 62) -> DataFrame:
    """``(lang, source, shard, slots, counts)``: counters of the terms in shards ``first`` to ``last - 1``, per task.

    ``slots`` and ``counts`` are longs; only counters that are not 0 come.
    """
    shards = {lang: (n, at) for lang, n, at in langs}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[tuple[str, str, int], np.ndarray] = {}

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source, shard), c in counters.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([source]), pa.array([shard], pa.int32()), pa.array([at.tobytes()], pa.binary()), pa.array([c[at].tobytes()], pa.binary())],
                    names=["lang", "source", "shard", "slots", "counts"],
                )
            counters.clear()

        held = 0
        for b in batches:
            groups, of_text, terms, term, text = _distinct(b, ["lang", "source"])
            if not len(terms):
                continue
            pairs, n = np.unique(of_text[text] * len(terms) + term, return_counts=True)
            group, term = pairs // len(terms), pairs % len(terms)
            names = terms.to_pylist()
            hashed = _shard_hash(names)
            for lang in {x[0] for x in groups} & shards.keys():
                own = np.flatnonzero(np.array([x[0] == lang for x in groups])[group])
                many, at = shards[lang]
                shard_of = at + hashed[term[own]] % many
                here = [int(k) for k in np.unique(shard_of) if first <= k < last]
                for shard, table in _shards(files, here).items():
                    rows = own[shard_of == shard]
                    seen, code = np.unique(term[rows], return_inverse=True)
                    slot = table.slots([names[i] for i in seen])[code]
                    rows, slot = rows[slot >= 0], slot[slot >= 0]
                    for g in np.unique(group[rows]):
                        mine = group[rows] == g
                        key = (*groups[g], shard)
                        if key not in counters:
                            counters[key] = np.zeros(len(table.keys), np.int64)
                            held += counters[key].nbytes
                        counters[key][slot[mine]] += n[rows[mine]]  # a term and group meet once here
            if held > COUNTER_BYTES:
                yield from handed_on()
                held = 0
        yield from handed_on()

    return docs.mapInArrow(run, COUNT_DDL)


# ------------------------------------------------------------------ shares and divergences


def _sum_counts(parts: DataFrame, tasks: int) -> DataFrame:
    """One row per (lang, source, shard): the tasks' counters added up, dealt by shard and source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(0, np.int64)

        def done():
            slots = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]]), pa.array([at[1]]), pa.array([at[2]], pa.int32()), pa.array([slots.tobytes()], pa.binary()), pa.array([total[slots].tobytes()], pa.binary()), pa.array([int(total.sum())])],
                names=["lang", "source", "shard", "slots", "counts", "n"],
            )

        for b in batches:
            for *key, slots, counts in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "shard", "slots", "counts"))):
                if key != at:
                    if at is not None:
                        yield done()
                    at, total = key, np.zeros(0, np.int64)
                slots = np.frombuffer(slots, np.int64)
                if len(slots):
                    if slots[-1] >= len(total):
                        total = np.concatenate([total, np.zeros(slots[-1] + 1 - len(total), np.int64)])
                    total[slots] += np.frombuffer(counts, np.int64)
        if at is not None:
            yield done()

    dealt = parts.repartition(tasks, "lang", "source", "shard").sortWithinPartitions("lang", "source", "shard")
    return dealt.mapInArrow(run, COUNT_DDL + ", n bigint")


def shares(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / (n + v))``, exactly."""
    if len(counts) and int(counts.max()) >= (1 << 63) // SCALE - 1:  # beyond longs: Python's whole numbers
        return np.array([1 + SCALE * (int(c) + 1) // (n + v) for c in counts], np.int64)
    return 1 + SCALE * (counts + 1) // (n + v)


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)^2 / q)``; shares are at most SCALE + 1, so squares fit longs."""
    d = p - q
    return d * d // q


def _first_ranks(values: np.ndarray, slots: np.ndarray, terms: list[bytes], top: int) -> list[int]:
    """Places of the ``top`` largest values, ties by term."""
    if len(values) > top:
        least = np.partition(values, len(values) - top)[len(values) - top]
        at = np.flatnonzero(values >= least)
    else:
        at = np.arange(len(values))
    return sorted(at.tolist(), key=lambda k: (-int(values[k]), terms[slots[k]]))[:top]


PART_DDL = "lang string, source string, part string, item string, value bigint"


def _compare(rows: DataFrame, top: int) -> DataFrame:
    """Per shard: sums of every pair of its language's sources, and each source's ``top`` terms.

    ``rows`` hold, for a shard, one row per source (with the source's ``n``, and ``v``) and one with its terms.
    """

    def shard(sources: list[dict], terms: list[bytes]) -> Iterator[pa.RecordBatch]:
        lang, v = sources[0]["lang"], sources[0]["v"]
        counts = np.zeros((len(sources), len(terms)), np.int64)
        for k, r in enumerate(sources):
            if r["slots"]:
                counts[k, np.frombuffer(r["slots"], np.int64)] = np.frombuffer(r["counts"], np.int64)
        p = np.stack([shares(c, r["n"], v) for c, r in zip(counts, sources)])
        q = shares(counts.sum(axis=0), sources[0]["lang_n"], v)
        names = [r["source"] for r in sources]
        for k, name in enumerate(names):
            sums = divergences(p[k], p).sum(axis=1)
            others = [j for j in range(len(names)) if j != k]
            found = np.flatnonzero((counts[k] > 0) & (p[k] > q))
            values = divergences(p[k][found], q[found])
            first = _first_ranks(values, found, terms, top)
            items = [names[j] for j in others] + [terms[found[x]].decode() for x in first]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(items), pa.string()),
                    pa.array([name] * len(items), pa.string()),
                    pa.array(["pair"] * len(others) + ["term"] * len(first), pa.string()),
                    pa.array(items, pa.string()),
                    pa.array([int(sums[j]) for j in others] + [int(values[x]) for x in first], pa.int64()),
                ],
                names=["lang", "source", "part", "item", "value"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sources, terms = None, [], []
        for b in batches:
            for r in b.to_pylist():
                if r["shard"] != at and at is not None:
                    yield from shard(sources, terms)
                    sources, terms = [], []
                at = r["shard"]
                if r["terms"] is not None:
                    terms = r["terms"]
                else:
                    sources.append(r)
        if at is not None:
            yield from shard(sources, terms)

    return rows.mapInArrow(run, PART_DDL)


def shards_of(terms: int, sources: int) -> int:
    """Shards of a language: some ``SHARD_TERMS`` terms each, and 128 x ``SHARD_TERMS`` cells of its matrix."""
    return -(-terms * max(128, sources) // (128 * SHARD_TERMS))


def audit(
    docs: DataFrame,
    min_docs: int = 3,
    top: int = 200,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of every (language, source) group.

    Part ``pair``: divergence from each other source of the language, summed over all
    kept terms. Part ``term``: the ``top`` terms whose share is above the language's, by their divergence from it.
    One row per language comes to the driver.
    """
    spark = docs.sparkSession
    python_workers(spark)
    named = _named(docs, text_col, lang_col, source_col)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = written(kept_terms(named, min_docs), "divergence-kept")
    groups = written(named.select("lang", "source").distinct(), "divergence-groups")
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s")).join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v")), "lang", "left").collect()
    langs, total = [], 0
    for r in sorted(sizes, key=lambda r: r["lang"]):
        if r["v"]:
            langs.append((r["lang"], shards_of(r["v"], r["s"]), total))
            total += langs[-1][1]
    hashes = written(perfect_hashes(kept, langs), "divergence-hashes")
    files = hashes.inputFiles()[0].rsplit("/", 1)[0] if total else ""
    counted = None
    for first in range(0, max(total, 1), PASS):
        part = recount(named, files, langs, first, first + PASS)
        counted = part if counted is None else counted.union(part)
    counts = written(_sum_counts(counted, tasks), "divergence-counts")

    # every group with its sums, and with each shard of its language: also where it has no count
    n = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left").fillna(0, ["n"])
    v = spark.createDataFrame([(r["lang"], r["v"] or 0) for r in sizes], "lang string, v bigint")
    n = n.join(F.broadcast(v), "lang").withColumn("lang_n", F.sum("n").over(Window.partitionBy("lang")))  # one row per language
    own = n.join(hashes.select("lang", "shard"), "lang").join(counts.drop("n"), ["lang", "source", "shard"], "left")
    own = own.select("shard", "lang", "source", "n", "lang_n", "v", "slots", "counts", F.lit(None).cast("array<binary>").alias("terms"))
    null = {c: F.lit(None).cast(own.schema[c].dataType) for c in own.columns}
    terms = hashes.select(*[F.col(c) if c in ("shard", "lang", "terms") else null[c].alias(c) for c in own.columns])
    parts = min(max(total, 1), tasks)
    dealt = own.union(terms).repartitionById(parts, F.col("shard") % parts).sortWithinPartitions("shard", "source")
    compared = written(_compare(dealt, top), "divergence-parts")

    pairs = compared.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    without = n.where("v = 0").select("lang", "source")
    other = without.select("lang", F.col("source").alias("item"))
    none = without.join(other, "lang").where("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("bigint").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = pairs.unionByName(none).withColumn("rank", rank)
    best = compared.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.unionByName(best).select("lang", "source", "part", "item", "value", "rank")
