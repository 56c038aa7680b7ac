"""Toxicity by a counterfactually regularised classifier.

A logistic model over the words of a document, and their beginnings, present
or not. It is fitted to labelled documents under one more penalty: wherever a
labelled sentence names a group of people, the name is swapped for others of
its kind, and every change of the score that this causes costs the square of
the change (counterfactual logit pairing). So a term that only happens to
stand in toxic sentences cannot carry the verdict, and neutral mentions of a
group are not flagged for it.

The fit sees ``sample_rows`` documents of either class at most (a documented
bound; the smallest hashes of their ids) and ``features`` features, chosen by
Spark from all features of the sample; only that table of numbers reaches the
driver. Scoring covers every whole text, one pass and no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.bpe import _slices
from concord.llm.store import python_workers, written

# Terms that name groups of people, by kind; a term is swapped for others of its kind.
IDENTITY_TERMS = {
    "religion": ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"],
    "religions": ["christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"],
    "origin": ["african", "american", "arab", "asian", "chinese", "european", "german", "indian", "mexican", "polish", "russian", "turkish"],
    "color": ["black", "white", "brown"],
    "gender": ["man", "woman"],
    "genders": ["men", "women"],
    "orientation": ["gay", "lesbian", "bisexual", "heterosexual", "transgender"],
    "standing": ["immigrant", "refugee", "native", "foreigner"],
    "standings": ["immigrants", "refugees", "natives", "foreigners"],
    "condition": ["blind", "deaf", "disabled", "autistic", "healthy"],
    "de": ["christen", "muslime", "juden", "frauen", "männer", "ausländer", "flüchtlinge", "deutsche"],
    "fr": ["chrétiens", "musulmans", "juifs", "femmes", "hommes", "étrangers", "réfugiés", "français"],
    "es": ["cristianos", "musulmanes", "judíos", "mujeres", "hombres", "extranjeros", "refugiados", "españoles"],
}
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")
_BEGINNINGS = (4, 5, 6)
_PIECE = 1 << 20


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of about a million characters, cut between words."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        while end < len(text) and _WORD.match(text[end]):
            end += 1
        yield text[at:end]
        at = end


def words(text: str | None) -> set[str]:
    """The different words of a whole text, in lower case."""
    out: set[str] = set()
    for piece in _pieces(text or ""):
        out.update(_WORD.findall(piece.lower()))
    return out


def word_features(word: str) -> list[str]:
    """A word and its beginnings (``idio*``)."""
    return [word, *(word[:k] + "*" for k in _BEGINNINGS if len(word) > k)]


def swaps(text: str | None, terms: dict[str, list[str]], turns: int = 3) -> list[tuple[set[str], set[str]]]:
    """For each of ``turns`` swaps of a text's identity terms: (words of the sentences before, after)."""
    after = {t: [kind[(k + turn) % len(kind)] for turn in range(1, turns + 1)] for kind in terms.values() for k, t in enumerate(kind)}
    before, now = set(), [set() for _ in range(turns)]
    for sentence in _SENTENCE.findall((text or "").lower()):
        found = _WORD.findall(sentence)
        if any(w in after for w in found):
            before.update(found)
            for turn in range(turns):
                now[turn].update(after[w][turn] if w in after else w for w in found)
    return [(before, x) for x in now if x != before]


@dataclass
class Model:
    """Weights of features, and the score of a document without any."""

    weights: dict[str, float]
    bias: float
    _known: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self._index = {f: k for k, f in enumerate(self.weights)}
        self._values = np.array([*self.weights.values()], float)

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias}

    def __setstate__(self, state):
        self.__init__(**state)

    def _features(self, word: str) -> tuple[int, ...]:
        found = self._known.get(word)
        if found is None:
            if len(self._known) >= 1 << 16:
                self._known.clear()
            found = self._known[word] = tuple(self._index[f] for f in word_features(word) if f in self._index)
        return found

    def logit(self, words_: set[str]) -> float:
        here: set[int] = set()
        for w in words_:
            if found := self._features(w):
                here.update(found)
        return self.bias + float(self._values[sorted(here)].sum())

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(words(text)), -700, 700))))


def fit_weights(
    x: np.ndarray, y: np.ndarray, sample: np.ndarray, difference: np.ndarray, l2: float, counterfactual: float, rounds: int = 400
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise log loss, ``l2`` and the counterfactual penalty.

    ``difference``: a row of features before less features after for each swap;
    ``sample``: the weight of each row.
    """
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    m, v = np.zeros(x.shape[1] + 1, np.float32), np.zeros(x.shape[1] + 1, np.float32)
    sample = (sample / sample.sum()).astype(np.float32)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -60, 60)))
        gap = sample * (p - y)
        grad = x.T @ gap + l2 * w
        if len(difference):
            grad += counterfactual * 2 / len(difference) * (difference.T @ (difference @ w))
        g = np.append(grad, gap.sum()).astype(np.float32)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8) * (1 - (t - 1) / rounds)
        w, b = w - step[:-1], b - float(step[-1])
    return w, b


def held_out(id_: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = 4000,
    features: int = 2048,
    min_docs: int = 4,
    min_z: float = 4.0,
    l2: float = 1e-5,
    counterfactual: float = 10.0,
    terms: dict[str, list[str]] | None = None,
) -> Model:
    """A model of ``label_col`` (0/1) from the labelled documents that are not held out.

    Labels that are null or not 0/1 are ignored, and of repeated labels the
    larger counts. A feature is used if it stands in ``min_docs`` documents of the
    sample and its shares of the classes differ by ``min_z`` standard errors; of
    those the ``features`` clearest, and the identity terms. With one class only, or none, the model has no features and
    its score is 1 or 0 (0 without labels).
    """
    spark = docs.sparkSession
    python_workers(spark)
    terms = IDENTITY_TERMS if terms is None else terms
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    marked = marked.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return Model({}, -40.0 if not counts.get(1) else 40.0)
    picked = [marked.where(F.col("y") == k).orderBy(F.xxhash64("id"), "id").limit(sample_rows) for k in (0, 1)]
    # a sample of 2 x sample_rows narrow rows; its texts are joined by id
    sample = written(texts.join(F.broadcast(picked[0].unionByName(picked[1])), "id"), "toxicity-sample")

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))]))
        of = lambda words_: sorted({f for w in words_ for f in word_features(w)})
        for batch in batches:
            for part in _slices(batch, "text", 1 << 19):
                texts_ = part.column("text").to_pylist()
                found = [of(words(t)) for t in texts_]
                flip = [[{"before": of(a), "after": of(b)} for a, b in swaps(t, terms)] for t in texts_]
                yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(found, pa.list_(pa.string())), pa.array(flip, kinds)], ["y", "found", "flip"])

    schema = "y int, found array<string>, flip array<struct<before: array<string>, after: array<string>>>"
    rows = written(sample.select("y", "text").mapInArrow(present, schema), "toxicity-features")
    per = rows.select("y", F.explode("found").alias("f")).groupBy("f").agg(F.sum("y").alias("n1"), F.count(F.lit(1)).alias("n"))
    size = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return Model({}, float(np.log((counts[1] + 0.5) / (counts[0] + 0.5))))
    share_of, gap = F.col("n") / (n1 + n0), F.abs(F.col("n1") / n1 - (F.col("n") - F.col("n1")) / n0)
    z = gap / F.sqrt(F.greatest(share_of * (1 - share_of), F.lit(0.5 / (n1 + n0))) * (1 / n1 + 1 / n0))
    best = per.where((F.col("n") >= min_docs) & (z >= min_z)).orderBy(z.desc(), "f").limit(features).select("f")
    names = {r["f"] for r in best.collect()}
    moved = rows.where(F.size("flip") > 0)
    known = [t for kind in terms.values() for t in kind]
    touched = moved.select(F.explode(F.concat(F.flatten("flip.before"), F.flatten("flip.after"))).alias("f")).where(F.col("f").isin(known))
    names |= {r["f"] for r in touched.distinct().collect()}  # identity terms only: as many as there are terms at most
    vocabulary = sorted(names)
    only = F.array(*[F.lit(f) for f in vocabulary])
    bounded = rows.select(
        "y",
        F.array_intersect("found", only).alias("found"),
        F.transform("flip", lambda x: F.struct(F.array_intersect(x["before"], only).alias("before"), F.array_intersect(x["after"], only).alias("after"))).alias("flip"),
    )
    index = {f: k for k, f in enumerate(vocabulary)}
    got = bounded.toArrow().to_pylist()
    x = np.zeros((len(got), len(vocabulary)), np.float32)
    for k, r in enumerate(got):
        x[k, [index[f] for f in r["found"]]] = 1
    difference = np.zeros((sum(len(r["flip"]) for r in got), len(vocabulary)), np.float32)
    for k, d in enumerate(d for r in got for d in r["flip"]):
        difference[k, [index[f] for f in d["before"]]] += 1
        difference[k, [index[f] for f in d["after"]]] -= 1
    difference = difference[np.abs(difference).any(axis=1)]
    y = np.array([r["y"] for r in got], np.float32)
    share = np.where(y == 1, counts[1] / total / n1, counts[0] / total / n0)
    w, b = fit_weights(x, y, share, difference, l2, counterfactual)
    return Model({f: float(w[k]) for f, k in index.items()}, b)


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """``docs`` with ``out_col double``, from 0 to 1, the higher the likelier toxic.

    Null, empty and word-less texts have the score of a document without
    features. Other columns are passed on; one named like ``out_col`` is
    replaced. Row count and partitions stay.
    """
    spark: SparkSession = docs.sparkSession
    python_workers(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by the number of features
    docs = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() != out_col.lower()])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value.score
        for batch in batches:
            for part in _slices(batch, text_col):
                scores = pa.array([judge(t) for t in part.column(text_col).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [scores], [*names, out_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out_col, T.DoubleType())]))
