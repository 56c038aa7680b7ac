"""Quality rules as a short-circuit cascade, in DataFrame expressions alone.

**Measures.** :func:`measure` counts, in one pass without a shuffle, what the
base rules need: words, their code points, symbols, repeated lines and words in
repeated 3-word windows. A window is found again by sorting ``hash | place`` of
all windows of a text as plain longs; windows that meet in the 40 bits of their
hash are compared word by word, and a text in which two different ones met (or
one of more than 2^24 words) is sorted by the words themselves. So the counts
are exact and cost ``n log n`` of a text's words, however often they repeat.

**Cascade.** Every further rule is a condition on the whole text. :func:`ordered`
times each rule on a bounded sample of rows, counts there which rows it rejects,
and takes, one after the other, the rule that rejects most of the rows still
there for its cost. :func:`judge` asks the rules in that order, in one ``CASE``:
a row that a rule rejects never meets the rules behind it. The order decides the
cost alone; the verdict is the same in any order.

**Defined results.** Null text counts as the empty text, which has no words.
Texts may be of any length. Repeated rows and ids are judged row by row, other
columns are kept, those named like an output column are replaced; an empty
table gives an empty result with every rule in the order given.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.llm.store import written

# The characters that end a word, that are symbols, and that count as letters.
SPACE = r"[\x20\x09-\x0D]"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
LETTER = r"[A-Za-z\x{80}-\x{10FFFF}]"
# The start of a line up to the first character of a word.
WORDED_LINE = r"(?m)^[\x20\x09\x0B-\x0D]*+[^\x20\x09-\x0D]"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
PLACE_BITS = 24
_PLACE = (1 << PLACE_BITS) - 1


@dataclass(frozen=True)
class Rule:
    """``rejects(doc)`` is a condition on ``doc["text"]`` and the measures; null counts as not rejected."""

    name: str
    rejects: Callable[[Mapping[str, Column]], Column]


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _chars(text: Column, char: str) -> Column:
    """Number of characters of a class; runs of them go at once."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{char}+", ""))


def _base_failed(d: Mapping[str, Column]) -> Column:
    return (d["n_words"] < 50) | (100 * d["n_repeat_words"] > 50 * d["n_words"])


BASE = Rule("base", _base_failed)

#: The production rules behind the base; shares as whole numbers, so that they are exact.
RULES = (
    Rule("word_length", lambda d: ~d["word_chars"].between(2 * d["n_words"], 12 * d["n_words"])),
    Rule("symbols", lambda d: 10 * d["n_symbols"] > d["n_words"]),
    Rule("dup_lines", lambda d: 2 * d["n_dup_lines"] > _count(d["text"], WORDED_LINE)),
    Rule("letters", lambda d: 10 * _chars(d["text"], LETTER) < 6 * d["word_chars"]),
    Rule("capitals", lambda d: _chars(d["text"], "[A-Z]") > _chars(d["text"], "[a-z]")),
    Rule("exclaimed", lambda d: 2 * _count(d["text"], rf"!(?!{WORD_CHAR})") > d["n_words"]),
)


def _neighbours(s: Column, key: Callable[[Column], Column]) -> Column:
    """The values of a sorted array whose key is that of the value before or behind."""
    return F.filter(s, lambda x, k: (key(x) == key(F.get(s, k - 1))) | (key(x) == key(F.get(s, k + 1))))


def _covered(places: Column) -> Column:
    """Number of words in the 3-word windows that begin at ``places``."""
    return F.size(F.array_distinct(F.concat(places, F.transform(places, lambda p: p + 1), F.transform(places, lambda p: p + 2))))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the longs ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    kept = [c for c in docs.columns if c.lower() not in MEASURES]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    # each step's arrays are used more than once by the next one, so they are not computed anew in a lambda
    words = docs.select(row, text).select(
        "row", "text", F.array_remove(F.split("text", f"{SPACE}+", -1), "").alias("w"), F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD_CHAR)).alias("l")
    )
    w = F.col("w")
    starts = F.slice("w", F.lit(1), F.greatest(F.size("w") - 2, F.lit(0)))
    marked = F.transform(starts, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long")))
    sorted_ = words.select("row", "text", "w", "l", F.sort_array(marked).alias("s"))
    high = lambda x: F.shiftright(x, PLACE_BITS)
    low = lambda x: x.bitwiseAND(F.lit(_PLACE)).cast("int")
    again = sorted_.select("row", "text", "w", "l", _neighbours(F.col("s"), high).alias("d"))
    d = F.col("d")
    at = lambda x, i: F.get(w, low(x) + i)
    met = F.filter(
        d,
        lambda x, k: (high(x) == high(F.get(d, k - 1)))
        & ~((at(x, 0) == at(F.get(d, k - 1), 0)) & (at(x, 1) == at(F.get(d, k - 1), 1)) & (at(x, 2) == at(F.get(d, k - 1), 2))),
    )
    whole = F.sort_array(F.transform(starts, lambda x, i: F.struct(F.struct(x, F.get(w, i + 1), F.get(w, i + 2)).alias("k"), i.alias("i"))))
    # `whole` stands once: its sorted array is bound by a lambda, as a column of its own it would be made for every row
    by_words = F.get(F.transform(F.array(whole), lambda s: F.transform(_neighbours(s, lambda x: x["k"]), lambda x: x["i"])), 0)
    fits = F.size("w") <= _PLACE
    exact = fits & (F.size(met) == 0)
    places = F.when(fits & (F.size("d") == 0), F.array().cast("array<int>")).when(exact, F.transform(d, low)).otherwise(by_words)
    found = again.select("row", "text", "w", "l", places.alias("p"))
    return found.select(
        *[F.col("row")[c].alias(c) for c in kept],
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _chars(F.col("text"), SYMBOL).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("p")).cast("long").alias("n_repeat_words"),
    )


def _doc(text_col: str) -> dict[str, Column]:
    return {"text": F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), **{m: F.col(m) for m in MEASURES}}


def sample_rows(docs: DataFrame, rows: int = 1024, files: int = 8) -> DataFrame:
    """At most ``rows`` rows, the first ones of up to ``files`` input files that lie evenly apart.

    Only those files are opened. A frame that is no plain file scan gives its first rows.
    """
    names = sorted(re.sub(r"^(\w+):///", r"\1:/", f) for f in docs.inputFiles())  # as _metadata writes them
    chosen = sorted({names[i * len(names) // files] for i in range(files)}) if names else []
    try:
        parts = [docs.where(F.col("_metadata.file_path") == f).limit(-(-rows // len(chosen))) for f in chosen]
    except AnalysisException:
        parts = []
    if not parts:
        return docs.limit(rows)
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@dataclass(frozen=True)
class Estimate:
    """What the sample says of a rule: seconds for a pass over it, and the share of its rows that the rule rejects."""

    rule: Rule
    cost: float
    rejected: float


def greedy(costs: Sequence[float], patterns: Mapping[tuple[bool, ...], int]) -> list[int]:
    """Numbers of the rules, each time that with most rejections per cost among the rows still there.

    ``patterns``: which rules reject, with the number of rows. Ties go to the cheaper rule, then to the first.
    """
    left, order, there = list(range(len(costs))), [], dict(patterns)
    while left:
        hits = {r: sum(n for p, n in there.items() if p[r]) for r in left}
        best = min(left, key=lambda r: (-hits[r] / costs[r], costs[r], r))
        order.append(best)
        left.remove(best)
        there = {p: n for p, n in there.items() if not p[best]}
    return order


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample: int = 1024, repeats: int = 2) -> list[Estimate]:
    """``rules`` in the order of the cascade, with the estimates; :data:`BASE` comes before them all.

    Reads at most ``sample`` rows. The cost of a rule is the time of a pass that
    evaluates it on every sampled row, less that of a pass that reads the row alone.
    """
    rows = written(measure(sample_rows(docs.select(F.col(f"`{text_col}`").alias("text")), sample)), "quality-sample")
    doc = _doc("text")
    flags = [F.coalesce(r.rejects(doc), F.lit(False)) for r in rules]

    def seconds(condition: Column) -> float:
        best = float("inf")
        for _ in range(repeats):
            begun = time.perf_counter()
            rows.agg(F.count_if(condition & (F.length("text") >= 0))).first()
            best = min(best, time.perf_counter() - begun)
        return best

    reads = seconds(F.col("n_words") >= 0)
    costs = [max(seconds(f) - reads, 1e-4) for f in flags]
    counted = rows.where(~BASE.rejects(doc)).groupBy(F.array(*flags).alias("p")).count().collect() if rules else []
    patterns = {tuple(r["p"]): r["count"] for r in counted}  # at most as many as sampled rows
    total = max(sum(patterns.values()), 1)
    shares = [sum(n for p, n in patterns.items() if p[k]) / total for k in range(len(rules))]
    return [Estimate(rules[k], costs[k], shares[k]) for k in greedy(costs, patterns)]


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept``; ``rules`` are asked in the order given."""
    kept = [c for c in docs.columns if c.lower() not in (*MEASURES, "base_failed", "kept")]
    if text_col.lower() in (*MEASURES, "base_failed", "kept"):
        raise ValueError(f"the text column may not be named {text_col}")
    measured = measure(docs.select(*[F.col(f"`{c}`") for c in kept]), text_col)
    doc = _doc(text_col)
    verdict = F.when(BASE.rejects(doc), False)
    for r in rules:
        verdict = verdict.when(r.rejects(doc), False)
    return measured.select("*", BASE.rejects(doc).alias("base_failed"), verdict.otherwise(True).alias("kept"))
