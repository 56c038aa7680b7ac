"""The corpus pipeline: ``documents`` to token ids, in four stages.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of ``documents``.

1. ``toxicity``: documents with a score of ``TOXIC_FROM`` or more go. The model
   is trained on the labelled documents of the stage's input.
2. ``simhash``: of each group of near-duplicates the smallest doc_id stays;
   rows that share an id but not their text are documents each.
3. ``mixing``: every document stays; the files hold them in the order that
   gives each source its target weight.
4. ``bpe``: token ids of whole texts, and the digest of what they decode to.
   ``mix_file`` and ``mix_row`` are a document's place in the order that stage 3
   left (null where the input is no Parquet table).

Null and empty texts pass all stages; an empty table gives an empty result.
Columns of any name pass the first three stages unchanged.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import bpe, mixing, simhash, toxicity
from concord.llm.queries import BYTE_BPE, TOXIC_FROM
from concord.llm.store import python_workers, new_folder


def _free(name: str, docs: DataFrame) -> str:
    """``name``, or a longer one that ``docs`` has no column of."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _quoted(columns: list[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = _free("toxicity", docs)
    scored = toxicity.score(docs, model, out_col=score)
    return scored.where(F.col(score) < TOXIC_FROM).select(*_quoted(docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clash = {c: _free(f"{c}_", docs) for c in docs.columns if c.lower() in mixing.COLUMNS}
    mixed = mixing.in_order(mixing.mix(docs.withColumnsRenamed(clash)))
    return mixed.select(*[F.col(f"`{clash.get(c, c)}`").alias(c) for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = ["doc_id", "lang", "source"]
    try:
        placed = docs.select(
            *kept,
            "text",
            F.concat_ws("-", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1), F.regexp_extract("_metadata.file_name", r"-(c\d+)\.", 1)).alias("mix_file"),
            F.col("_metadata.row_index").alias("mix_row"),
        )
    except AnalysisException:
        placed = docs.select(*kept, "text", F.lit(None).cast("string").alias("mix_file"), F.lit(None).cast("long").alias("mix_row"))
    decoded = bpe.encode(placed, BYTE_BPE, keep_text=False, decoded_col="decoded")
    digest = F.sha2("decoded", 256).alias("decoded_sha256")
    return decoded.select(*kept, "mix_file", "mix_row", F.size("ids").cast("long").alias("n_tokens"), "ids", digest)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: No SQL for a trained model, xxHash fingerprints and BPE: tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    python_workers(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
