"""A training-corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next.

Each stage takes (spark, docs, sf_dir) and returns documents with the same columns, but for the last, which returns
token ids. A stage works on all that its predecessor kept. Rows with a null doc_id or text are treated as each
operator states; no stage crashes on an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailloom.llm import byte_bpe, decontamination, line_crf, secrets, simhash
from mailloom.llm.common import stored, table
from mailloom.llm.queries import tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the line classifier rejects."""
    model = line_crf.trained(docs, table(spark, sf_dir, "labels"))
    return line_crf.keep(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that with the smallest doc_id, of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark window, also of an item without an id; each text is judged by itself."""
    own = F.xxhash64(F.coalesce("text", F.lit("")))
    items = table(spark, sf_dir, "benchmark").select(F.coalesce(F.col("item_id").cast("long"), F.lit(-1)).alias("item_id"), "text")
    found = decontamination.contaminated(docs.select(own.alias("doc_id"), "text"), items).where("n_hit > 0")
    hit = found.select("doc_id").distinct()
    return docs.join(hit, own == hit["doc_id"], "left_anti")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; no document goes."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids' digest, and whether they decode to the text's bytes."""
    return byte_bpe.round_trip(docs, tokenizer())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secret_scan),
    ("encode", encode),
]

#: The stages need a trained classifier, fingerprints and merges, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
