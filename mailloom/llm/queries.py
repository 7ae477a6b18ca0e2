"""The registered queries of the numbered operators; `oracle` has SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailloom.llm import byte_bpe, centroids, decontamination, licenses, line_crf, ranked, repetition, secrets, seed_extend, simhash, suffix_dedup, url_reputation, warc
from mailloom.llm.common import table
from mailloom.llm.oracle import oracle_sql

__all__ = ["oracle_sql", "queries", "tokenizer"]

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def op2_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op3_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(repetition.measure(table(spark, sf_dir, "documents"))).drop("repeats")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op7_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = line_crf.trained(documents, table(spark, sf_dir, "labels"))
    scored = line_crf.score(documents, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= line_crf.THRESHOLD).cast("int").alias("predicted"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.spans_text(base), 256).alias("base_sha256"), secrets.spans_text(F.col("spans")).alias("spans")
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer())


def op10_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return url_reputation.judge(table(spark, sf_dir, "pages"), outcomes).drop("url")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_extend.deduplicate(table(spark, sf_dir, "documents")).drop("removed", "kept")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_suffix_dedup, op2_warc_chunks, op3_repetition_rules, op4_license_scan, op5_decontaminate]
    own += [op6_simhash_groups, op7_line_crf, op8_secret_scan, op9_byte_bpe, op10_url_reputation, op11_centroids, op12_ranked_search, op13_seed_extend]
    return {f.__name__: f for f in own}
