"""Selecting existing message files for processing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailloom.operators.ranking import assign_chunks, text_levels
from mailloom.sources.messages import scan_messages

# Keys that go out together.
CHUNK = 10
# Keys are numbered in runs that agree in so many characters after the prefix: year, month, day, and three of the name.
NAME_LEVELS = (4, 7, 10, 14)


def under(df: DataFrame, prefix: str) -> DataFrame:
    return df.filter(F.col("source_key").startswith(prefix))


def select_keys(keys: DataFrame, prefix: str = "emails/", *more: str) -> DataFrame:
    """Message keys under a prefix, with further columns; the suffix test ignores case."""
    chosen = under(keys, prefix).filter(F.lower("source_key").endswith(".eml"))
    return chosen.select(*more, "source_key") if more else chosen


def backfill(objects: DataFrame, prefix: str = "emails/", dry_run: bool = False) -> DataFrame:
    """Objects to process; a dry run keeps the keys only and reads no content."""
    chosen = select_keys(objects, prefix)
    return chosen.select("source_key") if dry_run else chosen


def requests(keys: DataFrame, bucket: str) -> DataFrame:
    """A notification `body` for each key, as the store itself would send it."""
    named = F.struct(
        F.struct(F.lit(bucket).alias("name")).alias("bucket"), F.struct(F.url_encode("source_key").alias("key")).alias("object")
    )
    record = F.struct(F.lit("ObjectCreated:Backfill").alias("eventName"), named.alias("s3"))
    return keys.select("source_key", F.to_json(F.struct(F.array(record).alias("Records"))).alias("body"))


def enqueue(spark: SparkSession, root: str, bucket: str, queue: str, prefix: str = "emails/", dry_run: bool = False) -> DataFrame:
    """Write a notification for every message file under `root` whose key starts with `prefix` to the folder `queue`.

    Only what the prefix can hold is listed, and no content is read. Returns the counts: found, sent and chunks (of ten
    keys in order). A dry run sends nothing.
    """
    found = backfill(scan_messages(spark, root, prefix=prefix), prefix, dry_run=True)
    none = F.lit(0).cast("bigint")
    counts = found.agg(F.count("*").alias("found")).select("found", none.alias("sent"), none.alias("chunks"))
    if dry_run:
        return counts
    levels = text_levels("source_key", [len(prefix) + n for n in NAME_LEVELS])
    chunks = assign_chunks(requests(found, bucket), CHUNK, ["source_key"], levels)
    chunks.select("chunk_no", "body").write.mode("overwrite").json(queue)
    sent = spark.read.schema("chunk_no bigint, body string").json(queue)
    sent = sent.agg(none.alias("found"), F.count("body").alias("sent"), F.countDistinct("chunk_no").alias("chunks"))
    return counts.unionByName(sent).agg(*[F.sum(c).alias(c) for c in counts.columns])
