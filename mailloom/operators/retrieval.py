"""Reading threads back and selecting outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.functions.text import thread_digest
from mailloom.operators.ranking import text_levels, with_position

THREAD_ORDER = ["sent_text", "hash8", "output_key"]
# Characters of a time text that name its day.
DAY_CHARS = 8
_DIGEST = "__thread"


def thread(content: DataFrame, thread8: str) -> DataFrame:
    """All mails of a thread over all days, oldest first."""
    return content.filter(F.col("thread") == thread8).orderBy(*THREAD_ORDER)


def thread_listing(content: DataFrame, date: str | None = None) -> DataFrame:
    """Mails of a day (or all days) with their place in their thread, from 1.

    A thread is that of the subject's whole digest: two that share the 32 bits shown in keys are numbered apart.
    """
    if date is not None:
        content = content.filter(F.col("send_date") == date)
    # By day, by second, and mails of one second (all undated ones) by the first 12 bits of their digest.
    levels = [*text_levels("sent_text", [DAY_CHARS]), F.col("sent_text"), *text_levels("hash8", [3])]
    listed = with_position(
        content.withColumn(_DIGEST, thread_digest(F.col("subject"))), THREAD_ORDER, ["send_date", _DIGEST], levels
    )
    return listed.withColumn("thread_position", F.col("position") + 1).drop("position", _DIGEST)


def check_prefix(prefix: str | None, output_prefix: str, force: bool = False) -> str:
    """The prefix to clear; outside the output root only if forced."""
    chosen = prefix or output_prefix
    if not force and not chosen.startswith(output_prefix):
        raise ValueError(f"{chosen!r} is outside {output_prefix!r}; pass force=True to clear it")
    return chosen


def latest_pages(pages: DataFrame, key: Sequence[str]) -> DataFrame:
    """Pages as the latest batch wrote them; only what came in several batches is looked up."""
    renamed = [F.col(c).alias(f"__{c}") for c in key]
    seen = pages.groupBy(*renamed).agg(F.max("batch_id").alias("__latest"), F.min("batch_id").alias("__first"))
    stale = seen.filter("__first < __latest").drop("__first")
    same = F.col("batch_id") < F.col("__latest")
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return pages.join(stale, same, "left_anti")


def clear_outputs(
    outputs: DataFrame, output_prefix: str, prefix: str | None = None, force: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, keys to clear)."""
    chosen = check_prefix(prefix, output_prefix, force)
    hit = F.col("output_key").startswith(chosen)
    return outputs.filter(~hit), outputs.filter(hit).select("output_key")
