"""Checks over written outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
CONTENT_KEY_SHAPE = (
    r"^[^/]+/content/([0-9]{4}-[0-9]{2}-[0-9]{2}|undated)/"
    r"[0-9a-f]{8}__[0-9]{8}T[0-9]{6}Z__[a-z0-9-]+__[0-9a-f]{8}\.md$"
)
RAW_TAG = r"</?[a-zA-Z][^<>]*>"
QUOTED_PRINTABLE_RESIDUE = "=20|=3D"
MOJIBAKE = ("Â", "â€™", "Ã©")
# ----------------------------------------------------------------------------

MOJIBAKE_PATTERN = "|".join(MOJIBAKE)


def check_keys(df: DataFrame) -> DataFrame:
    """Per day: keys seen and keys that don't have the documented shape."""
    return df.groupBy("send_date").agg(
        F.count("*").alias("n_keys"),
        F.count_if(~F.col("output_key").rlike(CONTENT_KEY_SHAPE)).alias("bad_keys"),
    )


def check_pairs(pages: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Stems that don't have exactly one page and one sidecar."""
    counts = [
        df.groupBy(F.regexp_replace("output_key", r"\.(md|json)$", "").alias("stem")).agg(F.count("*").alias(name))
        for df, name in ((pages, "n_pages"), (sidecars, "n_sidecars"))
    ]
    both = counts[0].join(counts[1], "stem", "full_outer")
    return both.select(
        "stem", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_pages", "n_sidecars")]
    ).filter("n_pages <> 1 OR n_sidecars <> 1")


def check_residue(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with markup, transfer-encoding or charset residue in their text."""
    flags = {"raw_tag": RAW_TAG, "quoted_printable": QUOTED_PRINTABLE_RESIDUE, "mojibake": MOJIBAKE_PATTERN}
    return df.select(key, *[F.col(text).rlike(p).alias(c) for c, p in flags.items()]).filter(
        " OR ".join(flags)
    )


def check_refs(content_refs: DataFrame, attachments: DataFrame) -> DataFrame:
    """Attachment references that lead nowhere, with the number of mails naming them.

    `content_refs` has `refs`. References are counted per key before the join,
    so one key named by very many mails is one row.
    """
    named = content_refs.select(F.explode("refs.output_key").alias("output_key"))
    counted = named.groupBy("output_key").agg(F.count("*").alias("n_refs"))
    return counted.join(attachments.select("output_key").distinct(), "output_key", "left_anti")
