"""From one row per message to one row per individual mail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.functions.threads import header_value, thread_units, unfold_headers

ENVELOPE = ("message_id", "from_", "to_", "cc", "subject", "date_header")
# Header words of a quoted block for each unit column.
_QUOTED = {"from_": "From", "to_": "To", "cc": "Cc", "subject": "Subject", "date_header": "Sent|Date"}


def split_threads(emails: DataFrame, relax_markdown: bool = False) -> DataFrame:
    """Explode each message into its units, numbered from 0 without gaps.

    Needs the envelope columns and `body`; every other column is carried along.
    Units keep the message's envelope and their own quoted headers as structs,
    see `apply_envelope`. No shuffle.
    """
    carried = [c for c in emails.columns if c not in (*ENVELOPE, "body")]
    exploded = emails.select(
        *carried,
        F.struct(*ENVELOPE).alias("envelope"),
        F.posexplode(thread_units(F.col("body"), relax_markdown)).alias("unit_order", "unit"),
    )
    folded = exploded.withColumn("head", unfold_headers(F.col("unit.head")))
    return folded.select(
        *carried,
        "unit_order",
        "unit.is_wrapper",
        "unit.is_external",
        "envelope",
        F.struct(*[header_value(F.col("head"), w).alias(c) for c, w in _QUOTED.items()]).alias("headers"),
        "unit.body",
    )


def apply_envelope(units: DataFrame) -> DataFrame:
    """The wrapper takes the message's id and headers, a quoted unit its own.

    `envelope_date` keeps the message's date header on every unit.
    """
    carried = [c for c in units.columns if c not in ("envelope", "headers")]
    wrapper = F.col("is_wrapper")
    return units.select(
        *carried,
        F.when(wrapper, F.col("envelope.message_id")).alias("message_id"),
        *[
            F.when(wrapper, F.coalesce(F.col(f"envelope.{c}"), F.lit(""))).otherwise(F.col(f"headers.{c}")).alias(c)
            for c in _QUOTED
        ],
        F.col("envelope.date_header").alias("envelope_date"),
    )
