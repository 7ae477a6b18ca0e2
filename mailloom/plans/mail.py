"""The mail pipeline as plans over DataFrames, shared by batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailloom.functions.dates import parse_mail_date, partition_date, timestamp_text
from mailloom.functions.render import content_key, email_metadata, metadata_json, render_email
from mailloom.functions.text import short_hash, thread_id
from mailloom.operators.dedup import with_identity
from mailloom.operators.split import apply_envelope, split_threads
from mailloom.options import Options


def address_units(units: DataFrame, options: Options = Options()) -> DataFrame:
    """Add identity hash, thread, time, day and output key to identified units."""
    subject, date = F.col("subject"), F.col("date_header")
    day = partition_date(F.col("envelope_date"), F.col("source_key"), options.date_source, options.meridiem)
    return (
        units.withColumns(
            {
                "hash8": short_hash(F.col("identity")),
                "thread": thread_id(subject),
                "sent_at": parse_mail_date(date, options.meridiem),
                "send_date": day,
            }
        )
        .withColumn("sent_text", timestamp_text(F.col("sent_at")))
        .withColumn(
            "output_key",
            content_key(
                options.output_prefix,
                F.col("send_date"),
                F.col("thread"),
                F.col("sent_text"),
                subject,
                F.col("hash8"),
            ),
        )
    )


def units_of(emails: DataFrame, options: Options = Options()) -> DataFrame:
    """Individual mails with their identity; no shuffle."""
    return with_identity(apply_envelope(split_threads(emails, options.relax_markdown)))


def content_of(claimed: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """Accepted, addressed units with their page and metadata.

    `refs` has source_key and refs and belongs to the unit 0 of a message.
    """
    if refs is not None:
        refs = refs.select("source_key", F.lit(0).alias("unit_order"), "refs")
        claimed = claimed.join(refs, ["source_key", "unit_order"], "left")
    else:
        claimed = claimed.withColumn("refs", F.lit(None))
    page = render_email(
        *[F.col(c) for c in ("subject", "from_", "to_", "cc", "date_header", "body", "is_external")]
    )
    record = email_metadata(F.col("refs") if refs is not None else None)
    return (
        claimed.withColumn("markdown", page)
        .withColumn("metadata_json", metadata_json(record))
        .drop("body", "refs")
    )
