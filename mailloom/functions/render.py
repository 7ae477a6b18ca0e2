"""Object keys, Markdown pages and metadata records as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailloom.functions.text import SLUG_CHARS, STEM_SLUG_CHARS, key_stem, or_empty, slugify, strip_space

# --- fixed values -----------------------------------------------------------
SCHEMA_VERSION = 1
NO_SUBJECT_TITLE = "(no subject)"
EXTERNAL_BANNER = "> **EXTERNAL EMAIL**"
HARD_BREAK = "  "
CONTENT_FOLDER, ATTACHMENTS_FOLDER = "content/", "attachments/"
# ----------------------------------------------------------------------------

# Hexadecimal digits of the digest that ends an attachment's key.
PART_CHARS = 16

REF_TYPE = "array<struct<filename:string,output_key:string,content_type:string>>"
_PRETTY = {"ignoreNullFields": "false", "pretty": "true"}


def content_key(
    root: str | Column, date: Column, thread: Column, timestamp: Column, subject: Column, hash8: Column
) -> Column:
    name = F.concat_ws("__", thread, timestamp, slugify(subject), hash8)
    return F.concat(_column(root), F.lit(CONTENT_FOLDER), date, F.lit("/"), name, F.lit(".md"))


def attachment_key(
    root: str | Column, date: Column, thread: Column, timestamp: Column, source_key: Column, part_no: Column, filename: Column
) -> Column:
    """Names are cut and folded, so the end of the key is a digest of the message's key and the part's number."""
    part = F.substring(F.sha2(F.concat_ws("/", source_key, part_no.cast("string")), 256), 1, PART_CHARS)
    name = F.concat_ws(
        "__", thread, timestamp, slugify(key_stem(source_key), STEM_SLUG_CHARS), slugify(filename, SLUG_CHARS), part
    )
    return F.concat(_column(root), F.lit(ATTACHMENTS_FOLDER), date, F.lit("/"), name, F.lit(".md"))


def _column(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _labelled(label: str, value: Column) -> Column:
    return F.when(value != "", F.concat(F.lit(f"**{label}:** "), value, F.lit(HARD_BREAK)))


def _page(*lines: Column) -> Column:
    # concat_ws leaves NULL lines out.
    return F.concat(strip_space(F.concat_ws("\n", *lines)), F.lit("\n"))


def render_email(
    subject: Column, from_: Column, to_: Column, cc: Column, date: Column, body: Column, external: Column
) -> Column:
    title = F.when(subject != "", subject).otherwise(F.lit(NO_SUBJECT_TITLE))
    return _page(
        F.concat(F.lit("# "), title),
        F.lit(""),
        F.when(external, F.lit(EXTERNAL_BANNER + "\n")),
        _labelled("From", from_),
        _labelled("To", to_),
        _labelled("Cc", cc),
        _labelled("Date", date),
        F.lit("\n---\n"),
        strip_space(body),
    )


def render_attachment(filename: Column, source_key: Column, content_type: Column, text: Column) -> Column:
    return _page(
        F.concat(F.lit("# Attachment: "), filename),
        F.lit(""),
        F.concat(F.lit("**Source email:** `"), source_key, F.lit("`" + HARD_BREAK)),
        F.concat(F.lit("**Content type:** "), content_type, F.lit(HARD_BREAK)),
        F.lit("\n---\n"),
        strip_space(text),
    )


def email_metadata(refs: Column | None = None) -> Column:
    """Metadata record of an accepted unit; reads the unit columns by name."""
    empty = F.array().cast(REF_TYPE)
    return F.struct(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.col("identity"),
        F.col("message_id"),
        F.col("source_key"),
        F.col("output_key"),
        F.col("unit_order").alias("order"),
        F.col("is_wrapper"),
        F.col("is_external"),
        or_empty(F.col("subject")).alias("subject"),
        or_empty(F.col("from_")).alias("from"),
        or_empty(F.col("to_")).alias("to"),
        or_empty(F.col("cc")).alias("cc"),
        or_empty(F.col("date_header")).alias("date"),
        (empty if refs is None else F.coalesce(refs, empty)).alias("attachments"),
    )


def metadata_json(record: Column) -> Column:
    """Indented JSON that keeps NULL fields and non-ASCII text."""
    return F.to_json(record, _PRETTY)


def attachment_metadata(
    filename: Column, content_type: Column, source_key: Column, output_key: Column, data: Column | None = None
) -> Column:
    """JSON metadata of an attachment; `data` (JSON text) appears only if present."""
    fields = [
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        filename.alias("filename"),
        content_type.alias("content_type"),
        source_key.alias("source_key"),
        output_key.alias("output_key"),
    ]
    plain = metadata_json(F.struct(*fields))
    if data is None:
        return plain
    # `data` is already JSON, so it is spliced in before the closing brace.
    joined = F.concat(
        F.regexp_replace(plain, r"\s*\}\s*\z", ""), F.lit(',\n  "data" : '), data, F.lit("\n}")
    )
    return F.coalesce(joined, plain)
