"""Attachments: selection, guards, extraction and their link to accepted mails."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from mailloom.functions.dates import timestamp_text
from mailloom.functions.documents import (
    attachment_kind,
    decode_text,
    document_markdown,
    workbook_json,
    workbook_sheets,
)
from mailloom.functions.render import REF_TYPE, attachment_key, attachment_metadata, render_attachment
from mailloom.functions.text import or_empty, strip_space
from mailloom.options import Options

# A decoder turns the bytes of one attachment into a list of block dicts with
# the fields of BLOCK_TYPE; missing fields are NULL. Cells of `rows` are plain
# values (text, numbers, truth values, dates), which travel as JSON.
Decoder = Callable[[bytes], list[dict]]

_BLOCK = pa.struct(
    [
        ("section_no", pa.int32()),
        ("section_title", pa.string()),
        ("block_no", pa.int32()),
        ("kind", pa.string()),
        ("text", pa.string()),
        ("rows", pa.list_(pa.list_(pa.string()))),
    ]
)
_DECODED = pa.struct([("blocks", pa.list_(_BLOCK)), ("error", pa.string())])


def is_real_attachment(disposition: Column, filename: Column) -> Column:
    """Marked as an attachment and named; inline parts are not."""
    return (F.lower(or_empty(disposition)) == "attachment") & (or_empty(filename) != "")


def real_attachments(emails: DataFrame) -> DataFrame:
    """One row per kept part of each message."""
    parts = emails.select("source_key", F.explode("parts").alias("part")).select("source_key", "part.*")
    return parts.filter(is_real_attachment(F.col("disposition"), F.col("filename")))


def _useful(filename: Column, size: Column, decoders: Mapping[str, Decoder] | None, options: Options) -> Column:
    return attachment_kind(filename).isin(["text", *(decoders or {})]) & ~oversize(size, options)


def without_useless_bytes(
    emails: DataFrame, decoders: Mapping[str, Decoder] | None = None, options: Options = Options()
) -> DataFrame:
    """Keep the bytes of a message's parts only if they will be decoded, and their `size`.

    Done before mails are stored, so that unsupported and oversize files are
    neither written nor shuffled.
    """
    names = ("part_no", "filename", "content_type", "disposition", "error")

    def slim(p: Column) -> Column:
        size = F.coalesce(F.octet_length(p["data"]), F.lit(0))
        data = F.when(_useful(p["filename"], size, decoders, options), p["data"])
        return F.struct(*(p[c].alias(c) for c in names), size.alias("size"), data.alias("data"))

    return emails.withColumn("parts", F.transform("parts", slim))


def oversize(size: Column, options: Options) -> Column:
    most = options.max_attachment_bytes
    return F.lit(False) if most is None else size > most


def within_size(df: DataFrame, max_bytes: int, size: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, oversize); exactly `max_bytes` is still kept."""
    size = F.octet_length("data") if size is None else size
    small = F.coalesce(size, F.lit(0)) <= max_bytes
    return df.filter(small), df.filter(~small)


def attach_to_top(claimed: DataFrame, parts: DataFrame) -> DataFrame:
    """Parts of messages whose unit 0 was accepted, with that unit's address.

    There is one unit 0 per message, so a message with very many parts only
    skews the parts side, which adaptive execution splits.
    """
    top = claimed.filter("unit_order = 0").select("source_key", "send_date", "thread", "sent_at")
    return parts.join(top, "source_key", "inner")


def _typed(block: dict) -> dict:
    rows = block.get("rows")
    if rows is None:
        return block
    return block | {"rows": [[None if v is None else json.dumps(v, ensure_ascii=False, default=str) for v in row] for row in rows]}


def _decode_stage(decoders: Mapping[str, Decoder]):
    @F.arrow_udf(from_arrow_type(_DECODED))
    def decode(kind: pa.Array, data: pa.Array) -> pa.Array:
        out = []
        for k, d in zip(kind, data):
            if not d.is_valid:
                out.append(None)
                continue
            try:
                found = [_typed(b) for b in decoders[k.as_py()](d.as_py())]
                blocks = pa.array([found], pa.list_(_BLOCK))[0].as_py()
                out.append({"blocks": blocks, "error": None})
            except Exception as problem:  # one bad file must not fail the task
                out.append({"blocks": None, "error": f"{type(problem).__name__}: {problem}"})
        return pa.array(out, _DECODED)

    return decode


def extract_attachments(
    parts: DataFrame, decoders: Mapping[str, Decoder] | None = None, options: Options = Options()
) -> DataFrame:
    """Add kind, markdown, data (JSON text) and error to each part.

    Text is decoded by built-in functions. Other kinds go through the decoder
    given for them, in one Arrow-batched Python stage that receives only the
    bytes it has a decoder for. `markdown` is NULL when unsupported, blank,
    oversize or failed. `size`, if present, is the size before bytes were left out.
    """
    decoders = dict(decoders or {})
    size = F.col("size") if "size" in parts.columns else F.coalesce(F.octet_length("data"), F.lit(0))
    out = parts.withColumn("kind", attachment_kind(F.col("filename"))).withColumn(
        "oversize", oversize(size, options)
    )
    native = (F.col("kind") == "text") & ~F.col("oversize")
    text = F.when(native, decode_text(F.col("data"), options.strict_text_decoding))
    sheets = problem = F.lit(None).cast("string")
    if decoders:
        wanted = F.col("kind").isin(list(decoders)) & ~F.col("oversize")
        out = out.withColumn("decoded", _decode_stage(decoders)(F.col("kind"), F.when(wanted, F.col("data"))))
        blocks, problem = F.col("decoded.blocks"), F.col("decoded.error")
        rendered = document_markdown(F.col("kind"), blocks)
        text = F.when(wanted, rendered).otherwise(text)
        sheets = F.when((F.col("kind") == "xlsx") & blocks.isNotNull(), workbook_json(workbook_sheets(blocks)))
    markdown = F.nullif(strip_space(text), F.lit(""))
    return out.withColumns({"markdown": markdown, "sheet_data": sheets, "extract_error": problem}).drop(
        "decoded", "data"
    )


def render_attachments(extracted: DataFrame, options: Options = Options()) -> DataFrame:
    """Output rows of extracted parts that were joined to their unit 0."""
    key = attachment_key(
        options.output_prefix,
        F.col("send_date"),
        F.col("thread"),
        timestamp_text(F.col("sent_at")),
        F.col("source_key"),
        F.col("part_no"),
        F.col("filename"),
    )
    keyed = extracted.filter(F.col("markdown").isNotNull()).withColumn("output_key", key)
    return keyed.select(
        "source_key",
        "part_no",
        "send_date",
        "filename",
        "content_type",
        "output_key",
        render_attachment(
            F.col("filename"), F.col("source_key"), F.col("content_type"), F.col("markdown")
        ).alias("markdown"),
        attachment_metadata(
            F.col("filename"), F.col("content_type"), F.col("source_key"), F.col("output_key"), F.col("sheet_data")
        ).alias("metadata_json"),
    )


def attachment_refs(attachments: DataFrame) -> DataFrame:
    """source_key and refs: the references of each message's attachments in part order.

    Bounded by a message: all its references come out of one message row.
    """
    ref = F.struct("filename", "output_key", "content_type")
    pairs = F.array_sort(F.collect_list(F.struct(F.col("part_no").alias("o"), ref.alias("v"))))
    return attachments.groupBy("source_key").agg(F.transform(pairs, lambda p: p["v"]).cast(REF_TYPE).alias("refs"))
