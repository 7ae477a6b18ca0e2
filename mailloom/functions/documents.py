"""Attachment kinds, text decoding and Markdown assembly of decoded documents.

A decoded document is `ARRAY<STRUCT<section_no, section_title, block_no, kind,
text, rows>>`; the assembly functions turn such an array into Markdown, row by
row in the extraction job. The cells of `rows` are JSON values, so a number
stays a number in the structured output. Documents that arrive as tables are
handled line by line in `operators.documents`.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailloom.functions.text import or_empty, strip_space

# --- fixed values -----------------------------------------------------------
KIND_BY_EXTENSION = {
    "pdf": "pdf", "pptx": "pptx", "xlsx": "xlsx", "docx": "docx",
    "txt": "text", "csv": "text", "log": "text", "md": "text",
}
BLOCK_TYPE = (
    "array<struct<section_no:int,section_title:string,block_no:int,kind:string,"
    "text:string,rows:array<array<string>>>>"
)
# ----------------------------------------------------------------------------


def let(value: Column, body) -> Column:
    """Evaluate `value` once per row and hand it to `body`.

    Lambdas of higher-order functions are not covered by common-subexpression
    elimination; without this a value used per element is computed per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def runs(rows: Column, *by: str) -> Column:
    """An array of structs cut where neighbours differ in these fields, in one pass."""

    def cut(r: Column) -> Column:
        def opens(x: Column, i: Column) -> Column:
            new = i == 0
            for field in by:
                new = new | ~x[field].eqNullSafe(F.get(r, i - 1)[field])
            return F.when(new, i)

        def slices(at: Column) -> Column:
            return F.transform(at, lambda p, k: F.slice(r, p + 1, F.coalesce(F.get(at, k + 1), F.size(r)) - p))

        return let(F.filter(F.transform(r, opens), lambda i: i.isNotNull()), slices)

    return let(rows, cut)


def attachment_kind(filename: Column) -> Column:
    """Decoder kind by the last extension, NULL when unsupported."""
    kinds = F.from_json(F.lit(json.dumps(KIND_BY_EXTENSION)), "map<string,string>")
    name = F.substring_index(filename, "/", -1)
    # Leading dots belong to the name: ".txt" has no extension.
    extension = F.regexp_extract(name, r"\A\.*[^.].*\.([^.]*)\z", 1)
    return F.element_at(kinds, F.lower(extension))


def _paired_surrogates(data: Column, little_endian: bool) -> Column:
    low, any_byte = "D[C-F]", ".."
    high, plain = "D[89AB]", "(?:[0-9A-CEF].|D[0-7])"
    if little_endian:
        unit = rf"(?:{any_byte}{plain}|{any_byte}{high}{any_byte}{low})"
    else:
        unit = rf"(?:{plain}{any_byte}|{high}{any_byte}{low}{any_byte})"
    return F.hex(data).rlike(rf"\A{unit}*+\z")


def decode_text(data: Column, strict_parity: bool = False) -> Column:
    """UTF-8, else UTF-16, else ISO-8859-1; then trimmed.

    UTF-16 needs a byte order mark unless `strict_parity` is set, which also
    accepts any well-formed little-endian data.
    """
    text = data.cast("string")
    mark = F.hex(F.substring(data, 1, 2))
    rest = F.substring(data, F.lit(3), F.length(data))
    little = (mark == "FFFE") & _paired_surrogates(rest, True)
    big = (mark == "FEFF") & _paired_surrogates(rest, False)
    decoded = (
        F.when(F.is_valid_utf8(text), text)
        .when(little, F.decode(rest, "UTF-16LE"))
        .when(big, F.decode(rest, "UTF-16BE"))
    )
    if strict_parity:
        unmarked = ~mark.isin("FFFE", "FEFF") & _paired_surrogates(data, True)
        decoded = decoded.when(unmarked, F.decode(data, "UTF-16LE"))
    return strip_space(decoded.otherwise(F.decode(data, "ISO-8859-1")))


def table_line(cells: Column) -> Column:
    clean = F.transform(
        cells,
        lambda x: F.replace(F.replace(or_empty(x), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")),
    )
    return F.concat(F.lit("| "), F.array_join(clean, " | "), F.lit(" |"))


def padded(cells: Column, width: Column) -> Column:
    return F.concat(cells, F.array_repeat(F.lit(""), width - F.size(cells)))


def table_rule(width: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))


def json_string(text: Column) -> Column:
    """Text as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def cell_text(cell: Column) -> Column:
    """What a JSON value shows: a string without quotes, anything else as it is written; empty for NULL."""
    return or_empty(F.try_variant_get(F.try_parse_json(cell), "$", "string"))


def text_rows(rows: Column) -> Column:
    """Rows of JSON values as rows of text."""
    return F.transform(rows, lambda r: F.transform(r, cell_text))


def markdown_table(rows: Column) -> Column:
    """Markdown of ARRAY<ARRAY<STRING>>; the first row is the header."""
    kept = F.filter(rows, lambda r: F.size(r) > 0)
    width = F.array_max(F.transform(kept, lambda r: F.size(r)))

    def render(lines: Column, columns: Column) -> Column:
        ruled = F.concat(
            F.slice(lines, 1, 1), F.array(table_rule(columns)), F.slice(lines, F.lit(2), F.size(lines))
        )
        return F.array_join(ruled, "\n")

    text = let(
        width,
        lambda w: let(
            F.transform(kept, lambda r: table_line(padded(r, w))), lambda lines: render(lines, w)
        ),
    )
    return F.when(F.size(kept) > 0, text).otherwise(F.lit(""))


def visible_rows(rows: Column) -> Column:
    """Rows of JSON values with at least one cell that shows anything."""
    return F.filter(rows, lambda r: F.exists(r, lambda x: strip_space(cell_text(x)) != ""))


def _ordered(blocks: Column, late: str = "notes") -> Column:
    """Blocks by section and position, those of kind `late` at the section's end."""
    keyed = F.transform(
        blocks,
        lambda b: F.struct(
            b["section_no"].alias("s"), (b["kind"] == late).alias("last"), b["block_no"].alias("n"), b.alias("b")
        ),
    )
    return F.transform(F.array_sort(keyed), lambda k: k["b"])


def _shown(b: Column) -> Column:
    """A block as text; a table has rows or, if already rendered, its text."""
    text = strip_space(or_empty(b["text"]))
    return (
        F.when((b["kind"] == "table") & b["rows"].isNotNull(), markdown_table(text_rows(b["rows"])))
        .when((b["kind"] == "notes") & (text != ""), F.concat(F.lit("**Notes:** "), text))
        .otherwise(text)
    )


def _join(parts: Column) -> Column:
    return strip_space(F.array_join(F.filter(parts, lambda p: p != ""), "\n\n"))


def paragraph_markdown(blocks: Column) -> Column:
    """Paragraphs in order, then all tables in order."""
    text = F.filter(blocks, lambda b: b["kind"] != "table")
    tables = F.filter(blocks, lambda b: b["kind"] == "table")
    return _join(F.transform(F.concat(_ordered(text), _ordered(tables)), _shown))


def sectioned_markdown(blocks: Column, label: str, tables_last: bool) -> Column:
    """`## label N` before the first block of every section."""
    late = "table" if tables_last else "notes"
    pairs = F.transform(
        _ordered(blocks, late),
        lambda b: F.struct(b["section_no"].alias("s"), _shown(b).alias("md")),
    )

    def titled(p: Column, before: Column) -> Column:
        title = F.concat(F.lit(f"## {label} "), p["s"].cast("string"))
        return (
            F.when(before.eqNullSafe(p["s"]), p["md"])
            .when(p["md"] == "", title)
            .otherwise(F.concat(title, F.lit("\n\n"), p["md"]))
        )

    def render(p: Column) -> Column:
        before = F.concat(
            F.array(F.lit(None).cast("int")),
            F.transform(F.slice(p, F.lit(1), F.size(p) - 1), lambda x: x["s"]),
        )
        return _join(F.zip_with(p, before, titled))

    return F.when(F.size(blocks) > 0, let(pairs, render)).otherwise(F.lit(""))


def workbook_sheets(blocks: Column) -> Column:
    """ARRAY<STRUCT<sheet, rows>> of the sheets that hold anything; an empty cell is an empty string."""
    sheets = F.transform(
        _ordered(blocks),
        lambda b: F.struct(
            b["section_title"].alias("sheet"),
            F.transform(
                visible_rows(F.coalesce(b["rows"], F.array().cast("array<array<string>>"))),
                lambda r: F.transform(r, lambda x: F.coalesce(F.nullif(x, F.lit("null")), F.lit('""'))),
            ).alias("rows"),
        ),
    )
    return F.filter(sheets, lambda s: F.size(s["rows"]) > 0)


def workbook_markdown(sheets: Column) -> Column:
    return _join(
        F.transform(sheets, lambda s: F.concat(F.lit("## "), s["sheet"], F.lit("\n\n"), markdown_table(text_rows(s["rows"]))))
    )


def workbook_json(sheets: Column) -> Column:
    """Sheets as JSON text; cells are JSON already."""

    def sheet(s: Column) -> Column:
        rows = F.transform(s["rows"], lambda r: F.concat(F.lit("["), F.array_join(r, ","), F.lit("]")))
        return F.concat(F.lit('{"sheet":'), json_string(s["sheet"]), F.lit(',"rows":['), F.array_join(rows, ","), F.lit("]}"))

    return F.concat(F.lit('{"sheets":['), F.array_join(F.transform(sheets, sheet), ","), F.lit("]}"))


def document_markdown(kind: Column, blocks: Column) -> Column:
    """Markdown of one decoded attachment by its kind."""
    return (
        F.when(kind == "xlsx", workbook_markdown(workbook_sheets(blocks)))
        .when(kind == "docx", paragraph_markdown(blocks))
        .when(kind == "pptx", sectioned_markdown(blocks, "Slide", tables_last=False))
        .when(kind == "pdf", sectioned_markdown(blocks, "Page", tables_last=True))
        .otherwise(paragraph_markdown(blocks))
    )
