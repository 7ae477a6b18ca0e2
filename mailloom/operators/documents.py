"""Documents that arrive as tables of rows, cells or blocks, as whole texts or as tables of ordered lines.

`rows_to_markdown` and the `..._to_documents` operators return one row per document
with its whole text; a task holds one document at a time.

The `..._to_lines` and `..._to_pieces` operators are for documents beyond one value:
one row per line (or per piece, which may hold several lines) with the columns that
order it, streamed by `sinks.write_texts` into one file per document. Shapes that a
line depends on, such as a table's width, are aggregates with a partial step that are
joined back, so a document of any size is spread over tasks like any other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, VariantType

from mailloom.functions import documents as doc
from mailloom.functions.text import or_empty, strip_space

# What joins the rows of a document: lines of tables and sheets, pieces of all others.
LINE_BREAK, PIECE_BREAK = "\n", "\n\n"


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join in which NULL keys meet; the planner chooses whether to broadcast."""
    renamed = right.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return left.join(renamed, same).drop(*[f"__k_{k}" for k in keys])


def rows_to_lines(df: DataFrame, group: list[str], row_no: str, cells: str) -> DataFrame:
    """Markdown tables from rows of ARRAY<STRING> cells, `row_no` unique in its group.

    Columns: group, row_no, sub and line, in that order; the first row (the header) has its rule as sub 1. Rows without
    cells are left out.
    """
    rows = df.filter(F.size(cells) > 0)
    shape = rows.groupBy(*group).agg(F.max(F.size(cells)).alias("__width"), F.min(row_no).alias("__first"))
    line = doc.table_line(doc.padded(F.col(cells), F.col("__width")))
    ruled = F.array(line, doc.table_rule(F.col("__width")))
    lines = F.when(F.col(row_no) == F.col("__first"), ruled).otherwise(F.array(line))
    return _joined(rows, shape, group).select(*group, row_no, F.posexplode(lines).alias("sub", "line"))


def _in_order(order: str, *values: str) -> Column:
    """The values of a group's rows, sorted."""
    return F.array_sort(F.collect_list(F.struct(order, *values)))


def rows_to_markdown(df: DataFrame, group: list[str], row_no: str, cells: str) -> DataFrame:
    """One whole Markdown table per group, in `markdown`; see `rows_to_lines`."""
    tables = df.filter(F.size(cells) > 0).groupBy(*group).agg(_in_order(row_no, cells).alias("__rows"))
    return tables.select(*group, doc.markdown_table(F.transform("__rows", lambda r: r[cells])).alias("markdown"))


def _cell(cells: DataFrame) -> tuple[Column, Column]:
    """A cell's text and its JSON; cells are VARIANT, which keeps numbers and truth values, or become text."""
    kind, cell = cells.schema["cell"].dataType, F.col("cell")
    if isinstance(kind, VariantType):
        return or_empty(cell.cast("string")), F.coalesce(F.to_json(cell), F.lit('""'))
    text = or_empty(cell if isinstance(kind, StringType) else cell.cast("string"))
    return text, doc.json_string(text)


def sheets_to_documents(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Whole workbooks: keys, `markdown` and `data`, the sheets as JSON with typed cells; see `sheets_to_lines`.

    One aggregate: a workbook's cells are sorted once and cut into rows and sheets. Cells that lie by `keys` already are
    not moved again.
    """
    keys = keys or ["doc_id"]
    text, value = _cell(cells)
    place = ("section_no", "row_no", "section_title")
    told = cells.select(*keys, *place, "col_no", text.alias("text"), value.alias("json")).withColumn("shown", strip_space(F.col("text")) != "")
    listed = F.array_sort(F.collect_list(F.struct(*place, "col_no", "text", "json", "shown")))
    books = told.groupBy(*keys).agg(listed.alias("cells"), F.bool_or("shown").alias("shown")).filter("shown")

    def row(r: Column) -> Column:
        first = F.get(r, F.lit(0))
        part = lambda name: F.transform(r, lambda c: c[name]).alias(name)
        return F.struct(first["section_no"].alias("section_no"), first["section_title"].alias("title"), part("text"), part("json"))

    def sheet(s: Column) -> Column:
        title = F.get(s, F.lit(0))["title"]
        table = doc.markdown_table(F.transform(s, lambda r: r["text"]))
        return F.struct(
            F.concat(F.lit("## "), or_empty(title), F.lit("\n\n"), table).alias("md"),
            title.alias("sheet"),
            F.transform(s, lambda r: r["json"]).alias("rows"),
        )

    shown = F.filter(doc.runs(F.col("cells"), *place), lambda r: F.exists(r, lambda c: c["shown"]))
    sheets = F.transform(doc.runs(F.transform(shown, row), "section_no"), sheet)
    markdown = F.array_join(F.transform("sheets", lambda s: s["md"]), PIECE_BREAK)
    return books.select(*keys, sheets.alias("sheets")).select(*keys, markdown.alias("markdown"), doc.workbook_json(F.col("sheets")).alias("data"))


def sheets_to_lines(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Workbooks from cells (section_no, section_title, row_no, col_no, cell).

    Rows must be dense: a cell for each column from 0. Rows without a visible cell are left out, and sheets without such
    rows. Columns: keys, section_no, row_no, sub and line, in that order, and `data`: the row as a JSON array with typed
    cells, NULL on lines that are no row.
    """
    keys = keys or ["doc_id"]
    text, value = _cell(cells)
    # Bounded by a row: its cells are the columns of one sheet.
    rows = (
        cells.select(*keys, "section_no", "section_title", "row_no", "col_no", text.alias("text"), value.alias("json"))
        .groupBy(*keys, "section_no", "section_title", "row_no")
        .agg(
            F.array_sort(F.collect_list(F.struct("col_no", "text", "json"))).alias("cells"),
            F.bool_or(strip_space(F.col("text")) != "").alias("shown"),
        )
        .filter("shown")
        .drop("shown")
    )
    sheets = rows.groupBy(*keys, "section_no").agg(F.max(F.size("cells")).alias("__width"), F.min("row_no").alias("__first"))
    opening = sheets.groupBy(*keys).agg(F.min("section_no").alias("__opening"))
    placed = _joined(rows, _joined(sheets, opening, keys), [*keys, "section_no"])
    width = F.col("__width")
    texts = F.transform("cells", lambda c: c["text"])
    line = doc.table_line(doc.padded(texts, width))
    data = F.concat(F.lit("["), F.array_join(F.transform("cells", lambda c: c["json"]), ","), F.lit("]"))
    none = F.lit(None).cast("string")

    def at(sub: int, line: Column, data: Column = none) -> Column:
        return F.struct(F.lit(sub).alias("sub"), line.alias("line"), data.alias("data"))

    own = at(3, line, data)
    title = [at(1, F.concat(F.lit("## "), or_empty(F.col("section_title")))), at(2, F.lit("")), own, at(4, doc.table_rule(width))]
    first = F.col("row_no") == F.col("__first")
    lines = (
        F.when(first & (F.col("section_no") == F.col("__opening")), F.array(*title))
        .when(first, F.array(at(0, F.lit("")), *title))
        .otherwise(F.array(own))
    )
    return placed.select(*keys, "section_no", "row_no", F.inline(lines))


def _shown(blocks: DataFrame, keys: list[str], late: str) -> DataFrame:
    """The texts of blocks, empty ones too: place 1, or 2 for kind `late`, which ends its section."""
    text = strip_space(or_empty(F.col("text")))
    shown = F.when((F.col("kind") == "notes") & (text != ""), F.concat(F.lit("**Notes:** "), text)).otherwise(text)
    place = F.when(F.col("kind") == late, 2).otherwise(1)
    return blocks.select(*keys, place.alias("place"), F.col("block_no").cast("bigint").alias("block_no"), shown.alias("piece"))


def _pieces(blocks: DataFrame, keys: list[str], late: str) -> DataFrame:
    """The texts of blocks that show anything."""
    return _shown(blocks, keys, late).filter("piece <> ''")


def _whole(blocks: DataFrame, keys: list[str], late: str) -> DataFrame:
    """The texts of each group's blocks in order, in `pieces`; without any the array is empty."""
    block = F.when(F.col("piece") != "", F.struct("place", "block_no", "piece"))
    found = _shown(blocks, keys, late).groupBy(*keys).agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    return found.select(*keys, F.transform("blocks", lambda b: b["piece"]).alias("pieces"))


def _sectioned(blocks: DataFrame, keys: list[str], late: str, label: str) -> DataFrame:
    sections = _whole(blocks, [*keys, "section_no"], late)
    title = F.concat(F.lit(f"## {label} "), F.col("section_no").cast("string"))
    texts = sections.select(*keys, "section_no", F.array_join(F.concat(F.array(title), "pieces"), PIECE_BREAK).alias("text"))
    found = texts.groupBy(*keys).agg(_in_order("section_no", "text").alias("sections"))
    return found.select(*keys, F.array_join(F.transform("sections", lambda s: s["text"]), PIECE_BREAK).alias("markdown"))


def _titled(blocks: DataFrame, keys: list[str], late: str, label: str) -> DataFrame:
    sections = [*keys, "section_no"]
    title = F.concat(F.lit(f"## {label} "), F.col("section_no").cast("string"))
    titles = blocks.select(*sections).distinct().select(
        *sections, F.lit(0).alias("place"), F.lit(0).cast("bigint").alias("block_no"), title.alias("piece")
    )
    return titles.unionByName(_pieces(blocks, sections, late))


def paragraphs_to_pieces(blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Word-processor documents: paragraphs, then all tables. Columns: keys, place, block_no and piece.

    Blocks have block_no, kind and text; a table block carries its finished Markdown in `text`.
    """
    return _pieces(blocks, keys or ["doc_id"], "table")


def slides_to_pieces(blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Decks: a heading per slide, shapes in order, notes last. Columns: keys, section_no, place, block_no and piece."""
    return _titled(blocks, keys or ["doc_id"], "notes", "Slide")


def pages_to_pieces(blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Paged documents: a heading per page even if blank, text, then tables. Columns as of slides."""
    return _titled(blocks, keys or ["doc_id"], "table", "Page")


def paragraphs_to_documents(blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Whole word-processor documents: keys and `markdown`, which is empty if no block shows anything."""
    keys = keys or ["doc_id"]
    return _whole(blocks, keys, "table").select(*keys, F.array_join("pieces", PIECE_BREAK).alias("markdown"))


def slides_to_documents(blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Whole decks: keys and `markdown`."""
    return _sectioned(blocks, keys or ["doc_id"], "notes", "Slide")


def pages_to_documents(blocks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Whole paged documents: keys and `markdown`."""
    return _sectioned(blocks, keys or ["doc_id"], "table", "Page")
