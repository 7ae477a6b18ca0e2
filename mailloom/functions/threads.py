"""Splitting a mail body into the individual mails it quotes.

The body is cut with two regular expressions instead of a line loop: one marks
the start of every quoted header block, one finds the blank line that ends it.
Only the per-segment step uses a higher-order function; the header fields are
read after the explode, as scalar columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailloom.functions.text import BLANK, LINE_BREAK_CHARS, or_empty, strip_space

# --- fixed values -----------------------------------------------------------
HEADER_WORDS = "From|Sent|Date|To|Cc|Subject|Importance"
# A From: line opens a block only if a Sent:/Date: line is among the next 5.
LOOKAHEAD_LINES = 5
DIVIDER = "_{5,}"
EXTERNAL_PHRASE = "external email"
# ----------------------------------------------------------------------------

_ANY_BREAK = f"\r\n|[{LINE_BREAK_CHARS[1:]}]"
# Cannot occur in text whose line breaks were made uniform.
_MARK = "\x1e"
_BOUNDARY = (
    rf"(?idm)^{BLANK}*From{BLANK}*:."
    rf"(?=.*(?:\n.*){{0,{LOOKAHEAD_LINES - 1}}}\n{BLANK}*(?:Sent|Date){BLANK}*:.)"
)
_BLANK_LINE = rf"\n{BLANK}*(?:\n|\z)"
_DIVIDER_LINE = rf"(?dm)^{BLANK}*{DIVIDER}{BLANK}*(?:\n|\z)"
_CONTINUATION = rf"(?id){BLANK}*\n(?!{BLANK}*(?:{HEADER_WORDS}){BLANK}*:){BLANK}*"
_LEADING_JUNK = rf"\A(?:{BLANK}*+(?:{DIVIDER}+{BLANK}*+)?+(?:\n|\z))++"
_LABEL_STARS = rf"(?idm)^({BLANK}*)\*+({HEADER_WORDS})\*{{0,3}}({BLANK}*:)\*{{0,3}}"


def uniform_breaks(c: Column) -> Column:
    """Every kind of line break becomes a single LF."""
    return F.regexp_replace(or_empty(c), _ANY_BREAK, "\n")


def split_lines(c: Column) -> Column:
    """Lines of a text; a final line break opens no further line."""
    text = uniform_breaks(c)
    lines = F.split(F.regexp_replace(text, r"\n\z", ""), "\n", -1)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(lines)


def segments(c: Column, relax_markdown: bool = False) -> Column:
    """Element 0 is the text before the first quoted block, the rest one block each."""
    text = uniform_breaks(c)
    if relax_markdown:
        text = F.regexp_replace(text, _LABEL_STARS, "$1$2$3")
    return F.split(F.regexp_replace(text, _BOUNDARY, _MARK + "$0"), _MARK, -1)


def boundaries(c: Column, relax_markdown: bool = False) -> Column:
    """Zero-based line numbers at which quoted blocks start."""
    counts = F.transform(
        segments(c, relax_markdown), lambda s: F.length(s) - F.length(F.replace(s, F.lit("\n"), F.lit("")))
    )
    quoted = F.slice(counts, F.lit(1), F.size(counts) - 1)
    running = F.transform(
        quoted,
        lambda _, i: F.aggregate(F.slice(counts, F.lit(1), i + 1), F.lit(0), lambda a, n: a + n),
    )
    return running


def trim_segment(c: Column) -> Column:
    """Remove blank and divider lines at both ends, then blanks.

    The tail is trimmed on the reversed text so that both passes are anchored
    at the start and stay linear in the length of the text.
    """
    head = F.regexp_replace(c, _LEADING_JUNK, "")
    both = F.reverse(F.regexp_replace(F.reverse(head), _LEADING_JUNK, ""))
    return strip_space(both)


def is_external(c: Column) -> Column:
    return F.lower(c).contains(EXTERNAL_PHRASE)


def thread_units(c: Column, relax_markdown: bool = False) -> Column:
    """ARRAY<STRUCT<is_wrapper, head, body, is_external>>, empty bodies dropped."""

    def cut(segment: Column, position: Column) -> Column:
        pieces = F.when(
            position == 0, F.array(F.lit(""), segment)
        ).otherwise(F.split(segment, _BLANK_LINE, 2))
        return F.struct(
            (position == 0).alias("is_wrapper"), segment.alias("text"), pieces.alias("pieces")
        )

    def shape(unit: Column) -> Column:
        return F.struct(
            unit["is_wrapper"].alias("is_wrapper"),
            F.get(unit["pieces"], F.lit(0)).alias("head"),
            trim_segment(or_empty(F.get(unit["pieces"], F.lit(1)))).alias("body"),
            is_external(unit["text"]).alias("is_external"),
        )

    shaped = F.transform(F.transform(segments(c, relax_markdown), cut), shape)
    return F.filter(shaped, lambda u: u["body"] != "")


def unfold_headers(head: Column) -> Column:
    """One line per header of a block: dividers dropped, wrapped values joined."""
    return F.regexp_replace(F.regexp_replace(head, _DIVIDER_LINE, ""), _CONTINUATION, " ")


def header_value(unfolded: Column, words: str) -> Column:
    """Value of the last header named by one of `words`, `''` when there is none."""
    pattern = rf"(?idms)\A.*^{BLANK}*(?:{words}){BLANK}*:([^\n]*)"
    return strip_space(F.regexp_extract(unfolded, pattern, 1))
