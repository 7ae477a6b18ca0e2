"""HTML mail bodies to Markdown, as a chain of built-in string expressions.

Lists inside lists and preformatted blocks are handled approximately (see
README), inline tags that do not pair up within a block are dropped; everything else follows the usual ATX Markdown
rendering: one blank line between blocks, images and page furniture dropped.
"""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailloom.functions.text import or_empty, strip_space

# --- fixed values -----------------------------------------------------------
DROPPED_ELEMENTS = ("script", "style", "head", "title")
BLOCK_TAGS = "p|div|article|section|ul|ol"
SPACED_TAGS = (
    BLOCK_TAGS + "|blockquote|li|h[1-6]|table|thead|tbody|tr|td|th|br|hr|html|body|nav|header|footer|main"
)
INLINE_MARKS = (("code", "`"), ("em|i", "*"), ("b|strong", "**"), ("del|s", "~~"))
# Tags that say nothing in Markdown and may stand anywhere inside a line.
NEUTRAL_TAGS = "span|font|u|small|big|sub|sup|abbr|label|center|ins|mark|tt|cite|q|wbr|bdi|bdo|time|var|kbd|samp"
# ----------------------------------------------------------------------------

_NAMED = {**{k: chr(v) for k, v in name2codepoint.items()}, "apos": "'"}
# Stands for the # signs of a heading until the level is written out.
_LEVEL = "\x1e"


def _open(tag: str) -> str:
    return rf"<(?:{tag})(?:\s[^>]*)?/?>"


def _close(tag: str) -> str:
    return rf"</(?:{tag})\s*>"


def _inline(tag: str) -> str:
    """Anything up to the tag's end that opens or closes no block; possessive, so long texts do not recurse."""
    return rf"(?:[^<]++|<(?!/?(?:{SPACED_TAGS})[\s/>]|/{tag}\s*>))*+"


def _sub(c: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, "(?is)" + pattern, to)


def _per_block(c: Column, tag: str, render) -> Column:
    """Apply `render` to the inside of every `<tag>…</tag>`."""

    def piece(text: Column, position: Column) -> Column:
        inside = F.split(text, "(?i)" + _close(tag), 2)
        rest = or_empty(F.get(inside, F.lit(1)))
        return F.when(position == 0, text).otherwise(
            F.concat(F.lit("\n\n"), render(F.get(inside, F.lit(0))), F.lit("\n\n"), rest)
        )

    # No test for the tag first: that would evaluate `c`, the whole chain so
    # far, once more per test. Without the tag there is just one piece.
    return F.array_join(F.transform(F.split(c, "(?i)" + _open(tag), -1), piece), "")


def _numbered(inside: Column) -> Column:
    items = F.split(inside, "(?i)" + _open("li"), -1)
    return F.array_join(
        F.transform(items, lambda t, i: F.when(i == 0, t).otherwise(F.concat(i.cast("string"), F.lit(". "), t))),
        "",
    )


def _quoted(inside: Column) -> Column:
    text = F.regexp_replace(strip_space(inside), r"\n{3,}", "\n\n")
    marked = F.concat(F.lit("> "), F.replace(text, F.lit("\n"), F.lit("\n> ")))
    return F.replace(marked, F.lit("> \n"), F.lit(">\n"))


def _table(inside: Column) -> Column:
    def line(cells: Column) -> Column:
        flat = F.transform(cells, lambda x: strip_space(F.regexp_replace(x, r"(?s)<[^>]*>|\s*\n\s*", " ")))
        return F.concat(F.lit("| "), F.array_join(flat, " | "), F.lit(" |"))

    rows = F.transform(
        F.split(inside, "(?i)" + _close("tr"), -1),
        lambda r: F.regexp_extract_all(r, F.lit(rf"(?is){_open('td|th')}(.*?){_close('td|th')}"), F.lit(1)),
    )
    rows = F.filter(rows, lambda r: F.size(r) > 0)
    width = F.size(F.get(rows, F.lit(0)))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    lines = F.transform(rows, line)
    # Without header cells the first row stays data, under an empty header.
    has_header = inside.rlike(r"(?i)\A.*?<th[\s>]")
    blank = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit(""), width), " | "), F.lit(" |"))
    head = F.when(has_header, F.array(F.get(lines, F.lit(0)), rule)).otherwise(F.array(blank, rule))
    body = F.when(has_header, F.slice(lines, F.lit(2), F.size(lines))).otherwise(lines)
    return F.when(F.size(rows) > 0, F.array_join(F.concat(head, body), "\n")).otherwise(F.lit(""))


def decode_entities(c: Column) -> Column:
    """One pass over `&name;` and `&#n;`, so `&amp;lt;` stays `&lt;`."""
    names = F.from_json(F.lit(json.dumps(_NAMED)), "map<string,string>")

    def piece(text: Column, position: Column) -> Column:
        parts = F.split(text, ";", 2)
        name = F.get(parts, F.lit(0))
        hexed = F.regexp_extract(name, r"\A#[xX]([0-9a-fA-F]{1,6})\z", 1)
        number = F.when(hexed != "", F.conv(hexed, 16, 10).cast("int")).otherwise(
            F.regexp_extract(name, r"\A#([0-9]{1,7})\z", 1).try_cast("int")
        )
        real = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        value = F.coalesce(F.element_at(names, name), F.when(real, char))
        known = (position > 0) & (F.size(parts) == 2) & value.isNotNull()
        return (
            F.when(position == 0, text)
            .when(known, F.concat(value, F.get(parts, F.lit(1))))
            .otherwise(F.concat(F.lit("&"), text))
        )

    return F.array_join(F.transform(F.split(c, "&", -1), piece), "")


def html_to_markdown(c: Column) -> Column:
    # Every pass costs a scan of the text, so patterns are merged where they can be.
    dropped = [rf"<{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in DROPPED_ELEMENTS]
    neutral = rf"</?(?:{NEUTRAL_TAGS})(?:\s[^>]*)?/?>"
    x = _sub(or_empty(c), "|".join(["<!--.*?-->", *dropped, _open("img"), neutral]), "")
    # Blank runs: one space, or one line feed if the run holds a line break.
    x = _sub(x, r"[ \t\r\n]*[\r\n][ \t\r\n]*", "\n")
    x = _sub(x, r"[ \t]{2,}|\t", " ")
    x = _sub(x, rf"\s*(</?(?:{SPACED_TAGS})(?:\s[^>]*)?/?>)\s*", "$1")
    # Markdown's own characters are escaped in text, not inside tags.
    x = _sub(x, r"([*_])(?=[^<>]*(?:<|\z))", r"\\$1")
    x = _sub(x, _open("br"), "  \n")
    # Blanks leave the inside of inline tags, pairs around nothing go; what is left pairs up whatever inline tags it holds.
    paired = "|".join(["a", *(tag for tag, _ in INLINE_MARKS)])
    x = _sub(x, rf"((?:<(?:{paired})(?:\s[^>]*)?>)+)(\s+)|(\s+)((?:</(?:{paired})\s*>)+)", "$2$1$4$3")
    x = _sub(x, rf"<({paired})(?:\s[^>]*)?></\1\s*>", "")
    for tag, mark in INLINE_MARKS:
        x = _sub(x, rf"<({tag})(?:\s[^>]*)?>({_inline(chr(92) + '1')})</\1\s*>", f"{mark}$2{mark}")
    href = r"""href\s*=\s*(?:"([^">]*)"|'([^'>]*)'|([^\s"'>]+))"""
    x = _sub(x, rf"<a\s(?:[^>]*\s)?{href}[^>]*>({_inline('a')}){_close('a')}", "[$4]($1$2$3)")
    x = _sub(x, r"\[([^\]\s]+)\]\(\1\)", "&lt;$1&gt;")
    x = _sub(x, r"<h([1-6])(?:\s[^>]*)?/?>", f"\n\n{_LEVEL}$1 ")
    for level in range(1, 7):
        x = F.replace(x, F.lit(f"{_LEVEL}{level}"), F.lit("#" * level))
    x = _sub(x, _open("hr"), "\n\n---\n\n")
    x = _sub(x, _close("li"), "\n")
    x = _per_block(x, "table", _table)
    x = _per_block(x, "ol", _numbered)
    x = _sub(x, _open("li"), "* ")
    x = _sub(x, rf"</?(?:{BLOCK_TAGS})(?:\s[^>]*)?/?>|</h[1-6]\s*>", "\n\n")
    x = _per_block(x, "blockquote", _quoted)
    x = _sub(x, r"<[!?/a-z][^>]*>", "")
    x = _sub(x, r"\n{3,}", "\n\n")
    # Blank input needs no case of its own: it trims to nothing.
    return strip_space(decode_entities(x))


def best_body(plain: Column, html: Column) -> Column:
    """STRUCT<body, is_markdown>: plain text if it says anything, else converted HTML."""
    has_plain = strip_space(or_empty(plain)) != ""
    has_html = strip_space(or_empty(html)) != ""
    body = F.when(has_plain, plain).when(has_html, html_to_markdown(html)).otherwise(F.lit(""))
    return F.struct(body.alias("body"), (~has_plain & has_html).alias("is_markdown"))
